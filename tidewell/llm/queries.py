"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import exact, language, licenses, lines, minhash, mixing, packing, periodic, quality, substrings, toxicity, trie, warc
from tidewell.llm.shared import stored
from tidewell.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as monolithic archives, normalised to a member per record, and read back by offset."""
    archives = shared_folder(spark, "warc")
    warc.write_monolithic(table(spark, folder, "pages"), archives)
    index = warc.normalise(spark, archives, shared_folder(spark, "warc-members"))
    return warc.read_records(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How often each document is read in the temperature mixture of the sources."""
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "source", "n_tokens", "epochs", "copies", "mix_key")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without later copies of repeated line runs."""
    return lines.repeated_lines(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_removed", "kept_sha256")


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The licence statement of each document."""
    return licenses.scan(table(spark, folder, "documents"))


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents whose 3-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return minhash.near_duplicates(table(spark, folder, "documents"), k=3, percent=85)


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words in windows of 13 that an earlier document has are removed."""
    found = substrings.repeated_windows(table(spark, folder, "documents"), n=13)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256", "longest")


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts, and the document of each that stays."""
    return exact.exact_duplicates(table(spark, folder, "documents"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and the divergence of each document from its language."""
    found = quality.rate(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def shared_openings(turns: DataFrame, most: int = 3, families: int = 20) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first h turns of the first of their family of ids, and go on with their own after h; h = crc32(id) mod 4.

    `turns` are ordered (`conv_id`, `pos`, ...). Returns the steps with their `depth` from 1, and all `conv_id`.
    """
    convs = turns.select("conv_id").distinct().withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1))
    # At most `families` conversations with `most` turns meet a base.
    opening = turns.where((F.col("conv_id") % families == 0) & (F.col("pos") < most)).select(F.col("conv_id").alias("base"), "pos", "h1", "h2", "words")
    begun = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % families).join(opening, "base").where("pos < h")
    begun = begun.select("conv_id", (F.col("pos") + 1).alias("depth"), "h1", "h2", "words")
    given = begun.groupBy("conv_id").agg(F.count(F.lit(1)).alias("given"))
    own = turns.join(convs.join(given, "conv_id", "left"), "conv_id").where("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.coalesce("given", F.lit(0)) + 1).alias("depth"), "h1", "h2", "words")
    return begun.unionByName(own), convs.select("conv_id")


def op11_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of the conversations with shared openings, and the totals of its subtrees."""
    turns = stored(trie.ordered_turns(table(spark, folder, "conversations")), "turns")
    return trie.prefix_trie(*shared_openings(turns))


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out."""
    return language.identify(table(spark, folder, "documents"))


def looped(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text`; of documents with crc32(id) mod 10 = 0 the words from a place on repeat the first few of them."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    told = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h")).withColumn("g", F.floor(F.col("h") / 10))
    told = told.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    told = told.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    told = told.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", place(i))), " ")
    return told.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Maximal runs of repeated words in every document, the strongest of each, and what is left without the repeats."""
    found = periodic.periodic_runs(looped(table(spark, folder, "documents")))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.*", "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (
    op1_warc_normaliser, op2_toxicity, op3_temperature_mixing, op4_line_dedup, op5_license_scan, op6_minhash_near_dedup, op7_substring_dedup, op8_exact_dedup, op9_best_fit_packing, op10_quality_rules,
    op11_conversation_prefix_trie, op12_language_id, op13_periodic_runs,
)}


def license_sql() -> str:
    rows = ", ".join(f"('{name}', {licenses.bigrams(text)!r})" for name, text in licenses.TEMPLATES)
    return f"""
        WITH templates(name, grams) AS (VALUES {rows}),
        l AS (SELECT doc_id, i AS line, string_split(trim(regexp_replace(lower(string_split(coalesce(text, ''), chr(10))[i]), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
              FROM documents, range(1, len(string_split(coalesce(text, ''), chr(10))) + 1) AS r(i)),
        g AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM l WHERE len(w) > 1),
        d AS (SELECT doc_id, line, name, 2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
              FROM g JOIN templates t ON 2 * least(len(g.grams), len(t.grams)) >= {licenses.MIN_DICE} * (len(g.grams) + len(t.grams))),
        h AS (SELECT * FROM d WHERE dice >= {licenses.MIN_DICE}),
        top AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, name, line) AS k FROM h)
        SELECT doc_id, top.name AS licence, top.dice AS dice, top.line AS line,
               (SELECT count(DISTINCT h.line) FROM h WHERE h.doc_id = documents.doc_id) AS n_statements
        FROM documents LEFT JOIN (SELECT * FROM top WHERE k = 1) top USING (doc_id)
    """


def quality_sql() -> str:
    """The rules and both rounds of references, with histograms as lists."""
    lists = " ".join(f"WHEN '{lang}' THEN {words.split()!r}" for lang, words in sorted(quality.COMMON_WORDS.items()))
    steps, last = [], "t"
    for i, (_, pattern) in enumerate(quality.CLASSES):
        quoted = pattern.replace("'", "''")
        steps.append(f"s{i} AS (SELECT *, regexp_replace({last}, '{quoted}', '', 'g') AS t{i} FROM {f's{i - 1}' if i else 'd'})")
        last = f"t{i}"
    ends = ["t", *[f"t{i}" for i in range(len(quality.CLASSES))]]
    classes = ", ".join(f"length({x}) - length({y})" for x, y in zip(ends, ends[1:], strict=False)) + f", length({last})"

    def sums(column: str, n: int) -> str:
        return f"[{', '.join(f'sum({column}[{i + 1}])::DOUBLE' for i in range(n))}]"

    def reference(name: str, source: str, passed: str) -> str:
        return f"{name} AS (SELECT lang, {sums('c', quality.N_CLASSES)} AS rc, {sums('b', quality.N_COMMON + 1)} AS rb FROM {source} WHERE {passed} GROUP BY lang)"

    def distance(x: str, r: str) -> str:
        p, q = f"({x}[i] / list_sum({x}))", f"({r}[i] / list_sum({r}))"
        part = lambda v: f"CASE WHEN {v} > 0 THEN {v} * log2(2 * {v} / ({p} + {q})) ELSE 0 END"
        return f"CASE WHEN list_sum({x}) > 0 AND list_sum({r}) > 0 THEN sqrt(greatest(0, list_sum(list_transform(range(1, len({x}) + 1), lambda i: {part(p)} + {part(q)})) / 2)) END"

    def compared(name: str, refs: str) -> str:
        known = ", ".join(f"'{lang}'" for lang in quality.COMMON_WORDS)
        return f"""{name} AS MATERIALIZED (SELECT f.*, CASE WHEN list_sum(c) >= {quality.MIN_CHARS} THEN {distance('c', 'rc')} END AS cd,
            CASE WHEN f.lang IN ({known}) AND n_words >= {quality.MIN_WORDS} THEN {distance('b', 'rb')} END AS wd
            FROM f LEFT JOIN {refs} r ON f.lang IS NOT DISTINCT FROM r.lang)"""

    def near(classes_limit: float, words_limit: float) -> str:
        return f"NOT base_failed AND coalesce(cd <= {classes_limit}, true) AND coalesce(wd <= {words_limit}, true)"

    return f"""
        WITH d AS MATERIALIZED (SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
        {', '.join(steps)},
        u AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda j: w[j] || ' ' || w[j + 1] || ' ' || w[j + 2])) AS x FROM d),
        g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM u),
        o AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM g, range(0, 3) AS r(k) WHERE n > 1 GROUP BY doc_id),
        e AS (SELECT doc_id, lang, w, CASE lang {lists} ELSE [] END AS words, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
                [{classes}]::DOUBLE[] AS c FROM s{len(quality.CLASSES) - 1}),
        k AS (SELECT *, list_filter(list_transform(w, lambda x: lower(x)), lambda x: list_contains(words, x)) AS frequent FROM e),
        h AS (SELECT *, list_transform(range(1, {quality.N_COMMON + 1}), lambda i: len(list_filter(frequent, lambda x: x = words[i]))) AS hits FROM k),
        f AS MATERIALIZED (SELECT h.doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, c,
                list_append(hits, n_words - list_sum(hits)::BIGINT)::DOUBLE[] AS b,
                n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed FROM h LEFT JOIN o ON h.doc_id = o.doc_id),
        {reference('r1', 'f', 'NOT base_failed')}, {compared('v1', 'r1')},
        {reference('r2', 'v1', near(quality.TRIM_CLASS_DISTANCE, quality.TRIM_WORD_DISTANCE))}, {compared('v2', 'r2')}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               {near(quality.MAX_CLASS_DISTANCE, quality.MAX_WORD_DISTANCE)} AS kept FROM v2
    """


SQL = {
    "op1_warc_normaliser": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
        d AS (
            SELECT page_id, html, octet_length(encode(html)) AS payload_bytes,
                   array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest
            FROM p
        )
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = min(page_id) OVER w THEN NULL ELSE min(page_id) OVER w END AS refers_to
        FROM d WINDOW w AS (PARTITION BY html)
    """,
    "op4_line_dedup": """
        WITH l AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
                   FROM documents, range(1, len(string_split(coalesce(text, ''), chr(10))) + 1) AS r(i)),
        s AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
        w AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS following FROM s),
        f AS (SELECT doc_id, pos, following IS NOT NULL AND row_number() OVER (PARTITION BY line, following ORDER BY doc_id, pos) > 1 AS later FROM w),
        g AS (SELECT doc_id, pos, later OR coalesce(lag(later) OVER (PARTITION BY doc_id ORDER BY pos), false) AS gone FROM f),
        k AS (SELECT l.doc_id, l.i, l.line, s.pos, coalesce(g.gone, false) AS gone
              FROM l LEFT JOIN s ON l.doc_id = s.doc_id AND l.i = s.i LEFT JOIN g ON s.doc_id = g.doc_id AND s.pos = g.pos)
        SELECT doc_id, count(pos) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM k GROUP BY doc_id
    """,
    "op11_conversation_prefix_trie": """
        WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
                   FROM conversations WHERE conv_id IS NOT NULL),
        c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base,
                  xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                      lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, bit: xor(v >> 1, (v & 1) * 3988292384)))) % 4 AS h FROM o),
        b AS (SELECT c.conv_id, pos + 1 AS depth, said FROM c JOIN o ON o.conv_id = c.base AND pos < h),
        n AS (SELECT c.conv_id, h, count(b.conv_id) AS given FROM c LEFT JOIN b ON b.conv_id = c.conv_id GROUP BY ALL),
        s AS (SELECT * FROM b UNION ALL SELECT conv_id, pos - h + given + 1, said FROM o JOIN n USING (conv_id) WHERE pos >= h),
        p AS (SELECT conv_id, depth, list(said) OVER (PARTITION BY conv_id ORDER BY depth) AS prefix, said FROM s UNION ALL SELECT conv_id, 0, [], NULL FROM c),
        m AS (SELECT *, min(conv_id) OVER (PARTITION BY depth, prefix) AS node, depth = max(depth) OVER (PARTITION BY conv_id) AS ends,
                  len(list_filter(string_split_regex(coalesce(said.text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words FROM p),
        t AS (SELECT node, depth, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
                  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM m GROUP BY node, depth),
        u AS (SELECT t.*, a.node AS parent FROM t LEFT JOIN m a ON a.conv_id = t.node AND a.depth = t.depth - 1),
        k AS (SELECT u.*, coalesce(n, 0) AS n_children FROM u LEFT JOIN (SELECT parent, depth - 1 AS depth, count(*) AS n FROM u WHERE depth > 0 GROUP BY ALL) q ON q.parent = u.node AND q.depth = u.depth),
        w AS (SELECT a.node, a.depth, sum(CASE WHEN x.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(x.saved) AS saved_tokens FROM k x JOIN m a ON a.conv_id = x.node AND a.depth <= x.depth GROUP BY ALL)
        SELECT k.node AS conv_id, k.depth AS depth, k.parent AS parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
        FROM k JOIN w USING (node, depth)
    """,
    "op5_license_scan": license_sql(),
    "op10_quality_rules": quality_sql(),
    "op8_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)
    """,
}
