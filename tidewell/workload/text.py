"""Text preparation and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import vectors
from tidewell.operators import evaluate, text as ops
from tidewell.operators.quantiles import group_quantiles
from tidewell.plans import classifier
from tidewell.session import settled
from tidewell.session import shared_folder
from tidewell.workload import query

_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


@query(f"""
    WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\\r\\n|\\n|\\r')) AS line,
                      generate_subscripts(string_split_regex(text, '\\r\\n|\\n|\\r'), 1) - 1 AS line_no FROM documents),
    s AS (SELECT doc_id, line_no, regexp_replace(line, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') AS line FROM l)
    SELECT doc_id, line_no::INTEGER AS line_no, line FROM s WHERE line <> ''""")
def corpus_lines(t):
    return ops.corpus_lines(t("documents"), "text", ["doc_id"])


@query("""
    SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) - 1 AS position FROM documents""")
def shuffle_docs(t):
    return ops.shuffled(t("documents").select("doc_id"), "doc_id", seed=7)


@query("""
    SELECT doc_id, quality, CASE WHEN doc_id % 10 < 8 THEN 'train' ELSE 'validation' END AS split FROM labels""")
def split_train_valid(t):
    draw = F.pmod("doc_id", F.lit(10)) / 10
    return ops.split_corpus(t("labels"), draw, {"train": 0.8, "validation": 0.2}).select("doc_id", "quality", "split")


def _vocab_sql(table: str, column: str) -> str:
    return f"""v AS (SELECT ch, (row_number() OVER (ORDER BY unicode(ch)) - 1)::INTEGER AS id
        FROM (SELECT DISTINCT unnest(string_split({column}, '')) AS ch FROM {table}) WHERE ch <> '')"""


@query(f"WITH {_vocab_sql('documents', 'text')} SELECT ch, id FROM v")
def char_vocab(t):
    return ops.char_vocabulary(t("documents"), "text")


@query(f"WITH {_vocab_sql('nation', 'n_name')} SELECT count(*) AS boundary_id, count(*) + 1 AS vocab_size FROM v")
def vocab_size(t):
    return ops.vocabulary_size(ops.char_vocabulary(t("nation"), "n_name"))


def codes_sql(table: str, key: str, column: str) -> str:
    return f"""{_vocab_sql(table, column)},
    c AS (SELECT {key}, unnest(string_split({column}, '')) AS ch, generate_subscripts(string_split({column}, ''), 1) AS pos FROM {table}),
    e AS (SELECT {key}, pos, id, ch FROM c JOIN v USING (ch)),
    b AS (SELECT {key}, pos, id FROM e
          UNION ALL SELECT {key}, 0, (SELECT count(*) FROM v)::INTEGER FROM {table}
          UNION ALL SELECT {key}, length({column}) + 1, (SELECT count(*) FROM v)::INTEGER FROM {table})"""


@query(f"""WITH {codes_sql('part', 'p_partkey', 'p_name')}
    SELECT p_partkey, string_agg(id, ' ' ORDER BY pos) AS ids FROM b GROUP BY 1""")
def char_encode(t):
    codec = ops.CharCodec.of(ops.char_vocabulary(t("part"), "p_name"))
    return t("part").select("p_partkey", F.array_join(codec.encode(F.col("p_name")).cast("array<string>"), " ").alias("ids"))


@query(f"""WITH {codes_sql('documents', 'doc_id', 'text')}
    SELECT doc_id, count(*)::INTEGER AS tokens, md5(string_agg(id, ' ' ORDER BY pos)) AS digest FROM b GROUP BY 1""")
def char_encode_documents(t):
    codec = ops.CharCodec.of(ops.char_vocabulary(t("documents"), "text"))
    coded = t("documents").select("doc_id", codec.encode(F.col("text")).alias("ids"))
    return coded.select(
        "doc_id", F.size("ids").alias("tokens"), F.md5(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("digest"))


@query("SELECT n_nationkey, n_name AS decoded FROM nation")
def char_decode(t):
    codec = ops.CharCodec.of(ops.char_vocabulary(t("nation"), "n_name"))
    return t("nation").select("n_nationkey", codec.decode(codec.encode(F.col("n_name"))).alias("decoded"))


PAIRS_SQL = """p AS (SELECT {key}, pos::INTEGER AS position, id AS token, lead(id) OVER (PARTITION BY {key} ORDER BY pos) AS target FROM b)"""


def token_pairs(t, table, key, column, block, rows_per_task=None):
    codec = ops.CharCodec.of(ops.char_vocabulary(t(table), column))
    rows = t(table).select(key, column)
    rows = rows.repartition(max(1, -(-rows.count() // rows_per_task))) if rows_per_task else rows
    coded = rows.select(key, codec.encode(F.col(column)).alias("ids"))
    return ops.next_token_pairs(coded, "ids", block, [key])


@query(f"""WITH {codes_sql('nation', 'n_nationkey', 'n_name')}, {PAIRS_SQL.format(key='n_nationkey')}
    SELECT n_nationkey, position // 8 AS block, position % 8 AS position, token, target FROM p WHERE target IS NOT NULL""")
def next_token_pairs(t):
    return token_pairs(t, "nation", "n_nationkey", "n_name", 8)


@query(f"""WITH {codes_sql('documents', 'doc_id', 'text')}, {PAIRS_SQL.format(key='doc_id')},
    q AS (SELECT * FROM p WHERE target IS NOT NULL),
    m AS (SELECT token, target, count(*) / sum(count(*)) OVER (PARTITION BY token) AS prob FROM q GROUP BY 1, 2)
    SELECT doc_id, round(avg(-ln(prob)), 6) AS nll, count(*) AS positions FROM q JOIN m USING (token, target) GROUP BY 1""")
def doc_nll(t):
    pairs = token_pairs(t, "documents", "doc_id", "text", 1024)
    # Pairs of a document are counted before they meet their probability.
    own = pairs.groupBy("doc_id", "token", "target").agg(F.count(F.lit(1)).alias("n"))
    own = settled(own, "document-bigrams")
    counts = own.groupBy("token", "target").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("token").agg(F.sum("n").alias("all"))
    model = counts.join(totals, "token").select("token", "target", (F.col("n") / F.col("all")).alias("prob"))
    loss = own.join(settled(model, "bigrams"), ["token", "target"]).groupBy("doc_id").agg(
        F.sum(-F.log("prob") * F.col("n")).alias("sum"), F.sum("n").alias("positions"))
    return loss.select("doc_id", F.round(F.col("sum") / F.col("positions"), 6).alias("nll"), "positions")


_WORDS = r"""len(list_filter(string_split_regex(regexp_replace(text, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g'), '[ \t\n\r\f]+'), lambda x: x <> ''))"""


@query(f"""
    WITH w AS (SELECT lang, {_WORDS} AS n FROM documents)
    SELECT lang, count(*) AS documents, round(avg(n), 4) AS mean, min(n)::INTEGER AS min, max(n)::INTEGER AS max,
           round(quantile_cont(n::DOUBLE, 0.5), 6) AS median, round(quantile_cont(n::DOUBLE, 0.95), 6) AS p95
    FROM w GROUP BY 1""")
def token_length_profile(t):
    # Counted once: the sizes of the groups and the quantiles both read the numbers.
    sized = settled(t("documents").select("lang", ops.word_count(F.col("text")).alias("n")), "lengths")
    measures = [F.round(F.avg("value"), 4).alias("mean"), F.min("value").cast("int").alias("min"), F.max("value").cast("int").alias("max")]
    spread = group_quantiles(sized, ["lang"], "n", {"median": 0.5, "p95": 0.95}, measures).withColumnRenamed("n", "documents")
    return spread.withColumns({"median": F.round("median", 6), "p95": F.round("p95", 6)})


@query(f"SELECT max({_WORDS} + 2)::INTEGER AS max_length FROM documents")
def token_length_max(t):
    return ops.max_length(t("documents").select(ops.with_markers(ops.words(F.col("text"))).alias("tokens")), "tokens")


@query(rf"""
    WITH w AS (SELECT conv_id, turn, ['[CLS]'] || list_filter(string_split_regex(regexp_replace(text, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g'), '[ \t\n\r\f]+'), lambda x: x <> '') || ['[SEP]'] AS k FROM conversations),
    m AS (SELECT max(len(k)) AS mx FROM w),
    p AS (SELECT conv_id, turn, len(k) AS n, mx, k || list_transform(range(mx - len(k)), lambda x: '[PAD]') AS x FROM w, m)
    SELECT conv_id, turn, len(x)::INTEGER AS length, n::INTEGER AS mask_sum, md5(array_to_string(x, ' ')) AS digest FROM p""")
def pad_and_mask(t):
    tokens = t("conversations").select("conv_id", "turn", ops.with_markers(ops.words(F.col("text"))).alias("tokens"))
    out = tokens.withColumn("p", ops.padded(F.col("tokens"), ops.max_length(tokens, "tokens").scalar()))
    return out.select(
        "conv_id", "turn", F.size("p.input").alias("length"),
        F.aggregate("p.mask", F.lit(0), lambda a, v: a + v).alias("mask_sum"),
        F.md5(F.array_join("p.input", " ")).alias("digest"))


@query(rf"""
    WITH w AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch, ['[CLS]'] || list_filter(string_split_regex(regexp_replace(text, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g'), '[ \t\n\r\f]+'), lambda x: x <> '') || ['[SEP]'] AS k FROM documents),
    m AS (SELECT *, max(len(k)) OVER (PARTITION BY batch) AS mx FROM w)
    SELECT doc_id, batch, mx::INTEGER AS length, len(k)::INTEGER AS mask_sum, md5(array_to_string(k || list_transform(range(mx - len(k)), lambda x: '[PAD]'), ' ')) AS digest FROM m""")
def pad_batches(t):
    out = ops.padded_batches(t("documents").select("doc_id", "text"), ops.with_markers(ops.words(F.col("text"))), ["doc_id"], 16)
    return out.select(
        "doc_id", "batch", F.size("padded.input").alias("length"), F.aggregate("padded.mask", F.lit(0), lambda a, v: a + v).alias("mask_sum"),
        F.md5(F.array_join("padded.input", " ")).alias("digest"))


@query(f"""
    WITH w AS (SELECT doc_id, {_WORDS} AS n FROM documents), m AS (SELECT max(n) AS mx FROM w)
    SELECT doc_id, mx::INTEGER AS length, (mx - n)::INTEGER AS padding, CASE WHEN n < mx THEN '<|pad|>' END AS last_padding FROM w, m""")
def pad_token(t):
    """Another padding token than the usual one."""
    tokens = t("documents").select("doc_id", ops.words(F.col("text")).alias("tokens"))
    out = tokens.withColumn("p", ops.padded(F.col("tokens"), ops.max_length(tokens, "tokens").scalar(), pad="<|pad|>"))
    gap = F.size("p.mask") - F.size("tokens")
    return out.select("doc_id", F.size("p.input").alias("length"), gap.alias("padding"), F.when(gap > 0, F.element_at("p.input", -1)).alias("last_padding"))


@query(f"SELECT lang, max({_WORDS} + 2)::INTEGER AS max_length, max({_WORDS} + 2) > 512 AS beyond_512 FROM documents GROUP BY lang")
def persisted_length(t):
    """The maximum length per language, kept as settings and read back."""
    tokens = t("documents").select("lang", ops.with_markers(ops.words(F.col("text"))).alias("tokens"))
    longest = tokens.groupBy("lang").agg(F.max(F.size("tokens")).alias("n"))
    path = shared_folder(t.spark, "settings")
    # As many settings as languages.
    ops.save_settings(t.spark, path, **{r["lang"]: r["n"] for r in longest.collect()})
    kept = t.spark.createDataFrame(sorted(ops.load_settings(t.spark, path).items()), "lang string, max_length int")
    return kept.withColumn("beyond_512", F.col("max_length") > 512)


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch FROM labels")
def minibatch_assign(t):
    return ops.with_batches(t("labels"), ["doc_id"], 32).select("doc_id", "batch")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders")
def row_index(t):
    return ops.with_position(t("orders"), ["o_orderkey"], name="row_index").select("o_orderkey", "row_index")


@query("SELECT count(DISTINCT quality) AS qualities, count(DISTINCT toxic) AS toxics FROM labels")
def label_cardinality(t):
    return t("labels").agg(F.count_distinct("quality").alias("qualities"), F.count_distinct("toxic").alias("toxics"))


@query("SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS prediction FROM embeddings")
def argmax_label(t):
    return t("embeddings").select("vec_id", vectors.argmax(F.col("embedding")).alias("prediction"))


@query("SELECT count(*) AS rows, round(avg((quality = 1 - toxic)::INTEGER), 6) AS accuracy FROM labels")
def accuracy(t):
    out = evaluate.accuracy(t("labels").withColumn("pred", 1 - F.col("toxic")), "pred", "quality")
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query("""
    WITH b AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch, (quality = 1 - toxic)::INTEGER AS correct FROM labels),
    m AS (SELECT batch, avg(correct) AS a FROM b GROUP BY 1)
    SELECT count(*) AS batches, round(avg(a), 6) AS avg_correct FROM m""")
def batch_mean_accuracy(t):
    marked = t("labels").withColumn("correct", (F.col("quality") == 1 - F.col("toxic")).cast("int"))
    return evaluate.batch_means(marked, ["doc_id"], ["correct"]).withColumn("avg_correct", F.round("avg_correct", 6))


@query("""
    WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
    s AS (SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1) // 32 AS batch, (list_position(x, list_max(x)) - 1 = label)::INTEGER AS correct,
                 ln(list_sum(list_transform(x, lambda v: exp(v - list_max(x))))) + list_max(x) - x[label + 1] AS loss FROM v),
    b AS (SELECT batch, avg(loss) AS l, avg(correct) AS c FROM s GROUP BY 1)
    SELECT count(*) AS batches, round(avg(l), 6) AS avg_loss, round(avg(c), 6) AS avg_accuracy FROM b""")
def cross_entropy(t):
    out = evaluate.evaluation(t("embeddings"), ["vec_id"], "embedding", "label")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_loss", "avg_accuracy")})


def _corpus(t):
    corpus = t("documents").join(t("labels"), "doc_id").select("doc_id", "text", F.col("quality").alias("label"))
    return ops.split_corpus(corpus, F.pmod("doc_id", F.lit(10)) / 10, {"train": 0.8, "validation": 0.2})


_SPLIT_SQL = "CASE WHEN l.doc_id IS NULL THEN 'unlabelled' WHEN d.doc_id % 10 < 8 THEN 'train' ELSE 'validation' END AS split"


@query(f"SELECT d.doc_id, {_SPLIT_SQL}, true AS is_class, true AS is_argmax FROM documents d LEFT JOIN labels l USING (doc_id)")
def classifier_fit_predict(t):
    """Batch scoring of all documents with a model fitted on the training split."""
    model = classifier.train(_corpus(t).filter("split = 'train'")).model
    known = t("labels").select("doc_id", F.lit(True).alias("known")).distinct()
    split = F.when(F.col("known").isNull(), "unlabelled").when(F.col("doc_id") % 10 < 8, "train").otherwise("validation")
    docs = t("documents").join(known, "doc_id", "left").withColumn("split", split)
    scored = classifier.score(model, docs, ["doc_id", "split"])
    best = vectors.argmax(F.col("logits"))
    return scored.select("doc_id", "split", F.col("prediction").isin(0, 1).alias("is_class"), (F.col("prediction") == best).alias("is_argmax"))


@query("""
    SELECT count(*) FILTER (WHERE l.doc_id % 10 < 8) AS train, count(*) FILTER (WHERE l.doc_id % 10 >= 8) AS validation, true AS better_than_majority, true AS loss_never_rises
    FROM documents d JOIN labels l USING (doc_id)""")
def classifier_evaluation(t):
    split = _corpus(t)
    trained = classifier.train(split.filter("split = 'train'"))
    scored = classifier.score(trained.model, split, ["doc_id", "split", "label"])
    hit = (F.col("prediction") == F.col("label")).cast("int")
    told = scored.groupBy().agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "validation").alias("validation"),
        F.avg(F.when(F.col("split") == "train", hit)).alias("accuracy"), F.avg(F.when(F.col("split") == "train", F.col("label"))).alias("share"))
    losses = classifier.training_stats(t.spark, trained).agg(F.sort_array(F.collect_list(F.struct("epoch", "loss"))).alias("steps"))
    falling = losses.select(F.expr("forall(zip_with(slice(steps, 1, size(steps) - 1), slice(steps, 2, size(steps) - 1), (a, b) -> b.loss <= a.loss), x -> x)")).scalar()
    return told.select("train", "validation", (F.col("accuracy") >= F.greatest("share", 1 - F.col("share"))).alias("better_than_majority"), falling.alias("loss_never_rises"))
