"""Quality rules and the divergence of a document from its language, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.shared import stored

# Frequent words of four languages, in no order that matters.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit ist im für auf nicht ein eine",
    "en": "the of and to in a is that for it as was with be by on",
    "es": "de la que el en y a los del se las por un para con no",
    "fr": "de la le et les des en un du une que est pour qui dans par",
}
# Character classes, each counted in what the earlier ones have left; what remains at the end is the last class.
CLASSES = [
    ("lower", "[a-z]+"), ("space", r"[\x20\x09-\x0D]+"), ("upper", r"\p{Lu}+"), ("letter", r"\p{L}+"),
    ("digit", r"\p{N}+"), ("stop", r"[.,;:?'\"()\-]+"),
]
N_CLASSES = len(CLASSES) + 1
N_COMMON = max(len(words.split()) for words in COMMON_WORDS.values())

MAX_CLASS_DISTANCE = 0.19
MAX_WORD_DISTANCE = 0.35
# Documents farther than this from the first reference have no part in the second.
TRIM_CLASS_DISTANCE, TRIM_WORD_DISTANCE = 0.16, 0.28
# A shorter text is not compared: its histogram is mostly chance.
MIN_CHARS, MIN_WORDS = 200, 50


def _let(value: str, name: str, body: str) -> str:
    """`body` with `name` bound to `value`, which is evaluated once per row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def repeat_words_sql() -> str:
    """Words in three-word windows that occur twice or more, from `words`: equal hashes stand together once sorted."""
    hashed = "sort_array(transform(sequence(0, size(words) - 3), i -> struct(xxhash64(words[i], words[i + 1], words[i + 2]) as h, i as i)))"
    twins = "filter(s, (x, j) -> get(s, j - 1).h <=> x.h or get(s, j + 1).h <=> x.h)"
    covered = "aggregate(p, struct(0L as n, -3 as last), (a, x) -> struct(a.n + least(3, x - a.last) as n, x as last), a -> a.n)"
    return "case when size(words) < 3 then 0L else " + _let(hashed, "s", _let(f"sort_array(transform({twins}, x -> x.i))", "p", covered)) + " end"


def features(docs: DataFrame) -> DataFrame:
    """Counts of each text in one pass: the base rules' figures, the character classes, the common words of its `lang`."""
    lists = reduce(
        lambda rest, lang: F.when(F.col("lang") == lang, F.array(*map(F.lit, COMMON_WORDS[lang].split()))).otherwise(rest),
        sorted(COMMON_WORDS), F.array().cast("array<string>"),
    )
    step = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("t0"))
    step = step.withColumn("text_hash", F.xxhash64("t0"))
    step = step.withColumn("words", F.expr(r"array_remove(split(t0, '[\\x20\\x09-\\x0D]+'), '')")).withColumn("common", lists)
    step = step.withColumn("lines", F.expr(r"filter(split(t0, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"))
    step = step.withColumn("hits", F.expr(_let("common", "c", "filter(transform(words, w -> array_position(c, lower(w))), p -> p > 0)")))
    counts = [
        F.size("words").cast("bigint").alias("n_words"), F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.char_length("t0") - F.char_length(F.regexp_replace("t0", "[#*$%&|<>]", ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(repeat_words_sql()).cast("bigint").alias("n_repeat_words"),
    ]
    bins = [F.expr(f"size(filter(hits, p -> p = {i}))") for i in range(1, N_COMMON + 1)]
    words = F.array(*bins, F.size("words") - F.size("hits")).cast("array<bigint>").alias("common_words")
    step = step.select("doc_id", "lang", "text_hash", "t0", *counts, words)
    found = []
    for i, (name, pattern) in enumerate(CLASSES):
        step = step.withColumn(f"t{i + 1}", F.regexp_replace(f"t{i}", pattern, ""))
        step = step.withColumn(name, F.char_length(f"t{i}") - F.char_length(f"t{i + 1}")).drop(f"t{i}")
        found.append(name)
    rest = F.char_length(f"t{len(CLASSES)}")
    return step.select("doc_id", "lang", "text_hash", *[c for c in step.columns if c.startswith("n_") or c in ("word_chars", "common_words")],
                       F.array(*found, rest).cast("array<bigint>").alias("classes"))


def distance(left: str, right: str) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms, as arrays of counts; null if either is empty."""
    def shares(counts: str) -> str:
        return f"transform({counts}, x -> x / aggregate({counts}, 0D, (a, y) -> a + y))"

    def part(x: str) -> str:
        return f"case when {x} > 0 then {x} * log2(2 * {x} / (p + q)) else 0D end"

    terms = f"zip_with({shares(left)}, {shares(right)}, (p, q) -> {part('p')} + {part('q')})"
    filled = " and ".join(f"aggregate({c}, 0L, (a, y) -> a + y) > 0" for c in (left, right))
    return F.expr(f"case when {filled} then sqrt(greatest(0D, aggregate({terms}, 0D, (a, x) -> a + x) / 2)) end")


def _compared(found: DataFrame, passed: Column) -> DataFrame:
    """Distances of all documents from the summed histograms of those of their language that `passed`."""
    def sums(column: str, n: int) -> Column:
        return F.array(*[F.sum(F.col(column)[i]) for i in range(n)]).alias(f"r_{column}")

    reference = stored(found.where(passed).groupBy(F.col("lang").alias("r_lang")).agg(sums("classes", N_CLASSES), sums("common_words", N_COMMON + 1)), "references")
    joined = found.drop("class_distance", "word_distance").join(reference, found["lang"].eqNullSafe(reference["r_lang"]), "left")
    long_enough = F.expr(f"aggregate(classes, 0L, (a, x) -> a + x) >= {MIN_CHARS}")
    known = F.col("lang").isin(*COMMON_WORDS) & (F.col("n_words") >= MIN_WORDS)
    return joined.withColumns({
        "class_distance": F.when(long_enough, distance("classes", "r_classes")),
        "word_distance": F.when(known, distance("common_words", "r_common_words")),
    }).drop("r_lang", "r_classes", "r_common_words")


def rate(docs: DataFrame, max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Base rules and the verdict of divergence for `docs (doc_id, text, lang)`.

    Words are `[^\\x20\\x09-\\x0D]+`. `base_failed`: fewer than 50 words, or more than half of the words lie in three-word windows
    found twice or more. The reference of a language is the summed histogram of all its documents that pass the base rules,
    summed once more without those that are far from it. A document is kept if it passes them and neither its character classes nor its common words are farther from its
    language's than `max_class` and `max_word` (Jensen-Shannon distance). Texts under 200 characters or 50 words
    are not compared; nor are common words in a language without a list, or any in one without a reference.

    Result, one row per input row: `doc_id`, `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`, `base_failed`,
    `kept`, `class_distance`, `word_distance` (null if not compared), `text_hash` (xxhash64 of the text). A null text has no words. Null languages are one
    language. Repeated rows are rated alike. No rows give no rows; other columns are not used.
    """
    found = stored(features(docs).withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")), "features")

    def near(classes: float, words: float) -> Column:
        return F.expr(f"not base_failed and coalesce(class_distance <= {classes}, true) and coalesce(word_distance <= {words}, true)")

    first = _compared(found, F.expr("not base_failed"))
    second = _compared(first, near(TRIM_CLASS_DISTANCE, TRIM_WORD_DISTANCE))
    return second.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        near(max_class, max_word).alias("kept"), "class_distance", "word_distance", "text_hash",
    )
