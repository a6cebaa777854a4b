"""Small hand-computed cases."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewell.functions import calendar, formatting, paths, vectors
from tidewell.operators import attention, catalog, evaluate, explore, profile, temporal, text
from tidewell.plans import classifier
from tidewell.operators.profile import describe, head


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("seconds, want", [
    (0, "0:00:00"), (3661, "1:01:01"), (59.5, "0:01:00"), (0.5, "0:00:00"), (1.5, "0:00:02"),
    (86400, "1 day, 0:00:00"), (200000, "2 days, 7:33:20"), (-1, "-1 day, 23:59:59"),
])
def test_elapsed(spark, seconds, want):
    assert one(spark, formatting.elapsed_text(F.lit(seconds))) == want


@pytest.mark.parametrize("name, want", [
    ("a.CSV", "csv"), ("x/y.jsonl", "json"), ("b.xlsx", "excel"), ("c.htm", "html"), ("d.rst", "txt"), ("e.svg", "xml"),
    ("f.tar.gz", "other"), ("noext", "other"), (".csv", "other"), ("dir.csv/file", "other"), ("q.orc", "orc"),
])
def test_formats(spark, name, want):
    assert one(spark, paths.detect_format(F.lit(name))) == want


def test_output_names(spark):
    assert one(spark, paths.output_name(F.lit("a.b/c.d.csv"))) == "a.b__c.d.parquet"
    assert one(spark, paths.file_stem(F.lit("x/c.d.csv"))) == "c.d"


def test_dataset_path(spark):
    at = F.lit("2023-01-01 12:00:00").cast("timestamp")
    path = paths.dataset_path("/data/", "{owner}/{dataset_name}_{timestamp}", {"dataset_name": F.lit("My data: é/1"), "owner": F.lit("me")}, at)
    assert one(spark, path) == "/data/me/My_data__é_1_20230101_120000"


def test_iso(spark):
    assert one(spark, calendar.iso_timestamp(F.lit("2024-01-02 03:04:05").cast("timestamp"))) == "2024-01-02T03:04:05"
    assert one(spark, calendar.iso_timestamp(F.lit("2024-01-02 03:04:05.5").cast("timestamp"))) == "2024-01-02T03:04:05.500000"


def test_histogram_closes_the_last_bin_and_lists_empty_ones(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 9.0, 10.0, None)], "v double")
    assert [r["count"] for r in explore.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 2]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    rows = explore.histogram(same, "v", 2).orderBy("bin").collect()
    assert [(r["low"], r["high"], r["count"]) for r in rows] == [(2.5, 3.0, 0), (3.0, 3.5, 2)]


def test_box(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", None), (None, 5.0)], "g string, v double")
    rows = {r["g"]: r for r in explore.box_stats(df, ["g"], "v").collect()}
    a = rows["a"]
    assert (a["n"], a["q1"], a["median"], a["q3"], a["whisker_low"], a["whisker_high"], a["outliers"]) == (5, 2, 3, 4, 1, 4, 1)
    assert rows[None]["median"] == 5 and "b" not in rows
    assert [tuple(r) for r in explore.box_outliers(df, ["g"], "v").collect()] == [("a", 100.0)]


def test_density_integrates_to_about_one(spark):
    df = spark.createDataFrame([(float(i % 17),) for i in range(500)] + [(None,)], "v double")
    rows = explore.density(df, "v", 200).orderBy("point").collect()
    step = rows[1]["x"] - rows[0]["x"]
    assert 0.8 < sum(r["density"] for r in rows) * step <= 1.0


def test_describe_without_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (3,), (4,)], "v int")
    row = describe(df, ["v"]).first()
    assert (row["count"], row["mean"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]) == (4, 2.5, 1, 1.75, 2.5, 3.25, 4)
    assert row["std"] == pytest.approx(math.sqrt(5 / 3))


def test_head(spark):
    df = spark.range(10)
    assert [r["id"] for r in head(df, "id", 3).collect()] == [0, 1, 2]
    assert head(df, "id", None).count() == 10


def test_codec(spark):
    docs = spark.createDataFrame([(1, "ba"), (2, "é😀a"), (3, "")], "id int, t string")
    vocabulary = text.char_vocabulary(docs, "t")
    assert [(r["ch"], r["id"]) for r in vocabulary.orderBy("id").collect()] == [("a", 0), ("b", 1), ("é", 2), ("😀", 3)]
    assert tuple(text.vocabulary_size(vocabulary).first()) == (4, 5)
    codec = text.CharCodec.of(vocabulary)
    coded = docs.withColumn("ids", codec.encode(F.col("t")))
    assert [r["ids"] for r in coded.orderBy("id").collect()] == [[4, 1, 0, 4], [4, 2, 3, 0, 4], [4, 4]]
    assert [r["x"] for r in coded.orderBy("id").select(codec.decode(F.col("ids")).alias("x")).collect()] == ["ba", "é😀a", ""]
    cut = F.array(*[F.lit(i) for i in (0, 1, 4, 2)])
    assert one(spark, codec.decode(cut)) == "ab"
    pairs = text.next_token_pairs(coded, "ids", 2, ["id"]).orderBy("id", "block", "position").collect()
    assert [tuple(r) for r in pairs] == [
        (1, 0, 0, 4, 1), (1, 0, 1, 1, 0), (1, 1, 0, 0, 4), (2, 0, 0, 4, 2), (2, 0, 1, 2, 3), (2, 1, 0, 3, 0), (2, 1, 1, 0, 4), (3, 0, 0, 4, 4)]


def test_lines(spark, tmp_path):
    docs = spark.createDataFrame([(1, " a \n\n\u3000b\u00a0\r\nc\x1c")], "id int, t string")
    assert [tuple(r) for r in text.corpus_lines(docs, "t", ["id"]).collect()] == [(1, 0, "a"), (1, 2, "b"), (1, 3, "c")]
    (tmp_path / "in.txt").write_text(" x \n\n y\n")
    assert sorted(r["line"] for r in text.read_lines(spark, str(tmp_path / "in.txt")).collect()) == ["x", "y"]


def test_padding(spark):
    tokens = text.with_markers(text.words(F.lit(" a  b ")))
    row = one(spark, text.padded(tokens, F.lit(6)))
    assert (row["input"], row["mask"]) == (["[CLS]", "a", "b", "[SEP]", "[PAD]", "[PAD]"], [1, 1, 1, 1, 0, 0])
    own = one(spark, text.padded(text.with_markers(text.words(F.lit("a")), None, "<end>"), F.lit(3), pad="<end>"))
    assert (own["input"], own["mask"]) == (["a", "<end>", "<end>"], [1, 1, 0])
    assert one(spark, text.padded(tokens, F.lit(2)))["input"] == ["[CLS]", "a", "b", "[SEP]"]
    assert one(spark, text.padded(tokens, F.lit(2), truncate=True))["input"] == ["[CLS]", "a"]
    assert one(spark, F.size(text.words(F.lit(" ")))) == 0


def test_settings(spark, tmp_path):
    text.save_settings(spark, f"{tmp_path}/tok", max_length=47, pad="[PAD]")
    assert text.load_settings(spark, f"{tmp_path}/tok") == {"max_length": 47, "pad": "[PAD]"}


def test_shuffle_depends_on_the_seed_alone(spark):
    def places(df, seed):
        return [r["position"] for r in text.shuffled(df, "id", seed).orderBy("id").collect()]

    a = places(spark.range(100), 1)
    assert sorted(a) == list(range(100)) and a != list(range(100))
    assert a == places(spark.range(100).repartition(7), 1) != places(spark.range(100), 2)


def test_split_by_hash(spark):
    rows = text.split_corpus(spark.range(1000), text.hash_draw("id", 3), {"train": 0.7, "valid": 0.3}).groupBy("split").count().collect()
    sizes = {r["split"]: r["count"] for r in rows}
    assert sum(sizes.values()) == 1000 and 650 < sizes["train"] < 750


def test_accuracy_case(spark):
    df = spark.createDataFrame([(0, 1, [0.2, 0.1]), (1, 1, [0.1, 0.2])], "id int, label int, logits array<double>")
    row = evaluate.evaluation(df, ["id"], "logits", "label").first()
    assert row["avg_accuracy"] == 0.5
    want = sum(math.log(math.exp(a) + math.exp(b)) - y for a, b, y in ((0.2, 0.1, 0.1), (0.1, 0.2, 0.2))) / 2
    assert row["avg_loss"] == pytest.approx(want)


def test_batch_mean_is_not_the_row_mean(spark):
    df = spark.createDataFrame([(i, float(i == 4)) for i in range(5)], "id int, right double")
    row = evaluate.batch_means(df, ["id"], ["right"], 2).first()
    assert (row["batches"], row["avg_right"]) == (3, pytest.approx(1 / 3))


def test_vectors(spark):
    x = F.array(F.lit(1000.0), F.lit(1001.0))
    soft = one(spark, vectors.softmax(x))
    assert soft == pytest.approx([1 / (1 + math.e), math.e / (1 + math.e)])
    assert one(spark, vectors.linear(x, vectors.weights([[1, -1], [0.5, 0]]))) == [-1.0, 500.0]
    assert one(spark, vectors.argmax(F.array(F.lit(2), F.lit(5), F.lit(5)))) == 1
    normal = one(spark, vectors.layer_norm(F.array(F.lit(1.0), F.lit(3.0))))
    assert normal == pytest.approx([-1 / math.sqrt(1.001), 1 / math.sqrt(1.001)])


def series(spark, change=0.0, steps=10, width=4):
    rows = [(0, t, [math.sin(t * (c + 1)) + (change if t == steps - 1 else 0.0) for c in range(width)]) for t in range(steps)]
    return spark.createDataFrame(rows, "s int, t int, x array<double>")


@pytest.mark.parametrize("limit", ["1000000", "3"])
def test_convolution_does_not_leak(spark, limit):
    kernel = [[[0.1 * (j + c - f) for f in range(3)] for c in range(4)] for j in range(3)]
    spark.conf.set("spark.tidewell.taskRows", limit)
    try:
        a, b = (temporal.causal_conv(series(spark, c), ["s"], ["t"], "x", kernel, 2) for c in (0.0, 10.0))
        early = temporal.leakage(a, b, ["s", "t"], "conv", F.col("t") < 9).first()
        late = temporal.leakage(a, b, ["s", "t"], "conv", F.col("t") == 9).first()
    finally:
        spark.conf.unset("spark.tidewell.taskRows")
    assert (early["max_change"], early["rows"]) == (0.0, 9)
    assert late["max_change"] > 0.1


@pytest.mark.parametrize("causal, block", [(True, 1024), (True, 3), (False, 1024), (False, 3)])
def test_attention_mask(spark, causal, block):
    w = [[float(i == j) for j in range(4)] for i in range(4)]

    def run(change):
        df = series(spark, change).withColumn("y", F.col("x"))
        out = attention.attention(df, ["s"], ["t"], "x", "x", "x", heads=2, causal=causal, keep=["t"], block=block)
        return out

    early = temporal.leakage(run(0.0), run(10.0), ["s", "t"], "attended", F.col("t") < 9).first()
    assert early["rows"] == 9
    assert (early["max_change"] < 1e-9) is causal
    full = attention.temporal_attention_block(series(spark), ["s"], ["t"], "x", w, w, w, [[1.0] * 4], causal, ["t"])
    assert full.filter(F.size("block") == 1).count() == 10


@pytest.mark.parametrize("lookback", [None, 1, 4])
def test_attention_blocks_agree(spark, lookback):
    def run(block):
        out = attention.attention(series(spark, steps=23), ["s"], ["t"], "x", "x", "x", 2, True, lookback, ["t"], block)
        return {r["t"]: r["attended"] for r in out.collect()}

    whole, cut = run(1000), run(5)
    assert whole.keys() == cut.keys() == set(range(23))
    for t in whole:
        assert cut[t] == pytest.approx(whole[t], abs=1e-12)


@pytest.mark.parametrize("causal, lookback", [(True, None), (False, None), (True, 40), (True, 7)])
def test_attention_over_a_grid_of_tiles(spark, monkeypatch, causal, lookback):
    monkeypatch.setattr(attention, "FAN_IN", 2)
    rng = np.random.default_rng(1)
    q, k, v = rng.normal(size=(3, 230, 4)) * 2
    rows = [(s, t, *(m[t].tolist() for m in (q, k, v))) for s, n in ((None, 230), ("b", 60), ("c", 1)) for t in range(n)]
    df = spark.createDataFrame(rows, "s string, t int, q array<double>, k array<double>, v array<double>")
    got = {(r["s"], r["t"]): r["attended"] for r in attention.attention(df, ["s"], ["t"], "q", "k", "v", 2, causal, lookback, ["t"], block=8).collect()}
    assert len(got) == 291
    for s, n in ((None, 230), ("b", 60), ("c", 1)):
        for h in (slice(0, 2), slice(2, 4)):
            logits = q[:n, h] @ k[:n, h].T / np.sqrt(2)
            gap = np.arange(n)[:, None] - np.arange(n)
            logits[(gap < 0) & causal | (gap >= (lookback or n))] = -np.inf
            share = np.exp(logits - logits.max(1, keepdims=True))
            want = share / share.sum(1, keepdims=True) @ v[:n, h]
            assert np.allclose([got[s, t][h] for t in range(n)], want, atol=1e-12)


def test_attention_shuffles_less_than_the_square(spark):
    """Copies of a row: once per grid column, about the root of the blocks."""
    assert [attention.tile_rows(n, 10) for n in (1, 10, 11, 40, 41, 160, 1000)] == [10, 10, 20, 20, 30, 40, 100]
    sides = {n: -(-n // attention.tile_rows(n)) for n in (50_000, 200_000, 800_000)}
    assert sides[50_000] <= 7 and sides[200_000] <= 14 and sides[800_000] <= 28
    rows = spark.range(50_000).select(F.lit("s").alias("s"), F.col("id").alias("t"), F.array((F.col("id") % 7).cast("double")).alias("x"))
    out = attention.attention(rows, ["s"], ["t"], "x", "x", "x", causal=True)
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    first, last = out.count(), out.agg(F.max(F.col("attended")[0])).first()[0]
    assert first == 50_000 and 5 < last <= 6


@pytest.mark.parametrize("shape", ["normal", "far", "two"])
def test_density_is_exact(spark, shape):
    rng = np.random.default_rng(3)
    values = {"normal": rng.normal(5, 2, 700), "far": np.concatenate([rng.normal(0, 1, 500), [1e4, -3e4]]), "two": np.array([1.0, 4.0])}[shape]
    got = explore.density(spark.createDataFrame([(float(v),) for v in [*values]] + [(None,)], "v double"), "v", 50).orderBy("point").collect()
    grid = np.linspace(values.min(), values.max(), 50)
    h = values.std(ddof=1) * len(values) ** -0.2
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (len(values) * h * math.sqrt(2 * math.pi))
    assert np.allclose([r["x"] for r in got], grid)
    assert np.abs(np.array([r["density"] for r in got]) - want).max() < 1e-12 / h


def test_temporal_block_ends_in_relu(spark):
    kernel = [[[float(i == j) for j in range(4)] for i in range(4)]]
    out = temporal.temporal_block(series(spark), ["s"], ["t"], "x", kernel, activation="tanh").collect()
    for row in out:
        assert row["block"] == pytest.approx([max(0.0, math.tanh(v) + v) for v in row["x"]])


def test_temporal_block_needs_resampling_weights(spark):
    with pytest.raises(ValueError, match="resample"):
        temporal.temporal_block(series(spark), ["s"], ["t"], "x", [[[1.0] * 3] * 4])
    with pytest.raises(ValueError, match="lookback"):
        attention.attention(series(spark), ["s"], ["t"], "x", "x", "x", causal=False, lookback=3)


def test_status(spark):
    log = spark.createDataFrame([
        ("a", 1, "progress", 5.0), ("a", 2, "progress", 40.0), ("a", 3, "failed", 0.0),
        ("b", 1, "progress", 55.0), ("b", 2, "skipped", 0.0), ("c", 1, "progress", 0.0), ("d", 1, "progress", 100.0),
    ], "f string, ts int, kind string, p double")
    got = {r["f"]: (r["status"], r["progress"]) for r in catalog.latest_status(log, ["f"], ["ts"], "kind", "p").collect()}
    assert got == {"a": ("failed", 40.0), "b": ("skipped", 100.0), "c": ("pending", 0.0), "d": ("completed", 100.0)}
    passed = catalog.progress_milestones(log.filter("kind = 'progress'"), ["f"], ["ts"], "p")
    assert {(r["f"], r["ts"]) for r in passed.collect()} == {("a", 2), ("b", 1), ("d", 1)}


def test_listing_export(spark, tmp_path):
    a = spark.createDataFrame([("x", 1)], "name string, size int")
    b = spark.createDataFrame([("y", True)], "name string, metadata_missing boolean")
    merged = catalog.union_filled(a, b)
    assert merged.columns == ["metadata_missing", "name", "size"]
    assert {tuple(r) for r in merged.collect()} == {("", "x", "1"), ("true", "y", "")}
    for kind in ("json", "csv"):
        catalog.export_listing(merged, f"{tmp_path}/{kind}", kind)
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2
    assert spark.read.json(f"{tmp_path}/json").count() == 2
    with pytest.raises(ValueError):
        catalog.export_listing(merged, f"{tmp_path}/x", "table")


def test_newest_first_before_the_limit(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "name string, created int")
    assert [r["name"] for r in catalog.latest(df, "created", "name", 2).collect()] == ["b", "c"]


def test_classifier(spark):
    rows = [(i, ("good fine nice " if i % 2 else "bad poor awful ") + f"w{i % 7}", i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, text string, label int")
    trained = classifier.train(df.filter("id < 64"), features=256, epochs=5)
    result = classifier.test(trained.model, df.filter("id >= 64"), "id")
    assert result["avg_accuracy"] == 1.0 and result["avg_loss"] < 0.5 and result["elapsed"] > 0
    stats = classifier.training_stats(spark, trained).orderBy("epoch").collect()
    assert stats[0]["loss"] > stats[-1]["loss"]


def test_catalog_of_two_datasets(spark, tmp_path):
    datasets = spark.createDataFrame(
        [("me/a", "a", "me", 10, "u", "2023-01-01 12:00:00"), ("me/b", "b", "me", 20, "u", "2023-01-02 12:00:00")],
        "ref string, name string, owner string, size bigint, url string, at string")
    files = spark.createDataFrame(
        [("me/b", f"f{i}.parquet", 100 * i, i) for i in range(5)], "ref string, filename string, size bigint, rows bigint")
    entries = catalog.nested_entries(files, "ref", ["filename"], ["filename", "size", "rows"], page=2)
    assert {r["page"]: len(r["files"]) for r in entries.collect()} == {0: 2, 1: 2, 2: 1}
    totals = catalog.nested_totals(entries, "ref", "size").first()
    assert (totals["file_count"], totals["total_bytes"]) == (5, 1000.0)
    documents = catalog.metadata_documents(
        datasets, entries, F.concat(F.lit("/d/"), "name"), "/d", "{name}", F.col("at").cast("timestamp"))
    catalog.write_documents(documents, f"{tmp_path}/meta")
    stored = catalog.read_documents(spark, f"{tmp_path}/meta")
    first = stored.filter("dataset.ref = 'me/b' and page = 1").first()
    assert (first["dataset"]["file_count"], first["storage"]["storage_dir"]) == (5, "/d/b")
    assert [f["filename"] for f in first["parquet_files"]] == ["f2.parquet", "f3.parquet"]
    summary = catalog.document_summary(stored)
    listed = catalog.brief_listing(
        datasets.select("ref").unionByName(spark.createDataFrame([("gone",)], "ref string")), summary, "ref")
    newest = [tuple(r) for r in catalog.latest(listed, "created", "ref").collect()]
    assert newest == [
        ("me/b", "2023-01-02T12:00:00", "me/b", 5), ("me/a", "2023-01-01T12:00:00", "me/a", 0), ("gone", "", "", 0)]


def test_density_of_one_value(spark):
    for values in ([3.0] * 5, [3.0], [], [None]):
        assert explore.density(spark.createDataFrame([(v,) for v in values], "v double"), "v", 10).count() == 0


def test_median_ranks_keep_the_null_group(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 2), (None, 9.0, 3)], "g string, v double, m int")
    got = [tuple(r) for r in explore.rank_by_median(df, "g", "v", "m").orderBy("rank").collect()]
    assert got == [(None, 9.0, 1, 1, 1), ("a", 2.0, 2, 2, 2)]


def test_profiles_of_dotted_names(spark):
    df = spark.createDataFrame([(1, None), (2, 3.5)], "`a.b` int, `c``d` double")
    assert [tuple(r) for r in profile.table_info(df).collect()] == [(0, "a.b", "int", 2, 0), (1, "c`d", "double", 1, 1)]
    assert [r["column"] for r in profile.describe(df, ["a.b"]).collect()] == ["a.b"]


def test_gain_shift_bias_and_activation(spark):
    x = F.array(F.lit(1.0), F.lit(3.0))
    plain = one(spark, vectors.layer_norm(x))
    assert one(spark, vectors.layer_norm(x, gain=[2, 3], shift=[1, -1])) == pytest.approx([2 * plain[0] + 1, 3 * plain[1] - 1])
    assert one(spark, vectors.affine(x, [[1, 1], [0, 2]], [0.5, -7])) == [4.5, -1.0]
    y = F.array(F.lit(-1.0), F.lit(2.0))
    assert one(spark, vectors.activated(y)) == [0.0, 2.0]
    assert one(spark, vectors.activated(y, "linear")) == [-1.0, 2.0]
    assert one(spark, vectors.activated(y, "tanh")) == pytest.approx([math.tanh(-1), math.tanh(2)])
    assert one(spark, vectors.activated(y, "sigmoid")) == pytest.approx([1 / (1 + math.e), 1 / (1 + math.exp(-2))])
    with pytest.raises(ValueError):
        vectors.activated(y, "step")


def test_codec_takes_texts_in_slices(spark, monkeypatch):
    """Python holds some of the texts of a batch at a time; longer texts, empty ones and nulls have their ids."""
    monkeypatch.setattr(text, "SLICE_BYTES", 50)
    assert [len(a) for a in text._sliced(50)(pa.array(["x" * 20] * 5 + [None, "y" * 90, "é"]))] == [2, 2, 2, 1, 1]
    texts = ["ab" * (i * 7 % 60) + "é" for i in range(90)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").coalesce(1)
    codec = text.CharCodec.of(text.char_vocabulary(df, "s"))
    assert codec.chars == ("a", "b", "é")
    got = {r["i"]: r["ids"] for r in df.select("i", codec.encode(F.col("s")).alias("ids")).collect()}
    assert got == {i: None if s is None else [3, *["abé".index(c) for c in s], 3] for i, s in enumerate(texts)}
