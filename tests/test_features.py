"""TFRecord scan and feature records."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

import tfrecord_fixture as tf
from tidewell.operators import features
from tidewell.sources.tfrecord import _checksums, read_tfrecord, write_tfrecord
from tidewell.workload import Tables
from tidewell.workload import profile as workload_profile


@pytest.fixture
def file(tmp_path):
    path = str(tmp_path / "a.tfrecord")
    tf.three_records(path)
    return path


def test_scan(spark, file):
    rows = read_tfrecord(spark, file).orderBy("index").collect()
    assert [r["record"]["id"]["ints"] for r in rows] == [[0], [1], [2]]
    assert [bytes(r["record"]["name"]["bytes"][0]) for r in rows] == [b"record_0", b"record_1", b"record_2"]
    assert [r["record"]["score"]["floats"] for r in rows] == [[0.0], [1.5], [3.0]]


def test_scan_limit_and_folder(spark, file, tmp_path):
    tf.three_records(str(tmp_path / "b.tfrecord"))
    assert read_tfrecord(spark, str(tmp_path)).count() == 6
    rows = read_tfrecord(spark, str(tmp_path), limit=4).collect()
    assert [(r["file"][-10:], r["index"]) for r in rows] == [
        ("a.tfrecord", 0), ("a.tfrecord", 1), ("a.tfrecord", 2), ("b.tfrecord", 0)]
    assert read_tfrecord(spark, str(tmp_path)).rdd.getNumPartitions() == 2


def test_scan_values(spark, tmp_path):
    path = str(tmp_path / "c.tfrecord")
    tf.write(path, [{"n": ("int", [-5, 2**62, 0]), "f": ("float", [0.5, -1.25]), "b": ("bytes", [b"", b"\xff\x00"])}])
    record = read_tfrecord(spark, path, verify=True).first()["record"]
    assert record["n"]["ints"] == [-5, 2**62, 0]
    assert record["f"]["floats"] == [0.5, -1.25]
    assert [bytes(b) for b in record["b"]["bytes"]] == [b"", b"\xff\x00"]


@pytest.mark.parametrize("place, verify", [(3, False), (20, True), (-2, True)])
def test_scan_rejects_damage(spark, file, place, verify):
    data = bytearray(open(file, "rb").read())
    data[place] ^= 1
    open(file, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        read_tfrecord(spark, file, verify=verify).collect()


def test_scan_rejects_a_cut_file(spark, file):
    data = open(file, "rb").read()
    open(file, "wb").write(data[:-6])
    with pytest.raises(Exception, match="ends inside"):
        read_tfrecord(spark, file).collect()


def test_kinds_over_all_records(spark, tmp_path):
    path = str(tmp_path / "d.tfrecord")
    tf.write(path, [{"a": ("int", [1])}, {"a": ("int", [2]), "late": ("bytes", [b"x"])}])
    kinds = features.feature_kinds(read_tfrecord(spark, path))
    assert {(r["feature"], r["kind"]) for r in kinds.collect()} == {("a", "int64_list"), ("late", "bytes_list")}


def test_statistics(spark, tmp_path):
    path = str(tmp_path / "e.tfrecord")
    tf.write(path, [
        {"n": ("int", [1, 2]), "f": ("float", [0.5]), "b": ("bytes", [b"x", b"y"]), "bad": ("bytes", [b"\xff"]), "none": ("int", [])},
        {"n": ("int", [2]), "f": ("float", [1.5]), "b": ("bytes", [b"y"]), "bad": ("bytes", [b"a"]), "none": ("float", [])},
    ])
    got = {r["feature"]: tuple(r)[1:] for r in features.feature_statistics(read_tfrecord(spark, path)).collect()}
    assert got == {
        "n": ("Numeric", 3, 2, "1.6667", "1", "2"),
        "f": ("Numeric", 2, 2, "1.0", "0.5", "1.5"),
        "b": ("Bytes", 3, 2, "y", "-", "-"),
        "bad": ("Bytes", 2, 2, "-", "-", "-"),
        "none": ("N/A", 0, 0, "-", "-", "-"),
    }


def test_statistics_limit(spark, file):
    first = features.feature_statistics(read_tfrecord(spark, file), 2, ["file", "index"])
    assert {r["feature"]: r["count"] for r in first.collect()} == {"id": 2, "name": 2, "score": 2}


def test_json(spark, file):
    text = read_tfrecord(spark, file, limit=1).select(features.record_json(F.col("record"))).first()[0]
    assert text == '{\n  "id": [\n    0\n  ],\n  "name": [\n    "record_0"\n  ],\n  "score": [\n    0.0\n  ]\n}'


def test_json_of_bytes_that_are_no_text(spark, tmp_path):
    path = str(tmp_path / "g.tfrecord")
    tf.write(path, [{"b": ("bytes", [b"ok", b"\xff\x01"]), "e": ("int", []), "q": ("bytes", ['say "é"'.encode()])}])
    text = read_tfrecord(spark, path).select(features.record_json(F.col("record"))).first()[0]
    assert '"b": [\n    "b\'ok\'",\n    "b\'\\\\xff\\\\x01\'"\n  ]' in text
    assert '"e": []' in text
    assert '"q": [\n    "say \\"é\\""\n  ]' in text


def test_flat_table(spark, tmp_path):
    path = str(tmp_path / "h.tfrecord")
    tf.write(path, [
        {"n": ("int", [1, 2]), "b": ("bytes", [b"x"])},
        {"n": ("int", [3]), "extra": ("int", [9])},
    ])
    records = read_tfrecord(spark, path)
    headers = features.all_headers(records)
    assert headers == ["b", "extra", "n"]
    flat = features.flatten_records(records, headers, ["index"]).orderBy("index").collect()
    assert [tuple(r)[1:] for r in flat] == [("x", "", "[1, 2]"), ("", "9", "3")]


def test_one_file_in_ranges(spark, tmp_path):
    path = str(tmp_path / "i.tfrecord")
    rows = [{"n": ("int", [i, -i, 1 << 40]), "b": ("bytes", [b"x" * (i * 37 % 900)])} for i in range(400)]
    tf.write(path, rows)
    found = read_tfrecord(spark, path, verify=True, split_bytes=20_000)
    got = sorted((r["index"], r["record"]["n"]["ints"], len(r["record"]["b"]["bytes"][0])) for r in found.collect())
    assert got == [(i, [i, -i, 1 << 40], i * 37 % 900) for i in range(400)]
    assert spark.read.format("tfrecord_examples").option("splitBytes", "20000").load(path).rdd.getNumPartitions() > 5
    data = bytearray(open(path, "rb").read())
    at, frames = 0, []
    while at < len(data):
        frames.append(at)
        at += int.from_bytes(data[at : at + 8], "little") + 16
    for frame in (next(f for f in frames if f > 20_000), frames[-1]):
        damaged = bytearray(data)
        damaged[frame + 9] ^= 1
        open(path, "wb").write(damaged)
        with pytest.raises(Exception, match="damaged"):
            read_tfrecord(spark, path, split_bytes=20_000).collect()


def test_written_records_read_back(spark, tmp_path):
    df = spark.createDataFrame([(i, f"é{i}", [i / 2, None], []) for i in range(50)], "a bigint, s string, f array<double>, e array<bigint>")
    records = features.to_records(df.repartition(3), ["a", "s", "f", "e"])
    files = write_tfrecord(records, str(tmp_path / "out")).collect()
    assert len(files) == 3 and sum(r["rows"] for r in files) == 50
    back = read_tfrecord(spark, str(tmp_path / "out"), verify=True).collect()
    got = sorted((r["record"]["a"]["ints"], bytes(r["record"]["s"]["bytes"][0]).decode(), r["record"]["f"]["floats"], r["record"]["e"]["ints"]) for r in back)
    assert got == [([i], f"é{i}", [i / 2], []) for i in range(50)]


def test_checksums_of_many_pieces_at_once(spark, tmp_path):
    pieces = [bytes((i * j + n) % 251 for j in range(n)) for i, n in enumerate([0, 1, 3, 4, 5, 8, 115, 1023, 1024, 1025, 5000, *range(60)])]
    sizes = np.array([len(p) for p in pieces])
    found = _checksums()[0](np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert [struct.pack("<I", c) for c in found.tolist()] == [tf._crc(p) for p in pieces]


def test_records_larger_than_a_read(spark, tmp_path):
    """Files are read by megabytes; a record may be larger, and lie among small ones."""
    sizes = [10, 5 << 20, 20, 4 << 20, 30]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "i int, n int").select("i", F.repeat(F.lit("x"), F.col("n")).alias("s"))
    write_tfrecord(features.to_records(df.coalesce(1), ["i", "s"]), str(tmp_path / "out"))
    back = read_tfrecord(spark, str(tmp_path / "out"), verify=True, split_bytes=3 << 20)
    rows = back.select("index", F.col("record")["i"]["ints"][0], F.length(F.col("record")["s"]["bytes"][0])).collect()
    assert sorted(map(tuple, rows)) == [(i, i, n) for i, n in enumerate(sizes)]


def test_more_rows_are_written_by_more_tasks(spark, tmp_path):
    rows = spark.range(160_000).selectExpr("id AS event_id", "id AS user_id", "'a' AS event_type", "1.5D AS value")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    found = workload_profile._tfrecords(Tables(spark, str(tmp_path)))
    assert found.select("file").distinct().count() > 3
    assert found.count() == 160_000
