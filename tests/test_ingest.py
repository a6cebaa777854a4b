"""File listing, readers, sinks, conversion jobs and the incremental stream, on generated files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidewell.plans import ingest
from tidewell.sources import json_docs, listing, sinks, tabular
from tidewell.streaming import incremental
from tidewell.workload import ingest as workload_ingest

HEADER = ["id", "name", "age", "score"]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return str(path)


def delimited(rows, sep):
    return "\n".join([sep.join(HEADER)] + [sep.join(map(str, r)) for r in rows]) + "\n"


def records(rows):
    return [dict(zip(HEADER, r)) for r in rows]


def as_rows(df):
    return [tuple(r) for r in df.select(*HEADER).orderBy("id").collect()]


@pytest.mark.parametrize("kind", ["csv", "tsv", "array", "one_line_array", "lines", "columns"])
def test_readers(spark, people, kind):
    folder, rows = people
    texts = {
        "csv": delimited(rows, ","),
        "tsv": delimited(rows, "\t"),
        "array": json.dumps(records(rows), indent=2),
        "one_line_array": json.dumps(records(rows)),
        "lines": "\n".join(map(json.dumps, records(rows))),
        "columns": json.dumps({c: [r[i] for r in rows] for i, c in enumerate(HEADER)}, indent=1),
    }
    path = write(f"{folder}/in/data.txt", texts[kind])
    reader = {"csv": tabular.read_csv, "tsv": tabular.read_tsv}.get(kind, json_docs.read_json)
    df = reader(spark, path)
    assert as_rows(df) == rows
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {
        "id": "bigint", "name": "string", "age": "bigint", "score": "double"}


def test_json_single_object(spark, tmp_path):
    path = write(f"{tmp_path}/in/one.json", '{\n"a": 1,\n"b": "x"\n}')
    assert [r.asDict() for r in json_docs.read_json(spark, path).collect()] == [{"a": 1, "b": "x"}]


@pytest.mark.parametrize("values, kind", [([1, 2, 3], "bigint"), ([1.5, 2], "double"), (["1", "x"], "string"), ([True, False], "boolean")])
def test_json_scalars(spark, tmp_path, values, kind):
    df = json_docs.read_json(spark, write(f"{tmp_path}/in/list.json", json.dumps(values, indent=1)))
    assert df.dtypes == [("value", kind)]
    assert [r["value"] for r in df.collect()] == values


def test_json_columns_with_a_scalar_and_uneven_lists(spark, tmp_path):
    df = json_docs.read_json(spark, write(f"{tmp_path}/in/a.json", '{\n"k": "z",\n"v": [1, 2]\n}'))
    assert sorted((r["k"], r["v"]) for r in df.collect()) == [("z", 1), ("z", 2)]
    bad = json_docs.read_json(spark, write(f"{tmp_path}/in2/b.json", '{\n"u": [1],\n"v": [1, 2]\n}'))
    with pytest.raises(Exception, match="differ in length"):
        bad.collect()


def awkward_json(n):
    texts = ["plain", 'quote " , ] }', "back \\\\ slash\\", "[{", "", "line\nend", "é,\u2028x", ","]
    return [{"id": i, "s": texts[i % 8], "deep": {"a": [i, {"b": "}],"}], "c": None}, "list": list(range(i % 4))} for i in range(n)]


@pytest.fixture(params=["60b", "128m"])
def ranged(spark, request, monkeypatch):
    """Ranges of a few bytes, so that strings, elements and brackets cross them."""
    monkeypatch.setattr(json_docs, "LINE_BYTES", 200)
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_json_array_in_ranges(spark, tmp_path, ranged):
    rows = awkward_json(12)
    path = write(f"{tmp_path}/in/rows.json", json.dumps(rows, indent=1 if ranged == "60b" else None, ensure_ascii=False))
    got = {r["id"]: r for r in json_docs.read_json(spark, path).collect()}
    assert {i: (r["s"], [json.loads(x) for x in r["deep"]["a"]], r["list"]) for i, r in got.items()} == {
        r["id"]: (r["s"], r["deep"]["a"], r["list"]) for r in rows}


def test_json_scalars_and_columns_in_ranges(spark, tmp_path, ranged):
    numbers = [i * 1.5 for i in range(60)]
    path = write(f"{tmp_path}/in/numbers.json", json.dumps(numbers))
    assert sorted(r["value"] for r in json_docs.read_json(spark, path).collect()) == numbers
    rows = awkward_json(12)
    columns = {c: [r[c] for r in rows] for c in ("id", "s", "list")} | {"kind": "a, [b", "more": {"x": 1, "y": [2, 3]}}
    path = write(f"{tmp_path}/in/columns.json", json.dumps(columns))
    got = {r["id"]: (r["s"], r["list"], r["kind"], r["more"]["y"]) for r in json_docs.read_json(spark, path).collect()}
    assert got == {r["id"]: (r["s"], r["list"], "a, [b", [2, 3]) for r in rows}


@pytest.mark.parametrize("text", ['[{"a": 1},\n{"a":\n2}}',  '[{"a": 1}\n{"a": 2}]', '[1,\n2,]', '[{"a": 1}\n] x', '[1,\n"x]', '{"a": [1,\n2], "b": [1]}', '{"a": 1,\n}', '[1,\n01]'])
def test_json_damage_in_ranges(spark, tmp_path, text):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        with pytest.raises(Exception, match="damaged|differ"):
            json_docs.read_json(spark, write(f"{tmp_path}/in/bad.json", text)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_json_lists_of_nothing(spark, tmp_path):
    write(f"{tmp_path}/in/a.json", "[\n]\n")
    write(f"{tmp_path}/in/b.json", '[\n{"x": 1}\n]')
    assert [r["x"] for r in json_docs.read_json(spark, f"{tmp_path}/in").collect()] == [1]


@pytest.mark.parametrize("text, want", [('{"a":1}\n\n{"a":2}\n', True), ('[1]\n{"a":2}', True), ('{\n"a":1}', False), ('1\n2', False)])
def test_json_lines_detection(spark, tmp_path, text, want):
    path = write(f"{tmp_path}/in/x.json", text)
    assert json_docs.is_json_lines(spark.read.text(path)).first()["json_lines"] is want


def test_csv_types(spark, tmp_path):
    path = write(f"{tmp_path}/in/t.csv", (
        "day,gap,mixed,flag,real,big,none\n"
        "2020-01-01,1,1,True,1e3,9223372036854775807,NA\n"
        "2020-01-02,NA,x,False,-.5,1,\n"
        "2020-01-03,3,2.5,true,inf,2,null\n"))
    df = tabular.read_csv(spark, path)
    assert dict(df.dtypes) == {
        "day": "string", "gap": "bigint", "mixed": "string", "flag": "boolean", "real": "double", "big": "bigint", "none": "double"}
    rows = df.orderBy("day").collect()
    assert [r["gap"] for r in rows] == [1, None, 3]
    assert [r["flag"] for r in rows] == [True, False, True]
    assert [r["real"] for r in rows] == [1000.0, -0.5, float("inf")]
    assert {r["none"] for r in rows} == {None}


def test_csv_quoted_line_ends(spark, tmp_path):
    path = write(f"{tmp_path}/in/q.csv", 'id,text\n1,"a\nb ""c"", d"\n2,plain\n')
    rows = tabular.read_csv(spark, path).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 'a\nb "c", d'), (2, "plain")]


def odd_quotes(n):
    """Records with quoted line ends, doubled quotes, quotes inside plain fields, blank lines and carriage returns."""
    out = []
    for i in range(n):
        text = ["plain", "two\nlines", 'say ""hi""\n\n', "a\r\nb", "x,y", "", "\n" * 9, 'end""'][i % 8]
        field = text if i % 8 == 0 else f'"{text}"'
        out.append((f"{i},{field},{'in' + chr(34) + 'ner' if i % 5 == 0 else 'z'}", (i, text.replace('""', '"') or None, 'in"ner' if i % 5 == 0 else "z")))
    return out


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", ["40b", "200b", "128m"])
def test_csv_quoted_line_ends_in_ranges(spark, tmp_path, size, end):
    rows = odd_quotes(160)
    path = f"{tmp_path}/in/{end == chr(10)}.csv"
    os.makedirs(f"{tmp_path}/in", exist_ok=True)
    for name, part in (("one", rows[:150]), ("two", rows[150:])):
        with open(f"{tmp_path}/in/{name}.csv", "w", newline="") as out:
            out.write("id,text,more" + end + end.join(r for r, _ in part) + end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = tabular.read_csv(spark, f"{tmp_path}/in")
        tasks = tabular.ranges.pieces(spark, f"{tmp_path}/in").rdd.getNumPartitions()
        got = sorted(tuple(r) for r in found.collect())
        indexed = sinks.with_file_index(tabular.read_text_columns(spark, f"{tmp_path}/in")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [(i, None if t in (None, "") else t, m) for _, (i, t, m) in rows]
    assert tasks > 10 or size == "128m"
    assert {int(r["id"]): r[sinks.INDEX] for r in indexed} == {i: i % 150 for i in range(160)}


def test_csv_ranges_beyond_the_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tabular.ranges, "MOST_RANGES", 1)
    rows = odd_quotes(60)
    path = write(f"{tmp_path}/in/q.csv", "id,text,more\n" + "\n".join(r for r, _ in rows) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert sorted(r["id"] for r in tabular.read_csv(spark, path).collect()) == list(range(60))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("last, kind", [("2.5", "double"), ("x", "string")])
def test_csv_types_come_from_all_rows(spark, tmp_path, last, kind):
    path = write(f"{tmp_path}/in/late.csv", "n,s\n" + "1,a\n" * 1500 + f"{last},b\n")
    df = tabular.read_csv(spark, path)
    assert dict(df.dtypes) == {"n": kind, "s": "string"}
    assert df.count() == 1501


def test_csv_lines_that_do_not_fit(spark, tmp_path):
    path = write(f"{tmp_path}/in/c.csv", 'a,b\n1,2\n3,4,5\n6\n7,"x,y",\n8,\n9,"p"",q"\n')
    raw = tabular.read_text_columns(spark, path)
    assert sorted(r["line"] for r in tabular.rejected(raw).collect()) == ["3,4,5", '7,"x,y",']
    kept = tabular.read_csv(spark, path, rejects="apart").orderBy("a").collect()
    assert [tuple(r) for r in kept] == [(1, "2"), (6, None), (8, None), (9, 'p",q')]
    with pytest.raises(Exception, match="too many fields: (3,4,5|7,)"):
        tabular.read_csv(spark, path, kinds={"a": "bigint", "b": "string"}).collect()
    with pytest.raises(ValueError):
        tabular.read_csv(spark, path, rejects="drop")


def test_csv_a_quote_inside_a_field_opens_nothing(spark, tmp_path):
    path = write(f"{tmp_path}/in/p.csv", 'id,text\n1,5" pipe\n2,"a ""b"" c"\n3,"x" y\n')
    assert [r["quoted"] for r in tabular.file_shapes(spark, path).collect()] == [False]
    assert tabular.read_csv(spark, path).count() == 3
    both = write(f"{tmp_path}/in2/q.csv", 'id,text\n1,"a\n"\n')
    assert [r["quoted"] for r in tabular.file_shapes(spark, both).collect()] == [True]


def test_csv_header_names():
    assert tabular.header_names('a,"b,c",,A', ",") == ["a0", "b,c", "_c2", "A3"]


def test_csv_files_with_other_headers(spark, tmp_path):
    write(f"{tmp_path}/in/x.csv", "id,score\n1,10\n2,20\n")
    write(f"{tmp_path}/in/y.csv", "score,id\n30,3\n40,4\n")
    with pytest.raises(tabular.MixedHeaders):
        tabular.read_csv(spark, f"{tmp_path}/in")
    report = ingest.convert_folder(spark, f"{tmp_path}/in", f"{tmp_path}/out", by_folder=True).collect()
    assert {(r["status"], r["rows"]) for r in report} == {("completed", 2)} and len(report) == 2
    rows = [tuple(r) for x in report for r in spark.read.parquet(x["path"]).select("id", "score").collect()]
    assert sorted(rows) == [(1, 10), (2, 20), (3, 30), (4, 40)]
    assert ingest.convert_folder(spark, f"{tmp_path}/in", f"{tmp_path}/out", by_folder=True).count() == 0


def test_json_lines_with_damage(spark, tmp_path):
    lines = [json.dumps({"a": i}) for i in range(101)]
    path = write(f"{tmp_path}/in/x.json", "\n".join([lines[0], '{"a": 1', *lines[1:]]))
    rows = json_docs.read_json(spark, path).collect()
    assert len(rows) == 102 and [r["_corrupt_record"] for r in rows if r["a"] is None] == ['{"a": 1']
    blank = write(f"{tmp_path}/in2/x.json", "\n\n\n" + "\n".join(lines[:100]))
    assert json_docs.read_json(spark, blank).count() == 100
    report = ingest.convert(spark, ingest.Source("x", path, "json", 9, "x.parquet"), f"{tmp_path}/out")
    assert (report["rows"], report["rejected"]) == (102, 1)


def test_json_folder_of_several_shapes(spark, tmp_path):
    write(f"{tmp_path}/in/lines.json", "\n".join(json.dumps({"a": i, "b": "x"}) for i in range(100)))
    write(f"{tmp_path}/in/array.json", json.dumps([{"a": 1000}, {"a": 1001.5}], indent=1))
    write(f"{tmp_path}/in/values.json", json.dumps([1, 2, 3]))
    write(f"{tmp_path}/in/more.json", json.dumps([4, 5], indent=1))
    rows = json_docs.read_json(spark, f"{tmp_path}/in").collect()
    assert sorted(r["a"] for r in rows if r["a"] is not None) == [*map(float, range(100)), 1000.0, 1001.5]
    assert sorted(r["value"] for r in rows if r["value"] is not None) == [1, 2, 3, 4, 5]
    assert len(rows) == 107


def test_json_document_with_something_after_it(spark, tmp_path):
    path = write(f"{tmp_path}/in/x.json", '{\n"a":\n1\n}\n{\n"a":\n2\n}')
    with pytest.raises(ValueError, match="damaged JSON document"):
        json_docs.read_json(spark, path)


def test_index_over_two_files(spark, tmp_path):
    for name in "ba":
        write(f"{tmp_path}/in/{name}.csv", "v\n" + "".join(f"{name}{i}\n" for i in range(3)))
    rows = sinks.with_file_index(tabular.read_csv(spark, f"{tmp_path}/in"), "row").collect()
    assert sorted((r["v"], r["row"]) for r in rows) == [(f"{n}{i}", i) for n in "ab" for i in range(3)]


def test_convert_puts_lines_that_do_not_fit_apart(spark, tmp_path):
    path = write(f"{tmp_path}/raw/p.csv", "a,b\n1,2\n3,4,5\n6\n")
    source = ingest.Source("p.csv", path, "csv", 20, "p.parquet")
    report = ingest.convert(spark, source, f"{tmp_path}/out")
    assert (report["rows"], report["rejected"], report["short"], report["status"]) == (2, 1, 1, "completed")
    assert [r["line"] for r in spark.read.parquet(f"{tmp_path}/out/p__rejects").collect()] == ["3,4,5"]
    failed = ingest.convert_all(spark, [source], f"{tmp_path}/out2", ingest.Options(rejects="fail")).first()
    assert failed["status"] == "failed"


def test_listing(spark, tmp_path):
    for name in ("a.CSV", "b.json", "c.xyz", "sub/d.tsv", "sub/deep/e.parquet", "noext"):
        write(f"{tmp_path}/in/{name}", "x")
    flat = listing.list_files(spark, f"{tmp_path}/in")
    assert {r["relative"] for r in flat.collect()} == {"a.CSV", "b.json", "c.xyz", "noext"}
    deep = listing.list_files(spark, f"{tmp_path}/in/", recursive=True)
    assert {(r["relative"], r["format"], r["supported"], r["size"]) for r in deep.collect()} == {
        ("a.CSV", "csv", True, 1), ("b.json", "json", True, 1), ("c.xyz", "other", False, 1), ("noext", "other", False, 1),
        ("sub/d.tsv", "tsv", True, 1), ("sub/deep/e.parquet", "parquet", True, 1)}
    assert "content" not in deep._jdf.queryExecution().executedPlan().toString()
    chosen = listing.select_files(deep, include=["csv", "json", "tsv"], exclude=["json"], limit=1)
    assert [r["relative"] for r in chosen.collect()] == ["a.CSV"]
    assert {r["output"] for r in listing.to_convert(deep, None).collect()} == {
        "a.parquet", "b.parquet", "sub__d.parquet", "sub__deep__e.parquet"}


@pytest.mark.parametrize("codec", ["none", "snappy", "gzip", "lz4", "zstd"])
def test_codecs(spark, people, codec):
    folder, rows = people
    sinks.write_parquet(spark.createDataFrame(rows, HEADER), f"{folder}/out", codec)
    assert as_rows(spark.read.parquet(f"{folder}/out")) == rows


def test_codecs_that_do_not_work(spark, people):
    folder, rows = people
    df = spark.createDataFrame(rows, HEADER)
    with pytest.raises(ValueError, match="brotli"):
        sinks.write_parquet(df, f"{folder}/out", "brotli")
    with pytest.raises(ValueError, match="unknown codec"):
        sinks.write_parquet(df, f"{folder}/out", "zip")


def test_partitions_and_rows_per_file(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 2 AS k")
    sinks.write_parquet(df, f"{tmp_path}/out", partition_by=[" k "], rows_per_file=100)
    assert {n for n in os.listdir(f"{tmp_path}/out") if "=" in n} == {"k=0", "k=1"}
    files = listing.list_files(spark, f"{tmp_path}/out", recursive=True)
    assert files.count() >= 10
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1000


def test_rows_per_group(spark, tmp_path):
    import pyarrow.parquet as pq

    out = f"{tmp_path}/groups"
    sinks.write_parquet(spark.range(0, 1000, 1, 2), out, rows_per_group=100)
    files = [f"{out}/{f}" for f in os.listdir(out) if f.endswith(".parquet")]
    groups = [pq.ParquetFile(f).metadata.row_group(i).num_rows for f in files for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert groups == [100] * 10


@pytest.mark.parametrize("limit", ["1000000", "40"])
def test_file_index(spark, tmp_path, limit):
    path = write(f"{tmp_path}/in/n.csv", "v\n" + "".join(f"r{i}\n" for i in range(500)))
    spark.conf.set("spark.tidewell.taskRows", limit)
    try:
        rows = sinks.with_file_index(tabular.read_csv(spark, path), "row").collect()
    finally:
        spark.conf.unset("spark.tidewell.taskRows")
    assert sorted((r["row"], r["v"]) for r in rows) == [(i, f"r{i}") for i in range(500)]


@pytest.fixture
def raw(people):
    folder, rows = people
    write(f"{folder}/raw/people.csv", delimited(rows, ","))
    write(f"{folder}/raw/people.tsv", delimited(rows, "\t"))
    write(f"{folder}/raw/sub/people.csv", delimited(rows, ","))
    write(f"{folder}/raw/lines.jsonl", "\n".join(map(json.dumps, records(rows))))
    write(f"{folder}/raw/broken.json", "not json at all")
    write(f"{folder}/raw/book.xlsx", "no reader")
    write(f"{folder}/raw/notes.xyz", "skipped")
    return str(folder), rows


def test_convert_folder(spark, raw):
    folder, rows = raw
    report = ingest.convert_folder(spark, f"{folder}/raw", f"{folder}/out", recursive=True)
    got = {r["source"]: r for r in report.collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        "people.csv": "completed", "people.tsv": "completed", "sub/people.csv": "completed", "lines.jsonl": "completed",
        "broken.json": "failed", "book.xlsx": "unsupported"}
    # The same stem in one folder and in two folders.
    assert {got[n]["output"] for n in ("people.csv", "people.tsv")} == {"people__csv.parquet", "people__tsv.parquet"}
    assert got["broken.json"]["error"]
    one = got["sub/people.csv"]
    assert (one["rows"], one["output"]) == (5, "sub__people.parquet")
    assert one["schema"] == {"id": "bigint", "name": "string", "age": "bigint", "score": "double"}
    assert one["compression_ratio"] == one["parquet_bytes"] / one["source_bytes"]
    assert as_rows(spark.read.parquet(one["path"])) == rows
    totals = ingest.batch_totals(report).first()
    assert (totals["files"], totals["converted"]) == (6, 4)


def test_convert_skips_what_exists(spark, raw):
    folder, _ = raw
    ingest.convert_folder(spark, f"{folder}/raw", f"{folder}/out", recursive=True)
    again = ingest.convert_folder(spark, f"{folder}/raw", f"{folder}/out", recursive=True)
    assert {r["source"] for r in again.collect()} == {"broken.json", "book.xlsx"}
    forced = ingest.convert_folder(spark, f"{folder}/raw", f"{folder}/out", recursive=True, force=True)
    assert forced.count() == 6


def test_convert_by_folder(spark, people):
    folder, rows = people
    for i in range(3):
        write(f"{folder}/raw/day/part{i}.csv", delimited([(r[0] + 10 * i, *r[1:]) for r in rows], ","))
    report = ingest.convert_folder(spark, f"{folder}/raw", f"{folder}/out", recursive=True, by_folder=True).collect()
    assert [(r["source"], r["rows"], r["status"]) for r in report] == [("day", 15, "completed")]
    assert ingest.convert_folder(spark, f"{folder}/raw", f"{folder}/out", recursive=True, by_folder=True).count() == 0


def test_convert_options(spark, people):
    folder, rows = people
    path = write(f"{folder}/raw/p.csv", delimited(rows, ","))
    source = ingest.Source("p.csv", path, "csv", os.path.getsize(path), "p.parquet")
    options = ingest.Options(codec="zstd", partition_by=["age"], preserve_index=True)
    report = ingest.convert(spark, source, f"{folder}/out", options)
    table = spark.read.parquet(report["path"])
    assert report["partition_cols"] == ["age"]
    assert sorted((r[sinks.INDEX], r["id"]) for r in table.collect()) == [(i, i + 1) for i in range(5)]


def test_unsupported_format_raises(spark, tmp_path):
    path = write(f"{tmp_path}/raw/a.xyz", "text")
    with pytest.raises(ingest.UnsupportedFormat):
        ingest.convert(spark, ingest.Source("a.xyz", path, "other", 4, "a.parquet"), f"{tmp_path}/out")


def test_parquet_keeps_ratio_one(spark, people):
    folder, rows = people
    spark.createDataFrame(rows, HEADER).write.parquet(f"{folder}/in.parquet")
    source = ingest.Source("in.parquet", f"{folder}/in.parquet", "parquet", 10, "in.parquet")
    report = ingest.convert(spark, source, f"{folder}/out")
    assert (report["rows"], report["compression_ratio"]) == (5, 1.0)


def test_stream_converts_only_new_files(spark, people):
    folder, rows = people
    write(f"{folder}/in/a.csv", delimited(rows[:2], ","))
    schema = "id bigint, name string, age bigint, score double"

    def run():
        stream = incremental.arriving(spark, f"{folder}/in", "csv", schema, header="true")
        return incremental.convert_new_files(stream, f"{folder}/out", f"{folder}/mark")

    run()
    assert as_rows(spark.read.parquet(f"{folder}/out")) == rows[:2]
    write(f"{folder}/in/b.csv", delimited(rows[2:], ","))
    run()
    run()
    assert as_rows(spark.read.parquet(f"{folder}/out")) == rows


def test_stream_puts_lines_apart_and_goes_on(spark, tmp_path):
    folder, schema = str(tmp_path), "id bigint, name string, more double"

    def run():
        stream = incremental.arriving(spark, f"{folder}/in", "csv", schema, rejects=True, header="true")
        incremental.convert_with_rejects(stream, f"{folder}/out", f"{folder}/apart", f"{folder}/mark")

    def found():
        kept, lost = (spark.read.parquet(f"{folder}/{p}") for p in ("out", "apart"))
        return sorted((r["id"], r["name"], r["more"]) for r in kept.collect()), sorted(r["line"] for r in lost.collect())

    write(f"{folder}/in/a.csv", 'id,name,more\n1,a,2.5\n2,b\n3\nx,c,1\n4,"d,",1,9\n')
    run()
    first = [(1, "a", 2.5), (2, "b", None), (3, None, None)], ['4,"d,",1,9', "x,c,1"]
    assert found() == first
    write(f"{folder}/in/b.csv", "id,name,more\n5,e,7\n6,f,y\n")
    run()
    # The last batch is run again, as after a crash before its commit.
    for name in os.listdir(f"{folder}/mark/commits"):
        if name.startswith(("1", ".1")):
            os.remove(f"{folder}/mark/commits/{name}")
    run()
    assert found() == ([*first[0], (5, "e", 7.0)], [*first[1][:1], "6,f,y", *first[1][1:]])


def test_stream_batches_follow_bytes(spark, tmp_path):
    """Many small files are one batch, looked up by a few tasks per core; none is lost when batches are small."""
    for i in range(40):
        write(f"{tmp_path}/in/{i}.csv", f"id,name\n{i},a\n{i},b,c\n")

    def run(name, bound):
        stream = incremental.arriving(spark, f"{tmp_path}/in", "csv", "id bigint, name string", files_per_batch=16, rejects=True, bytes_per_batch=bound, header="true")
        query = incremental.convert_with_rejects(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-apart", f"{tmp_path}/{name}-mark")
        kept, lost = (spark.read.parquet(f"{tmp_path}/{p}") for p in (name, f"{name}-apart"))
        assert sorted(r["id"] for r in kept.collect()) == list(range(40)) and sorted(r["line"] for r in lost.collect()) == sorted(f"{i},b,c" for i in range(40))
        told = spark.sparkContext.statusTracker()
        stages = [s for job in told.getJobIdsForGroup(query.runId) for s in told.getJobInfo(job).stageIds]
        return kept.select("batch").distinct().count(), max(told.getStageInfo(s).numTasks for s in stages)

    batches, tasks = run("whole", 1 << 20)
    assert batches == 1 and tasks <= incremental.LISTING_WAVES * spark.sparkContext.defaultParallelism < 40
    assert run("small", 100)[0] > 3
    assert spark.conf.get(incremental.LISTING_KEY) == "10000"


def test_empty_totals(spark):
    empty = spark.createDataFrame([], "n bigint, p bigint, done boolean")
    row = listing.size_totals(empty, "n", "p", "done").first()
    assert (row["files"], row["converted"], row["ratio"]) == (0, 0, 1.0)


@pytest.mark.parametrize("text", ["plain", '{"a": 1,\n', '[\n1,\n', ""])
def test_damaged_json_fails(spark, tmp_path, text):
    path = write(f"{tmp_path}/in/x.json", text)
    with pytest.raises(Exception, match="JSON document"):
        json_docs.read_json(spark, path).collect()


def test_documents_are_made_by_several_tasks(spark, tmp_path):
    """A task writes few files, whatever they hold: one row each here."""
    rows = spark.range(400).selectExpr("id AS k", "concat('r', id) AS s", "'not needed' AS other").coalesce(1)
    docs = workload_ingest._documents(None, rows, ["s"], ["k"], 2)
    held = docs.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(held) >= 4 and max(r["count"] for r in held) < 100
    got = {r["doc"]: [x["s"] for x in r["rows"]] for r in docs.collect()}
    assert got == {i: [f"r{2 * i}", f"r{2 * i + 1}"] for i in range(200)}


def test_headers_are_looked_at_once(spark, tmp_path, monkeypatch):
    for name, content in (("a", "x,y\n1,2\n"), ("b", "y,x\n3,4\n"), ("c", 'x,y\n5,"6\n"\n')):
        write(f"{tmp_path}/in/{name}.csv", content)
    scans, shapes = [], tabular.file_shapes
    monkeypatch.setattr(tabular, "file_shapes", lambda *a, **k: scans.append(a) or shapes(*a, **k))
    report = ingest.convert_folder(spark, f"{tmp_path}/in", f"{tmp_path}/out", by_folder=True)
    assert len(scans) == 1
    told = {(r["status"], r["rows"]) for r in report.collect()}
    assert told == {("completed", 2), ("completed", 1)}


def test_shapes_are_decided_once(spark, tmp_path, monkeypatch):
    write(f"{tmp_path}/in/a.json", '{"a": 1}\n{"a": 2}\n')
    write(f"{tmp_path}/in/b.json", '[\n{"a": 3}\n]')
    write(f"{tmp_path}/in/c.json", "[4.5, 5]")
    kept, settled = [], json_docs.settled
    monkeypatch.setattr(json_docs, "settled", lambda df, purpose: kept.append(purpose) or settled(df, purpose))
    rows = json_docs.read_json(spark, f"{tmp_path}/in").collect()
    assert kept.count("file-shapes") == 1
    assert sorted((r["a"], r["value"]) for r in rows if r["a"]) == [(1, None), (2, None), (3, None)]
    assert sorted(r["value"] for r in rows if not r["a"]) == [4.5, 5.0]
