"""Ingest queries: the tables are written in other formats and read back, or listed as files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.paths import FORMATS, detect_format, is_supported, output_name
from tidewell.operators.ordering import with_position
from tidewell.plans import bulk, ingest
from tidewell.session import shared_folder
from tidewell.sources import json_docs, listing, sinks, tabular, types
from tidewell.streaming import incremental
from tidewell.workload import query

_ENDINGS = [*FORMATS, "CSV", "Parquet", "xyz", "tar.gz"]
_KIND_SQL = "CASE lower(ending) " + " ".join(f"WHEN '{e}' THEN '{k}'" for e, k in FORMATS.items()) + " ELSE 'other' END"
_FILES_SQL = f"""n AS (SELECT doc_id, n_chars, {_ENDINGS}[1 + doc_id % {len(_ENDINGS)}] AS ending FROM documents),
    f AS (SELECT doc_id, n_chars, source, 'raw.data/doc_' || doc_id || '.' || ending AS path, {_KIND_SQL} AS format
          FROM n JOIN documents USING (doc_id, n_chars))"""


def _files(t):
    ending = F.array(*[F.lit(e) for e in _ENDINGS])[(F.col("doc_id") % len(_ENDINGS)).cast("int")]
    path = F.concat(F.lit("raw.data/doc_"), F.col("doc_id").cast("string"), F.lit("."), ending)
    return listing.classified(t("documents").select("doc_id", "n_chars", "source", path.alias("path")))


@query(f"""WITH {_FILES_SQL} SELECT doc_id, path, format, format IN ('csv', 'json', 'excel', 'tsv', 'parquet') AS supported FROM f""")
def format_detect(t):
    return _files(t).select("doc_id", "path", detect_format(F.col("path")).alias("format"),
                            is_supported(F.col("format")).alias("supported"))


@query(f"""WITH {_FILES_SQL}
    SELECT format IN ('csv', 'json', 'excel', 'tsv', 'parquet') AS supported, format, count(*) AS files FROM f GROUP BY ALL""")
def format_support_counts(t):
    return listing.support_counts(_files(t))


@query(f"""WITH {_FILES_SQL}
    SELECT path, format FROM f WHERE format IN ('csv', 'tsv', 'json', 'txt') AND format NOT IN ('txt') ORDER BY path LIMIT 50""")
def format_selection(t):
    return listing.select_files(_files(t), ["csv", "tsv", "json", "txt"], ["txt"], 50).select("path", "format")


@query("""
    SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS folder, 'parquet' AS format, true AS supported, true AS filled FROM orders""")
def file_listing(t):
    out = shared_folder(t.spark, "orders-listed")
    sinks.write_parquet(t("orders"), out, partition_by=["o_orderstatus"], rows_per_file=5000)
    files = listing.list_files(t.spark, out, recursive=True)
    return files.groupBy(F.split("relative", "/")[0].alias("folder"), "format", "supported").agg(F.bool_and(F.col("size") > 0).alias("filled"))


@query("SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)")
def skip_existing(t):
    return listing.without_existing(t("documents"), t("labels"), "doc_id").select("doc_id", "source")


@query("""
    WITH j AS (SELECT n_chars, l.doc_id IS NOT NULL AS done FROM documents LEFT JOIN labels l USING (doc_id))
    SELECT count(*) AS files, count(*) FILTER (WHERE done) AS converted, round(sum(n_chars) / 1048576.0, 2) AS source_mb,
           round(sum(n_chars // 3) FILTER (WHERE done) / 1048576.0, 2) AS parquet_mb,
           round((sum(n_chars // 3) FILTER (WHERE done))::DOUBLE / sum(n_chars)::DOUBLE, 6) AS ratio FROM j""")
def corpus_size_totals(t):
    marks = t("labels").select("doc_id", F.lit(True).alias("mark"))
    joined = t("documents").join(marks, "doc_id", "left")
    joined = joined.withColumn("done", F.col("mark").isNotNull()).withColumn("packed", F.floor(F.col("n_chars") / 3))
    return listing.size_totals(joined, "n_chars", "packed", "done").withColumn("ratio", F.round("ratio", 6))


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS priority,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS maybe, o_orderstatus = 'F' AS closed FROM orders""")
def csv_scan(t):
    priority = F.when(F.col("o_orderkey") % 7 == 0, "NA").otherwise(F.col("o_orderpriority"))
    maybe = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey"))
    out = shared_folder(t.spark, "orders-csv")
    t("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        priority.alias("priority"), maybe.alias("maybe"), (F.col("o_orderstatus") == "F").alias("closed"),
    ).write.option("header", True).csv(out)
    return tabular.read_csv(t.spark, out)


@query("""
    SELECT unnest(['event_id', 'ts', 'user_id', 'value', 'mixed', 'flag', 'gone']) AS "column",
           unnest(['bigint', 'string', 'bigint', 'double', 'string', 'boolean', 'double']) AS type, (SELECT count(*) FROM events) AS rows""")
def csv_schema(t):
    mixed = F.when(F.col("event_id") % 9 == 0, "x").otherwise(F.col("event_id").cast("string"))
    out = shared_folder(t.spark, "events-csv")
    t("events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("ts"), "user_id", "value", mixed.alias("mixed"),
        (F.col("user_id") % 2 == 0).alias("flag"), F.lit("NA").alias("gone"),
    ).write.option("header", True).csv(out)
    raw = tabular.fitting(tabular.read_text_columns(t.spark, out)).drop(tabular.RAW, tabular.LONG)
    kinds = types.infer_types(raw)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("type")) for c, k in kinds.items()])
    return raw.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(pairs))


@query("SELECT doc_id, text, lang FROM documents")
def csv_quoted_text(t):
    out = shared_folder(t.spark, "documents-csv")
    writer = t("documents").select("doc_id", "text", "lang").write
    writer.options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(out)
    raw = tabular.read_text_columns(t.spark, out)
    return raw.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")


@query("SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def tsv_scan(t):
    out = shared_folder(t.spark, "customer-tsv")
    t("customer").write.option("header", True).option("sep", "\t").csv(out)
    return tabular.read_tsv(t.spark, out)


@query("SELECT event_id, user_id, event_type, value FROM events")
def json_lines_scan(t):
    out = shared_folder(t.spark, "events-json")
    t("events").select("event_id", "user_id", "event_type", "value").write.json(out)
    return json_docs.read_json(t.spark, out, "*.json").select("event_id", "user_id", "event_type", "value")


# Documents that a task makes and writes, about.
DOCUMENTS_PER_TASK = 40


def _documents(t, df, key, order, size=500):
    """Groups of at most `size` rows, as many documents as the table needs."""
    needed = df.select(*dict.fromkeys([*order, *key]))
    placed = with_position(needed, order, name="pos").withColumn("doc", F.floor(F.col("pos") / size))
    # A file takes its time whatever its size, so that a task has few of them.
    placed = placed.repartition(max(1, -(-df.count() // (size * DOCUMENTS_PER_TASK))), "doc")
    return placed.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("pos", *key))).alias("rows"))


def _write_documents(t, texts, purpose):
    """One file per document."""
    out = shared_folder(t.spark, purpose)
    texts.write.partitionBy("doc").text(out)
    return out


@query("SELECT p_partkey, p_name, p_size::BIGINT AS p_size, p_retailprice FROM part")
def json_array_scan(t):
    docs = _documents(t, t("part"), ["p_partkey", "p_name", "p_size", "p_retailprice"], ["p_partkey"])
    records = F.transform("rows", lambda r: r.dropFields("pos"))
    out = _write_documents(t, docs.select("doc", F.concat(
        F.lit("[\n"), F.array_join(F.transform(records, lambda r: F.to_json(r)), ",\n"), F.lit("\n]")).alias("value")), "part-json")
    return json_docs.read_json(t.spark, out).select("p_partkey", "p_name", "p_size", "p_retailprice")


@query("SELECT s_suppkey, s_name, s_acctbal, 'supplier' AS kind FROM supplier")
def json_columns_scan(t):
    docs = _documents(t, t("supplier"), ["s_suppkey", "s_name", "s_acctbal"], ["s_suppkey"], 100)
    columns = [F.concat(F.lit(f'"{c}": '), F.to_json(F.col(f"rows.{c}")))
               for c in ("s_suppkey", "s_name", "s_acctbal")]
    text = F.concat(F.lit('{\n"kind": "supplier",\n'), F.concat_ws(",\n", *columns), F.lit("\n}"))
    out = _write_documents(t, docs.select("doc", text.alias("value")), "supplier-json")
    return json_docs.read_json(t.spark, out).select("s_suppkey", "s_name", "s_acctbal", "kind")


@query("SELECT o_totalprice AS value FROM orders")
def json_scalars_scan(t):
    docs = _documents(t, t("orders"), ["o_totalprice"], ["o_orderkey"], 2000)
    text = F.concat(F.lit("[\n"), F.array_join(F.col("rows.o_totalprice").cast("array<string>"), ",\n"), F.lit("\n]"))
    out = _write_documents(t, docs.select("doc", text.alias("value")), "prices-json")
    return json_docs.read_json(t.spark, out).select("value")


@query("""
    SELECT event_type AS "group", count(*) AS lines, bool_and(json_valid(props) AND props[1] IN ('{', '[')) AS json_lines FROM events GROUP BY 1
    UNION ALL SELECT role, count(*) FILTER (WHERE trim(text) <> ''), false FROM conversations GROUP BY 1""")
def props_json_shape(t):
    events = t("events").select(F.col("event_type").alias("group"), F.col("props").alias("value"))
    talk = t("conversations").select(F.col("role").alias("group"), F.col("text").alias("value"))
    return json_docs.is_json_lines(events.unionByName(talk), group=["group"])


@query("SELECT 'region' AS source, (SELECT count(*) FROM region) AS rows, 2 AS columns, 1.0::DOUBLE AS ratio, 'completed' AS status "
       "UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), 6, 1.0, 'completed'")
def parquet_passthrough(t):
    out = shared_folder(t.spark, "parquet-copy")
    sources = [ingest.Source(n, t.path(n), "parquet", 1, f"{n}.parquet") for n in ("region", "orders")]
    report = ingest.convert_all(t.spark, sources, out)
    return report.select("source", "rows", F.size("schema").alias("columns"), F.col("compression_ratio").alias("ratio"), "status")


@query("""
    SELECT 'customer' AS source, 'csv' AS format, (SELECT count(*) FROM customer) AS rows, 'c_acctbal:double c_custkey:bigint c_mktsegment:string c_name:string c_nationkey:bigint' AS columns, 'completed' AS status
    UNION ALL SELECT 'part', 'json', (SELECT count(*) FROM part), 'p_brand:string p_name:string p_partkey:bigint p_retailprice:double p_size:bigint p_type:string', 'completed'
    UNION ALL SELECT 'supplier', 'tsv', (SELECT count(*) FROM supplier), 's_acctbal:double s_name:string s_nationkey:bigint s_suppkey:bigint', 'completed'""")
def convert_report(t):
    raw = shared_folder(t.spark, "raw")
    t("customer").write.option("header", True).csv(f"{raw}/customer")
    t("part").write.json(f"{raw}/part")
    # Spark names these files .csv; the copy job reads them by their folder and ending.
    t("supplier").write.option("header", True).option("sep", "\t").csv(f"{raw}/supplier")
    files = ingest.folders(listing.list_files(t.spark, raw, recursive=True).filter("supported"))
    sources = (
        s if s.name != "supplier" else ingest.Source(s.name, s.path, "tsv", s.size, s.output, s.glob)
        for s in ingest.sources_by_folder(t.spark, files))
    report = ingest.convert_all(t.spark, sources, shared_folder(t.spark, "converted"))
    columns = F.array_sort(F.transform(F.map_entries("schema"), lambda e: F.concat_ws(":", e["key"], e["value"])))
    return report.select("source", "format", "rows", F.array_join(columns, " ").alias("columns"), "status")


@query("""
    SELECT o_orderstatus, o_orderpriority, count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL""")
def sink_partitioned(t):
    out = shared_folder(t.spark, "orders-partitioned")
    sinks.write_parquet(t("orders"), out, "zstd", ["o_orderstatus", " o_orderpriority"], rows_per_file=1000)
    return t.spark.read.parquet(out).groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_incremental(t):
    columns = ["event_id", "user_id", "event_type", "value"]
    first, out = shared_folder(t.spark, "arriving"), shared_folder(t.spark, "streamed")
    mark, kind = shared_folder(t.spark, "stream-mark"), "event_id bigint, user_id bigint, event_type string, value double"
    for errors in (True, False):
        arrived = t("events").filter((F.col("event_type") == "error") == errors)
        arrived.select(columns).write.mode("append").option("header", True).csv(first)
        stream = incremental.arriving(t.spark, first, "csv", kind, header="true")
        incremental.convert_new_files(stream, out, mark)
    return t.spark.read.parquet(out).select(columns)


def _files_of(t, texts, purpose):
    """One file per row of a text column."""
    out = shared_folder(t.spark, purpose)
    texts.write.option("maxRecordsPerFile", 1).text(out)
    return out


def _delimited(t, df, key, header, line, size=400):
    """CSV files of at most `size` lines, each with the header."""
    docs = _documents(t, df.withColumn("line", line), ["line"], [key], size)
    return docs.select(F.concat_ws("\n", F.lit(header), F.col("rows.line")).alias("value"))


def _reject_lines(t):
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    line = F.when(F.col("o_orderkey") % 11 == 0, F.concat_ws(",", key, status, F.lit("more"))).when(
        F.col("o_orderkey") % 13 == 0, key).otherwise(F.concat_ws(",", key, status))
    return _files_of(t, _delimited(t, t("orders"), "o_orderkey", "key,status", line), "orders-odd")


@query("""
    SELECT o_orderkey AS key, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS status, false AS rejected FROM orders WHERE o_orderkey % 11 <> 0
    UNION ALL SELECT o_orderkey, o_orderstatus, true FROM orders WHERE o_orderkey % 11 = 0""")
def csv_rejects(t):
    raw = tabular.read_text_columns(t.spark, _reject_lines(t))
    kept = tabular.fitting(raw, "apart").select(F.col("key").cast("bigint").alias("key"), "status", F.lit(False).alias("rejected"))
    parts = F.split("line", ",")
    return kept.unionByName(tabular.rejected(raw).select(parts[0].cast("bigint").alias("key"), parts[1].alias("status"), F.lit(True).alias("rejected")))


@query("""
    SELECT 'completed' AS status, count(*) FILTER (WHERE o_orderkey % 11 <> 0) AS rows, count(*) FILTER (WHERE o_orderkey % 11 = 0) AS rejected,
           count(*) FILTER (WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0) AS short FROM orders""")
def csv_reject_report(t):
    source = ingest.Source("orders", _reject_lines(t), "csv", 1, "orders.parquet", "*.txt")
    return ingest.convert_all(t.spark, [source], shared_folder(t.spark, "converted")).select("status", "rows", "rejected", "short")


@query("""
    WITH m AS (SELECT max(event_id) AS last FROM events)
    SELECT event_id, CASE WHEN event_id = last THEN 2.5 ELSE user_id::DOUBLE END AS n, CASE WHEN event_id = last THEN 'x' ELSE user_id::VARCHAR END AS s FROM events, m""")
def csv_late_type(t):
    last = t("events").agg(F.max("event_id").alias("last"))
    odd = F.col("event_id") == F.col("last")
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.when(odd, "2.5").otherwise(F.col("user_id").cast("string")), F.when(odd, "x").otherwise(F.col("user_id").cast("string")))
    texts = _delimited(t, t("events").join(F.broadcast(last), F.lit(True)), "event_id", "event_id,n,s", line)
    return tabular.read_csv(t.spark, _files_of(t, texts, "events-late"))


@query("SELECT o_orderkey AS id, o_custkey AS score, o_orderkey % 3 = 0 AS swapped FROM orders")
def csv_two_headers(t):
    id_, score = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    swapped = F.col("o_orderkey") % 3 == 0
    raw = shared_folder(t.spark, "two-headers")
    for i, (rows, header, line) in enumerate([
        (t("orders").where(swapped), "score,id,swapped", F.concat_ws(",", score, id_, F.lit("true"))),
        (t("orders").where(~swapped), "id,score,swapped", F.concat_ws(",", id_, score, F.lit("false"))),
    ]):
        _delimited(t, rows, "o_orderkey", header, line).write.option("maxRecordsPerFile", 1).mode("append").text(raw)
    source = ingest.Source("two", raw, "csv", 1, "two.parquet", "*.txt")
    files = t.spark.createDataFrame([(source.name, source.path, "csv", 1, source.output, "txt")], "name string, path string, format string, size bigint, output string, ending string")
    report = ingest.convert_all(t.spark, ingest.sources_by_folder(t.spark, files), shared_folder(t.spark, "converted"))
    tables = [r["path"] for r in report.select("path").collect()]
    # One table per header, so two here.
    first, second = (t.spark.read.parquet(p) for p in tables)
    return first.unionByName(second)


@query("""
    WITH o AS (SELECT *, o_orderkey % 3 = 0 AS swapped FROM orders)
    SELECT 'completed' AS status, CASE WHEN swapped THEN 'id:bigint price:double score:bigint' ELSE 'id:bigint note:string' END AS columns,
           count(*) AS rows, sum(o_orderkey)::BIGINT AS ids, 0::BIGINT AS rejected FROM o GROUP BY swapped""")
def convert_many_files(t):
    """Files of two headers, converted together; the report and the rows of all tables."""
    raw, out = shared_folder(t.spark, "many-raw"), shared_folder(t.spark, "many-out")
    id_, swapped = F.col("o_orderkey").alias("id"), F.col("o_orderkey") % 3 == 0
    note = F.concat(F.lit("a\n"), "o_orderpriority").alias("note")
    for rows in (t("orders").where(swapped).select(F.col("o_custkey").alias("score"), id_, F.col("o_totalprice").alias("price")), t("orders").where(~swapped).select(id_, note)):
        rows.write.options(header=True, maxRecordsPerFile=4000, escape='"').mode("append").csv(raw)
    report = bulk.convert_many(t.spark, raw, out)
    columns = F.array_join(F.array_sort(F.transform(F.map_entries("schema"), lambda e: F.concat_ws(":", e["key"], e["value"]))), " ")
    told = report.groupBy("status", columns.alias("columns")).agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"))
    ids = t.spark.read.schema(f"id bigint, {listing.OUTPUT} string").parquet(out).join(report.select("output", columns.alias("columns")), F.col(listing.OUTPUT) == F.col("output"))
    return told.join(ids.groupBy("columns").agg(F.sum("id").alias("ids")), "columns")


@query("""
    SELECT event_id, value, NULL::BIGINT AS part, NULL::VARCHAR AS name FROM events
    UNION ALL SELECT NULL, NULL, p_partkey, p_name FROM part
    UNION ALL SELECT NULL, s_acctbal, NULL, NULL FROM supplier""")
def json_mixed_folder(t):
    lines = _documents(t, t("events"), ["event_id", "value"], ["event_id"])
    record = F.transform("rows", lambda r: F.to_json(r.dropFields("pos")))
    records = _documents(t, t("part").selectExpr("p_partkey AS part", "p_name AS name"), ["part", "name"], ["part"])
    values = _documents(t, t("supplier"), ["s_acctbal"], ["s_suppkey"], 50)
    texts = lines.select(F.concat_ws("\n", record).alias("value")).unionByName(
        records.select(F.concat(F.lit("[\n"), F.array_join(record, ",\n"), F.lit("\n]")).alias("value"))).unionByName(
        values.select(F.concat(F.lit("["), F.array_join(F.col("rows.s_acctbal").cast("array<string>"), ","), F.lit("]")).alias("value")))
    return json_docs.read_json(t.spark, _files_of(t, texts, "mixed-json")).select("event_id", "value", "part", "name")


@query("""
    SELECT CASE WHEN event_id % 10 <> 1 THEN event_id END AS event_id, CASE WHEN event_id % 10 <> 1 THEN value END AS value,
           CASE WHEN event_id % 10 = 1 THEN '{"event_id":' || event_id END AS damaged FROM events""")
def json_damaged_line(t):
    line = F.when(F.col("event_id") % 10 == 1, F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"))).otherwise(F.to_json(F.struct("event_id", "value")))
    docs = _documents(t, t("events").withColumn("line", line), ["line"], ["event_id"], 300)
    out = _files_of(t, docs.select(F.concat_ws("\n", "rows.line").alias("value")), "damaged-json")
    return json_docs.read_json(t.spark, out).select("event_id", "value", F.col("_corrupt_record").alias("damaged"))


@query("SELECT r_regionkey, r_name, n FROM region JOIN (SELECT n_regionkey AS r_regionkey, count(*) AS n FROM nation GROUP BY 1) USING (r_regionkey)")
def json_object_scan(t):
    """One object per file, over several lines."""
    counts = t("nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.count(F.lit(1)).alias("n"))
    record = F.to_json(F.struct("r_regionkey", "r_name", "n"))
    text = F.regexp_replace(F.regexp_replace(record, r'([{,])"', '$1\n"'), r"\}$", "\n}")
    return json_docs.read_json(t.spark, _files_of(t, t("region").join(counts, "r_regionkey").select(text.alias("value")), "region-json"))


@query("SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderkey IS NOT NULL) AS keys, true AS bounded FROM orders")
def row_groups(t):
    """Row groups of at most 100 rows, as the footers of the written files tell."""
    out = shared_folder(t.spark, "orders-groups")
    sinks.write_parquet(t("orders"), out, rows_per_group=100)
    groups = sinks.row_groups(t.spark, out)
    rows = t.spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows"), F.count("o_orderkey").alias("keys"))
    return rows.join(groups.agg((F.max("rows") <= 100).alias("bounded"), F.sum("rows").alias("in_groups")), F.col("rows") == F.col("in_groups")).drop("in_groups")


@query(f"""
    WITH {_FILES_SQL}
    SELECT doc_id, 'raw_data__' || 'doc_' || doc_id || CASE WHEN ending = 'tar.gz' THEN '.tar' ELSE '' END || '.parquet' AS output
    FROM (SELECT doc_id, {_ENDINGS}[1 + doc_id % {len(_ENDINGS)}] AS ending FROM documents)""")
def output_names(t):
    files = _files(t).withColumn("relative", F.replace("path", F.lit("raw.data"), F.lit("raw_data")))
    return files.select("doc_id", output_name(F.col("relative")).alias("output"))


@query("""
    SELECT o_orderkey AS key, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS status, NULL::VARCHAR AS line FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 17 <> 0
    UNION ALL SELECT NULL, NULL, CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey || ',' || o_orderstatus || ',more' ELSE 'x' || o_orderkey || ',' || o_orderstatus END
    FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 17 = 0""")
def stream_rejects(t):
    """Lines that do not fit are put apart, and the stream goes on."""
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    line = F.when(F.col("o_orderkey") % 11 == 0, F.concat_ws(",", key, status, F.lit("more"))).when(
        F.col("o_orderkey") % 17 == 0, F.concat(F.lit("x"), key, F.lit(","), status)).when(F.col("o_orderkey") % 13 == 0, key).otherwise(F.concat_ws(",", key, status))
    arriving, out, apart, mark = (shared_folder(t.spark, f"reject-{p}") for p in ("in", "out", "apart", "mark"))
    for part in range(2):
        _delimited(t, t("orders").where(F.col("o_orderkey") % 2 == part), "o_orderkey", "key,status", line).write.option("maxRecordsPerFile", 1).mode("append").text(arriving)
        stream = incremental.arriving(t.spark, arriving, "csv", "key bigint, status string", rejects=True, bytes_per_batch=256 << 20, header="true", pathGlobFilter="*.txt")
        incremental.convert_with_rejects(stream, out, apart, mark)
    kept, lost = t.spark.read.parquet(out), t.spark.read.parquet(apart)
    none = F.lit(None).cast("string").alias
    return kept.select("key", "status", none("line")).unionByName(lost.select(F.lit(None).cast("bigint").alias("key"), none("status"), "line"))


@query("SELECT o_totalprice AS value FROM orders")
def json_scalars_one_line(t):
    docs = _documents(t, t("orders"), ["o_totalprice"], ["o_orderkey"], 700)
    text = F.concat(F.lit("["), F.array_join(F.col("rows.o_totalprice").cast("array<string>"), ", "), F.lit("]"))
    return json_docs.read_json(t.spark, _files_of(t, docs.select(text.alias("value")), "prices-line"))
