"""Catalog and job-status queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import paths
from tidewell.operators import catalog as ops
from tidewell.session import shared_folder
from tidewell.streaming import incremental
from tidewell.streaming import status as running
from tidewell.workload import query


@query("""
    SELECT p_partkey, '/data/datasets/' || regexp_replace(p_brand || ': ' || p_name || '/é', '[^\\p{L}\\p{N}_-]', '_', 'g')
        || '_' || strftime(TIMESTAMP '2023-01-01 12:00:00' + to_days(p_size), '%Y%m%d_%H%M%S') AS path
    FROM part""")
def safe_dataset_path(t):
    at = F.expr("timestamp_ntz'2023-01-01 12:00:00' + make_dt_interval(p_size)")
    name = F.concat("p_brand", F.lit(": "), "p_name", F.lit("/é"))
    path = paths.dataset_path("/data", "datasets/{dataset_name}_{timestamp}", {"dataset_name": name}, at)
    return t("part").select("p_partkey", path.alias("path"))


_PAGE_SQL = """
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS pos
               FROM lineitem)
    SELECT l_orderkey, pos // 4 AS page, count(*)::INTEGER AS file_count,
           string_agg(l_linenumber || ':' || l_partkey, ' ' ORDER BY pos) AS files
    FROM p GROUP BY 1, 2"""
_FILE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _entries(t, page=4):
    return ops.nested_entries(t("lineitem"), "l_orderkey", _FILE_ORDER, ["l_linenumber", "l_partkey", "l_extendedprice"], page)


@query(_PAGE_SQL)
def catalog_nested(t):
    names = F.transform("files", lambda f: F.concat_ws(":", f["l_linenumber"].cast("string"), f["l_partkey"].cast("string")))
    return _entries(t).select("l_orderkey", "page", F.size("files").alias("file_count"), F.array_join(names, " ").alias("files"))


@query("""
    SELECT l_orderkey, count(*) AS file_count, round(sum(l_extendedprice) * 100 / 1048576.0, 2) AS total_mb
    FROM lineitem GROUP BY 1""")
def nested_totals(t):
    entries = _entries(t).withColumn("files", F.transform("files", lambda f: f.withField("size", f["l_extendedprice"] * 100)))
    return ops.nested_totals(entries, "l_orderkey", "size").select("l_orderkey", "file_count", "total_mb")


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')")
def list_filter(t):
    return ops.filter_by_name(t("part"), "p_name", "RiNg").select("p_partkey", "p_name")


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS created FROM orders
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""")
def list_latest(t):
    newest = ops.latest(t("orders"), "o_orderdate", "o_orderkey", 100)
    return newest.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"))


@query("""
    WITH m AS (SELECT o_custkey, max(o_orderdate) AS created, count(*) AS file_count FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT c_custkey, c_name, coalesce(strftime(created, '%Y-%m-%d'), '') AS created,
           CASE WHEN m.o_custkey IS NULL THEN '' ELSE 'customer/' || c_custkey END AS dataset_ref,
           coalesce(file_count, 0) AS file_count
    FROM customer LEFT JOIN m ON c_custkey = o_custkey""")
def list_brief(t):
    metadata = t("orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("created"), F.count(F.lit(1)).alias("file_count"))
    metadata = metadata.withColumn("dataset_ref", F.concat(F.lit("customer/"), "c_custkey"))
    return ops.brief_listing(t("customer").select("c_custkey", "c_name"), metadata, "c_custkey")


@query("""
    WITH j AS (SELECT d.doc_id, d.source, l.quality, l.toxic, l.doc_id IS NULL AS gone, l.doc_id % 5 = 0 AS broken
               FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT doc_id, source, gone AS metadata_missing,
           CASE WHEN broken THEN 'metadata is not valid JSON' END AS error,
           CASE WHEN NOT broken THEN quality END AS quality, CASE WHEN NOT broken THEN toxic END AS toxic
    FROM j""")
def list_detail_flags(t):
    document = F.when(F.col("doc_id") % 5 == 0, "{broken").otherwise(F.to_json(F.struct("quality", "toxic")))
    metadata = t("labels").select("doc_id", document.alias("document"))
    datasets = t("documents").select("doc_id", "source")
    out = ops.detail_listing(datasets, metadata, "doc_id", "document", "quality int, toxic int")
    return out.select("doc_id", "source", "metadata_missing", "error", "metadata.quality", "metadata.toxic")


@query("""
    WITH f AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'skipped'
                      WHEN o_orderpriority = '1-URGENT' THEN 'failed' ELSE 'in_progress' END AS s FROM orders)
    SELECT o_custkey, CASE WHEN bool_and(s IN ('completed', 'skipped')) THEN 'downloaded'
                           WHEN bool_or(s = 'failed') THEN 'failed' ELSE 'downloading' END AS status, count(*) AS files
    FROM f GROUP BY 1""")
def status_rollup(t):
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "skipped")
        .when(F.col("o_orderpriority") == "1-URGENT", "failed").otherwise("in_progress"))
    return ops.status_rollup(t("orders").withColumn("file_status", status), "o_custkey", "file_status")


@query("""
    WITH p AS (SELECT user_id, event_id, value, coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS old_progress FROM events)
    SELECT user_id, event_id, value, old_progress, CASE WHEN value >= 100 THEN 'completed' WHEN value > 0 THEN 'in_progress' END AS status
    FROM p WHERE trunc(old_progress / 10) < trunc(value / 10)""")
def progress_milestones(t):
    out = ops.progress_milestones(t("events"), ["user_id"], ["ts", "event_id"], "value")
    return out.select("user_id", "event_id", "value", "old_progress", "status")


_KINDS_SQL = """CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'signup' THEN 'skipped' WHEN 'error' THEN 'failed' ELSE 'progress' END"""


def _kind():
    e = F.col("event_type")
    return F.when(e == "purchase", "completed").when(e == "signup", "skipped").when(e == "error", "failed").otherwise("progress")


@query(f"""
    WITH e AS (SELECT user_id, ts, event_id, value, {_KINDS_SQL} AS kind FROM events),
    s AS (SELECT user_id, ts, event_id,
                 CASE WHEN kind <> 'progress' THEN kind WHEN value >= 100 THEN 'completed' WHEN value > 0 THEN 'in_progress' END AS status,
                 CASE WHEN kind = 'progress' THEN value WHEN kind IN ('completed', 'skipped') THEN 100.0 END AS progress FROM e)
    SELECT user_id, coalesce(arg_max(status, (ts, event_id)) FILTER (WHERE status IS NOT NULL), 'pending') AS status,
           coalesce(arg_max(progress, (ts, event_id)) FILTER (WHERE progress IS NOT NULL), 0)::DOUBLE AS progress
    FROM s GROUP BY 1""")
def latest_status(t):
    log = t("events").withColumn("kind", _kind())
    return ops.latest_status(log, ["user_id"], ["ts", "event_id"], "kind", "value")


@query(f"""
    WITH e AS (SELECT user_id, ts, event_id, value, {_KINDS_SQL} AS kind FROM events),
    p AS (SELECT user_id, event_id, value, coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS old_progress FROM e),
    s AS (SELECT user_id, ts, event_id,
                 CASE WHEN kind <> 'progress' THEN kind WHEN value >= 100 THEN 'completed' WHEN value > 0 THEN 'in_progress' END AS status,
                 CASE WHEN kind = 'progress' THEN value WHEN kind IN ('completed', 'skipped') THEN 100.0 END AS progress FROM e)
    SELECT user_id, event_id, 'milestone' AS what, value AS progress, old_progress, CASE WHEN value >= 100 THEN 'completed' WHEN value > 0 THEN 'in_progress' END AS status
    FROM p WHERE trunc(old_progress / 10) < trunc(value / 10)
    UNION ALL SELECT user_id, NULL, 'status', coalesce(arg_max(progress, (ts, event_id)) FILTER (WHERE progress IS NOT NULL), 0)::DOUBLE, NULL,
           coalesce(arg_max(status, (ts, event_id)) FILTER (WHERE status IS NOT NULL), 'pending') FROM s GROUP BY 1""")
def stream_status(t):
    """The log arrives in three parts, each read by a run of its own."""
    log = t("events").withColumn("kind", _kind()).select("user_id", "ts", "event_id", "kind", "value")
    ends = log.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    part = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - ends[0]) * 3 / (ends[1] - ends[0] + 1))
    arriving, out, mark = (shared_folder(t.spark, f"status-{p}") for p in ("in", "out", "mark"))
    for i in range(3):
        log.where(part == i).write.mode("append").parquet(arriving)
        stream = incremental.arriving(t.spark, arriving, "parquet", log.schema)
        running.follow(running.running_status(stream, ["user_id"], ["ts", "event_id"], "kind", "value"), out, mark)
    told = t.spark.read.parquet(out)
    last = running.latest(told, ["user_id"]).select(
        "user_id", F.lit(None).cast("bigint").alias("event_id"), F.lit("status").alias("what"), "progress", F.lit(None).cast("double").alias("old_progress"), "status")
    return told.where("what = 'milestone'").select("user_id", "event_id", "what", "progress", "old_progress", "status").unionByName(last)


@query("""
    WITH l AS (SELECT CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
                      strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || CASE WHEN event_type = 'error' THEN ' [ERROR] ' ELSE ' [INFO] ' END
                      || 'file ' || user_id || ' ' || event_type AS line FROM events)
    SELECT level, count(*) AS events, min(line) AS first_line, max(line) AS last_line FROM l GROUP BY 1""")
def event_log_levels(t):
    message = F.concat(F.lit("file "), F.col("user_id").cast("string"), F.lit(" "), F.col("event_type"))
    failed = F.col("event_type") == "error"
    lines = ops.log_lines(t("events"), "ts", failed, message, keep=["event_type"])
    log = shared_folder(t.spark, "event-log")
    ops.append_log(lines.filter("level = 'INFO'").drop("event_type"), log)
    ops.append_log(lines.filter("level = 'ERROR'").drop("event_type"), log)
    return t.spark.read.parquet(log).groupBy("level").agg(
        F.count(F.lit(1)).alias("events"), F.min("line").alias("first_line"), F.max("line").alias("last_line"))


@query("""
    SELECT doc_id, coalesce(nullif(quality, 0), toxic, -1) AS size, coalesce(lang, 'unknown') AS lang
    FROM documents LEFT JOIN labels USING (doc_id)""")
def coalesce_fields(t):
    joined = t("documents").join(t("labels"), "doc_id", "left")
    size = ops.first_present(F.nullif("quality", F.lit(0)), F.col("toxic"), default=F.lit(-1))
    lang = ops.first_present(F.col("lang"), default=F.lit("unknown"))
    return joined.select("doc_id", size.alias("size"), lang.alias("lang"))


@query("""
    SELECT c_custkey::VARCHAR AS c_custkey, '' AS s_suppkey, c_name AS name, c_nationkey::VARCHAR AS nation FROM customer
    UNION ALL SELECT '', s_suppkey::VARCHAR, s_name, s_nationkey::VARCHAR FROM supplier""")
def union_fill(t):
    customer = t("customer").selectExpr("c_custkey", "c_name AS name", "c_nationkey AS nation")
    supplier = t("supplier").selectExpr("s_suppkey", "s_name AS name", "s_nationkey AS nation")
    return ops.union_filled(customer, supplier)


@query("""
    SELECT 'orders/' || o_orderkey AS dataset_ref, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS created,
           (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS file_count FROM orders""")
def catalog_documents(t):
    ref = F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string"))
    datasets = t("orders").select(
        ref.alias("ref"), F.col("o_orderkey").cast("string").alias("name"), F.col("o_custkey").cast("string").alias("owner"),
        F.col("o_totalprice").cast("bigint").alias("size"), F.lit("").alias("url"), "o_orderdate")
    files = t("lineitem").select(
        F.concat(F.lit("orders/"), F.col("l_orderkey").cast("string")).alias("ref"), *_FILE_ORDER,
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".parquet")).alias("filename"),
        F.col("l_extendedprice").cast("bigint").alias("size"), F.col("l_quantity").cast("bigint").alias("rows"))
    entries = ops.nested_entries(files, "ref", _FILE_ORDER, ["filename", "size", "rows"])
    documents = ops.metadata_documents(
        datasets, entries, F.concat(F.lit("/data/"), F.col("ref")), "/data", "{ref}", F.col("o_orderdate"))
    place = shared_folder(t.spark, "metadata")
    ops.write_documents(documents, place)
    return ops.document_summary(ops.read_documents(t.spark, place)).select("dataset_ref", "created", "file_count")


@query(f"""
    WITH e AS (SELECT user_id % 10 AS dataset, user_id, ts, event_id, value, {_KINDS_SQL} AS kind FROM events),
    s AS (SELECT dataset, user_id, ts, event_id,
                 CASE WHEN kind <> 'progress' THEN kind WHEN value >= 100 THEN 'completed' WHEN value > 0 THEN 'in_progress' END AS st,
                 CASE WHEN kind = 'progress' THEN value WHEN kind IN ('completed', 'skipped') THEN 100.0 END AS pr FROM e),
    f AS (SELECT dataset, user_id, coalesce(arg_max(st, (ts, event_id)) FILTER (WHERE st IS NOT NULL), 'pending') AS st,
                 coalesce(arg_max(pr, (ts, event_id)) FILTER (WHERE pr IS NOT NULL), 0) AS pr FROM s GROUP BY 1, 2)
    SELECT dataset, CASE WHEN bool_and(st IN ('completed', 'skipped')) THEN 'downloaded' WHEN bool_or(st = 'failed') THEN 'failed' ELSE 'downloading' END AS status,
           string_agg(user_id || ':' || st, ' ' ORDER BY user_id) AS files, round(sum(pr), 2) AS progress FROM f GROUP BY 1""")
def status_documents(t):
    log = t("events").withColumns({"kind": _kind(), "dataset": F.col("user_id") % 10})
    files = ops.latest_status(log, ["dataset", "user_id"], ["ts", "event_id"], "kind", "value").withColumnRenamed("status", "file_status")
    documents = ops.status_documents(files, "dataset", ["user_id"], "file_status", ["user_id", "file_status", "progress"])
    names = F.transform("files", lambda f: F.concat_ws(":", f["user_id"].cast("string"), f["file_status"]))
    progress = F.aggregate("files", F.lit(0.0), lambda a, f: a + f["progress"])
    return documents.select("dataset", "status", F.array_join(names, " ").alias("files"), F.round(progress, 2).alias("progress"))
