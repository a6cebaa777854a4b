"""Profile and feature-viewer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import features
from tidewell.operators import profile as ops
from tidewell.session import shared_folder
from tidewell.sources import tfrecord
from tidewell.workload import query


@query("SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 20")
def head_rows(t):
    return ops.head(t("events"), "event_id", 20).select("event_id", "user_id", "event_type", "value")


@query("SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def table_shape(t):
    return ops.table_shape(t("lineitem"))


@query("""
    SELECT * FROM (VALUES (0, 'event_id', 'bigint'), (1, 'ts', 'timestamp_ntz'), (2, 'user_id', 'bigint'),
        (3, 'event_type', 'string'), (4, 'value', 'double'), (5, 'props', 'string')) v(position, "column", dtype)
    JOIN (UNPIVOT (SELECT count(event_id) AS event_id, count(ts) AS ts, count(user_id) AS user_id,
                          count(event_type) AS event_type, count(value) AS value, count(props) AS props FROM events)
          ON COLUMNS(*) INTO NAME "column" VALUE non_null) USING ("column")
    CROSS JOIN (SELECT 0::BIGINT AS nulls)""")
def table_info(t):
    return ops.table_info(t("events"))


@query("""
    WITH j AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT 'doc_id' AS "column", count(*) FILTER (WHERE doc_id IS NULL) AS nulls FROM j
    UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL) FROM j
    UNION ALL SELECT 'source', count(*) FILTER (WHERE source IS NULL) FROM j
    UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM j
    UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM j""")
def null_counts(t):
    joined = t("documents").join(t("labels"), "doc_id", "left")
    return ops.null_counts(joined.select("doc_id", "lang", "source", "quality", "toxic"))


def _describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
           min({c})::DOUBLE AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25,
           round(quantile_cont({c}::DOUBLE, 0.5), 6) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75,
           max({c})::DOUBLE AS max FROM {table}""" for c in columns)


def _describe(df, columns):
    return ops.describe(df, columns).withColumns({
        **{c: F.round(c, 4) for c in ("mean", "std")}, **{c: F.round(c, 6) for c in ("q25", "q50", "q75")}
    })


@query(_describe_sql("orders", ["o_totalprice"]))
def describe_orders(t):
    return _describe(t("orders"), ["o_totalprice"])


_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(_describe_sql("lineitem", _LINE))
def describe_lineitem(t):
    return _describe(t("lineitem"), _LINE)


_EVENT_FEATURES = ["event_id", "user_id", "event_type", "value"]


@query("""
    SELECT 'event_id' AS feature, 'int64_list' AS kind UNION ALL SELECT 'user_id', 'int64_list'
    UNION ALL SELECT 'event_type', 'bytes_list' UNION ALL SELECT 'value', 'float_list'
    UNION ALL SELECT DISTINCT 'props.' || unnest(json_keys(props)), 'int64_list' FROM events""")
def feature_kinds(t):
    events = t("events").withColumn("props.k", F.get_json_object("props", "$.k").cast("bigint"))
    renamed = events.withColumnRenamed("props.k", "props_k")
    out = features.feature_kinds(features.to_records(renamed, [*_EVENT_FEATURES, "props_k"]))
    return out.withColumn("feature", F.replace("feature", F.lit("props_"), F.lit("props.")))


def _stats_sql(source: str, numeric: dict[str, str], text: list[str]) -> str:
    parts = [f"""
    SELECT '{c}' AS feature, 'Numeric' AS type, count(*) AS count, count(DISTINCT {x}) AS "unique",
           round(avg(({x})::DOUBLE), 4) AS mean, NULL::VARCHAR AS mode, min({x})::DOUBLE AS min, max({x})::DOUBLE AS max FROM s"""
             for c, x in numeric.items()]
    parts += [f"""
    SELECT '{c}' AS feature, 'Bytes' AS type, sum(n)::BIGINT AS count, count(*) AS "unique", NULL::DOUBLE AS mean,
           arg_min(v, (-n, v)) AS mode, NULL::DOUBLE AS min, NULL::DOUBLE AS max
    FROM (SELECT {c} AS v, count(*) AS n FROM s GROUP BY 1)""" for c in text]
    return f"WITH s AS ({source}) " + " UNION ALL ".join(parts)


def _stats(df):
    numeric = F.col("type") == "Numeric"
    return df.select(
        "feature", "type", "count", "unique",
        F.when(numeric, F.col("mean_or_mode").cast("double")).alias("mean"),
        F.when(~numeric, F.col("mean_or_mode")).alias("mode"),
        F.when(numeric, F.col("min").cast("double")).alias("min"),
        F.when(numeric, F.col("max").cast("double")).alias("max"),
    )


@query(_stats_sql("SELECT * FROM orders", {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey",
                                           "o_totalprice": "o_totalprice::FLOAT"}, []))
def feature_stats_numeric(t):
    return _stats(features.feature_statistics(
        features.to_records(t("orders"), ["o_orderkey", "o_custkey", "o_totalprice"])))


@query(_stats_sql("SELECT * FROM orders", {}, ["o_orderstatus", "o_orderpriority"]))
def feature_stats_string(t):
    return _stats(features.feature_statistics(
        features.to_records(t("orders"), ["o_orderstatus", "o_orderpriority"])))


@query(_stats_sql("SELECT * FROM events ORDER BY event_id LIMIT 1000",
                  {"event_id": "event_id", "user_id": "user_id", "value": "value::FLOAT"}, ["event_type"]))
def feature_stats_limited(t):
    records = features.to_records(t("events"), _EVENT_FEATURES, keep=["event_id"])
    return _stats(features.feature_statistics(records, 1000, ["event_id"]))


@query("""
    WITH s AS (SELECT unnest(embedding)::FLOAT AS v FROM embeddings)
    SELECT 'embedding' AS feature, 'Numeric' AS type, count(*) AS count, count(DISTINCT v) AS "unique",
           round(avg(v::DOUBLE), 4) AS mean, NULL::VARCHAR AS mode, min(v)::DOUBLE AS min, max(v)::DOUBLE AS max FROM s
    UNION ALL SELECT 'label', 'Numeric', count(*), count(DISTINCT label), round(avg(label), 4), NULL::VARCHAR,
           min(label)::DOUBLE, max(label)::DOUBLE FROM embeddings""")
def feature_stats_lists(t):
    return _stats(features.feature_statistics(features.to_records(t("embeddings"), ["embedding", "label"])))


@query("""
    SELECT 'gone' AS feature, 'N/A' AS type, 0::BIGINT AS count, 0::BIGINT AS "unique", '-' AS mean_or_mode, '-' AS min, '-' AS max
    UNION ALL SELECT 'some', 'Numeric', count(*), count(DISTINCT o_custkey), round_even(avg(o_custkey), 4)::VARCHAR, min(o_custkey)::VARCHAR, max(o_custkey)::VARCHAR
    FROM orders WHERE o_orderkey % 3 = 0""")
def feature_stats_empty(t):
    """A feature without any value, and one whose lists are often empty."""
    none, some = F.array().cast("array<bigint>"), F.when(F.col("o_orderkey") % 3 == 0, F.array("o_custkey")).otherwise(F.array().cast("array<bigint>"))
    records = features.to_records(t("orders").select(none.alias("gone"), some.alias("some")), ["gone", "some"])
    return features.feature_statistics(records)


@query("""
    SELECT n_nationkey, '{' || chr(10) || '  "n_name": [' || chr(10) || '    "' || n_name || '"' || chr(10) || '  ],' || chr(10)
        || '  "n_nationkey": [' || chr(10) || '    ' || n_nationkey || chr(10) || '  ]' || chr(10) || '}' AS json FROM nation""")
def record_json(t):
    records = features.to_records(t("nation"), ["n_nationkey", "n_name"], keep=["n_nationkey"])
    return records.select("n_nationkey", features.record_json(F.col("record")).alias("json"))


@query("""
    SELECT vec_id, label::VARCHAR AS label, CASE WHEN vec_id % 3 = 1 THEN '' ELSE
           '[' || array_to_string(list_transform(embedding, lambda x: round_even(x::DOUBLE * 1000, 0)::BIGINT::VARCHAR), ', ') || ']' END AS scaled,
           CASE WHEN vec_id % 3 = 2 THEN vec_id::VARCHAR ELSE '' END AS vec
    FROM embeddings""")
def flatten_lists(t):
    """Records with differing features: the first one lacks `vec`."""
    scaled = F.transform("embedding", lambda v: F.bround(v.cast("double") * 1000, 0).cast("bigint"))
    records = features.to_records(
        t("embeddings").withColumns({"scaled": scaled, "vec": F.col("vec_id")}), ["label", "scaled", "vec"], keep=["vec_id"])
    present = lambda k, v: ~((k == "scaled") & (F.col("vec_id") % 3 == 1)) & ~((k == "vec") & (F.col("vec_id") % 3 != 2))
    records = records.withColumn("record", F.map_filter("record", present))
    return features.flatten_records(records, features.all_headers(records), keep=["vec_id"])


def _tfrecords(t):
    out = shared_folder(t.spark, "events-tfrecord")
    rows = t("events").count()
    # As many files as the rows need, three at least.
    tfrecord.write_tfrecord(features.to_records(t("events").repartition(max(3, -(-rows // 50_000))), _EVENT_FEATURES), out)
    # Small ranges, so that files are read by several tasks; larger ones for more rows, so that tasks are not only begun.
    return tfrecord.read_tfrecord(t.spark, out, verify=True, split_bytes=min(max(50_000, 3 * rows), 16 << 20))


@query("SELECT event_id, user_id, event_type, value::FLOAT::DOUBLE AS value FROM events")
def tfrecord_scan(t):
    item = F.col("record")
    return _tfrecords(t).select(
        item["event_id"]["ints"][0].alias("event_id"), item["user_id"]["ints"][0].alias("user_id"),
        item["event_type"]["bytes"][0].cast("string").alias("event_type"), item["value"]["floats"][0].cast("double").alias("value"))


@query(_stats_sql("SELECT * FROM events", {"event_id": "event_id", "user_id": "user_id", "value": "value::FLOAT"}, ["event_type"]))
def tfrecord_stats(t):
    return _stats(features.feature_statistics(_tfrecords(t)))
