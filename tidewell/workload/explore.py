"""Exploration queries: enrichment, calendar columns, distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.calendar import iso_timestamp, parse_datetime, with_calendar
from tidewell.functions.formatting import elapsed_text
from tidewell.operators import explore as ops
from tidewell.plans import eda
from tidewell.workload import Tables, query


def rounded(df, places=6, *names):
    return df.withColumns({n: F.round(n, places) for n in names})


def _box_sql(source: str, keys: str, value: str) -> str:
    on = " AND ".join(f"b.{k.strip()} IS NOT DISTINCT FROM q.{k.strip()}" for k in keys.split(","))
    outer = ", ".join(f"b.{k.strip()}" for k in keys.split(","))
    return f"""
    WITH b AS ({source}),
    q AS (SELECT {keys}, count(*) AS n, quantile_cont({value}, 0.25) AS q1,
                 quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3
          FROM b GROUP BY {keys}),
    f AS (SELECT {outer}, b.{value} AS v, q.n, q.q1, q.median, q.q3,
                 b.{value} BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
          FROM b JOIN q ON {on})
    SELECT {keys}, any_value(n) AS n, round(any_value(q1), 6) AS q1,
           round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
           min(v) FILTER (WHERE inside) AS whisker_low, max(v) FILTER (WHERE inside) AS whisker_high,
           count(*) FILTER (WHERE NOT inside) AS outliers
    FROM f GROUP BY {keys}"""


_SALES = """SELECT o.*, c.c_mktsegment, c.c_nationkey, month(o_orderdate)::INTEGER AS month,
    day(o_orderdate)::INTEGER AS day, (isodow(o_orderdate) - 1)::INTEGER AS day_of_week
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""


def _box(t: Tables, key: str):
    out = ops.box_stats(eda.sales(t("orders"), t("customer")), [key], "o_totalprice")
    return rounded(out, 6, "q1", "median", "q3")


for _name, _key in {
    "box_by_month": "month",
    "box_by_dow": "day_of_week",
    "box_by_segment": "c_mktsegment",
    "box_by_nation": "c_nationkey",
    "box_by_priority": "o_orderpriority",
}.items():
    query(_box_sql(_SALES, _key, "o_totalprice"), name=_name)(lambda t, key=_key: _box(t, key))


@query("""
    WITH r AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
          FROM events GROUP BY event_type)
    SELECT e.event_type, e.event_id, e.value FROM events e JOIN r ON e.event_type = r.event_type
    WHERE NOT e.value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5""")
def box_outliers(t):
    return ops.box_outliers(t("events"), ["event_type"], "value").select("event_type", "event_id", "value")


@query(f"""
    WITH b AS ({_SALES}),
    m AS (SELECT c_nationkey, quantile_cont(o_totalprice, 0.5) AS med, count(*) AS n,
                 count(DISTINCT o_custkey) AS members FROM b GROUP BY c_nationkey)
    SELECT c_nationkey, round(med, 6) AS median, n, members,
           row_number() OVER (ORDER BY med DESC, c_nationkey) AS rank FROM m""")
def rank_by_median(t):
    sales = eda.sales(t("orders"), t("customer"))
    return rounded(ops.rank_by_median(sales, "c_nationkey", "o_totalprice", "o_custkey"), 6, "median")


@query("""
    SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment, n.n_name, r.r_name
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def enrich_left_join(t):
    customer = t("customer").withColumnRenamed("c_custkey", "o_custkey")
    nation = t("nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = t("region").withColumnRenamed("r_regionkey", "n_regionkey")
    joined = ops.enrich(t("orders"), customer, "o_custkey")
    joined = ops.enrich(ops.enrich(joined, nation, "c_nationkey"), region, "n_regionkey")
    return joined.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment", "n_name", "r_name")


@query("""
    SELECT o_orderkey, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day,
           (isodow(o_orderdate) - 1)::INTEGER AS day_of_week FROM orders""")
def calendar_features(t):
    return with_calendar(t("orders"), "o_orderdate").select("o_orderkey", "month", "day", "day_of_week")


@query("""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1""")
def daily_totals(t):
    out = ops.daily_totals(t("orders"), "o_orderdate", "o_totalprice")
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), F.round("total", 2).alias("total"))


@query("""
    WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
    h AS (SELECT least(floor((o_totalprice - lo) / (hi - lo) * 50), 49)::INTEGER AS bin, count(*) AS n
          FROM orders, s GROUP BY 1)
    SELECT g.i::INTEGER AS bin, round(lo + (hi - lo) * g.i / 50, 4) AS low,
           round(lo + (hi - lo) * (g.i + 1) / 50, 4) AS high, coalesce(h.n, 0) AS count
    FROM range(50) g(i) CROSS JOIN s LEFT JOIN h ON h.bin = g.i""")
def histogram_50(t):
    return rounded(ops.histogram(t("orders"), "o_totalprice", 50), 4, "low", "high")


@query("""
    WITH s AS (SELECT count(*) AS n, min(s_acctbal) AS lo, max(s_acctbal) AS hi,
                      stddev_samp(s_acctbal) * pow(count(*), -0.2) AS h FROM supplier)
    SELECT g.i::INTEGER AS point, round(any_value(lo + (hi - lo) / 199 * g.i), 4) AS x,
           round(sum(exp(-0.5 * pow((lo + (hi - lo) / 199 * g.i - s_acctbal) / h, 2)))
                 / any_value(n * h * sqrt(2 * pi())), 10) AS density
    FROM range(200) g(i), s, supplier GROUP BY g.i""")
def kde_curve(t):
    out = ops.density(t("supplier"), "s_acctbal", 200)
    return out.select("point", F.round("x", 4).alias("x"), F.round("density", 10).alias("density"))


@query("""
    WITH s AS (SELECT count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
                      stddev_samp(o_totalprice) * pow(count(*), -0.2) AS h FROM orders)
    SELECT g.i::INTEGER AS point, round(any_value(lo + (hi - lo) / 199 * g.i), 4) AS x,
           round(sum(exp(-0.5 * pow((lo + (hi - lo) / 199 * g.i - o_totalprice) / h, 2)))
                 / any_value(n * h * sqrt(2 * pi())), 12) AS density
    FROM range(200) g(i), s, orders GROUP BY g.i""")
def kde_curve_orders(t):
    out = ops.density(t("orders"), "o_totalprice", 200)
    return out.select("point", F.round("x", 4).alias("x"), F.round("density", 12).alias("density"))


@query("""
    WITH n AS (SELECT n_nationkey, CASE WHEN n_nationkey <> 3 THEN n_name END AS n_name FROM nation),
    j AS (SELECT c_custkey, c_mktsegment, n_name FROM customer LEFT JOIN n ON c_nationkey = n_nationkey),
    s AS (SELECT c_mktsegment AS v, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code
          FROM (SELECT DISTINCT c_mktsegment FROM j)),
    m AS (SELECT n_name AS v, dense_rank() OVER (ORDER BY n_name) - 1 AS code
          FROM (SELECT DISTINCT n_name FROM j WHERE n_name IS NOT NULL))
    SELECT c_custkey, c_mktsegment, n_name, s.code::INTEGER AS c_mktsegment_code,
           coalesce(m.code, -1)::INTEGER AS n_name_code
    FROM j LEFT JOIN s ON c_mktsegment = s.v LEFT JOIN m ON n_name = m.v""")
def category_codes(t):
    name = F.when(F.col("n_nationkey") != 3, F.col("n_name"))
    nation = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), name.alias("n_name"))
    joined = ops.enrich(t("customer"), nation, "c_nationkey").select("c_custkey", "c_mktsegment", "n_name")
    return ops.category_codes(joined, ["c_mktsegment", "n_name"])


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day_text,
           epoch(date_trunc('second', ts))::BIGINT AS epoch_second,
           try_cast(CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d') END AS TIMESTAMP) IS NULL AS unparsed
    FROM events""", name="parse_datetime")
def parse_datetimes(t):
    day = F.date_format("ts", "yyyy-MM-dd")
    text = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(day)
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t("events").select(
        "event_id",
        F.date_format(parse_datetime(day), "yyyy-MM-dd").alias("day_text"),
        F.unix_timestamp(parse_datetime(stamp, "yyyy-MM-dd HH:mm:ss")).alias("epoch_second"),
        parse_datetime(text).isNull().alias("unparsed"),
    )


@query("""
    SELECT event_id, CASE WHEN micros = '000000' THEN whole ELSE whole || '.' || micros END AS iso
    FROM (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS whole, strftime(ts, '%f') AS micros FROM events)""", name="iso_timestamp")
def iso_timestamp_text(t):
    return t("events").select("event_id", iso_timestamp(F.col("ts")).alias("iso"))


@query("""
    WITH s AS (SELECT event_id, round_even(value * 1000, 0)::BIGINT AS sec FROM events),
    p AS (SELECT event_id, sec // 86400 AS d, sec % 86400 AS r FROM s)
    SELECT event_id, CASE WHEN d = 0 THEN '' WHEN d = 1 THEN '1 day, ' ELSE d || ' days, ' END
           || (r // 3600) || ':' || lpad((r // 60 % 60)::VARCHAR, 2, '0') || ':' || lpad((r % 60)::VARCHAR, 2, '0')
           AS elapsed FROM p""")
def format_elapsed(t):
    return t("events").select("event_id", elapsed_text(F.col("value") * 1000).alias("elapsed"))


@query("""
    SELECT u.user_id, c.c_name, c.c_custkey IS NOT NULL AS found
    FROM (SELECT DISTINCT user_id * 11 AS user_id FROM events) u LEFT JOIN customer c ON u.user_id = c.c_custkey""")
def ref_lookup(t):
    refs = t("events").select((F.col("user_id") * 11).alias("user_id")).distinct()
    known = t("customer").withColumnRenamed("c_custkey", "user_id")
    found = ops.lookup(refs, known, "user_id")
    return ops.enrich(found, known.select("user_id", "c_name"), "user_id").select("user_id", "c_name", "found")
