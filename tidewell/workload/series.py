"""Vector, time-series and attention queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import vectors
from tidewell.operators import attention as attn
from tidewell.operators import temporal
from tidewell.plans.char_model import CharModel, Layer, document_loss
from tidewell.workload import query
from tidewell.workload.text import PAIRS_SQL, codes_sql, token_pairs

_X = "list_transform(embedding, lambda x: x::DOUBLE)"


def _digits(col, places=6):
    """A list of numbers as text, rounded, so that both engines print it alike."""
    scaled = F.transform(col, lambda v: F.bround(v * 10**places, 0).cast("bigint").cast("string"))
    return F.array_join(scaled, " ")


def _digits_sql(expr: str, places: int = 6) -> str:
    return f"array_to_string(list_transform({expr}, lambda z: round_even(z * {10**places}, 0)::BIGINT::VARCHAR), ' ')"


def _matrix(rows: int, cols: int, seed: int = 0) -> list[list[float]]:
    return [[((i * 7 + j * 3 + seed) % 11 - 5) / 10 for j in range(cols)] for i in range(rows)]


def _dots(matrix, x: str) -> str:
    return "[" + ", ".join(f"list_dot_product({x}, {[float(w) for w in row]}::DOUBLE[])" for row in matrix) + "]"


def _vector(t):
    return t("embeddings").withColumn("x", vectors.doubles(F.col("embedding")))


@query(f"SELECT vec_id, {_digits_sql(_dots(_matrix(4, 64), _X))} AS y FROM embeddings")
def vec_linear(t):
    y = vectors.linear(F.col("x"), vectors.weights(_matrix(4, 64)))
    return _vector(t).select("vec_id", _digits(y).alias("y"))


@query(f"""
    WITH v AS (SELECT vec_id, {_X} AS x FROM embeddings),
    e AS (SELECT vec_id, list_transform(x, lambda v: exp(v - list_max(x))) AS e FROM v)
    SELECT vec_id, {_digits_sql('list_transform(e, lambda v: v / list_sum(e))')} AS y FROM e""")
def vec_softmax(t):
    return _vector(t).select("vec_id", _digits(vectors.softmax(F.col("x"))).alias("y"))


@query(f"""
    WITH v AS (SELECT vec_id, {_X} AS x FROM embeddings),
    s AS (SELECT vec_id, x, pow(list_sum(list_transform(x, lambda v: v * v)) / len(x) + 1e-5, -0.5) AS s FROM v)
    SELECT vec_id, {_digits_sql('list_transform(x, lambda v: v * s)')} AS y FROM s""")
def vec_rmsnorm(t):
    return _vector(t).select("vec_id", _digits(vectors.rms_norm(F.col("x"))).alias("y"))


@query(f"""
    WITH v AS (SELECT vec_id, {_X} AS x FROM embeddings)
    SELECT vec_id, {_digits_sql('list_transform(x, lambda v: v + greatest(v, 0.0))')} AS y FROM v""")
def vec_residual_relu(t):
    y = vectors.add(F.col("x"), vectors.relu(F.col("x")))
    return _vector(t).select("vec_id", _digits(y).alias("y"))


@query(f"""
    WITH v AS (SELECT vec_id, {_X} AS x FROM embeddings),
    m AS (SELECT vec_id, x, list_sum(x) / len(x) AS m FROM v),
    s AS (SELECT vec_id, x, m, sqrt(list_sum(list_transform(x, lambda v: (v - m) * (v - m))) / len(x) + 1e-3) AS s FROM m)
    SELECT vec_id, {_digits_sql('list_transform(x, lambda v: (v - m) / s)')} AS y FROM s""")
def vec_layernorm(t):
    return _vector(t).select("vec_id", _digits(vectors.layer_norm(F.col("x"))).alias("y"))


def _attention_sql(condition: str) -> str:
    return f"""
    WITH r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS t,
                      {_X} AS x FROM embeddings),
    h AS (SELECT unnest([0, 1]) AS h),
    p AS (SELECT a.vec_id, a.label, h, list_dot_product(a.x[1 + 8 * h : 8 + 8 * h], b.x[17 + 8 * h : 24 + 8 * h]) / sqrt(8) AS s,
                 b.x[33 + 16 * h : 48 + 16 * h] AS v
          FROM r a JOIN r b ON a.label = b.label AND {condition} CROSS JOIN h),
    e AS (SELECT *, exp(s - max(s) OVER (PARTITION BY vec_id, h)) AS w FROM p),
    o AS (SELECT vec_id, label, h, [{', '.join(f'sum(w * v[{i}]) / sum(w)' for i in range(1, 17))}] AS y
          FROM e GROUP BY 1, 2, 3)
    SELECT a.vec_id, a.label, {_digits_sql('a.y || b.y')} AS y FROM o a JOIN o b ON a.vec_id = b.vec_id AND a.h = 0 AND b.h = 1"""


def _attention(t, **options):
    x = F.col("x")
    parts = _vector(t).select(
        "vec_id", "label", F.slice(x, 1, 16).alias("q"), F.slice(x, 17, 16).alias("k"), F.slice(x, 33, 32).alias("v"))
    out = attn.attention(parts, ["label"], ["vec_id"], "q", "k", "v", heads=2, keep=["vec_id"], **options)
    return out.select("vec_id", "label", _digits(F.col("attended")).alias("y"))


@query(_attention_sql("b.t <= a.t"))
def causal_attention(t):
    return _attention(t)


@query(_attention_sql("b.t <= a.t AND a.t - b.t < 16"))
def causal_attention_lookback(t):
    return _attention(t, lookback=16, block=32)


@query(_attention_sql("true"))
def full_attention(t):
    return _attention(t, causal=False, block=64)


_WQ, _WK, _WV, _WO = _matrix(64, 64, 1), _matrix(64, 64, 2), _matrix(64, 64, 4), _matrix(1, 64, 3)


@query(f"""
    WITH w AS (SELECT {[[float(v) for v in r] for r in _WQ]}::DOUBLE[][] AS wq, {[[float(v) for v in r] for r in _WK]}::DOUBLE[][] AS wk,
                      {[[float(v) for v in r] for r in _WV]}::DOUBLE[][] AS wv),
    r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS t, {_X} AS x FROM embeddings),
    p AS (SELECT vec_id, label, t, x, list_transform(wq, lambda c: list_dot_product(c, x)) AS q,
                 list_transform(wk, lambda c: list_dot_product(c, x)) AS k, list_transform(wv, lambda c: list_dot_product(c, x)) AS v FROM r, w),
    s AS (SELECT a.vec_id, a.x, list_dot_product(a.q, b.k) / 8 AS s, b.v FROM p a JOIN p b ON a.label = b.label AND b.t <= a.t),
    e AS (SELECT *, exp(s - max(s) OVER (PARTITION BY vec_id)) AS w FROM s),
    u AS (SELECT vec_id, x, w, unnest(v) AS vi, unnest(range(64)) AS i FROM e),
    o AS (SELECT vec_id, any_value(x) AS x, i, sum(w * vi) / sum(w) AS y FROM u GROUP BY vec_id, i),
    z AS (SELECT vec_id, list(greatest(x[i + 1] + y, 0) ORDER BY i) AS z FROM o GROUP BY vec_id),
    m AS (SELECT vec_id, z, list_sum(z) / 64 AS m FROM z),
    d AS (SELECT vec_id, z, m, sqrt(list_sum(list_transform(z, lambda v: (v - m) * (v - m))) / 64 + 1e-3) AS d FROM m)
    SELECT vec_id, round(list_dot_product(list_transform(z, lambda v: (v - m) / d), {[float(v) for v in _WO[0]]}::DOUBLE[]), 6) AS y FROM d""")
def temporal_attention(t):
    out = attn.temporal_attention_block(_vector(t), ["label"], ["vec_id"], "x", _WQ, _WK, _WV, _WO, keep=["vec_id"])
    return out.select("vec_id", F.round(F.col("block")[0], 6).alias("y"))


# kernel[tap][channel][filter]
_TAPS = [[[0.2]], [[-0.5]], [[0.9]]]
_CONV_SQL = """c AS (SELECT event_id, user_id, ts, value, row_number() OVER w - 1 AS step,
        0.2 * coalesce(lag(value, 4) OVER w, 0) - 0.5 * coalesce(lag(value, 2) OVER w, 0) + 0.9 * value + 0.1 AS y
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


def _conv(t):
    events = t("events").withColumn("x", F.array("value"))
    return temporal.causal_conv(events, ["user_id"], ["ts", "event_id"], "x", _TAPS, dilation=2, bias=[0.1])


@query(f"WITH {_CONV_SQL} SELECT event_id, round(y, 6) AS y FROM c")
def causal_conv(t):
    return _conv(t).select("event_id", F.round(F.col("conv")[0], 6).alias("y"))


@query(f"WITH {_CONV_SQL} SELECT event_id, round(y, 6) AS y FROM c WHERE step % 3 = 0")
def strided_conv(t):
    kept = temporal.strided(_conv(t), ["user_id"], ["ts", "event_id"], 3)
    return kept.select("event_id", F.round(F.col("conv")[0], 6).alias("y"))


_KERNEL = [[[0.1, -0.2, 0.3], [0.4, 0.0, -0.1]], [[0.5, 0.2, -0.3], [-0.6, 0.1, 0.2]]]
_RESAMPLE = [[0.3, -0.1], [0.2, 0.5], [-0.4, 0.1]]


def _block_sql(activated: str = "greatest({}, 0)") -> str:
    def out(f):
        taps = " + ".join(
            f"({_KERNEL[j][c][f]}) * {v}" for j, names in enumerate((("pa", "pb"), ("a", "b"))) for c, v in enumerate(names))
        kept = f"({_RESAMPLE[f][0]}) * a + ({_RESAMPLE[f][1]}) * b"
        return f"round(greatest({activated.format(taps)} + {kept}, 0), 6) AS y{f}"
    return f"""
    WITH s AS (SELECT event_id, user_id, ts, value AS a, hour(ts)::DOUBLE AS b FROM events),
    l AS (SELECT event_id, a, b, coalesce(lag(a, 3) OVER w, 0) AS pa, coalesce(lag(b, 3) OVER w, 0) AS pb FROM s
          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, {', '.join(out(f) for f in range(3))} FROM l"""


def _block(t, activation):
    events = t("events").withColumn("x", F.array("value", F.hour("ts").cast("double")))
    out = temporal.temporal_block(events, ["user_id"], ["ts", "event_id"], "x", _KERNEL, dilation=3, resample=_RESAMPLE, activation=activation)
    return out.select("event_id", *[F.round(F.col("block")[f], 6).alias(f"y{f}") for f in range(3)])


@query(_block_sql())
def temporal_block(t):
    return _block(t, "relu")


@query(_block_sql("tanh({})"))
def temporal_block_tanh(t):
    return _block(t, "tanh")


@query("""
    WITH s AS (SELECT event_id, row_number() OVER w AS t, lead(value) OVER w AS target, lead(event_id) OVER w AS nxt,
                      list(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS v,
                      list(hour(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS h
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, target, v[1] AS first_value, v[8] AS last_value, round(list_sum(v), 4) AS value_sum, list_sum(h)::DOUBLE AS hour_sum, len(v)::INTEGER AS steps
    FROM s WHERE t >= 8 AND nxt IS NOT NULL""")
def sequence_windows(t):
    events = t("events").withColumn("hour", F.hour("ts"))
    out = temporal.sequence_windows(events, ["user_id"], ["ts", "event_id"], ["value", "hour"], "value", 8)
    seq = F.col("sequence")

    def channel(c):
        return vectors.total(F.transform(seq, lambda r: r[c]))
    return out.select(
        "event_id", "target", seq[0][0].alias("first_value"), seq[7][0].alias("last_value"),
        F.round(channel(0), 4).alias("value_sum"), channel(1).alias("hour_sum"), F.size(seq).alias("steps"))


@query("""
    SELECT 0.0::DOUBLE AS max_change, count(*) - count(DISTINCT user_id) AS rows FROM events""")
def conv_leakage(t):
    """Changing the last step of each series leaves the earlier outputs as they are."""
    last = t("events").groupBy("user_id").agg(F.max(F.struct("ts", "event_id"))["event_id"].alias("last_id"))
    events = t("events").join(last, "user_id").withColumn("final", F.col("event_id") == F.col("last_id"))

    def run(change):
        x = F.array(F.col("value") + F.when(F.col("final"), change).otherwise(0.0))
        return temporal.causal_conv(events.withColumn("x", x), ["user_id"], ["ts", "event_id"], "x", _TAPS, dilation=2)
    return temporal.leakage(run(0.0), run(10.0), ["user_id", "event_id"], "conv", ~F.col("final"))


@query("""
    SELECT 0.0::DOUBLE AS max_change, count(*) - count(DISTINCT label) AS rows FROM embeddings""")
def attention_leakage(t):
    last = t("embeddings").groupBy("label").agg(F.max("vec_id").alias("last_id"))
    rows = _vector(t).join(last, "label").withColumn("final", F.col("vec_id") == F.col("last_id"))

    def run(change):
        shift = F.when(F.col("final"), change).otherwise(0.0)
        moved = rows.withColumn("y", F.transform("x", lambda v: v + shift))
        return attn.attention(moved, ["label"], ["vec_id"], "y", "y", "y", heads=4, keep=["vec_id", "final"])
    out = temporal.leakage(run(0.0), run(10.0), ["label", "vec_id"], "attended", ~F.col("final"))
    return out.withColumn("max_change", F.round("max_change", 6))


_MODEL = CharModel(
    _matrix(64, 4, 1), _matrix(16, 4, 5),
    [Layer(_matrix(4, 4, 1), _matrix(4, 4, 2), _matrix(4, 4, 3), _matrix(4, 4, 6), _matrix(8, 4, 2), _matrix(4, 8, 4))],
    _matrix(64, 4, 7), heads=1)


def _norm_sql(v: str) -> str:
    return f"list_transform({v}, lambda z: z * pow(list_dot_product({v}, {v}) / 4 + 1e-5, -0.5))"


def _plus_sql(a: str, b: str) -> str:
    return "[" + ", ".join(f"{a}[{i}] + {b}[{i}]" for i in range(1, 5)) + "]"


def _model_sql() -> str:
    layer = _MODEL.layers[0]
    return f"""
    WITH {codes_sql('part', 'p_partkey', 'p_name')}, {PAIRS_SQL.format(key='p_partkey')},
    w AS (SELECT {_MODEL.tokens}::DOUBLE[][] AS wte, {_MODEL.positions}::DOUBLE[][] AS wpe),
    e0 AS (SELECT p_partkey AS d, position AS t, target, {_plus_sql('wte[token + 1]', 'wpe[position + 1]')} AS s
          FROM p, w WHERE target IS NOT NULL),
    x AS (SELECT d, t, target, {_norm_sql('s')} AS x FROM e0),
    h AS (SELECT *, {_norm_sql('x')} AS h FROM x),
    k AS (SELECT *, {_dots(layer.query, 'h')} AS q, {_dots(layer.key, 'h')} AS k, {_dots(layer.value, 'h')} AS v FROM h),
    s AS (SELECT a.d, a.t, a.target, a.x, b.v, list_dot_product(a.q, b.k) / 2 AS s FROM k a JOIN k b ON a.d = b.d AND b.t <= a.t),
    g AS (SELECT *, exp(s - max(s) OVER (PARTITION BY d, t)) AS g FROM s),
    o AS (SELECT d, t, any_value(target) AS target, any_value(x) AS x, [{', '.join(f'sum(g * v[{i}]) / sum(g)' for i in range(1, 5))}] AS o FROM g GROUP BY d, t),
    m AS (SELECT *, {_dots(layer.mix, 'o')} AS m FROM o),
    y AS (SELECT d, t, target, {_plus_sql('m', 'x')} AS y FROM m),
    n AS (SELECT *, {_norm_sql('y')} AS n FROM y),
    f AS (SELECT *, list_transform({_dots(layer.widen, 'n')}, lambda z: greatest(z, 0.0)) AS f FROM n),
    r AS (SELECT *, {_dots(layer.narrow, 'f')} AS r FROM f),
    z AS (SELECT d, t, target, {_plus_sql('r', 'y')} AS z FROM r),
    l AS (SELECT *, {_dots(_MODEL.head, 'z')} AS l FROM z)
    SELECT d AS p_partkey, round(avg(ln(list_sum(list_transform(l, lambda v: exp(v)))) - l[target + 1]), 6) AS nll, count(*) AS positions
    FROM l GROUP BY d"""


@query(_model_sql())
def char_model_loss(t):
    # A small file becomes many positions, so its rows are dealt among tasks first.
    pairs = token_pairs(t, "part", "p_partkey", "p_name", 16, rows_per_task=20_000)
    return document_loss(pairs, _MODEL, "p_partkey").withColumn("nll", F.round("nll", 6))
