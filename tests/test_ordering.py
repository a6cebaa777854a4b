"""Positions, frames and quantiles under heavy skew, against pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.operators import text
from tidewell.operators.ordering import hot_groups, over_frames, range_starts, ranged, with_position
from tidewell.operators.quantiles import group_quantiles
from tidewell.session import TASK_BYTES_KEY


def skewed(spark, seed):
    rng = np.random.default_rng(seed)
    n = 900
    frame = pd.DataFrame({
        "id": np.arange(n),
        # One group has half of the rows and one timestamp a third of them.
        "g": np.where(rng.random(n) < 0.5, 7, rng.integers(0, 60, n)),
        "t": np.where(rng.random(n) < 0.33, 500, rng.integers(0, 1000, n)),
        "v": np.round(np.where(rng.random(n) < 0.3, 3.25, rng.normal(0, 100, n)), 2),
    })
    return frame, spark.createDataFrame(frame).repartition(5)


def by_id(df, *columns):
    return df.select("id", *columns).toPandas().sort_values("id").reset_index(drop=True)


@pytest.mark.parametrize("seed", range(3))
def test_position_in_group(spark, small_tasks, seed):
    frame, df = skewed(spark, seed)
    assert hot_groups(df, ["g"]) is not None
    got = by_id(with_position(df, ["t", "id"], ["g"]), "pos")
    want = frame.sort_values(["t", "id"]).groupby("g").cumcount().sort_index()
    assert got["pos"].tolist() == want.tolist()


def test_wide_rows_are_placed_by_several_tasks(spark):
    """Rows far below the row limit, whose texts are above the byte limit."""
    rows = [(i, "x y " * 500) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, s string").repartition(4)
    spark.conf.set(TASK_BYTES_KEY, "20000")
    try:
        placed = with_position(df, ["id"])
        assert [(r["id"], r["pos"]) for r in placed.orderBy("id").collect()] == [(i, i) for i in range(60)]
        held = placed.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0]
        assert held < 30
        assert hot_groups(df, []) is None
        batches = text.padded_batches(df, text.words(F.col("s")), ["id"], 7)
        assert {(r["batch"], len(r["padded"]["input"])) for r in batches.collect()} == {(i // 7, 1000) for i in range(60)}
    finally:
        spark.conf.unset(TASK_BYTES_KEY)


def test_position_over_all_rows(spark, small_tasks):
    frame, df = skewed(spark, 5)
    got = by_id(with_position(df, ["v", "id"]), "pos")
    order = frame.sort_values(["v", "id"]).index
    want = pd.Series(np.arange(len(frame)), index=order).sort_index()
    assert got["pos"].tolist() == want.tolist()


@pytest.mark.parametrize("prefix", ["", "shared/prefix/", "é"])
def test_position_of_strings(spark, small_tasks, prefix):
    names = [prefix + str(i * 37 % 1000) for i in range(300)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    got = by_id(with_position(df, ["name", "id"]), "pos")["pos"].tolist()
    places = {n: p for p, n in enumerate(sorted(names, key=lambda s: s.encode()))}
    assert got == [places[n] for n in names]


def test_nulls_sort_first(spark, small_tasks):
    df = spark.createDataFrame([(i, None if i % 3 else i) for i in range(200)], "id int, t int")
    got = by_id(with_position(df, ["t", "id"]), "pos")["pos"].tolist()
    order = sorted(range(200), key=lambda i: (-1 if i % 3 else i, i))
    assert [order[p] for p in range(200)] == [got.index(p) for p in range(200)]


@pytest.mark.parametrize("seed", range(2))
def test_frames(spark, small_tasks, seed):
    frame, df = skewed(spark, seed)

    def columns(d, w):
        return d.withColumns({
            "lag": F.lag("v", 5).over(w), "lead": F.lead("v", 3).over(w),
            "sum": F.round(F.sum("v").over(w.rowsBetween(-5, 3)), 6),
        })

    got = by_id(over_frames(df, ["t", "id"], ["g"], columns, back=5, ahead=3), "lag", "lead", "sum")
    ordered = frame.sort_values(["t", "id"])
    groups = ordered.groupby("g")["v"]
    want = pd.DataFrame({"id": ordered["id"], "lag": groups.shift(5), "lead": groups.shift(-3)})
    shifted = sum(groups.shift(k).fillna(0) for k in range(-3, 6))
    want["sum"] = shifted.round(6)
    want = want.sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, atol=1e-6)


@pytest.mark.parametrize("seed", range(3))
def test_quantiles(spark, small_tasks, seed):
    frame, df = skewed(spark, seed)
    probs = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.75, "f": 0.999, "g1": 1.0}
    got = group_quantiles(df, ["g"], "v", probs).toPandas().sort_values("g").set_index("g")
    for name, p in probs.items():
        want = frame.groupby("g")["v"].quantile(p)
        np.testing.assert_allclose(got[name].to_numpy(), want.to_numpy(), atol=1e-9)
    whole = group_quantiles(df, [], "v", {"m": 0.5, "q": 0.9}).first()
    assert whole["n"] == len(frame)
    np.testing.assert_allclose([whole["m"], whole["q"]], frame["v"].quantile([0.5, 0.9]), atol=1e-9)


def test_quantiles_of_odd_numbers(spark, small_tasks):
    """Zeros of both signs, infinities and very small numbers in a group that no task may hold."""
    values = [0.0, -0.0, float("inf"), float("-inf"), 5e-324, -5e-324, 1e308, -1e308, 1.0, -1.0] * 9
    df = spark.createDataFrame([(None, v) for v in values], "g string, v double")
    found = group_quantiles(df, ["g"], "v", {"low": 0.0, "q1": 0.25, "m": 0.5, "q3": 0.75, "high": 1.0}).first()
    ordered = sorted(values)
    assert (found["low"], found["m"], found["high"]) == (float("-inf"), 0.0, float("inf"))
    assert (found["q1"], found["q3"]) == pytest.approx((np.quantile(ordered, 0.25), np.quantile(ordered, 0.75)))
    top = group_quantiles(spark.createDataFrame([(float(i % 50),) for i in range(90)] + [(float("nan"),)], "v double"), [], "v", {"high": 1.0}).first()
    assert math.isnan(top["high"])


def test_quantiles_leave_nulls_out(spark, small_tasks):
    df = spark.createDataFrame([(i % 2, float(i) if i % 5 else None) for i in range(400)], "g int, v double")
    got = {r["g"]: (r["n"], r["m"]) for r in group_quantiles(df, ["g"], "v", {"m": 0.5}).collect()}
    for g in (0, 1):
        values = [float(i) for i in range(400) if i % 2 == g and i % 5]
        assert got[g] == (len(values), np.median(values))


def balanced(df, order, group, limit):
    """The largest number of rows of a group in a range, with ranges made as `with_position` makes them."""
    found = hot_groups(df, group)
    starts = range_starts(ranged(df, order, group, found[1]), group)
    largest = max(r["__n"] for r in starts.collect())
    return largest <= 2 * limit and starts.count() > found[1] / (2 * limit)


def test_groups_of_disjoint_times_are_split(spark, small_tasks):
    df = spark.range(20 * 400).selectExpr("id % 20 AS g", "(id % 20) * 1000000 + id AS t", "id")
    assert balanced(df, ["t", "id"], ["g"], small_tasks)


def test_strings_with_one_outlier_are_split(spark, small_tasks):
    df = spark.createDataFrame([(f"doc_{i:010d}",) for i in range(3000)] + [("a",)], "name string")
    assert balanced(df, ["name"], [], small_tasks)
    assert sorted(r["pos"] for r in with_position(df, ["name"]).collect()) == list(range(3001))


def test_other_types_and_later_columns_are_split(spark, small_tasks):
    df = spark.range(2000).selectExpr("cast(cast(id AS string) AS binary) AS b", "array(1, id) AS a", "1 AS one", "id")
    for order in (["b"], ["a"], ["one", "id"]):
        assert balanced(df, order, [], small_tasks)
    got = {r["id"]: r["pos"] for r in with_position(df, ["one", "id"]).collect()}
    assert got == {i: i for i in range(2000)}


def test_names_with_dots(spark, small_tasks):
    df = spark.range(200).selectExpr("id % 2 AS `g.x`", "id AS `t.y`")
    assert {r["t.y"]: r["pos"] for r in with_position(df, ["t.y"], ["g.x"]).collect()} == {i: i // 2 for i in range(200)}
