"""Conversion of many delimited files together."""

import os

import pytest

from tidewell.plans import bulk, ingest


def files(folder, n):
    """Two headers, files with types of their own, quoted line ends, a file of nothing and one of its header alone."""
    os.makedirs(f"{folder}/sub dir", exist_ok=True)
    for i in range(n):
        where = f"{folder}/sub dir/f{i}.csv" if i % 5 == 0 else f"{folder}/f{i}.csv"
        with open(where, "w") as out:
            if i % 2:
                out.write(f'id,text\n{i},"a\n{i}"\n{i + 1},b\n')
            else:
                out.write(f"k,v,w\n{i},{'x' if i % 4 else i}.5,true\n{i},2.5\n{i},1,false,more\n")
    for name, text in (("empty.csv", "\n"), ("head.csv", "id,text\n"), ("other.txt", "not,asked\n")):
        with open(f"{folder}/{name}", "w") as out:
            out.write(text)


def jobs(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_many_files_in_few_jobs(spark, tmp_path):
    counts = []
    for n in (6, 60):
        files(f"{tmp_path}/in{n}", n)
        report, count = jobs(spark, f"bulk{n}", lambda: bulk.convert_many(spark, f"{tmp_path}/in{n}", f"{tmp_path}/out{n}", recursive=True))
        counts.append(count)
        got = {r["source"]: r for r in report.collect()}
        assert len(got) == n + 2
        for i in range(n):
            row = got[f"sub dir/f{i}.csv" if i % 5 == 0 else f"f{i}.csv"]
            table = spark.read.parquet(row["path"])
            assert row["status"] == "completed" and dict(table.dtypes) == row["schema"]
            if i % 2:
                assert (row["rows"], row["rejected"], row["short"]) == (2, 0, 0)
            else:
                assert (row["rows"], row["rejected"], row["short"]) == (2, 1, 1)
                assert row["schema"]["v"] == ("string" if i % 4 else "double")
        assert sorted(tuple(r) for r in spark.read.parquet(got["f1.csv"]["path"]).collect()) == [(1, "a\n1"), (2, "b")]
        assert (got["empty.csv"]["status"], got["empty.csv"]["error"], got["head.csv"]["rows"]) == ("failed", "no header line", 0)
        lost = spark.read.parquet(f"{tmp_path}/out{n}/{bulk.REJECTS}")
        assert sorted(r["line"] for r in lost.collect()) == sorted(f"{i},1,false,more" for i in range(0, n, 2))
    # Stages that Spark plans as jobs of their own are counted too.
    assert counts[1] <= counts[0] + 3
    again = bulk.convert_many(spark, f"{tmp_path}/in6", f"{tmp_path}/out6", recursive=True)
    assert {r["source"] for r in again.collect()} <= {"empty.csv", "head.csv"}


def test_files_with_lines_that_do_not_fit_can_fail_alone(spark, tmp_path):
    files(f"{tmp_path}/in", 4)
    report = bulk.convert_many(spark, f"{tmp_path}/in", f"{tmp_path}/out", options=ingest.Options(rejects="fail"), recursive=True)
    got = {r["source"]: r["status"] for r in report.collect()}
    assert got == {"sub dir/f0.csv": "failed", "f1.csv": "completed", "f2.csv": "failed", "f3.csv": "completed", "empty.csv": "failed", "head.csv": "completed"}
    with pytest.raises(ValueError, match="index"):
        bulk.convert_many(spark, f"{tmp_path}/in", f"{tmp_path}/out", options=ingest.Options(preserve_index=True))
