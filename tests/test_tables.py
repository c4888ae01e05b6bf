"""Append-only keyed tables: replace by key, replay, crash, positions, folding, lookups."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from martlane.sources import tables
from martlane.sources.tables import FOLD, PART, AppendTable
from martlane.sources.topics import POSITION

SCHEMA = "id string, day string, v2 long, seq long"


def make(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def folders(root):
    return sorted(os.path.relpath(d, root) for d, _, names in os.walk(root)
                  if any(n.endswith(".parquet") for n in names))


def files(root):
    return sum(n.endswith(".parquet") for _, _, names in os.walk(root) for n in names)


def test_insert_replace_replay(spark, tmp_dir):
    t = AppendTable(spark, f"{tmp_dir}/t", ["id"], "day")
    assert t.read() is None and t.read(["d1"]) is None
    assert t.append(make(spark, [("a", "d1", 1, 1), ("b", "d1", 2, 1), ("c", "d2", 3, 1)]), "q1", 0)
    again = make(spark, [("a", "d1", 10, 0), ("d", "d3", 4, 1)])
    assert t.append(again, "q1", 1)
    want = [("a", "d1", 10), ("b", "d1", 2), ("c", "d2", 3), ("d", "d3", 4)]
    assert rows(t.read(), "id", "day", "v2") == want
    assert not t.append(again, "q1", 1)                 # replay: no-op
    assert not t.append(make(spark, []), "q1", 2)       # empty batch: no-op
    assert rows(t.read(["d1"]), "id") == [("a",), ("b",)]
    assert t.append(make(spark, [("e", "d1", 5, 1)]), "q2", 0)    # a new query's batch 0 counts
    assert rows(t.read(), "id", "day", "v2") == want + [("e", "d1", 5)]
    assert rows(t.read(["d1"]), "id") == [("a",), ("b",), ("e",)]


def test_null_empty_and_odd_partitions(spark, tmp_dir):
    t = AppendTable(spark, f"{tmp_dir}/t", ["id"], "day")
    t.append(make(spark, [("a", None, 1, 1), ("b", "", 2, 1), ("x", "a/b:c=%", 4, 1)]), "q", 0)
    t.append(make(spark, [("c", None, 3, 1)]), "q", 1)
    got = {r.id: r.day for r in t.read().collect()}
    assert got == {"a": None, "b": "", "c": None, "x": "a/b:c=%"}
    assert {r.id for r in t.read([None]).collect()} == {"a", "b", "c"}
    assert rows(t.read(["a/b:c=%"]), "id") == [("x",)]
    assert t.fold([None, "a/b:c=%"]) == 4
    assert {r.id: r.day for r in t.read().collect()} == got
    assert rows(t.read(["a/b:c=%"]), "id") == [("x",)]


def test_key_that_changes_its_day_and_late_older_version(spark, tmp_dir):
    t = AppendTable(spark, f"{tmp_dir}/t", ["id"], "day", ["seq"])
    t.append(make(spark, [("a", "d1", 1, 1)]), "q", 0)
    t.append(make(spark, [("a", "d2", 2, 5)]), "q", 1)
    t.append(make(spark, [("a", "d1", 3, 2)]), "q", 2)     # late, older version
    assert rows(t.read(), "id", "day", "v2") == [("a", "d2", 2)]
    t.fold(["d1", "d2"])
    assert rows(t.read(), "id", "day", "v2") == [("a", "d2", 2)]


def test_crash_inside_a_batch(spark, tmp_dir, monkeypatch):
    t = AppendTable(spark, f"{tmp_dir}/t", ["id"], "day")
    t.append(make(spark, [("a", "d1", 1, 1)]), "q", 0)
    real = tables._replace_text

    def dies(spark_, path, text):
        if "/last-" in path:
            raise RuntimeError("lost driver")
        real(spark_, path, text)

    monkeypatch.setattr(tables, "_replace_text", dies)
    with pytest.raises(RuntimeError):
        t.append(make(spark, [("b", "d1", 2, 1), ("c", "d2", 2, 1)]), "q", 1)
    monkeypatch.setattr(tables, "_replace_text", real)
    assert rows(t.read(), "id") == [("a",)]                              # written, not complete
    assert t.append(make(spark, [("b", "d1", 2, 1)]), "q", 1)            # written anew
    assert rows(t.read(), "id") == [("a",), ("b",)]                      # and nothing left of the first try


def test_smallest_stands(spark, tmp_dir):
    t = AppendTable(spark, f"{tmp_dir}/t", ["id"], "day", ["seq"], latest=False)
    t.append(make(spark, [("a", "d1", 1, 5)]), "q", 0)
    t.append(make(spark, [("a", "d1", 2, 2), ("a", "d1", 3, 9)]), "q", 1)
    assert rows(t.read(), "id", "v2") == [("a", 2)]


def test_position_decides_inside_a_batch(spark, tmp_dir):
    t = AppendTable(spark, f"{tmp_dir}/t", ["id"], "day")
    at = lambda time, part, offset: (time, part, offset)
    data = [("a", "d1", 9, 1, at(5, 3, 1)), ("a", "d1", 2, 1, at(5, 3, 10)),
            ("b", "d1", 8, 1, at(5, 9, 99)), ("b", "d1", 1, 1, at(6, 1, 0))]
    t.append(spark.createDataFrame(data, f"{SCHEMA}, {POSITION} struct<time:long,part:long,offset:long>"), "q", 0)
    assert rows(t.read(), "id", "v2") == [("a", 2), ("b", 1)]      # not the larger value
    assert POSITION not in t.read().columns
    t.append(make(spark, [("a", "d1", 3, 1)]), "q", 1)             # a later batch, without positions
    assert rows(t.read(), "id", "v2") == [("a", 3), ("b", 1)]


def test_files_per_batch_and_folders_per_read(spark, tmp_dir, monkeypatch):
    t = AppendTable(spark, f"{tmp_dir}/t", ["id"], "day")
    many = spark.range(3000).selectExpr("cast(id as string) id", "concat('d', id % 30) day", "id v2", "id seq")
    t.append(many.repartition(8), "q", 0)
    assert files(f"{tmp_dir}/t") == 30                              # one a day, whatever the tasks
    t.append(many, "q", 1)
    read = [f.split("/q=q/")[1] for f in t.rows(["d7"]).inputFiles()]
    assert sorted(f.rpartition("/")[0] for f in read) == [f"{PART}=d7/b=0", f"{PART}=d7/b=1"]
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 500)               # a day with most of the rows
    hot = spark.range(3000).selectExpr("cast(id as string) id", "if(id < 2500, 'hot', 'd1') day", "id v2", "id seq")
    t.append(hot, "q2", 0)
    assert 1 < files(f"{tmp_dir}/t/q=q2/{PART}=hot") <= 5 and files(f"{tmp_dir}/t/q=q2/{PART}=d1") == 1
    assert t.read(["hot"]).count() == 2500


def test_fold_and_retire(spark, tmp_dir, monkeypatch):
    t = AppendTable(spark, f"{tmp_dir}/t", ["id"], "day")
    for b in range(4):
        t.append(make(spark, [("a", "d1", b, 1), (f"x{b}", "d1", b, 1), ("y", "d2", b, 1)]), "q", b)
    want = rows(t.read(), "id", "v2")
    real = tables._replace_text

    def dies(spark_, path, text):
        if path.endswith("/folds"):
            raise RuntimeError("lost driver")
        real(spark_, path, text)

    monkeypatch.setattr(tables, "_replace_text", dies)
    with pytest.raises(RuntimeError):
        t.fold(["d1"])
    assert rows(t.read(), "id", "v2") == want                        # died before the swap
    monkeypatch.setattr(tables, "_replace_text", real)
    assert t.fold(["d1"]) == 5
    assert rows(t.read(), "id", "v2") == want                        # swapped, nothing removed
    day = {r[0] for r in t.rows(["d1"]).select(F.input_file_name()).collect()}
    assert len(day) == 1 and f"/q={FOLD}/" in day.pop()
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = t.rows(["d1"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "element_at" in plan.split("PartitionFilters: ")[1].split("\n")[0]     # pruned, not read and filtered
    t.append(make(spark, [("a", "d1", 70, 1), ("z", "d1", 7, 1)]), "q", 4)   # comes for the folded day
    t.append(make(spark, [("a", "d1", 80, 1)]), "other", 0)
    want = sorted([(i, v) for i, v in want if i != "a"] + [("a", 80), ("z", 7)])
    assert rows(t.read(), "id", "v2") == want
    t.retire()
    assert rows(t.read(), "id", "v2") == want
    listed = t.rows(["d1"]).inputFiles()                             # a closed day: one folder, and what came late
    assert [f.split("/t/")[1].rpartition("/")[0] for f in sorted(listed)] == [
        f"q={FOLD}/{PART}=d1/b=0", f"q=other/{PART}=d1/b=0", f"q=q/{PART}=d1/b=4"]
    assert rows(t.read(["d1"]), "id", "v2") == [w for w in want if w[0] != "y"]
    assert not [f for f in folders(f"{tmp_dir}/t/q=q/{PART}=d1") if f in ("b=0", "b=1", "b=2", "b=3")]
    assert t.fold(["d1", "d2", "d9"]) == 7                           # again, over the first fold
    t.retire()
    assert rows(t.read(), "id", "v2") == want
    assert folders(f"{tmp_dir}/t/q={FOLD}") == [f"{PART}=d1/b=1", f"{PART}=d2/b=1"]


def test_lookup_skips_row_groups(spark, tmp_dir):
    """A lookup's keys reach the parquet reader, whose key order and bloom
    filters leave most row groups unread."""
    t = AppendTable(spark, f"{tmp_dir}/t", ["id"], None, ["seq"], indexed=True)
    for b in range(3):
        t.append(spark.range(20_000).selectExpr("cast(id * 7 as string) id", "'d' day", f"id + {b} v2", f"{b} seq"), "q", b)
    asked = spark.createDataFrame([(str(7 * i),) for i in (5, 11, 4000)] + [("none",)], "id string")
    got = t.lookup(asked)
    assert rows(got, "id", "v2") == [("28000", 4002), ("35", 7), ("77", 13)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(id, [" in plan
    by_join = t.lookup(asked, most=2)                                # more keys than that: a semi-join
    assert rows(by_join, "id", "v2") == rows(got, "id", "v2")
    assert "LeftSemi" in by_join._jdf.queryExecution().executedPlan().toString()
    absent = spark.createDataFrame([("3",)], "id string")            # inside the range of ids, in no row group
    assert t.lookup(absent).count() == 0
    read = t.rows().filter(F.col("id").isin("3"))                    # the scan below a lookup
    assert read.collect() == []
    scan = read._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 3 and scan.metrics().apply("numOutputRows").value() == 0
    import pyarrow.parquet as pq
    file = next(os.path.join(d, n) for d, _, names in os.walk(f"{tmp_dir}/t") for n in names if n.endswith(".parquet"))
    ids = pq.read_table(file, partitioning=None)["id"].to_pylist()
    assert ids == sorted(ids)


def test_fold_job_over_the_warehouse(spark, tmp_dir):
    from martlane.streaming import folding, runners
    firsts = runners.first_order_table(spark, f"{tmp_dir}/first_order_users")
    dau = runners.dau_table(spark, f"{tmp_dir}/dau")
    for b in range(3):
        dau.append(spark.createDataFrame([(f"m{i}", d, 10 - b) for i in range(4) for d in ("2024-01-15", "2024-01-16")],
                                         "mid string, log_date string, ts long"), "q", b)
        firsts.append(spark.createDataFrame([("u", str(b), f"2024-01-1{b} 00:00:00")],
                                            "user_id string, id string, create_time string"), "q", b)
    want, first = rows(dau.read()), rows(firsts.read())
    done = folding.fold_days(spark, tmp_dir, ["2024-01-15"])
    assert (done["dau"], done["first_order_users"], done["orders"]) == (4, 1, 0)
    folding.main(["--warehouse", tmp_dir, "--retire"])
    assert rows(dau.read()) == want and rows(firsts.read()) == first == [("u", "0", "2024-01-10 00:00:00")]
    assert folders(f"{tmp_dir}/dau/q=q/{PART}=2024-01-15") == []
    assert len(dau.rows(["2024-01-15"]).inputFiles()) == 1 and len(dau.rows(["2024-01-16"]).inputFiles()) == 3
