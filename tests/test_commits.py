"""Commits that meet, loads and exports that fail halfway, digests and the access matrix."""

import threading

import pytest
from pyspark.sql import functions as F

from aisleframe.operators import checks
from aisleframe.plans import security
from aisleframe.plans.star import Star
from aisleframe.sources import master, tables
from aisleframe.sources.commits import CommitConflict, CommitLog, swap_folder
from tests.test_master import _master


def test_two_publishers_that_saw_the_same_version_both_get_one(spark, tmp_path):
    target = str(tmp_path)
    one, two = (spark.createDataFrame([(n,)], "n int") for n in (1, 2))
    assert tables.publish({"t": one}, target) == {"t": 0}
    logs = [CommitLog(spark, f"{target}/t") for _ in range(2)]
    seen = [log.latest() for log in logs]
    real = CommitLog.latest
    CommitLog.latest = lambda self: seen[0]  # both read the latest version before either commits
    try:
        assert tables.publish({"t": two}, target) == {"t": 1}
        assert tables.publish({"t": one}, target) == {"t": 2}
    finally:
        CommitLog.latest = real
    assert [tables.read_published(spark, target, "t", v).first()[0] for v in (0, 1, 2)] == [1, 2, 1]
    assert tables.latest_version(spark, f"{target}/t") == 2


def test_many_writers_at_once_lose_nothing(spark, tmp_path):
    log, got = CommitLog(spark, str(tmp_path / "t")), []
    writers = [threading.Thread(target=lambda i=i: got.append((log.add({"writer": i}), i))) for i in range(16)]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert sorted(v for v, _ in got) == list(range(16)) == log.versions()
    assert all(log.read(v) == {"writer": i} for v, i in got)
    assert not [f for f in (tmp_path / "t" / "_commits").iterdir() if f.name.endswith(".draft")]


def test_publishing_after_a_version_that_is_no_longer_the_latest(spark, tmp_path):
    df = spark.range(1)
    tables.publish({"t": df}, str(tmp_path))
    assert tables.publish({"t": df}, str(tmp_path), after={"t": 0}) == {"t": 1}
    with pytest.raises(CommitConflict):
        tables.publish({"t": df}, str(tmp_path), after={"t": 0})
    assert tables.latest_version(spark, str(tmp_path / "t")) == 1 and tables.latest_version(spark, str(tmp_path / "none")) == -1


def test_failed_publication_changes_nothing(spark, tmp_path):
    good = spark.createDataFrame([(1,)], "n int")
    tables.publish({"t": good}, str(tmp_path))
    with pytest.raises(Exception):
        tables.publish({"t": good.select(F.raise_error(F.lit("broken")).alias("n"))}, str(tmp_path))
    assert tables.read_published(spark, str(tmp_path), "t").first()[0] == 1


def test_empty_table_keeps_its_schema(spark, tmp_path):
    tables.publish({"t": spark.createDataFrame([], "a int, b string")}, str(tmp_path))
    assert tables.read_published(spark, str(tmp_path), "t").dtypes == [("a", "int"), ("b", "string")]


def test_load_that_fails_at_the_seventh_table_leaves_the_nine_before(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    master.load_master(spark, _master(tmp_path / "in"), out)
    changed = _master(tmp_path / "in", region="region_id,region_name\n1,South\n")
    calls, write = [], master._write

    def broken(df, path):
        calls.append(path)
        if len(calls) == 7:
            raise OSError("disk full")
        write(df, path)

    monkeypatch.setattr(master, "_write", broken)
    with pytest.raises(OSError):
        master.load_master(spark, changed, out)
    assert master.read_loaded(spark, out)["region"].first().region_name == "North"
    monkeypatch.setattr(master, "_write", write)
    assert master.load_master(spark, changed, out)["region"].first().region_name == "South"
    assert master.read_loaded(spark, out, 0)["region"].first().region_name == "North"
    assert set(master.read_loaded(spark, out)) == set(master.LOAD_ORDER)


def test_export_replaces_the_folder_as_a_whole(spark, tmp_path):
    dest, one = str(tmp_path / "gold"), spark.createDataFrame([(1,)], "n int")
    tables.write_gold({"a": one, "b": one}, dest)
    with pytest.raises(Exception):
        tables.write_gold({"a": one.withColumn("n", F.lit(2)), "b": one.select(F.raise_error(F.lit("x")).alias("n"))}, dest)
    assert tables.folder_names(spark, dest) == ["a", "b"] and spark.read.parquet(f"{dest}/a").first()[0] == 1
    tables.write_gold({"a": one.withColumn("n", F.lit(3))}, dest)
    assert tables.folder_names(spark, dest) == ["a"] and spark.read.parquet(f"{dest}/a").first()[0] == 3


def test_failed_swap_puts_the_old_folder_back(spark, tmp_path):
    (tmp_path / "gold").mkdir()
    (tmp_path / "gold" / "x").write_text("old")
    with pytest.raises(Exception):
        swap_folder(spark, str(tmp_path / "missing"), str(tmp_path / "gold"))
    assert (tmp_path / "gold" / "x").read_text() == "old"


def test_only_partitions_with_other_digests_are_joined(spark):
    rows = [(y, c, float(y * 10 + i), None if i == 2 else 1 / 3) for y in (1, 2, 3) for i, c in enumerate(["a", None, "b|c"])]
    left = spark.createDataFrame(rows, "y int, c string, u double, v double")
    near = left.withColumn("u", F.col("u") * (1 + 1e-13)).orderBy(F.desc("u"))
    by = {"keys": ["y", "c"], "values": ["u", "v"], "by": ["y"]}
    assert checks.differing_partitions(left, left.orderBy(F.rand(1)), ["y"], ["y", "c"], ["u", "v"]).collect() == []
    assert checks.reconcile(left, near, **by).collect() == []
    changed = left.filter("NOT (y = 3 AND c <=> 'a')").withColumn("u", F.when((F.col("y") == 2) & F.col("c").isNull(), 0.0).otherwise(F.col("u")))
    assert [r.y for r in checks.differing_partitions(left, changed, ["y"], ["y", "c"], ["u", "v"]).orderBy("y").collect()] == [2, 3]
    found = {(r.y, r.c, r.u_left, r.u_right) for r in checks.reconcile(left, changed, **by).collect()}
    assert found == {(2, None, 21.0, 0.0), (3, "a", 30.0, None)}
    twice = left.unionByName(left.filter("y = 1 AND c = 'a'"))
    assert [r.y for r in checks.differing_partitions(left, twice, ["y"], ["y", "c"], ["u", "v"]).collect()] == [1]


def _small_star(spark):
    stores = spark.createDataFrame([(1,), (2,), (3,)], "store_key int").selectExpr(
        "store_key", "store_key as store_nbr", "'c' as city", "'s' as state", "'A' as store_type", "1 as cluster",
        "date'2016-01-01' as opening_date", "1 as selling_area_m2", "'r' as region")
    access = spark.createDataFrame([("u", 1), ("u", 2), ("u", 9), ("v", 3)], "user_principal_name string, store_key int")
    dates = spark.sql("SELECT date'2016-01-01' AS date, 2016 AS year, 1 AS month_num, 'Jan' AS month_name, 201601 AS month_key")
    return Star.of({"dim_store": lambda: stores, "user_access": lambda: access, "dim_date": lambda: dates,
                    "dim_item": lambda: spark.createDataFrame([(1, 1.0)], "item_key int, unit_cost double")})


def test_access_matrix_follows_the_roles(spark, monkeypatch):
    star = _small_star(spark)
    members = spark.createDataFrame(
        [("u", security.STORE_OPERATIONS), ("v", security.STORE_OPERATIONS), ("w", security.STORE_OPERATIONS), ("h", security.COMMERCIAL)],
        "user string, role string")
    matrix = lambda: {r["user"]: tuple(r)[2:] for r in security.access_matrix(star, members).collect()}
    assert matrix() == {"u": (2, 3, False), "v": (1, 1, False), "w": (0, 0, False), "h": (3, 0, True)}
    roles = {role: [r["user"] for r in members.collect() if r["role"] == role] for role in security.RULES}
    for user, (stores, rows, cost) in matrix().items():
        seen = security.secure(star, user, roles)
        assert (seen.table("dim_store").count(), seen.table("user_access").count()) == (stores, rows)
        assert ("unit_cost" in seen.table("dim_item").columns) == cost
    monkeypatch.setitem(security.RULES, security.COMMERCIAL, security.Role(False, frozenset({"dim_store"}), frozenset({"unit_cost"})))
    monkeypatch.setitem(security.RULES, security.STORE_OPERATIONS, security.Role(True, frozenset({"user_access"})))
    assert matrix() == {"u": (2, 0, True), "v": (1, 0, True), "w": (0, 0, True), "h": (0, 4, False)}
    assert security.secure(star, "h", roles).table("dim_store").count() == 0
