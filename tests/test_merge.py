import pytest
from pyspark.sql import functions as F

from tidewater.operators.merge import delete_rows, merge_rows, update_rows
from tidewater.plans import dml
from tidewater.sources.snapshots import SnapshotTable


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_update_uses_old_values_and_leaves_null_conditions(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "a int, b int")
    got = update_rows(df, F.col("b") > 5, {"a": F.col("b"), "b": F.col("a")})
    assert sorted(map(tuple, got.collect())) == [(2, None), (10, 1), (30, 3)]
    assert got.dtypes == df.dtypes


def test_delete_keeps_null_conditions(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "a int, b int")
    assert sorted(r[0] for r in delete_rows(df, F.col("b") > 15).collect()) == [1, 2]


def test_walkthrough_versions(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    dml.walkthrough(table, spark.range(0, 5), spark.range(0, 10))
    assert table.versions() == [0, 1, 2, 3]
    assert ids(table.read(0)) == [0, 1, 2, 3, 4]
    assert ids(table.read(1)) == [1, 2, 3, 100, 104]
    assert ids(table.read(2)) == [2, 100, 104]
    assert ids(table.read()) == [*range(10), 100, 104]
    assert table.read_all().groupBy("version").count().count() == 4
    with pytest.raises(ValueError):
        table.read(7)


def test_uncommitted_version_does_not_count(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.write(spark.range(3))
    half = tmp_path / "t" / "version=1"
    half.mkdir()
    (half / "part-0.parquet").write_text("torn")
    assert table.versions() == [0]
    assert table.write(spark.range(4)) == 1
    assert ids(table.read()) == [0, 1, 2, 3]


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "k int, name string, v double"
    )


def test_merge_with_column_lists(spark, target):
    source = spark.createDataFrame([(2, 20), (3, 30), (None, 40)], "k int, amount int")
    got = merge_rows(
        target, source, ["k"], update={"v": "amount"}, insert={"k": "k", "v": "amount"}
    )
    assert got.dtypes == target.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "a", 1.0), (2, "b", 20.0), (None, "n", 0.0), (3, None, 30.0), (None, None, 40.0)],
        key=str,
    )


def test_merge_on_two_keys(spark):
    target = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "a int, b string, v int")
    source = spark.createDataFrame([(1, "y", 9), (2, "y", 8)], "a int, b string, v int")
    got = merge_rows(target, source, ["a", "b"])
    assert sorted(map(tuple, got.collect())) == [(1, "x", 1), (1, "y", 9), (2, "y", 8)]


def test_several_source_rows_for_a_match_fail_even_in_a_count(spark, target):
    source = spark.createDataFrame([(2, "p", 1.0), (2, "q", 2.0)], "k int, name string, v double")
    for action in ("collect", "count"):
        with pytest.raises(Exception, match="several source rows"):
            getattr(merge_rows(target, source, ["k"]), action)()


def test_duplicate_unmatched_source_rows_are_all_inserted(spark, target):
    source = spark.createDataFrame([(7, "p", 1.0), (7, "q", 2.0)], "k int, name string, v double")
    assert merge_rows(target, source, ["k"]).count() == 5


def test_keep_last(spark, target):
    source = spark.createDataFrame(
        [(2, "p", 1.0), (2, "q", 2.0), (7, "r", 3.0), (7, "s", 1.0), (None, "m", 9.0)],
        "k int, name string, v double",
    )
    got = merge_rows(target, source, ["k"], on_duplicate="keep_last", newest_by="v")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "a", 1.0), (2, "q", 2.0), (None, "n", 0.0), (7, "r", 3.0), (None, "m", 9.0)],
        key=str,
    )
    with pytest.raises(ValueError):
        merge_rows(target, source, ["k"], on_duplicate="keep_last")


def test_keys_of_different_types(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    got = merge_rows(target, source, ["k"])
    assert got.dtypes == target.dtypes
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_columns_that_cannot_be_hashed_or_ordered(spark):
    schema = "k string, day int, m map<string,int>"
    target = spark.createDataFrame([("a", 1, {"x": 1}), (None, 1, {"x": 2})], schema)
    source = spark.createDataFrame([("a", 2, {"y": 3}), ("a", 3, {"z": 4})], schema)
    got = merge_rows(target, source, ["k"], on_duplicate="keep_last", newest_by="day")
    assert sorted(((r.k, r.day, r.m) for r in got.collect()), key=str) == [
        ("a", 3, {"z": 4}), (None, 1, {"x": 2})
    ]
