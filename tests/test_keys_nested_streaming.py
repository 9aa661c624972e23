import datetime
import pathlib

import pytest
from pyspark.sql import functions as F

from tidewater.operators import keys, nested
from tidewater.plans import domain
from tidewater.session import work_dir
from tidewater.streaming.incremental import ingest_new_files


def test_ids_are_consecutive_over_many_partitions(spark):
    df = spark.range(10_000).select((F.col("id") * 7 % 10_007).alias("n")).repartition(5)
    got = keys.assign_ids(df, ["n"], last_id=50).orderBy("n").collect()
    assert [r["id"] for r in got] == list(range(51, 10_051))
    assert keys.assign_ids(df.where("n < 0"), ["n"]).count() == 0


def test_ids_with_a_hot_value(spark):
    """A third of the rows share the first order column."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    # At this size AQE would merge all ranges.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = keys.assign_ids(df, ["k"], into="key").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r["key"] for r in got) == list(range(1, 3001))
    assert max(r["key"] for r in got if r["k"] != "hot") == 2000
    # The hot value lies in several ranges.
    staged = max(pathlib.Path(spark.conf.get("spark.checkpoint.dir")).glob("ids-*"),
                 key=lambda p: p.stat().st_mtime)
    parts = spark.read.parquet(str(staged)).where("k = 'hot'").select("_part").distinct().count()
    assert parts > 1


def test_high_water_mark(spark, tmp_path):
    mark = keys.HighWaterMark(spark, str(tmp_path / "mark"))
    assert mark.read() == 0
    mark.store(7)
    mark.store(12)
    assert mark.read() == 12
    first = keys.assign_ids(spark.range(3).toDF("n"), ["n"], mark.read())
    assert sorted(r["id"] for r in first.collect()) == [13, 14, 15]


@pytest.fixture(scope="module")
def positions(spark):
    return spark.range(100).select(
        F.when(F.col("id") < 40, 1).when(F.col("id") < 95, F.col("id")).alias("account"),
        F.col("id").alias("position"),
        (F.col("id") * 1.5).alias("value"),
    )


def test_nest_and_flatten(positions):
    whole = nested.nest(positions, "account", "position", ["position", "value"], "positions")
    assert whole.count() == 57
    hot = whole.where("account = 1").first()
    assert hot["page"] == 0
    assert [p["position"] for p in hot["positions"]] == list(range(40))
    assert whole.where("account IS NULL").first()["positions"][0]["position"] == 95
    flat = nested.flatten(whole, "positions")
    assert flat.columns == positions.columns
    assert sorted(map(str, flat.collect())) == sorted(map(str, positions.collect()))


def test_large_parent_is_paged_without_loss(positions):
    paged = nested.nest(
        positions, "account", "position", ["position", "value"], "positions", page_size=3
    )
    assert paged.where("account = 1").count() > 5
    assert paged.where("account IS NULL").count() == 2
    assert paged.where("account = 50").first()["page"] == 0
    flat = nested.flatten(paged, "positions")
    assert sorted(map(str, flat.collect())) == sorted(map(str, positions.collect()))


def test_hot_parent_is_split(spark, tmp_path):
    """A third of the rows under one parent, a third under none."""
    spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id")).alias("parent"),
        "id",
    ).write.parquet(str(tmp_path / "c"))
    children = spark.read.parquet(str(tmp_path / "c"))
    paged = nested.nest(children, "parent", "id", ["id"], "ids", page_size=500)
    sizes = [r["n"] for r in paged.select(F.size("ids").alias("n")).collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 800


def test_domain_records(spark):
    accounts = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "y")], "id long, name string, description string"
    )
    positions = spark.createDataFrame(
        [(2.5, "long", 1, 11), (1.5, "short", 1, 10)],
        domain.POSITION,
    )
    got = domain.accounts_with_positions(accounts, positions).orderBy("id")
    lists = [[(p.security_id, p.market_value, p.exposure) for p in r.positions] for r in got.collect()]
    assert lists == [[(10, 1.5, "short"), (11, 2.5, "long")], []]
    in_order = got.select(
        "id", "name", "description",
        F.transform("positions", lambda p: F.struct(*[p[n] for n in domain.POSITION.names])).cast(
            domain.ACCOUNT["positions"].dataType
        ).alias("positions"),
    )
    assert in_order.dtypes == spark.createDataFrame([], domain.ACCOUNT).dtypes
    securities = spark.createDataFrame(
        [(7, "s", "d", "c")], "id long, name string, description string, cusip string"
    )
    industries = spark.createDataFrame(
        [(7, 2, "n2", "src", "v"), (7, 1, "n1", "src", "v")],
        "security_id long, id long, name string, source string, value string",
    )
    row = domain.securities_with_industries(securities, industries).first()
    assert [i.name for i in row.industries] == ["n1", "n2"]


def test_each_file_arrives_once(spark, tmp_path):
    source, target, bookmark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = spark.range(1).withColumn("d", F.lit("x")).schema

    def run():
        ingest_new_files(
            spark, source, schema, target, bookmark,
            transform=lambda df: df.where("id % 2 = 0"),
            partition_by="d",
            options={"maxFilesPerTrigger": "1"},
        )
        return sorted(r["id"] for r in spark.read.parquet(target).collect())

    spark.range(4).withColumn("d", F.lit("a")).write.parquet(source)
    assert run() == [0, 2]
    assert run() == [0, 2]
    spark.range(10, 14).withColumn("d", F.lit("b")).write.mode("append").parquet(source)
    assert run() == [0, 2, 10, 12]
    assert run() == [0, 2, 10, 12]


def test_incremental_csv_with_its_business_date(spark, tmp_path):
    from tidewater.functions.dates import business_date

    (tmp_path / "in").mkdir()
    day = datetime.date(2021, 12, 1)
    args = [str(tmp_path / n) for n in ("in", "out", "mark")]
    for i in range(2):
        name = (day + datetime.timedelta(i)).strftime("index_%Y%m%d.csv")
        (tmp_path / "in" / name).write_text("a,b\n1,x\n2,\n")
        ingest_new_files(
            spark, args[0], spark.createDataFrame([], "a string, b string").schema, *args[1:],
            file_format="csv", options={"header": "true"},
            transform=lambda df: df.withColumn("d", business_date(F.col("_metadata.file_path"))),
        )
    got = spark.read.parquet(args[1]).groupBy("d").count().collect()
    assert sorted(map(tuple, got)) == [("2021-12-01", 2), ("2021-12-02", 2)]


def test_work_dir_is_under_the_shared_folder_and_new_each_time(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(shared) and b.startswith(shared)


def test_streamed_history_takes_a_batch_once(spark, tmp_path):
    from tidewater.operators import scd
    from tidewater.sources.history import HistoryTable
    from tidewater.streaming.history import merge_new_files

    schema = "k string, a string, business_date string"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    landed, bookmark = str(tmp_path / "in"), str(tmp_path / "bookmark")
    table = HistoryTable(spark, str(tmp_path / "t"), scd.new_versions(rows()).schema, "k")
    run = lambda: merge_new_files(spark, landed, rows().schema, table, bookmark, scd.new_versions)
    rows(("a", "2", "2021-12-02"), ("b", "2", "2021-12-02")).write.parquet(landed)
    run()
    rows(("a", "4", "2021-12-04"), ("a", "1", "2021-12-01")).write.mode("append").parquet(landed)
    run()
    wanted = [
        ("a", "1", "2021-12-01", "2021-12-02", False), ("a", "2", "2021-12-02", "2021-12-04", False),
        ("a", "4", "2021-12-04", "9999-12-31", True), ("b", "2", "2021-12-02", "9999-12-31", True),
    ]
    got = lambda: sorted(map(tuple, table.read().collect()))
    assert got() == wanted and table.snapshots.versions() == [0, 1]
    # The run failed after the merge and before the bookmark moved.
    for name in ("1", ".1.crc"):
        (tmp_path / "bookmark" / "commits" / name).unlink(missing_ok=True)
    run()
    assert got() == wanted and table.snapshots.versions() == [0, 1]
    rows(("b", "3", "2021-12-03")).write.mode("append").parquet(landed)
    run()
    assert ("b", "3", "2021-12-03", "9999-12-31", True) in got() and table.snapshots.versions() == [0, 1, 2]
