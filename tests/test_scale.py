"""What the plans must look like for data far larger than a test's."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tidewater.operators import aggregate, scd
from tidewater.operators.joins import balanced_join, lookup_join
from tidewater.operators.merge import merge_rows, update_rows
from tidewater.operators.transform import dynamic_filter
from tidewater.plans import medallion
from tidewater.sources.history import HistoryTable

SF = "/root/testdata/sf0.01"


@contextlib.contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df):
    """The final plan after running."""
    query = df._jdf.queryExecution()
    query.executedPlan().executeCollect()
    return query.executedPlan().toString()


def test_aggregate_combines_before_its_only_shuffle_and_reads_needed_columns(spark):
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(aggregate.grouped_total(lineitem, ["l_returnflag"], "l_extendedprice", "t"))
    assert text.count("Exchange") == 1
    assert text.count("HashAggregate") == 2
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in text


def test_word_count_reads_texts_once_and_shuffles_counts_once(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    text = plan(aggregate.word_count(documents, "text"))
    assert text.count("Exchange") == 1 and text.count("Generate") == 1
    assert text.count("HashAggregate") == 2
    assert "ReadSchema: struct<text:string>" in text
    top = plan(aggregate.top_words(aggregate.word_count(documents, "text")))
    assert "TakeOrderedAndProject" in top


def test_backfill_shuffles_once(spark):
    rows = spark.createDataFrame([("a", "x", "d")], "k string, a string, business_date string")
    assert plan(scd.scd2_backfill(rows, "k")).count("Exchange") == 1


def test_filters_reach_the_scan(spark):
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    got = dynamic_filter(customer, [{"column_name": "c_mktsegment", "column_value": "BUILDING"}])
    assert "EqualTo(c_mktsegment,BUILDING)" in plan(got)


def test_update_does_not_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(update_rows(orders, F.col("o_orderkey") > 5, {"o_totalprice": F.lit(0.0)}))
    assert "Exchange" not in text


@pytest.fixture
def stored(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.concat(F.lit("S"), "id").alias("security_id"),
        F.lit("name").alias("security_name"),
        F.concat(F.lit("B"), "id").alias("id_bb_global"),
        F.lit("c").alias("cusip"),
        F.lit("2021-12-01").alias("effective_business_date"),
        F.lit("9999-12-31").alias("end_date"),
        F.lit(True).alias("latest"),
    )
    table = HistoryTable(spark, str(tmp_path / "h"), medallion.SECURITY_SCHEMA)
    table.append_version(rows)
    source = rows.where("security_id < 'S11'").withColumn(
        "effective_business_date", F.lit("2021-12-02")
    )
    source.write.parquet(str(tmp_path / "s"))
    return table, spark.read.parquet(str(tmp_path / "s"))


def above_scans(text, column):
    """For each scan with ``column``, the operators on its way to the root, nearest
    first."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = text.split("\n")
    paths = []
    for i, line in enumerate(lines):
        if "FileScan" in line and column in line:
            level, path = depth(line), []
            for upper in reversed(lines[:i]):
                if depth(upper) < level:
                    level = depth(upper)
                    path.append(upper.strip(" :+-"))
            paths.append(path)
    return paths


@pytest.mark.parametrize("how", ["scd2", "upsert"])
def test_small_source_merges_without_shuffling_the_target(spark, stored, how):
    table, source = stored
    merge = scd.scd2_merge if how == "scd2" else scd.scd1_merge
    text = plan(merge(table.open_rows(), source, "security_id"))
    # The target is scanned twice: in full, and for its keys, which are cut down
    # to the source's before they are shuffled.
    full, keys = above_scans(text, "version#")
    assert not any("Exchange" in op for op in full)
    joins = [op for op in keys if "Join" in op or "Exchange" in op]
    assert joins[0].startswith("BroadcastHashJoin") and "LeftSemi" in joins[0]


def test_large_source_merges_without_any_broadcast(spark, stored):
    table, source = stored
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    ):
        merged = scd.scd2_merge(table.open_rows(), source, "security_id")
        assert "BroadcastExchange" not in plan(merged)
        n = source.count()
        assert merged.count() == 20_000 + n
        assert merged.where("latest").count() == 20_000
        upsert = merge_rows(table.open_rows(), source, ["security_id"])
        assert "BroadcastExchange" not in plan(upsert)
        assert upsert.count() == 20_000


def test_merge_reads_and_writes_open_rows_only(spark, stored):
    table, source = stored
    n = source.count()
    table.merge(source, "security_id")
    table.merge(source.withColumn("effective_business_date", F.lit("2021-12-03")), "security_id")
    filters = plan(table.open_rows()).split("PartitionFilters: [")[1].split("]")[0]
    assert "latest" in filters and "true" in filters
    written = spark.read.parquet(table.snapshots.version_path(2))
    assert written.where("latest = 'false'").count() == n
    assert table.read().count() == 20_000 + 2 * n
    assert table.read(1).count() == 20_000 + n


def test_bronze_date_is_pruned(spark, tmp_path):
    lake = medallion.Lake(spark, str(tmp_path))
    rows = spark.range(10).select(
        *[F.col("id").cast("string").alias(c) for c in medallion.INDEX_COLUMNS[:-1]],
        F.concat(F.lit("2021-12-0"), (F.col("id") % 3 + 1)).alias("business_date"),
    )
    medallion.land(lake, "index", rows)
    bronze = spark.read.parquet(lake.path("index", "bronze"))
    silver = medallion.index_silver_rows(bronze, "2021-12-02")
    filters = plan(silver).split("PartitionFilters: [")[1].split("]")[0]
    assert "2021-12-02" in filters
    assert silver.count() == 3


def skewed(spark, key):
    """A third of the rows share one key, another third have none."""
    return spark.range(120_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 1000))
        .alias(key),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )


SKEW = {
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2.0",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "128KB",
}


def test_hot_and_missing_keys_are_split_in_a_lookup(spark, tmp_path):
    skewed(spark, "figi").repartition(16).write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    lookup = spark.range(1000).select(
        F.concat(F.lit("k"), "id").alias("gid"), F.col("id").alias("v")
    ).unionByName(spark.createDataFrame([("hot", -1), (None, -2)], "gid string, v long"))
    with settings(spark, **SKEW):
        joined = lookup_join(facts, lookup, "figi", "gid").select("id", "figi", "v")
        text = run_plan(joined)
        assert "skew=true" in text or "(skew" in text
        # Rows without a key are spread over the shuffle partitions.
        spread = (
            lookup_join(facts.where("figi IS NULL"), lookup, "figi", "gid")
            .withColumn("part", F.spark_partition_id())
            .groupBy("part")
            .count()
            .collect()
        )
    assert len(spread) > 1
    rows = {r["figi"]: r["n"] for r in joined.groupBy("figi").agg(F.count("v").alias("n")).collect()}
    assert joined.count() == 120_000
    assert rows["hot"] == 40_000 and rows[None] == 0
    assert sum(rows.values()) == 80_000


def test_merge_with_a_hot_target_key(spark, tmp_path):
    skewed(spark, "k").repartition(16).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.createDataFrame([(1, "hot", "new"), (2, "k1", "new"), (3, "z", "new")], target.schema)
    with settings(spark, **SKEW):
        merged = merge_rows(target, source, ["k"], update={"payload": "payload"})
        text = run_plan(merged)
        assert "skew=true" in text or "(skew" in text
    assert merged.count() == 120_001
    assert merged.where("payload = 'new' AND k = 'hot'").count() == 40_000


KEY_TYPES = [
    ("int", "bigint"), ("bigint", "double"), ("double", "float"), ("decimal(9,2)", "bigint"),
    ("decimal(9,2)", "decimal(12,4)"), ("decimal(9,2)", "double"), ("double", "double"), ("float", "float"),
]


@pytest.mark.parametrize("a, b", KEY_TYPES)
def test_keys_of_any_numeric_types_are_spread_and_match_as_in_sql(spark, a, b):
    """A third of the rows without a key and a third with one value, whatever the types."""
    whole = F.col("id") % 50
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(whole + (0.5 if "int" not in a else 0))
    left = spark.range(3_000).select(key.cast(a).alias("k"), F.col("id").alias("v"))
    right = spark.range(60).select((F.col("id") / (1 if "int" in b else 2)).cast(b).alias("r"), F.col("id").alias("w"))
    if a in ("double", "float"):
        odd = spark.createDataFrame([("-0.0", -1), ("NaN", -2)], "k string, v long").select(F.col("k").cast(a).alias("k"), "v")
        left = left.unionByName(odd)
        right = right.unionByName(spark.createDataFrame([("0.0", -3), ("NaN", -4)], "r string, w long").select(F.col("r").cast(b).alias("r"), "w"))
    for how in ("left", "left_semi", "left_anti"):
        with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
            joined = balanced_join(left, right, [("k", "r")], how)
            text = plan(joined)
            got = sorted(map(str, joined.collect()))
        assert got == sorted(map(str, left.join(right, F.col("k") == F.col("r"), how).collect()))
        assert "_spread" in text
