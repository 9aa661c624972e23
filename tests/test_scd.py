import pytest
from pyspark.sql import functions as F

from tidewater.operators import scd
from tidewater.plans import feeds
from tidewater.sources.history import HistoryTable

SCHEMA = "k string, a string, effective_business_date string, end_date string, latest boolean"
D1, D2, D3, END = "2021-12-01", "2021-12-02", "2021-12-03", "9999-12-31"


def day(spark, date, *rows):
    source = spark.createDataFrame(
        [(k, a, date) for k, a in rows], "k string, a string, business_date string"
    )
    return scd.new_versions(source)


def history(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_first_file_opens_every_row(spark):
    got = scd.scd2_merge(history(spark), day(spark, D1, ("a", "x"), ("b", "y")), "k")
    assert rows_of(got) == [("a", "x", D1, END, True), ("b", "y", D1, END, True)]


def test_unchanged_row_opens_a_new_version(spark):
    got = scd.scd2_merge(history(spark, ("a", "x", D1, END, True)), day(spark, D2, ("a", "x")), "k")
    assert rows_of(got) == [("a", "x", D1, D2, False), ("a", "x", D2, END, True)]


def test_closed_and_missing_rows_stay(spark):
    before = [("a", "x", D1, D2, False), ("a", "y", D2, END, True), ("b", "z", D1, END, True)]
    got = scd.scd2_merge(history(spark, *before), day(spark, D3, ("a", "w")), "k")
    assert rows_of(got) == [
        ("a", "w", D3, END, True),
        ("a", "x", D1, D2, False),
        ("a", "y", D2, D3, False),
        ("b", "z", D1, END, True),
    ]


def test_duplicate_new_keys_are_both_opened(spark):
    got = scd.scd2_merge(
        history(spark, ("b", "z", D1, END, True)), day(spark, D2, ("a", "x"), ("a", "y")), "k"
    )
    assert rows_of(got) == [
        ("a", "x", D2, END, True), ("a", "y", D2, END, True), ("b", "z", D1, END, True)
    ]


def test_two_open_rows_are_closed_by_one_row_and_reopened_twice(spark):
    before = [("a", "x", D1, END, True), ("a", "y", D1, END, True)]
    got = scd.scd2_merge(history(spark, *before), day(spark, D2, ("a", "z")), "k")
    assert rows_of(got) == [
        ("a", "x", D1, D2, False),
        ("a", "y", D1, D2, False),
        ("a", "z", D2, END, True),
        ("a", "z", D2, END, True),
    ]


def test_key_with_closed_rows_only_gets_nothing(spark):
    before = [("a", "x", D1, D2, False)]
    got = scd.scd2_merge(history(spark, *before), day(spark, D3, ("a", "z")), "k")
    assert rows_of(got) == before


def test_duplicate_known_keys_fail(spark):
    got = scd.scd2_merge(
        history(spark, ("a", "x", D1, END, True)), day(spark, D2, ("a", "y"), ("a", "z")), "k"
    )
    with pytest.raises(Exception, match="several source rows"):
        got.collect()
    with pytest.raises(Exception, match="several source rows"):
        got.count()


def test_keep_last_takes_the_newest(spark):
    source = day(spark, D2, ("a", "y")).unionByName(day(spark, D3, ("a", "z")))
    got = scd.scd2_merge(
        history(spark, ("a", "x", D1, END, True)), source, "k", on_duplicate="keep_last"
    )
    assert rows_of(got) == [("a", "x", D1, D3, False), ("a", "z", D3, END, True)]
    with pytest.raises(ValueError):
        scd.scd2_merge(history(spark), source, "k", on_duplicate="other")


def test_late_file_closes_the_newer_version_unless_guarded(spark):
    before = history(spark, ("a", "x", D2, END, True))
    late = day(spark, D1, ("a", "w"), ("b", "v"))
    assert rows_of(scd.scd2_merge(before, late, "k")) == [
        ("a", "w", D1, END, True),
        ("a", "x", D2, D1, False),
        ("b", "v", D1, END, True),
    ]
    assert rows_of(scd.scd2_merge(before, late, "k", guard_late=True)) == [
        ("a", "x", D2, END, True),
        ("b", "v", D1, END, True),
    ]


def test_null_keys_never_match(spark):
    before = history(spark, (None, "x", D1, END, True))
    got = scd.scd2_merge(before, day(spark, D2, (None, "y")), "k")
    assert rows_of(got) == [(None, "x", D1, END, True), (None, "y", D2, END, True)]


def test_null_latest_counts_as_closed(spark):
    before = [("a", "x", D1, END, None)]
    got = scd.scd2_merge(history(spark, *before), day(spark, D2, ("a", "y")), "k")
    assert rows_of(got) == before


def test_scd1(spark):
    before = history(spark, ("a", "x", D2, END, True), ("b", "y", D1, END, True))
    got = scd.scd1_merge(before, day(spark, D1, ("a", "w"), ("c", "v"), ("c", "u")), "k")
    assert rows_of(got) == [
        ("a", "w", D1, END, True),
        ("b", "y", D1, END, True),
        ("c", "u", D1, END, True),
        ("c", "v", D1, END, True),
    ]


def test_scd1_updates_every_copy_of_a_key(spark):
    before = history(spark, ("a", "x", D1, END, True), ("a", "y", D1, END, True))
    got = scd.scd1_merge(before, day(spark, D2, ("a", "z")), "k")
    assert rows_of(got) == [("a", "z", D2, END, True)] * 2


@pytest.fixture(scope="module")
def feed(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = feeds.security_feed(events, feeds.day("ts"))
    return rows.where(F.col("id_bb_global").isNotNull()).cache()


def test_backfill_equals_merging_day_by_day(spark, feed, tmp_path):
    days = sorted(r[0] for r in feed.select("business_date").distinct().collect())[:4]
    some = feed.where(F.col("business_date").isin(days))
    schema = scd.new_versions(feed).schema
    table = HistoryTable(spark, str(tmp_path / "history"), schema)
    whole = None
    latest = None
    for d in days:
        source = scd.new_versions(some.where(F.col("business_date") == d))
        table.merge(source, "security_id")
        if whole is None:
            whole, latest = source, source
        else:
            whole = spark.createDataFrame(
                scd.scd2_merge(whole, source, "security_id").collect(), schema
            )
            latest = spark.createDataFrame(
                scd.scd1_merge(latest, source, "security_id").collect(), schema
            )
    expected = rows_of(scd.scd2_backfill(some, "security_id"))
    assert rows_of(whole) == expected
    assert rows_of(table.read()) == expected
    newest = rows_of(scd.scd1_backfill(some, "security_id"))
    assert rows_of(latest) == newest
    # One table serves both: the open rows are the type 1 table.
    assert rows_of(table.open_rows()) == newest


def test_backfill_keeps_null_keys_open(spark):
    source = spark.createDataFrame(
        [(None, "x", D1), (None, "y", D2), ("a", "z", D1)],
        "k string, a string, business_date string",
    )
    assert rows_of(scd.scd2_backfill(source, "k")) == [
        ("a", "z", D1, END, True), (None, "x", D1, END, True), (None, "y", D2, END, True)
    ]
    assert len(rows_of(scd.scd1_backfill(source, "k"))) == 3


D4, D5 = "2021-12-04", "2021-12-05"


def test_splice_places_late_and_corrected_rows(spark):
    before = history(
        spark,
        ("a", "a2", D2, D4, False), ("a", "a4", D4, END, True),
        ("b", "b3", D3, END, True), ("c", "c1", D1, END, True), (None, "n2", D2, END, True),
    )
    source = (
        day(spark, D1, ("a", "a1"), ("d", "d1"))
        .unionByName(day(spark, D2, ("a", "A2"), ("b", "b2")))
        .unionByName(day(spark, D5, ("c", "c5"), (None, "n5")))
    )
    assert rows_of(scd.scd2_splice(before, source, "k")) == [
        ("a", "A2", D2, D4, False), ("a", "a1", D1, D2, False), ("a", "a4", D4, END, True),
        ("b", "b2", D2, D3, False), ("b", "b3", D3, END, True),
        ("c", "c1", D1, D5, False), ("c", "c5", D5, END, True), ("d", "d1", D1, END, True),
        (None, "n2", D2, END, True), (None, "n5", D5, END, True),
    ]


def test_splice_of_a_whole_date_withdraws_rows(spark):
    before = history(
        spark,
        ("a", "a2", D2, D4, False), ("a", "a4", D4, END, True),
        ("b", "b2", D2, END, True), (None, "n2", D2, END, True), (None, "n3", D3, END, True),
    )
    source = day(spark, D2, ("c", "c2"), (None, "N2"))
    assert rows_of(scd.scd2_splice(before, source, "k", [D2])) == [
        ("a", "a4", D4, END, True), ("c", "c2", D2, END, True),
        (None, "N2", D2, END, True), (None, "n3", D3, END, True),
    ]


def test_rows_of_one_key_and_date_share_their_interval(spark):
    before = history(spark, ("a", "x", D3, END, True))
    source = day(spark, D1, ("a", "u"), ("a", "v"))
    assert rows_of(scd.scd2_splice(before, source, "k")) == [
        ("a", "u", D1, D3, False), ("a", "v", D1, D3, False), ("a", "x", D3, END, True)
    ]
    with pytest.raises(Exception, match="several rows of one k"):
        scd.scd2_backfill(
            spark.createDataFrame([("a", D1), ("a", D1)], "k string, business_date string"), "k"
        ).collect()


def test_deliveries_in_any_order_give_the_history_of_all(spark, feed, tmp_path):
    days = sorted(r[0] for r in feed.select("business_date").distinct().collect())[:5]
    some = feed.where(F.col("business_date").isin(days))
    of = lambda d: scd.new_versions(some.where(F.col("business_date") == d))
    stale = of(days[3]).withColumn("cusip", F.lit("stale")).withColumn(
        "security_id", F.when(F.col("security_id").endswith("1"), "S-gone").otherwise(F.col("security_id"))
    ).dropDuplicates(["security_id"])
    table = HistoryTable(spark, str(tmp_path / "history"), scd.new_versions(feed).schema, "security_id")
    for d in (days[2], days[4], days[0]):
        table.splice(of(d), [d])
    after_three = rows_of(table.read())
    table.splice(stale, [days[3]])
    table.splice(of(days[1]), [days[1]], batch="b")
    newest = table.splice(of(days[3]), [days[3]])
    expected = rows_of(scd.scd2_backfill(some, "security_id"))
    assert rows_of(table.read()) == expected
    # A batch that is in the table changes nothing, whatever it brings.
    assert table.splice(stale, [days[1]], batch="b") == newest - 1
    assert table.snapshots.latest_version() == newest
    assert rows_of(table.read(2)) == after_three
    three = some.where(F.col("business_date").isin(days[0], days[2], days[4]))
    assert after_three == rows_of(scd.scd2_backfill(three, "security_id"))
    # Several dates at once, into a new table and an old one.
    other = HistoryTable(spark, str(tmp_path / "other"), table.schema, "security_id")
    other.splice(of(days[4]).unionByName(of(days[0])))
    other.splice(of(days[1]).unionByName(of(days[2])).unionByName(of(days[3])))
    assert rows_of(other.read()) == expected
    assert rows_of(other.open_rows()) == rows_of(scd.scd1_backfill(some, "security_id"))


def test_a_version_counts_without_marker_files_of_the_writer(spark, tmp_path):
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        table = HistoryTable(spark, str(tmp_path), scd.new_versions(day_rows(spark)).schema, "k")
        for d in (D1, D2):
            table.merge(day(spark, d, ("a", d)), "k")
    finally:
        hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    assert table.snapshots.versions() == [0, 1]
    assert rows_of(table.read()) == [("a", D1, D1, D2, False), ("a", D2, D2, END, True)]


def day_rows(spark):
    return spark.createDataFrame([], "k string, a string, business_date string")


def test_first_merge_keeps_the_last_row(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path), scd.new_versions(day_rows(spark)).schema, "k")
    table.merge(day(spark, D1, ("a", "x")).unionByName(day(spark, D2, ("a", "y"))), "k", "keep_last")
    assert rows_of(table.read()) == [("a", "y", D2, END, True)]
