"""Every operator and job over the whole sample tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import dates, html
from tidewater.operators import cards as card_ops
from tidewater.operators import choices, elements, keys, links, nested, scd, transform
from tidewater.operators.aggregate import grouped_total, top_words, word_count
from tidewater.operators.merge import delete_rows, merge_rows, update_rows
from tidewater.plans import dml, feeds, medallion
from tidewater.session import work_dir
from tidewater.sinks.files import append_parquet, append_partitioned, rebalanced
from tidewater.sources.files import driver_table as table
from tidewater.sources.history import HistoryTable
from tidewater.sources.loads import read_loads
from tidewater.sources.snapshots import SnapshotTable
from tidewater.streaming.history import merge_new_files
from tidewater.streaming.incremental import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

KEYWORD = "the"
LAST_SUPPLIER_ID = 1000
# Days merged one after another.
MERGED_DAYS = 5


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, computed once."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fare_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = grouped_total(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus", "l_linenumber"],
        "l_extendedprice",
        "total_fare_amount",
    )
    return totals.withColumn("total_fare_amount", F.round("total_fare_amount", 2))


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(table(spark, sf_dir, "documents"), "text")


def word_count_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_words(word_counts(spark, sf_dir), 10)


def index_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All daily order files at once; a partly filled order comes a day after its date,
    so its file's date is not its own and it stays out of silver."""
    late = F.when(F.col("o_orderstatus") == "P", F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    bronze = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("index_name"),
        F.col("o_orderkey").alias("constituent_id"),
        F.col("o_orderstatus").alias("ticker"),
        F.col("o_custkey").alias("figi"),
        F.col("o_totalprice").alias("index_weight"),
        (F.col("o_totalprice") * 2).alias("market_cap"),
        dates.iso_day(F.col("o_orderdate")).alias("business_date"),
        (F.col("o_orderdate") + late).alias("file_ts"),
    )
    path = feeds.landing_path(F.lit("orders"), "file_ts")
    return medallion.index_silver_rows(bronze, dates.business_date(path))


def business_date_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = feeds.landing_path(F.col("o_orderpriority"), "o_orderdate")
    return orders.select(
        "o_orderkey",
        dates.file_date(path).alias("file_date"),
        dates.business_date(path).alias("business_date"),
    )


def dynamic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.dynamic_filter(
        table(spark, sf_dir, "customer"),
        [
            {"column_name": "c_mktsegment", "column_value": "BUILDING"},
            {"column_name": "c_nationkey", "column_value": "7"},
        ],
    )


def typed_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.typed_mapping(
        table(spark, sf_dir, "lineitem"),
        [
            ("l_orderkey", "string", "order_id", "long"),
            ("l_linenumber", "int", "line", "long"),
            ("l_quantity", "double", "quantity", "long"),
            ("l_extendedprice", "string", "price", "double"),
            ("l_returnflag", "string", "flag", "string"),
            ("l_linestatus", "string", "status_code", "long"),
        ],
    )


def resolve_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    mixed = part.select(
        "p_partkey",
        F.when(F.col("p_size") <= 15, F.col("p_size").cast("string"))
        .when(F.col("p_size") <= 30, F.col("p_retailprice").cast("string"))
        .otherwise(F.col("p_type"))
        .alias("code"),
        F.col("p_brand").alias("brand"),
    )
    resolved = transform.resolve_choice(mixed)
    return resolved.select(
        "p_partkey",
        F.col("code.long").alias("code_long"),
        F.col("code.double").alias("code_double"),
        F.col("code.string").alias("code_string"),
        "brand",
    )


def nested_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records whose places hold numbers, texts and lists by turns."""
    part = table(spark, sf_dir, "part")
    size, price = F.col("p_size"), F.col("p_retailprice")
    code = F.when(size <= 15, size.cast("variant")).when(size <= 30, F.col("p_type").cast("variant"))
    records = part.select(
        "p_partkey",
        F.to_variant_object(
            F.struct(
                F.struct(code.alias("code"), F.col("p_brand").alias("brand")).alias("spec"),
                F.array(price.cast("variant"), F.col("p_brand").cast("variant")).alias("tags"),
            )
        ).alias("record"),
    )
    resolved = choices.resolve_nested(records, "record")
    return resolved.select(
        "p_partkey",
        F.col("record.spec.brand").alias("brand"),
        F.col("record.spec.code.long").alias("code_long"),
        F.col("record.spec.code.string").alias("code_string"),
        F.get(F.col("record.tags"), F.lit(0))["double"].alias("first_tag"),
        F.get(F.col("record.tags"), F.lit(1))["string"].alias("second_tag"),
        F.size("record.tags").alias("n_tags"),
    )


def silver_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in three loads, in which a code is all integers, numbers and text, and
    nothing; read back in one schema."""
    part = table(spark, sf_dir, "part")
    size, path = F.col("p_size"), work_dir(spark, "silver")
    mixed = part.select(
        "p_partkey",
        F.when(size <= 15, size.cast("string"))
        .when(size <= 30, F.col("p_retailprice").cast("string"))
        .when(size <= 45, F.col("p_type"))
        .alias("code"),
        F.when(size <= 15, size).alias("size"),
    )
    for number, rows in enumerate((size <= 15, (size > 15) & (size <= 45), size > 45)):
        load = transform.drop_null_columns(transform.resolve_choice(mixed.where(rows), ["code"]))
        append_parquet(load, f"{path}/load={number}")
    return read_loads(spark, path).select(
        "p_partkey",
        F.col("code.long").alias("code_long"),
        F.col("code.double").alias("code_double"),
        F.col("code.string").alias("code_string"),
        "size",
    )


def drop_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return transform.drop_null_columns(
        customer.withColumn("c_fee", F.when(F.col("c_custkey") < 0, F.col("c_acctbal")))
        .withColumn("c_vip", F.when(F.col("c_custkey") == 0, F.col("c_name")))
    )


def row_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dml.shift_even_ids(table(spark, sf_dir, "orders"), "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


def row_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return delete_rows(orders, F.col("o_orderstatus") == "F")


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the new state of customers: known keys get a new balance, the
    others are inserted without a segment."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    source = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("c_custkey"), "p_name", "p_retailprice"
    )
    return merge_rows(
        customer,
        source,
        ["c_custkey"],
        update={"c_acctbal": "p_retailprice"},
        insert={"c_custkey": "c_custkey", "c_name": "p_name", "c_acctbal": "p_retailprice"},
    )


def _daily_securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identified securities of every day."""
    feed = feeds.security_feed(table(spark, sf_dir, "events"), feeds.day("ts"))
    return feed.where(F.col("id_bb_global").isNotNull())


def _landed_securities(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, list[tuple[str, DataFrame]]]:
    """The same from a bronze table with a partition per day: the rows before the last
    MERGED_DAYS days, and each of these days' rows as new versions."""
    path = work_dir(spark, "bronze")
    daily = _daily_securities(spark, sf_dir)
    append_partitioned(rebalanced(daily, "business_date"), path, "business_date")
    bronze = spark.read.schema(daily.schema).parquet(path).select(*daily.columns)
    dates_in = sorted(r["business_date"] for r in bronze.select("business_date").distinct().collect())
    days = dates_in[-MERGED_DAYS:]

    def versions(day: str) -> DataFrame:
        rows = spark.read.schema(daily.schema).option("basePath", path)
        return scd.new_versions(rows.parquet(f"{path}/business_date={day}").select(*daily.columns))

    before = bronze.where(F.col("business_date") < days[0]) if days else bronze
    return before, [(day, versions(day)) for day in days]


def scd1_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days before the last five in one pass, then five merges."""
    before, days = _landed_securities(spark, sf_dir)
    latest = SnapshotTable(spark, work_dir(spark, "latest"))
    latest.write(scd.scd1_backfill(before, "security_id"))
    for _, today in days:
        latest.write(scd.scd1_merge(latest.read(), today, "security_id"))
    return latest.read()


def _history(spark: SparkSession) -> HistoryTable:
    return HistoryTable(
        spark, work_dir(spark, "history"), medallion.SECURITY_SCHEMA, medallion.SECURITY_KEY
    )


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days before the last five in one pass, then five merges, which read and
    write open rows only."""
    before, days = _landed_securities(spark, sf_dir)
    history = _history(spark)
    history.append_version(scd.scd2_backfill(before, "security_id"))
    for _, today in days:
        history.merge(today, "security_id")
    return history.read()


def scd2_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five days delivered out of order, and one of them first with wrong rows:
    other names, and a part of the securities under ids that its correction withdraws."""
    before, days = _landed_securities(spark, sf_dir)
    history = _history(spark)
    history.append_version(scd.scd2_backfill(before, "security_id"))
    mistaken = F.pmod(F.xxhash64("security_id"), F.lit(3)) == 0
    order = [i for i in (2, 4, 0, 2, 1, 3) if i < len(days)]
    for turn, i in enumerate(order):
        day, rows = days[i]
        if i in order[turn + 1 :]:
            rows = rows.withColumn("security_name", F.lit("wrong")).withColumn(
                "security_id",
                F.when(mistaken, F.concat(F.lit("X"), F.col("security_id"))).otherwise(F.col("security_id")),
            )
        history.splice(rows, [day])
    return history.read()


def streamed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Security files that land in three deliveries, a run of the stream after each; the
    second brings the last days, the third the days before them."""
    daily = _daily_securities(spark, sf_dir)
    landed, bookmark = work_dir(spark, "landed"), work_dir(spark, "bookmark")
    history = _history(spark)
    number = F.dayofmonth(F.to_date("business_date"))
    for delivery in (number <= 10, number > 20, (number > 10) & (number <= 20)):
        daily.where(delivery).write.mode("append").parquet(landed)
        merge_new_files(spark, landed, daily.schema, history, bookmark, scd.new_versions)
    return history.read()


def scd2_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_backfill(_daily_securities(spark, sf_dir), "security_id")


def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of the customers, read as of version 1."""
    versions = SnapshotTable(spark, work_dir(spark, "customers"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    versions.write(customer)
    versions.write(
        update_rows(
            versions.read(), F.col("c_acctbal") < 0, {"c_acctbal": F.lit(0.0)}
        )
    )
    versions.write(delete_rows(versions.read(), F.col("c_mktsegment") == "BUILDING"))
    return versions.read(1)


def dml_walkthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the customers, merged with those of the parts; all four versions."""
    versions = SnapshotTable(spark, work_dir(spark, "ids"))
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    new_ids = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    dml.walkthrough(versions, ids, new_ids)
    return versions.read_all().select("version", "id")


def index_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a constituent with its latest security."""
    events = table(spark, sf_dir, "events")
    latest = scd.scd1_backfill(_daily_securities(spark, sf_dir), "security_id")
    silver = feeds.index_feed(events, feeds.day("ts")).withColumnRenamed(
        "business_date", "effective_business_date"
    )
    return medallion.gold_rows(silver, latest)


def medallion_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole lake from landed files to gold, one delivery date after another."""
    events = table(spark, sf_dir, "events")
    lake = medallion.Lake(spark, work_dir(spark, "lake"))
    index_date = feeds.third_of_month("ts")
    security_date = feeds.first_or_last_third("ts")
    medallion.land(
        lake, "index", rebalanced(feeds.index_feed(events, index_date), "business_date")
    )
    medallion.land(
        lake, "security", rebalanced(feeds.security_feed(events, security_date), "business_date")
    )
    return medallion.replay(
        lake,
        feeds.distinct_dates(index_date, events),
        feeds.distinct_dates(security_date, events),
    )


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.page_links(table(spark, sf_dir, "pages"))


def html_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading, advertisement and footer of every page, by native expressions."""
    content = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.get(html.element_texts(content, "h1"), F.lit(0)).alias("title"),
        F.get(html.element_texts(content, "div", "ad"), F.lit(0)).alias("ad"),
        F.get(html.element_texts(content, "footer"), F.lit(0)).alias("footer"),
    )


def html_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Navigation items of every page as cards, from the parsed element tree."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    found = card_ops.select_cards(pages, ("li", None), {"label": ("a", None)})
    return found.select(
        "page_id", "card_no", "label", F.array_join("links", " ").alias("links")
    )


def html_keyword_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return links.keyword_page_links(pages, KEYWORD)


def html_keyword_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For links of the navigation whose text has the keyword: all links of the list's
    element, three elements above, from the table of elements."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    nodes = materialised(elements.element_nodes(pages, "page_id"), "elements")
    found = elements.keyword_cards(nodes, "page_id", "a", KEYWORD)
    return found.select("page_id", "title", "link")


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New ids after the stored mark, and the mark after them."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    mark = keys.HighWaterMark(spark, work_dir(spark, "last-id"))
    mark.store(LAST_SUPPLIER_ID)
    numbered = keys.number_rows(supplier, ["s_suppkey"], mark, "security_id")
    return numbered.withColumn("last_id", F.lit(mark.read()).cast("long"))


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.nest(
        table(spark, sf_dir, "orders"),
        "o_custkey",
        "o_orderkey",
        ["o_orderkey", "o_totalprice", "o_orderpriority"],
        "positions",
    )


def nest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as accounts with their orders as positions, or with none."""
    accounts = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    nest = nested.attach(
        accounts, "c_custkey", _positions(spark, sf_dir), "o_custkey", "positions"
    )
    return nest.select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("name"),
        "page",
        F.size("positions").alias("n_positions"),
        F.array_join(
            F.transform("positions", lambda p: p["o_orderkey"].cast("string")), ","
        ).alias("position_ids"),
    )


def paged_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders by date in pages of four."""
    orders = table(spark, sf_dir, "orders").withColumn("day", dates.iso_day(F.col("o_orderdate")))
    pages = nested.nest(orders, "o_custkey", "day", ["o_orderkey"], "positions", page_size=4)
    ids = F.transform("positions", lambda p: p["o_orderkey"].cast("string"))
    return pages.select(
        F.col("o_custkey").alias("account_id"), "page", F.array_join(ids, ",").alias("position_ids")
    )


def flatten_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.flatten(_positions(spark, sf_dir), "positions").select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderkey").alias("position_id"),
        F.col("o_totalprice").alias("market_value"),
        F.col("o_orderpriority").alias("exposure"),
    )


def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files that land in three deliveries, a run after each and one more."""
    events = table(spark, sf_dir, "events")
    source, target = work_dir(spark, "landed"), work_dir(spark, "events")
    bookmark = work_dir(spark, "bookmark")
    number = F.dayofmonth("ts")
    for delivery in (number <= 10, number > 20, (number > 10) & (number <= 20), None):
        if delivery is not None:
            events.where(delivery).write.mode("append").parquet(source)
        ingest_new_files(spark, source, events.schema, target, bookmark)
    return spark.read.schema(events.schema).parquet(target)


QUERIES: dict[str, Query] = {
    "fare_totals": fare_totals,
    "word_count": word_counts,
    "word_count_top10": word_count_top10,
    "index_silver": index_silver,
    "business_date_from_path": business_date_from_path,
    "dynamic_filter": dynamic_filter,
    "typed_mapping": typed_mapping,
    "resolve_choice": resolve_choice,
    "nested_choices": nested_choices,
    "silver_loads": silver_loads,
    "drop_null_columns": drop_null_columns,
    "row_update": row_update,
    "row_delete": row_delete,
    "merge_upsert": merge_upsert,
    "scd1_latest": scd1_latest,
    "scd2_history": scd2_history,
    "scd2_backfill": scd2_backfill,
    "scd2_late_files": scd2_late_files,
    "streamed_history": streamed_history,
    "time_travel": time_travel,
    "dml_walkthrough": dml_walkthrough,
    "index_gold": index_gold,
    "medallion_replay": medallion_replay,
    "page_links": page_links,
    "html_elements": html_elements,
    "html_cards": html_cards,
    "html_keyword_links": html_keyword_links,
    "html_keyword_cards": html_keyword_cards,
    "surrogate_keys": surrogate_keys,
    "nest_positions": nest_positions,
    "paged_positions": paged_positions,
    "flatten_positions": flatten_positions,
    "incremental_files": incremental_files,
}
