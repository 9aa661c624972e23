"""Three days of files through all layers, against tables worked out by hand."""

import pytest

from tidewater.plans import medallion
from tidewater.plans.medallion import Lake
from tidewater.sinks import catalog
from tidewater.sinks.catalog import create_database

# The daily files, each without a final line end.
FILES = {
    "index_20211201.csv": """index_name,constituent_id,ticker,figi,index_weight,market_cap,business_date
S&P500,C1,AAPL,BBG1111,0.02,2.01,2021-12-01
S&P500,C2,GOOGL,BBG2222,0.05,1.96,2021-12-01
S&P500,C3,ZURN,BBG3333,0.01,0.23,2021-12-01
S&P500,C4,GSK,BBG4444,0.02,0.67,2021-12-01""",
    "index_20211202.csv": """index_name,constituent_id,ticker,figi,index_weight,market_cap,business_date
S&P500,C1,AAPL,BBG1111,0.02,2.01,2021-12-02
S&P500,C2,GOOGL,BBG2222,0.05,1.96,2021-12-02
S&P500,C3,ZURN,BBG3333,0.01,0.23,2021-12-02
S&P500,C4,GSK,BBG4444,0.02,0.67,2021-12-02
MSCI,C5,MSFT,BBG5555,0.02,1.1,2021-12-02
MSCI,C6,SNOW,,0.03,0.07,2021-12-02""",
    "index_20211204.csv": """index_name,constituent_id,ticker,figi,index_weight,market_cap,business_date
S&P500,C1,AAPL,BBG1111,0.02,2.01,2021-12-04
S&P500,C2,GOOGL,BBG2222,0.05,1.96,2021-12-04
S&P500,C4,GSK,BBG4444,0.02,0.67,2021-12-04
MSCI,C5,MSFT,BBG5555,0.02,1.1,2021-12-04
MSCI,C6,SNOW,BBG6666,0.03,0.07,2021-12-04""",
    "security_20211201.csv": """security_id,security_name,id_bb_global,cusip,business_date
S1,Apple,BBG1111,123W456,2021-12-01
S2,Alphabet,BBG2222,222B341,2021-12-01
S3,Zurich Insurance Group,BBG3333,35G2330,2021-12-01
S4,GlaxoSmithKline,BBG4444,,2021-12-01
S5,Microsoft,BBG5555,B112NU9,2021-12-01
S6,Sprott Uranium Trust,,5P6L679,2021-12-01""",
    "security_20211204.csv": """security_id,security_name,id_bb_global,cusip,business_date
S4,GlaxoSmithKline,BBG4444,AB22333,2021-12-04
S6,Sprott Uranium Trust,BBG6666,5P6L679,2021-12-04
S6,Snowflake,BBG7777,0C064K3,2021-12-04""",
}

HISTORY = """
S1|Apple|BBG1111|123W456|2021-12-01|9999-12-31|True
S2|Alphabet|BBG2222|222B341|2021-12-01|9999-12-31|True
S3|Zurich Insurance Group|BBG3333|35G2330|2021-12-01|9999-12-31|True
S4|GlaxoSmithKline|BBG4444|None|2021-12-01|2021-12-04|False
S4|GlaxoSmithKline|BBG4444|AB22333|2021-12-04|9999-12-31|True
S5|Microsoft|BBG5555|B112NU9|2021-12-01|9999-12-31|True
S6|Snowflake|BBG7777|0C064K3|2021-12-04|9999-12-31|True
S6|Sprott Uranium Trust|BBG6666|5P6L679|2021-12-04|9999-12-31|True
""".split("\n")[1:-1]

GOLD = """
2021-12-01 C1 S1 123W456
2021-12-01 C2 S2 222B341
2021-12-01 C3 S3 35G2330
2021-12-01 C4 S4 None
2021-12-02 C1 S1 123W456
2021-12-02 C2 S2 222B341
2021-12-02 C3 S3 35G2330
2021-12-02 C4 S4 None
2021-12-02 C5 S5 B112NU9
2021-12-02 C6 None None
2021-12-04 C1 S1 123W456
2021-12-04 C2 S2 222B341
2021-12-04 C4 S4 AB22333
2021-12-04 C5 S5 B112NU9
2021-12-04 C6 S6 5P6L679
""".split("\n")[1:-1]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    for name, text in FILES.items():
        (folder / name).write_text(text)
    return folder


def load_three_days(lake, files):
    for day in ("20211201", "20211202", "20211204"):
        date = medallion.ingest_index_file(lake, f"{files}/index_{day}.csv")
        if f"security_{day}.csv" in FILES:
            medallion.ingest_security_file(lake, f"{files}/security_{day}.csv")
        medallion.gold(lake, date)


@pytest.fixture(scope="module")
def lake(spark, files, tmp_path_factory):
    create_database(spark, "harbour")
    loaded = Lake(spark, str(tmp_path_factory.mktemp("lake")), database="harbour")
    load_three_days(loaded, files)
    return loaded


def lines(df):
    return sorted("|".join(str(v) for v in row) for row in df.collect())


def gold_lines(df):
    ordered = medallion.in_report_order(df)
    columns = ["effective_business_date", "constituent_id", "security_id", "cusip"]
    return [" ".join(map(str, r)) for r in ordered.select(columns).collect()]


def test_history(lake):
    assert lines(lake.history.read()) == sorted(HISTORY)


def test_latest_is_the_open_history(lake):
    assert lines(lake.latest) == sorted(h for h in HISTORY if h.endswith("True"))


def test_gold(lake):
    gold = medallion.read_gold(lake)
    assert gold.schema == medallion.GOLD_SCHEMA
    assert gold_lines(gold) == GOLD
    first = gold.where("constituent_id = 'C1'").first()
    assert first["index_weight"] == pytest.approx(0.02, rel=1e-6)
    assert first["market_cap"] == pytest.approx(2.01, rel=1e-6)


def test_replay_of_landed_rows_gives_the_same_gold(spark, lake, tmp_path):
    again = Lake(spark, str(tmp_path))
    for domain in ("index", "security"):
        rows = spark.table(f"harbour.{domain}_bronze")
        medallion.land(again, domain, rows.select(*medallion.BRONZE_SCHEMAS[domain].names))
    dates = ["2021-12-01", "2021-12-02", "2021-12-04"]
    gold = medallion.replay(again, dates, [dates[0], dates[2]])
    assert gold_lines(gold) == GOLD
    assert lines(again.history.read()) == sorted(HISTORY)


def test_tables_are_registered(spark, lake):
    gold = spark.sql(
        "SELECT * FROM harbour.index_security ORDER BY effective_business_date, constituent_id"
    )
    assert gold_lines(gold) == GOLD
    assert spark.table("harbour.index_bronze").count() == 15
    assert spark.table("harbour.index_silver").count() == 15
    assert dict(gold.dtypes)["effective_business_date"] == "string"
    assert spark.table("harbour.security_bronze").count() == 9
    # Of every session of the catalog, not of the one that loaded.
    other = spark.newSession()
    assert lines(other.table("harbour.security_history_silver")) == sorted(HISTORY)
    assert other.table("harbour.security_latest_silver").count() == 7
    assert other.table("harbour.security_latest_silver").schema.names == medallion.SECURITY_SCHEMA.names


def test_history_time_travel(lake):
    first_day = lake.history.read(0)
    assert first_day.count() == 5
    assert first_day.where("NOT latest").count() == 0
    assert lake.history.open_rows().count() == 7


def test_row_dated_otherwise_than_its_file_stays_in_bronze(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    text = FILES["index_20211201.csv"].replace("0.67,2021-12-01", "0.67,2021-11-30")
    (tmp_path / "index_20211201.csv").write_text(text)
    medallion.ingest_index_file(lake, str(tmp_path / "index_20211201.csv"))
    assert spark.read.parquet(lake.path("index", "bronze")).count() == 4
    assert spark.read.parquet(lake.path("index", "silver")).count() == 3


def test_second_load_adds_rows_and_fails_on_securities(spark, files, tmp_path):
    lake = Lake(spark, str(tmp_path))
    medallion.ingest_index_file(lake, f"{files}/index_20211201.csv")
    medallion.ingest_index_file(lake, f"{files}/index_20211201.csv")
    # The second run reads both copies from bronze.
    assert spark.read.parquet(lake.path("index", "silver")).count() == 4 + 8
    medallion.ingest_security_file(lake, f"{files}/security_20211201.csv")
    with pytest.raises(Exception, match="several source rows"):
        medallion.ingest_security_file(lake, f"{files}/security_20211201.csv")
    assert lake.history.snapshots.versions() == [0]


def test_safe_rerun_changes_nothing(spark, files, tmp_path):
    lake = Lake(spark, str(tmp_path), safe_rerun=True)
    load_three_days(lake, files)
    medallion.ingest_index_file(lake, f"{files}/index_20211204.csv")
    medallion.gold(lake, "2021-12-04")
    assert gold_lines(medallion.read_gold(lake)) == GOLD
    before = lines(lake.history.read())
    assert before == sorted(HISTORY)


def test_safe_rerun_replaces_only_the_file_itself(spark, files, tmp_path):
    """A file with a stray row of another day must not touch that day's file."""
    create_database(spark, "bay")
    lake = Lake(spark, str(tmp_path / "lake"), database="bay", safe_rerun=True)
    medallion.ingest_index_file(lake, f"{files}/index_20211201.csv")
    stray = FILES["index_20211202.csv"] + "\nMSCI,C9,X,BBG9,0.1,0.1,2021-12-01"
    (tmp_path / "index_20211202.csv").write_text(stray)
    for _ in range(2):
        medallion.ingest_index_file(lake, str(tmp_path / "index_20211202.csv"))
    assert spark.read.parquet(lake.path("index", "bronze")).count() == 4 + 7
    by_file = spark.table("bay.index_bronze").groupBy("file_date", "business_date").count()
    assert sorted(map(tuple, by_file.collect())) == [
        ("2021-12-01", "2021-12-01", 4),
        ("2021-12-02", "2021-12-01", 1),
        ("2021-12-02", "2021-12-02", 6),
    ]
    silver = spark.read.parquet(lake.path("index", "silver"))
    assert sorted(map(tuple, silver.groupBy("effective_business_date").count().selectExpr(
        "cast(effective_business_date as string)", "count").collect())) == [
        ("2021-12-01", 4), ("2021-12-02", 6)
    ]


def test_safe_rerun_of_a_security_date(spark, files, tmp_path):
    lake = Lake(spark, str(tmp_path), safe_rerun=True)
    medallion.ingest_security_file(lake, f"{files}/security_20211201.csv")
    before = lines(lake.history.read())
    medallion.ingest_security_file(lake, f"{files}/security_20211201.csv")
    assert lines(lake.history.read()) == before
    assert lines(lake.latest) == before


def test_lookup_repeats_a_constituent_per_security_with_its_id(spark):
    silver = spark.createDataFrame(
        [("I", "C1", "T", "B1", "0.5", "1", "2021-12-01")],
        "index_name string, constituent_id string, ticker string, figi string, "
        "index_weight string, market_cap string, effective_business_date string",
    )
    latest = spark.createDataFrame(
        [("S1", "n", "B1", "c1", "2021-12-01", "9999-12-31", True),
         ("S2", "n", "B1", "c2", "2021-12-01", "9999-12-31", True)],
        medallion.SECURITY_SCHEMA,
    )
    rows = medallion.gold_rows(silver, latest).select("security_id").collect()
    assert sorted(r[0] for r in rows) == ["S1", "S2"]


def test_gold_rejects_a_weight_that_is_no_number(spark):
    silver = spark.createDataFrame(
        [("I", "C1", "T", None, "heavy", "1", "2021-12-01")],
        "index_name string, constituent_id string, ticker string, figi string, "
        "index_weight string, market_cap string, effective_business_date string",
    )
    latest = spark.createDataFrame([], medallion.SECURITY_SCHEMA)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        medallion.gold_rows(silver, latest).collect()


def test_day_without_identified_securities(spark, files, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(ValueError, match="no committed version"):
        lake.latest  # noqa: B018
    (tmp_path / "security_20211130.csv").write_text(
        ",".join(medallion.SECURITY_COLUMNS) + "\nS1,Apple,,123W456,2021-11-30"
    )
    medallion.ingest_security_file(lake, str(tmp_path / "security_20211130.csv"))
    assert lake.latest.count() == 0 and lake.history.read().count() == 0
    medallion.ingest_security_file(lake, f"{files}/security_20211201.csv")
    assert lake.latest.count() == 5


def test_late_and_corrected_security_files(spark, files, tmp_path):
    """Files in any order, one of them first with a wrong and a surplus row."""
    create_database(spark, "cove")
    lake = Lake(spark, str(tmp_path / "lake"), database="cove", safe_rerun=True)
    wrong = FILES["security_20211204.csv"].replace("AB22333", "WRONG") + "\nS9,Gone,BBG9,C9,2021-12-04"
    (tmp_path / "security_20211204.csv").write_text(wrong)
    medallion.ingest_security_file(lake, str(tmp_path / "security_20211204.csv"))
    assert "S9" in {r["security_id"] for r in lake.latest.collect()}
    medallion.ingest_security_file(lake, f"{files}/security_20211201.csv")
    medallion.ingest_security_file(lake, f"{files}/security_20211204.csv")
    assert lines(lake.history.read()) == sorted(HISTORY)
    other = spark.newSession()
    assert lines(other.table("cove.security_history_silver")) == sorted(HISTORY)
    assert lines(other.table("cove.security_latest_silver")) == lines(lake.latest)


def test_a_daily_run_reads_and_registers_one_folder(spark, files, tmp_path, monkeypatch):
    create_database(spark, "reef")
    lake = Lake(spark, str(tmp_path / "lake"), database="reef")
    load_three_days(lake, files)
    repaired = []
    monkeypatch.setattr(catalog, "refresh", lambda *a: repaired.append(a))
    medallion.land(lake, "index", spark.createDataFrame(
        [("I", "C", "T", "F", "1", "1", "2021-12-07")], medallion.BRONZE_SCHEMAS["index"]
    ))
    rows = medallion._bronze(lake, "index", "2021-12-07")
    assert {f.split("/")[-2] for f in rows.inputFiles()} == {"business_date=2021-12-07"}
    medallion.index_silver(lake, "2021-12-07")
    assert repaired == []
    assert spark.table("reef.index_silver").where("effective_business_date = '2021-12-07'").count() == 1
    # A date without rows has no folder, and is read as no rows.
    medallion.index_silver(lake, "2021-12-08")
    medallion.gold(lake, "2021-12-08")
    assert spark.table("reef.index_silver").where("effective_business_date = '2021-12-08'").count() == 0
