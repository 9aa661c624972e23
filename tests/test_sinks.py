import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sinks import catalog, files


@pytest.fixture(scope="module")
def db(spark):
    catalog.create_database(spark, "port")
    return "port"


def test_database_lifecycle(spark):
    catalog.create_database(spark, "quay")
    catalog.create_database(spark, "quay")
    catalog.create_database(spark, "quay", recreate=True)
    spark.sql("CREATE TABLE quay.t (a int) USING parquet")
    with pytest.raises(Exception, match="quay"):
        catalog.create_database(spark, "quay", recreate=True)
    spark.sql("DROP TABLE quay.t")
    catalog.create_database(spark, "quay", recreate=True)
    assert spark.catalog.databaseExists("quay")


def test_append_partitioned_and_register(spark, db, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "d1"), (2, "d2")], "a int, d string")
    files.append_partitioned(rows, path, "d")
    catalog.register_table(spark, f"{db}.parts", path)
    assert spark.table(f"{db}.parts").count() == 2
    files.append_partitioned(spark.createDataFrame([(3, "d3")], "a int, d string"), path, "d")
    catalog.register_table(spark, f"{db}.parts", path)
    assert sorted(r["d"] for r in spark.table(f"{db}.parts").collect()) == ["d1", "d2", "d3"]
    files.append_partitioned(rows, path, "d")
    assert spark.read.parquet(path).count() == 5
    for _ in range(2):
        one = spark.createDataFrame([(9, "d1")], "a int, d string")
        files.replace_partition(one, path, "d", "d1")
    assert sorted(r["a"] for r in spark.read.parquet(path).collect()) == [2, 2, 3, 9]


def test_registered_schema_keeps_dates_as_text(spark, db, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "2021-12-01")], "a int, d string")
    files.append_partitioned(rows, path, "d")
    catalog.register_table(spark, f"{db}.inferred", path)
    catalog.register_table(spark, f"{db}.declared", path, rows.schema, "d")
    assert spark.table(f"{db}.inferred").dtypes == [("a", "int"), ("d", "date")]
    assert spark.table(f"{db}.declared").dtypes == [("a", "int"), ("d", "string")]
    assert spark.table(f"{db}.declared").where("d = '2021-12-01'").count() == 1


def test_rebalanced_keeps_all_rows(spark, tmp_path):
    df = spark.range(1000).withColumn("d", F.when(F.col("id") < 600, "hot").otherwise("cold"))
    files.append_partitioned(files.rebalanced(df, "d"), str(tmp_path / "t"), "d")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_overwrite_append_and_tsv(spark, tmp_path):
    path = str(tmp_path / "p")
    files.overwrite_parquet(spark.range(3), path)
    files.overwrite_parquet(spark.range(2), path)
    files.append_parquet(spark.range(2), path)
    assert spark.read.parquet(path).count() == 4
    links = spark.createDataFrame([("u", "v")], "source_url string, parsed_url string")
    tsv = str(tmp_path / "links")
    files.append_tsv(links, tsv)
    files.append_tsv(links, tsv)
    parts = [p.read_text() for p in (tmp_path / "links").glob("part-*")]
    header = "source_url\tparsed_url\n"
    assert all(p.startswith(header) for p in parts)
    assert "".join(p.removeprefix(header) for p in parts) == "u\tv\n" * 2


def test_insert_by_position_with_casts(spark, db, tmp_path):
    name = f"{db}.gold"
    catalog.create_table(
        spark, name, "a string, d string, w float", str(tmp_path / "gold"), partitioned_by="d"
    )
    catalog.create_table(
        spark, name, "a string, d string, w float", str(tmp_path / "gold"), partitioned_by="d"
    )
    source = spark.createDataFrame([("x", "2021-12-01", "0.5")], "p string, q string, r string")
    catalog.insert_into(source, name, ["a", "d", "w"])
    catalog.insert_into(source, name, ["a", "d", "w"])
    got = spark.table(name)
    assert dict(got.dtypes) == {"a": "string", "w": "float", "d": "string"}
    assert [tuple(r) for r in got.select("a", "d", "w").collect()] == [("x", "2021-12-01", 0.5)] * 2
    with pytest.raises(ValueError):
        catalog.insert_into(source.select("p"), name)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        catalog.insert_into(source.withColumn("r", F.lit("much")), name, ["a", "d", "w"])


def test_in_schema(spark):
    schema = T.StructType([T.StructField("a", T.FloatType()), T.StructField("b", T.StringType())])
    got = catalog.in_schema(spark.createDataFrame([("1.5", 2)], "x string, y int"), schema)
    assert got.schema == schema
    assert tuple(got.first()) == (1.5, "2")


def test_discover(spark, db, tmp_path):
    spark.range(3).withColumn("d", F.lit("x")).write.partitionBy("d").parquet(str(tmp_path / "p"))
    assert catalog.discover(spark, str(tmp_path / "p"), f"{db}.found").count() == 3
    assert set(spark.table(f"{db}.found").columns) == {"id", "d"}
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("n,t\n1,x\n2,y\n")
    found = catalog.discover(spark, str(tmp_path / "c"), f"{db}.found", "csv")
    assert found.dtypes == [("n", "int"), ("t", "string")]
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3


def test_load_table(spark, db):
    name = f"{db}.warehouse"
    catalog.load_table(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    catalog.load_table(spark.createDataFrame([("b", 2)], "v string, k int"), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (2, "b")]
    catalog.load_table(spark.createDataFrame([(3, "c")], "k int, v string"), name, truncate=True)
    assert [tuple(r) for r in spark.table(name).collect()] == [(3, "c")]


def ids(df):
    return sorted(r["a"] for r in df.collect())


def test_a_replacement_that_breaks_off_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old, new = (spark.createDataFrame([(a, "d1")], "a int, d string") for a in (1, 2))
    files.append_partitioned(old, path, "d")
    moves = []

    def failing(fs, source, target):
        moves.append(str(target))
        if len(moves) == 2:
            raise OSError("no space")
        assert fs.rename(source, target)

    with monkeypatch.context() as m:
        m.setattr(files, "_move", failing)
        with pytest.raises(OSError, match="no space"):
            files.replace_partition(new, path, "d", "d1")
    assert ids(spark.read.parquet(path)) == [1]

    # The driver is lost between the moves: nothing is put back, the rows are aside.
    def lost(fs, source, target):
        if "/.new-" in str(source):
            raise KeyboardInterrupt
        assert fs.rename(source, target)

    with monkeypatch.context() as m:
        m.setattr(files, "_move", lost)
        with pytest.raises(KeyboardInterrupt):
            files.replace_partition(new, path, "d", "d1")
    files.recover_partitions(spark, path)
    assert ids(spark.read.parquet(path)) == [1]
    files.replace_partition(new, path, "d", "d1")
    assert ids(spark.read.parquet(path)) == [2]
    assert not [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith((".old", ".new"))]


def test_table_replacement_is_one_change_of_the_catalog(spark, db, tmp_path, monkeypatch):
    name = f"{db}.goods"
    schema = T.StructType().add("a", T.IntegerType()).add("b", T.StringType())
    spark.createDataFrame([(1, "x"), (2, "y")], schema).write.parquet(str(tmp_path / "goods"))
    catalog.register_table(spark, name, str(tmp_path / "goods"), schema)
    new = spark.createDataFrame([("z", 3)], "b string, a int")
    with monkeypatch.context() as m:
        m.setattr(catalog, "_switch", lambda *a: (_ for _ in ()).throw(OSError("catalog away")))
        with pytest.raises(OSError, match="catalog away"):
            catalog.replace_rows(new, name)
    assert ids(spark.table(name)) == [1, 2]
    catalog.replace_rows(new, name)
    assert ids(spark.newSession().table(name)) == [3]
    # It may read what it replaces.
    catalog.load_table(spark.table(name).withColumn("a", F.col("a") + 1), name, truncate=True)
    assert ids(spark.table(name)) == [4]
    catalog.load_table(spark.createDataFrame([(9, "q")], schema), name)
    assert ids(spark.table(name)) == [4, 9]
    with pytest.raises(ValueError, match="partitioned"):
        files.append_partitioned(spark.createDataFrame([(1, "d")], "a int, d string"), str(tmp_path / "p"), "d")
        catalog.register_table(spark, f"{db}.split", str(tmp_path / "p"))
        catalog.replace_rows(new, f"{db}.split")
