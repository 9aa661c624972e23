import random

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import token_files
from tidewater.llm.common import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def encoded(encoder, texts):
    ids, counts = encoder.encode([t.encode() for t in texts])
    ends = np.cumsum(counts)
    return [ids[b - n : b].tolist() for n, b in zip(counts, ends)]


def test_every_character_before_punctuation():
    """A letter that the rules turn into a letter and a mark joins the punctuation."""
    encoder = token_files.WordEncoder(PATH)
    points = [c for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 40_000):
        part = [chr(c) for c in points[start : start + 40_000]]
        texts = [f"a{c}." for c in part] + [f"{c}!" for c in part]
        wrong = [t for t, a, b in zip(texts, encoded(encoder, texts), library(texts)) if a != b]
        assert wrong == []


def test_random_texts_equal_the_library(monkeypatch):
    pick = random.Random(2)
    letters = "abYZ é İ ß ǅ 漢 1٣½ .,!?:;'\"<|>-_ ़̇क़\t\n\r\x0b\x0c\x85  🙂 ﬁ"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randint(0, 40))) for _ in range(3_000)]
    texts += ["", "   ", "GAZİ! BELEDİYESİ. İ", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>.", "don't we'll I'M x's. 's", "a" * 5_000 + "!"]
    for kept in (150_000, 20):
        monkeypatch.setattr(token_files, "WORDS_KEPT", kept)
        encoder = token_files.WordEncoder(PATH)
        for at in range(0, len(texts), 700):
            part = texts[at : at + 700]
            assert encoded(encoder, part) == library(part)
    assert encoded(token_files.WordEncoder(PATH), ["", " "]) == [[], []]


def test_text_ids_repeated_rows_and_no_rows(spark, tmp_path):
    rows = [("b", "one two"), ("a", "x."), ("a", "x."), (None, None), ("a", "y")] * 3
    docs = spark.createDataFrame(rows, "doc_id string, text string").withColumn("part", F.lit("own"))
    token_files.write_token_files(docs.repartition(4), str(tmp_path / "t"), PATH)
    out = sorted(token_files.read_token_files(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == [None] * 3 + ["a"] * 9 + ["b"] * 3
    start, wanted = 0, sorted(map(str, library(["x.", "y"] * 3 + ["x."] * 3)))
    for r in out:
        assert r.start == start and r.ids[-1] == 1 and len(r.ids) == r.n_tokens
        start += r.n_tokens
    assert sorted(str(r.ids[:-1]) for r in out if r.doc_id == "a") == wanted
    token_files.write_token_files(docs.limit(0), str(tmp_path / "none"), PATH)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).collect() == []


def test_one_id_is_spread_over_tasks(spark, tmp_path):
    docs = spark.range(4_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    # Small partitions would be merged.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_token_files(docs, str(tmp_path / "t"), PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in spark.read.orc(str(tmp_path / "t")).groupBy("part").count().collect()]
    assert sum(sizes) == 4_000 and max(sizes) < 2_000


def rows_scanned(df):
    """Rows that the scan of a collected frame gave to the plan above it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_readers_leave_out_row_groups_by_range_and_bloom_filter(spark, tmp_path):
    """Ids are even, so that an odd one lies in the range of a row group but not in its filter."""
    docs = spark.range(20_000).select((F.col("id") * 2).alias("doc_id"), F.lit("a few words").alias("text"))
    token_files.write_token_files(docs, str(tmp_path / "t"), PATH)
    with_one = token_files.documents_in(spark, str(tmp_path / "t"), [10_000])
    assert 1 <= rows_scanned(with_one) <= 1_000
    assert with_one.first().ids == library(["a few words"])[0] + [1]
    odd = [rows_scanned(token_files.documents_in(spark, str(tmp_path / "t"), [x])) for x in range(9_001, 9_401, 20)]
    assert sum(n == 0 for n in odd) >= 18
