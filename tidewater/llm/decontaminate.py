"""Benchmark items in documents: SimHash of item-sized windows, then exact similarity.

Only DataFrame functions. Windows are made where a text shares enough shingles with the
items of a size to reach SIMILARITY at all, and their fingerprints come from running sums
over the text. Fingerprints are cut into BLOCKS runs of bits. Two that differ in RADIUS
bits or less differ in FLIPS or less in one of the runs, so items are looked up under all
values of their runs with that many bits flipped. What meets within the radius is compared
shingle by shingle.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import columns_of_row, row_of, table, written

SHINGLE = 5
SIMILARITY = 0.8
# Fingerprints have 64 bits. A window of SIMILARITY differs from its item in few words.
RADIUS = 15
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
FLIPS = RADIUS // BLOCKS
# Rows of a few numbers that may be sent to every executor.
BROADCAST_ROWS = 500_000


def words_of(text: str) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _if_small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _shingles(words: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words, in order; none for fewer words."""
    return F.when(
        F.size(words) >= width,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (width - 1)),
            lambda i: F.xxhash64(*[F.element_at(words, (i + k).cast("int")) for k in range(width)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _counters(h: str) -> list[Column]:
    """The 64 bits of a hash as counters of 32 bits, two to a number."""
    bit = lambda k: F.shiftrightunsigned(h, k).bitwiseAND(F.lit(1))
    return [bit(2 * k).bitwiseOR(F.shiftleft(bit(2 * k + 1), 32)) for k in range(32)]


def _fingerprint(sums: list[Column], n: Column) -> Column:
    """The bits that more than half of ``n`` hashes have, from the sums of their counters."""
    bits = F.lit(0).cast("long")
    for k, total in enumerate(sums):
        for b in range(2):
            count = F.shiftrightunsigned(total, 32 * b).bitwiseAND(F.lit(0xFFFFFFFF))
            one = F.shiftleft(F.lit(1).cast("long"), 2 * k + b)
            bits = bits.bitwiseOR(F.when(2 * count > n, one).otherwise(F.lit(0).cast("long")))
    return bits


def fingerprints(spans: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` with ``fingerprint``, the SimHash of the array ``words`` of each row.

    A bit is set if more than half of the words' hashes have it.
    """
    hashed = spans.select(*keys, F.explode("words").alias("word")).select(*keys, F.xxhash64("word").alias("h"))
    sums = hashed.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.sum(c).alias(f"s{k}") for k, c in enumerate(_counters("h"))]
    )
    return sums.select(*keys, _fingerprint([F.col(f"s{k}") for k in range(32)], F.col("n")).alias("fingerprint"))


def _starts(size: Column, block: Column, words: Column) -> tuple[Column, Column]:
    """The first and last window of a block; the last ones of a text may be shorter, but
    for the fewer words a window needs to be similar to an item of ``size`` words."""
    last = F.greatest(words - F.ceil(F.lit(SIMILARITY) * size).cast("int"), F.lit(0))
    return block * size, F.least((block + 1) * size - 1, last)


def window_fingerprints(texts: DataFrame, blocks: DataFrame) -> DataFrame:
    """key, size, start and fingerprint of the windows of ``size`` words that start in ``blocks``.

    ``texts`` has key and words, ``blocks`` key, size and block: the words from block *
    size on, as many as the size. A word is read once for each block whose windows reach
    it, at most two; a window's counters are the running sums up to its end less those
    up to its start.
    """
    size, block, words = F.col("size"), F.col("block"), F.col("n_words")
    first, last = _starts(size, block, words)
    part = texts.join(blocks.select("key", "size", "block"), "key").select(
        "key", "size", "block", F.size("words").alias("n_words"),
        F.posexplode(F.slice("words", block * size + 1, 2 * size)).alias("i", "word"),
    )
    hashed = part.select(
        "key", "size", "block", "n_words", (first + F.col("i")).cast("int").alias("at"), F.xxhash64("word").alias("h")
    )
    region = ["key", "size", "block"]
    upto = Window.partitionBy(*region).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = hashed.select(*region, "n_words", "at", *[F.sum(c).over(upto).alias(f"s{k}") for k, c in enumerate(_counters("h"))])
    at, none = F.col("at"), F.array().cast("array<int>")
    begins = F.when((at + 1 > first) & (at + 1 <= last), F.array(at + 1)).otherwise(none)
    whole = at - size + 1
    # All windows that the end of the text cuts short end with its last word.
    ends = (
        F.when((at == words - 1) & (F.greatest(whole, first) <= last), F.sequence(F.greatest(whole, first), last))
        .when((at < words - 1) & (whole >= first) & (whole <= last), F.array(whole))
        .otherwise(none)
    )
    signed = lambda starts, sign: F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(sign).alias("sign")))
    marks = running.select("*", F.explode(F.concat(signed(ends, 1), signed(begins, -1))).alias("mark")).select(
        "*", F.col("mark.start").alias("start"), F.col("mark.sign").alias("sign")
    )
    sums = marks.groupBy(*region, "start").agg(
        F.first("n_words").alias("n_words"), *[F.sum(F.col(f"s{k}") * F.col("sign")).alias(f"s{k}") for k in range(32)]
    )
    n = F.least(size, words - F.col("start"))
    return sums.select(
        "key", "size", "start", _fingerprint([F.col(f"s{k}") for k in range(32)], n).alias("fingerprint")
    )


def _runs(fingerprint: str) -> list[Column]:
    """The BLOCKS runs of bits of a fingerprint."""
    mask = F.lit((1 << BLOCK_BITS) - 1)
    return [F.shiftrightunsigned(fingerprint, BLOCK_BITS * k).bitwiseAND(mask).cast("int") for k in range(BLOCKS)]


def blocks(fingerprint: str) -> Column:
    """The runs as (block, bits)."""
    return F.posexplode(F.array(*_runs(fingerprint))).alias("block", "bits")


def probes(fingerprint: str) -> Column:
    """The runs as (block, bits) with up to FLIPS bits flipped."""
    flips = [sum(1 << b for b in some) for n in range(FLIPS + 1) for some in combinations(range(BLOCK_BITS), n)]
    near = lambda run: F.transform(F.array(*[F.lit(x) for x in flips]), lambda x: x.bitwiseXOR(run))
    runs = F.array(*[F.struct(F.lit(k).alias("block"), near(run).alias("near")) for k, run in enumerate(_runs(fingerprint))])
    return F.explode(F.flatten(F.transform(runs, lambda r: F.transform(r["near"], lambda x: F.struct(r["block"].alias("block"), x.alias("bits"))))))


def item_table(benchmark: DataFrame) -> DataFrame:
    """item, item_id, words, size and width (words of a shingle) of the items that have words.

    ``item`` stands for the id, which may be null, and the words: rows that repeat an id
    with other words are items of their own.
    """
    words = benchmark.select("item_id", words_of("text").alias("words")).withColumn("size", F.size("words"))
    named = F.to_json(F.struct(F.col("item_id").cast("string").alias("id"), F.array_join("words", " ").alias("words")))
    return (
        words.where("size > 0")
        .select(F.unhex(F.md5(named.cast("binary"))).alias("item"), "item_id", "words", "size", F.least("size", F.lit(SHINGLE)).alias("width"))
        .dropDuplicates(["item"])
    )


def _similar_regions(texts: DataFrame, shingles: DataFrame, widths: list[int], rows: int) -> DataFrame:
    """key, size and block where windows share enough shingles with the items of a size."""
    near = None
    for width in widths:
        sizes = shingles.where(F.col("width") == width).groupBy("shingle").agg(F.collect_set("size").alias("sizes"))
        places = texts.select("key", F.posexplode(_shingles(F.col("words"), width)).alias("at", "shingle"))
        shared = (
            places.join(_if_small(sizes, rows), "shingle")
            .select("key", "at", F.explode("sizes").alias("size"))
            .groupBy("key", "size", F.floor(F.col("at") / F.col("size")).cast("int").alias("block"))
            .agg(F.count_distinct("at").alias("n"))
            .withColumn("width", F.lit(width))
        )
        near = shared if near is None else near.unionByName(shared)
    near = written(near, "leak-places")
    # A window starting in a block reaches into the next one; both together must share
    # as many shingles as the similarity takes.
    starts = (
        near.unionByName(near.withColumn("block", F.col("block") - 1))
        .groupBy("key", "size", "width", "block")
        .agg(F.sum("n").alias("n"))
        .where((F.col("block") >= 0) & (F.col("n") >= F.lit(SIMILARITY) * (F.col("size") - F.col("width") + 1)))
    )
    return written(starts.select("key", "size", "block"), "leak-blocks")


def _within_radius(windows: DataFrame, prints: DataFrame, n_items: int) -> DataFrame:
    """key, size, start and item of the ``windows`` within RADIUS bits of an item's print."""
    probed = prints.select("item", "size", F.col("fingerprint").alias("wanted"), probes("fingerprint").alias("probe")).select(
        "item", "size", "wanted", "probe.block", "probe.bits"
    )
    n_probes = n_items * BLOCKS * sum(1 for n in range(FLIPS + 1) for _ in combinations(range(BLOCK_BITS), n))
    # Equal windows, of copies of a passage, are looked up once.
    distinct = windows.select("size", "fingerprint").distinct()
    pairs = (
        distinct.select("size", "fingerprint", blocks("fingerprint"))
        .join(_if_small(probed, n_probes), ["size", "block", "bits"])
        .where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("wanted"))) <= RADIUS)
        .select("size", "fingerprint", "item")
        .distinct()
    )
    pairs = written(pairs, "leak-pairs")
    return windows.join(_if_small(pairs, pairs.count()), ["size", "fingerprint"]).select("key", "size", "start", "item")


def _shared(texts: DataFrame, met: DataFrame, shingles: DataFrame, widths: list[int], n_shingles: int) -> DataFrame:
    """key, item, size, start, n (shingles of the window) and both (those it shares with
    the item, repeats counted) of the windows ``met`` that share any.

    A text's shingles are dealt out once for each block of windows met in it. Windows are
    cut from them afterwards and counted where they lie, so that their shingles, many
    times the text, are never shuffled.
    """
    region = ["key", "size", "block"]
    met = met.withColumn("block", F.floor(F.col("start") / F.col("size")).cast("int"))
    regions = written(met.select(*region).distinct(), "leak-regions")
    size, first = F.col("size"), F.col("block") * F.col("size")
    part = texts.join(_if_small(regions, regions.count()), "key").select(
        *region, F.slice("words", first + 1, 2 * size).alias("words")
    )
    pieces = None
    for width in widths:
        some = part.where(F.least(size, F.lit(SHINGLE)) == width).select(*region, _shingles(F.col("words"), width).alias("pieces"))
        pieces = some if pieces is None else pieces.unionByName(some)
    # Dealt out whichever join follows: its rows, cut and counted, stay where they are.
    pieces = pieces.repartition(*region)
    own = F.slice("pieces", F.col("start") - first + 1, size - F.least(size, F.lit(SHINGLE)) + 1)
    counted = (
        pieces.join(met, region)
        .select(*region, "item", "start", own.alias("own"))
        .select(*region, "item", "start", F.size("own").alias("n"), F.explode("own").alias("shingle"))
        .groupBy(*region, "item", "start", "n", "shingle")
        .agg(F.count("*").alias("times"))
    )
    of_items = shingles.groupBy("item", "size", "shingle").agg(F.count("*").alias("m"))
    return (
        counted.join(_if_small(of_items, n_shingles), ["item", "size", "shingle"])
        .groupBy(*region, "item", "start", "n")
        .agg(F.sum(F.least("times", "m")).alias("both"))
        .drop("block")
    )


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """key (of the text), item_id, start (word, from 0) and similarity of the best window.

    One row for each text of ``documents`` (text) and item of ``benchmark`` (item_id,
    text) of which a window, as many words as the item has, or fewer where the text
    ends, has a weighted Jaccard similarity of SIMILARITY or more in runs of SHINGLE
    words (items of fewer words: their whole). Null and wordless texts and items have no
    leaks. Equal texts are searched once, equal rows of ``benchmark`` are one item; rows
    with one item_id, or none, and different words are items of their own. Of equally
    similar windows the first counts. No documents or items: no rows.
    """
    spark = documents.sparkSession
    items = written(item_table(benchmark), "leak-items")
    n_items = items.count()
    schema = T.StructType().add("key", T.BinaryType()).add("item_id", benchmark.schema["item_id"].dataType)
    schema = schema.add("start", T.IntegerType()).add("similarity", T.DoubleType())
    if not n_items:
        return spark.createDataFrame([], schema)
    widths = [r.width for r in items.select("width").distinct().collect()]  # at most SHINGLE
    texts = documents.select(text_key().alias("key"), words_of("text").alias("words"))
    shingles = None
    for width in widths:
        some = items.where(F.col("width") == width).select(
            "item", "size", "width", F.explode(_shingles(F.col("words"), width)).alias("shingle")
        )
        shingles = some if shingles is None else shingles.unionByName(some)
    shingles = written(shingles, "leak-shingles")
    n_shingles = shingles.count()

    regions = _similar_regions(texts, shingles, widths, n_shingles)
    wanted = written(regions.select("key").distinct(), "leak-keys")
    near = texts.join(_if_small(wanted, wanted.count()), "key", "left_semi")
    # Copies of a text are combined before the shuffle.
    near = written(near.groupBy("key").agg(F.first("words").alias("words")), "leak-texts")
    windows = written(window_fingerprints(near, regions), "leak-windows")
    met = written(_within_radius(windows, fingerprints(items, ["item", "size"]), n_items), "leak-candidates")

    both = _shared(near, met, shingles, widths, n_shingles)
    of_item = F.col("size") - F.least("size", F.lit(SHINGLE)) + 1
    best = (
        both.withColumn("similarity", F.col("both") / (F.col("n") + of_item - F.col("both")))
        .where(F.col("similarity") >= SIMILARITY)
        .groupBy("key", "item")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"))
    )
    return best.join(_if_small(items.select("item", "item_id"), n_items), "item").select(
        "key", "item_id", (-F.col("best.back")).alias("start"), F.col("best.similarity").alias("similarity")
    )


def text_key() -> Column:
    """128 bits that stand for the text; null is the empty text."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def document_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start and similarity of every leak in a row of ``documents``
    (doc_id, text); see ``leaks``. Rows of equal or null ids have their own text's."""
    found = written(leaks(documents.select("text"), benchmark), "leaks")
    own = documents.select("doc_id", text_key().alias("key"))
    return own.join(_if_small(found, found.count()), "key").select("doc_id", "item_id", "start", "similarity")


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` (text) that hold no benchmark item; see ``leaks``.

    Null and empty texts hold none and stay, as do repeated rows without a leak. All
    columns are kept, whatever their names.
    """
    found = written(leaks(documents.select("text"), benchmark).select("key").distinct(), "leaks")
    own = documents.select(row_of(documents), text_key().alias("key"))
    clean = own.join(_if_small(found, found.count()), "key", "left_anti")
    return clean.select(*columns_of_row(documents.columns))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
