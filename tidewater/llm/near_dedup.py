"""Near-duplicate documents by BagMinHash signatures of their word shingles.

Equal texts are one class from the start. Distinct texts meet in signature bands, and
every link that counts is verified on the whole multisets of shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import columns_of_row, row_of, slices, table, text_bytes, travels, written

travels(__name__)

SHINGLE = 5
SIMILARITY = 0.8
# Linked texts differ in at most this part of the elements of both.
RATIO = (1 - SIMILARITY) / (1 + SIMILARITY)
# A pair at SIMILARITY shares no band with a probability of 0.0002.
BANDS = 16
BAND_ROWS = 4
COMPONENTS = BANDS * BAND_ROWS

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), base)]).cumprod(dtype=np.uint64)[:n]


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text in UTF-8, letters A to Z as a to z."""
    data = np.frombuffer(raw.lower(), np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    # Sums of byte * odd^position; a word's part, moved back to position 0, is its hash.
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, n), out=sums[1:])
    back = _powers(_INVERSE, n)[starts]
    return _mix((sums[ends] - sums[starts]) * back + (ends - starts).astype(np.uint64))


def shingles(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the text's runs of SHINGLE words, and how often each occurs.

    A text of fewer words is one shingle; one without words has none.
    """
    words = word_hashes(raw)
    n = len(words)
    if not n:
        return words, np.zeros(0, np.int64)
    width = min(SHINGLE, n)
    found = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        found = _mix(found * _ODD + words[k : n - width + 1 + k] + np.uint64(1))
    return np.unique(found, return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets; two empty ones are equal."""
    total = a[1].sum() + b[1].sum()
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (total - both)) if total else 1.0


def signature(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """BagMinHash of a multiset: two signatures agree at a place with the probability of
    their weighted Jaccard similarity.

    Each element has a hierarchy of Poisson processes over its weight: one on (0, 1],
    one on (1, 2], (2, 4] and so on, so that a large weight costs its logarithm. Points
    come in order of time; each has a place and a position in its weight interval, and
    counts if the element's weight reaches it. A place keeps the element of its first
    point. Processes stop once they are past the latest first point.
    """
    level = np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64)
    levels = np.concatenate([np.arange(x + 1) for x in level]) if len(level) and level.max() else level * 0
    at = np.repeat(np.arange(len(hashes)), level + 1)
    low = np.where(levels == 0, 0, 2 ** np.maximum(levels - 1, 0))
    length = np.maximum(low, 1)
    reach = (weights[at] - low) / length
    seed = _mix(hashes[at] + levels.astype(np.uint64) * _ODD)
    first = np.full(COMPONENTS, np.inf)
    owner = np.zeros(COMPONENTS, np.uint64)
    now, count = np.zeros(len(at)), 0
    active = np.arange(len(at))
    while len(active):
        block = max(1, 6 * COMPONENTS // len(active)) if count == 0 else max(1, COMPONENTS // len(active))
        step = np.arange(count + 1, count + block + 1, dtype=np.uint64) * _ODD
        one = _mix(seed[active, None] ^ _mix(step))
        two = _mix(one + _ODD)
        waits = -np.log((one >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54)
        times = now[active, None] + np.cumsum(waits, axis=1) / (length[active, None] * COMPONENTS)
        place = (two & np.uint64(COMPONENTS - 1)).astype(np.int64)
        position = (two >> np.uint64(11)).astype(float) * 2.0**-53
        near = (position < reach[active, None]) & (times < first[place])
        who = np.broadcast_to(hashes[at[active], None], times.shape)[near]
        where, when = place[near], times[near]
        order = np.argsort(-when, kind="stable")  # the earliest is written last
        first[where[order]], owner[where[order]] = when[order], who[order]
        now[active] = times[:, -1]
        active = active[now[active] < first.max()]
        count += block
    return owner


def signed(docs: DataFrame, kept: list[str]) -> DataFrame:
    """``kept`` columns with the text's key (two hashes), size (shingles) and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_bytes"):
            sizes, bands = [], []
            for raw in batch["_bytes"].to_pylist():
                hashes, weights = shingles(raw)
                sizes.append(int(weights.sum()))
                if len(hashes):
                    mixed = np.zeros(BANDS, np.uint64)
                    for column in signature(hashes, weights).reshape(BANDS, BAND_ROWS).T:
                        mixed = _mix(mixed * _ODD + column)
                    bands.append(mixed.view(np.int64))
                else:
                    bands.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in [*kept, "key"]],
                    pa.array(sizes, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                [*kept, "key", "size", "bands"],
            )

    source = docs.select(*kept, text_key().alias("key"), text_bytes().alias("_bytes"))
    schema = source.drop("_bytes").schema.simpleString()[7:-1] + ",size:bigint,bands:array<bigint>"
    return source.mapInArrow(run, schema)


def text_key() -> Column:
    """128 bits that stand for the text; null is the empty text."""
    return F.unhex(F.md5(text_bytes()))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) of keys with ``similarity``, from ``texts`` (key, text as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag = None, None
        for batch in slices(batches, "text_b"):
            found = []
            columns = [batch[c].to_pylist() for c in ("a", "text_a", "text_b")]
            for a, text_a, text_b in zip(*columns, strict=True):
                if a != last:
                    last, bag = a, shingles(text_a)
                found.append(overlap(bag, shingles(text_b)))
            yield pa.RecordBatch.from_arrays(
                [batch["a"], batch["b"], pa.array(found, pa.float64())], ["a", "b", "similarity"]
            )

    both = pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a"
    )
    return both.select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a binary, b binary, similarity double"
    )


def components(links: DataFrame) -> DataFrame:
    """key and class (the least key) of every key in ``links`` (a, b), from written rows.

    Labels fall to the least of the neighbours', then to the label's own label, so long
    chains take a logarithm of rounds.
    """
    both = written(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "dedup-links",
    )
    labels = written(both.groupBy(F.col("a").alias("key")).agg(F.least("key", F.min("b")).alias("class")), "dedup-class")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("key"))
            .groupBy(F.col("a").alias("key"))
            .agg(F.min("class").alias("near"))
        )
        met = labels.join(near, "key").select(
            "key", F.col("class").alias("was"), F.least("class", "near").alias("via")
        )
        jump = labels.select(F.col("key").alias("via"), F.col("class").alias("far"))
        moved = written(
            met.join(jump, "via", "left").select("key", "was", F.least("via", "far").alias("class")), "dedup-class"
        )
        labels = moved.select("key", "class")
        if moved.where("was <> class").isEmpty():
            return labels


def copies(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A multiset as a set: the k-th copy of an element has a hash of its own."""
    first = np.repeat(np.cumsum(weights) - weights, weights)
    copy = np.arange(len(first)).astype(np.uint64) - first.astype(np.uint64)
    return _mix(np.repeat(hashes, weights) + copy * _ODD)


def shared_needed(n: int, leader: int, size: int) -> int:
    """How many elements two texts' differences to a leader must share at least.

    Similarity S or more means that x and y differ in at most r(|x| + |y|) elements, with
    r = (1 - S) / (1 + S). Their differences X and Y to the leader c share
    (|X| + |Y| - |x ^ y|) / 2 elements, where ^ is the symmetric difference. If x itself
    is not linked to c, |X| > r(|x| + |c|), so they share more than
    (|Y| + r(|c| - |y|)) / 2. ``n`` is |Y|, ``leader`` |c| and ``size`` |y|.
    """
    return math.floor((n + RATIO * (leader - size)) / 2 - 1e-9) + 1


def most_of_prefix(size: int) -> int:
    """How many first elements of a difference hold one of any linked text's, however far.

    The shared part of the differences X and Y has at least (|X| + |Y| - r(|x| + |y|)) / 2
    elements (``shared_needed``) and at most |Y|, so |Y| is |X| - r(|x| + |y|) or more, and
    then so is the shared part. |y| is |x| / S at most, and r(1 + 1 / S) is (1 - S) / S.
    """
    return math.floor(size * (1 - SIMILARITY) / SIMILARITY + 1e-9) + 1


def differences(state: DataFrame, texts: DataFrame) -> DataFrame:
    """``state`` (group, leader, key and more) with ``diff``, the elements that only one of
    text and leader has; ``far``, whether they are not linked; ``reach`` and ``prefix``: of
    one order of all elements, that many first ones of ``diff`` hold one of those of every
    text linked to this (``reach``), or of every far one (``prefix``).
    """
    kept = [c for c in state.columns if c not in ("leader", "leader_size")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag = None, None
        for batch in slices(batches, "text_b"):
            diffs, far, reach, prefix = [], [], [], []
            columns = [batch[c].to_pylist() for c in ("leader", "text_a", "text_b")]
            for leader, text_a, text_b in zip(*columns, strict=True):
                if leader != last:
                    last, bag = leader, copies(*shingles(text_a))
                own = copies(*shingles(text_b))
                diff = np.setxor1d(bag, own)
                total, n = len(bag) + len(own), len(diff)
                diffs.append(diff.view(np.int64))
                far.append((total - n) / (total + n) < SIMILARITY)
                reach.append(most_of_prefix(len(own)))
                prefix.append(min(reach[-1], n - shared_needed(n, len(bag), len(own)) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in kept],
                    pa.array(diffs, pa.list_(pa.int64())),
                    pa.array(far, pa.bool_()),
                    pa.array(reach, pa.int64()),
                    pa.array(prefix, pa.int64()),
                ],
                [*kept, "diff", "far", "reach", "prefix"],
            )

    both = state.join(texts.select("key", F.col("text").alias("text_b")), "key").join(
        texts.select(F.col("key").alias("leader"), F.col("text").alias("text_a")), "leader"
    )
    schema = state.select(*kept).schema.simpleString()[7:-1] + ",diff:array<bigint>,far:boolean,reach:bigint,prefix:bigint"
    return both.select(*kept, "leader", "text_a", "text_b").mapInArrow(run, schema)


def difference_buckets(apart: DataFrame) -> DataFrame:
    """Buckets (group, element) of the texts of ``apart`` (written ``differences``) in which
    every two linked texts of different classes meet: one not linked to the leader comes
    ``far``, by the ``reach`` rarest elements of its difference, the other ``indexed``, by
    its ``prefix`` of the rarest.
    """
    elements = apart.select(
        "group", "key", "size", "pull", "class", "far", "reach", "prefix",
        F.size("diff").alias("many"), F.explode("diff").alias("element"),
    )
    at = ["group", "element"]
    useful = (
        elements.groupBy(*at)
        .agg(F.count("*").alias("n"), F.min("class").alias("x"), F.max("class").alias("y"), F.bool_or("far").alias("any"))
        .where("any AND x <> y")
        .select(*at, "n")
    )
    # Elements that bring no two classes together come first in every prefix.
    text = Window.partitionBy("group", "key")
    place = F.col("many") - F.count("*").over(text) + F.row_number().over(text.orderBy("n", "element"))
    buckets = (
        elements.join(useful, at)
        .withColumn("place", place)
        .withColumn("indexed", F.col("place") <= F.col("prefix"))
        .withColumn("far", F.col("far") & (F.col("place") <= F.col("reach")))
        .where("indexed OR far")
        .select(*at, "key", "size", "many", "place", "pull", "class", "far", "indexed")
    )
    return written(buckets, "dedup-buckets")


class Links:
    """Verified links between texts and the classes that they make so far."""

    def __init__(self, texts: DataFrame):
        spark = texts.sparkSession
        self.texts = texts
        self.seen = spark.createDataFrame([], "a binary, b binary")
        self.classes = spark.createDataFrame([], "key binary, class binary")

    def add(self, pairs: DataFrame) -> None:
        """Compares ``pairs`` (a, b) that have not been compared before."""
        new = pairs.distinct().join(self.seen, ["a", "b"], "left_anti")
        checked = written(verified(new, self.texts), "dedup-pairs")
        self.seen = self.seen.unionByName(checked.select("a", "b"))
        near = checked.where(F.col("similarity") >= SIMILARITY)
        ends = near.select(F.col("a").alias("key")).unionByName(near.select(F.col("b").alias("key")))
        known = written(self.classed(ends.unionByName(self.classes.select("key")).distinct()), "dedup-known")
        # Only classes that a new link joins change.
        of = [known.select(F.col("key").alias(x), F.col("class").alias(f"class_{x}")) for x in "ab"]
        joins = (
            near.join(of[0], "a").join(of[1], "b").where("class_a <> class_b")
            .select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()
        )
        joins = written(joins, "dedup-joins")
        if not joins.isEmpty():
            to = components(joins).select(F.col("key").alias("class"), F.col("class").alias("to"))
            moved = known.join(to, "class", "left").select("key", F.coalesce("to", "class").alias("class"))
            self.classes = written(moved, "dedup-classes")

    def classed(self, df: DataFrame) -> DataFrame:
        """``df`` with the class of its ``key``; a text without links is its own."""
        rest = df.drop("class").join(self.classes, "key", "left")
        return rest.withColumn("class", F.coalesce("class", "key"))


def alike_in_size(a: str, b: str) -> Column:
    """False where two sizes alone rule out a link."""
    return F.least(a, b) >= F.lit(SIMILARITY) * F.greatest(a, b)


def can_share_enough() -> Column:
    """False where a bucket's element cannot be the first that a text and the leader ``l``
    share, if they are linked: too few elements of their differences come after it.

    Linked texts also meet at the first element they share, so no link is lost.
    """
    most = F.least(F.col("many") - F.col("place"), F.col("l.many") - F.col("l.place")) + 1
    size = F.col("size") + F.col("l.size")
    return 2 * most >= F.col("many") + F.col("l.many") - F.lit(RATIO) * size - 1e-6


def text_classes(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """key and class of the distinct texts of ``rows`` that have links.

    Texts of one band bucket are not paired with each other. A bucket's most central text
    leads and is compared with the rest. Texts that then still lie in different classes are
    dealt anew by how they differ from their leader: linked texts share so much of their
    differences that they meet in a bucket of one element (``difference_buckets``). There
    1, 30, 900 ... indexed texts lead, until every bucket is one class or all its indexed
    texts have led: no link between classes is lost. Pairs whose sizes and places
    in the bucket rule out a link are not compared there (``can_share_enough``).
    """
    one = rows.where("size > 0").groupBy("key").agg(F.first("size").alias("size"), F.first("bands").alias("bands"))
    members = one.select("key", "size", F.posexplode("bands").alias("band", "hash"))
    full = members.groupBy("band", "hash").agg(F.count("*").alias("n")).where("n > 1")
    members = written(members.join(full, ["band", "hash"]), "dedup-members")
    # Texts that share many buckets with many others lead first: the text that a group of
    # copies was made from is near to all of them, while two of its copies may not be.
    pull = members.groupBy("key").agg(F.sum("n").alias("pull"))
    texts = written(
        docs.select(text_key().alias("key"), text_bytes().alias("text"))
        .join(members.select("key").distinct(), "key", "left_semi")
        .groupBy("key")
        .agg(F.first("text").alias("text")),
        "dedup-texts",
    )
    links = Links(texts)

    first = members.drop("n").join(pull, "key")
    chosen = first.groupBy("band", "hash").agg(F.max_by(F.struct("key", "size"), F.struct("pull", "key")).alias("l"))
    # Buckets with one leader are one group.
    groups = written(
        first.join(chosen, ["band", "hash"])
        .where(F.col("key") != F.col("l.key"))
        .groupBy(F.col("l.key").alias("leader"), F.col("l.size").alias("leader_size"), "key")
        .agg(F.first("size").alias("size"), F.first("pull").alias("pull"))
        .withColumn("group", F.col("leader")),
        "dedup-groups",
    )
    links.add(
        groups.where(alike_in_size("size", "leader_size"))
        .select(F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b"))
    )
    state = links.classed(groups)
    split = state.groupBy("group").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x <> y")
    apart = written(differences(state.join(split, "group", "left_semi"), texts), "dedup-differences")

    at = ["group", "element"]
    state = difference_buckets(apart).withColumn("led", ~F.col("indexed")).drop("indexed")
    leaders = 1
    while True:
        split = (
            state.groupBy(*at)
            .agg(F.min("class").alias("x"), F.max("class").alias("y"), F.bool_and("led").alias("done"), F.bool_or("far").alias("any"))
            .where("x <> y AND any AND NOT done")
        )
        state = written(state.join(split, at, "left_semi"), "dedup-state")
        if state.isEmpty():
            return links.classes
        # Spark keeps only the first rows of each bucket before the shuffle.
        rank = F.row_number().over(Window.partitionBy(*at).orderBy(F.desc("pull"), "key"))
        chosen = written(
            state.where("NOT led")
            .withColumn("rank", rank)
            .where(F.col("rank") <= leaders)
            .select(*at, F.struct("key", "size", "many", "place", "class", "far").alias("l")),
            "dedup-leaders",
        )
        links.add(
            state.join(chosen, at)
            .where((F.col("class") != F.col("l.class")) & (F.col("far") | F.col("l.far")))
            .where(alike_in_size("size", "l.size"))
            .where(can_share_enough())
            .select(F.least("key", "l.key").alias("a"), F.greatest("key", "l.key").alias("b"))
        )
        led = chosen.select(*at, F.col("l.key").alias("key"), F.lit(True).alias("now"))
        state = links.classed(state.join(led, [*at, "key"], "left")).withColumn(
            "led", F.col("led") | F.coalesce("now", F.lit(False))
        ).drop("now")
        leaders *= 30


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, class_id and class_size of every row of ``documents`` (doc_id, text).

    ``class_id`` is the least doc_id of the documents joined by chains of equal texts and
    of texts with a similarity of SIMILARITY or more. A null text counts as empty; texts
    without words are duplicates of exactly equal texts only. Null ids are in the
    classes of their texts; class_id is null if a class has no other id.
    """
    rows = written(signed(documents, ["doc_id"]), "dedup-rows")
    classes = text_classes(documents, rows)
    by_key = rows.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    in_class = written(
        by_key.join(classes, "key", "left")
        .select("key", "least", "n", F.coalesce("class", "key").alias("class")),
        "dedup-keys",
    )
    of_class = in_class.groupBy("class").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"))
    named = in_class.join(of_class, "class").select("key", "class_id", "class_size")
    return rows.select("doc_id", "key").join(named, "key").select("doc_id", "class_id", "class_size")


def one_of_each(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` without near duplicates: of each class the row of the
    least doc_id, of equal ids the one of the least text key, and one of repeated rows.

    A null text counts as empty; of texts without words one of each stays. A null id
    comes after all others. All columns are kept, whatever their names.
    """
    rows = written(signed(documents, ["doc_id"]), "dedup-rows")
    classes = text_classes(documents, rows)
    ids = rows.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "key")).alias("first"))
    stays = (
        ids.join(classes, "key", "left")
        .groupBy(F.coalesce("class", "key").alias("class"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"))
    )
    row = row_of(documents)
    own = documents.select(row, text_key().alias("key"), F.col("doc_id").alias("id"))
    match = (own["key"] == stays["_key"]) & own["id"].eqNullSafe(stays["_id"])
    kept = own.join(stays, match, "left_semi").dropDuplicates(["key", "id"])
    return kept.select(*columns_of_row(documents.columns))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
