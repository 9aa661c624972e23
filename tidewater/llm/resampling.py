"""Documents drawn by how much more likely their features are in a target than in the corpus.

Features are runs of one to three words, hashed to BUCKETS counts of the corpus and of the
target. A bucket's gain is the logarithm of the ratio of its smoothed shares; a document's
weight is the sum over its features, looked up as arrays, and perturbed by a Gumbel value
of its id so that the highest scores are a draw without replacement. Ranks come from a
distributed radix sort.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import TEXT_AT_ONCE, Remembered, slices, table, text_bytes, travels, written
from tidewater.llm.radix import radix_ranked

travels(__name__)

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
WORDS_KEPT = 500_000
# Words of more bytes are hashed one by one.
LONG_WORD = 48

# A-Z as a-z; every other byte of ASCII but digits and a-z parts words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def _shift_tables() -> np.ndarray:
    """What CRC-32 makes of each byte of a checksum followed by n zero bytes, n up to LONG_WORD + 1."""
    # crc(a + b) = shift(crc(a), len(b)) ^ crc(b), and a shift is linear in the checksum's bits.
    one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    images = np.uint32(1) << np.arange(32, dtype=np.uint32)
    out = np.zeros((LONG_WORD + 2, 4, 256), np.uint32)
    values = np.arange(256)
    for n in range(LONG_WORD + 2):
        if n:
            images = (images >> np.uint32(8)) ^ one[images & np.uint32(255)]
        for k in range(4):
            for bit in range(8):
                out[n, k] ^= np.where(values >> bit & 1, images[8 * k + bit], np.uint32(0))
    return out


class Features:
    """Buckets of the features of texts."""

    def __init__(self):
        self.tables = _shift_tables().ravel()
        self.words = Remembered(WORDS_KEPT)

    def _word(self, word: bytes) -> int:
        """The word's checksum, that of a space and the word, and its length, as one number."""
        found = self.words.get(word)
        if found is None:
            found = zlib.crc32(word) | min(len(word), LONG_WORD + 1) << 32
            self.words.put(word, found)
        return found

    def _longer(self, before: np.ndarray, words: list[bytes], spaced: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Checksums of what has checksums ``before``, a space and the words."""
        base = np.minimum(sizes + 1, LONG_WORD + 1) * 1024
        out = spaced.copy()
        for k in range(4):
            out ^= self.tables[base + k * 256 + (before >> np.uint32(8 * k) & np.uint32(255))]
        for i in np.flatnonzero(sizes > LONG_WORD).tolist():
            out[i] = zlib.crc32(b" " + words[i], int(before[i]))
        return out

    def buckets(self, pieces: list[list[bytes]], carried: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(piece, bucket) of the features of pieces of texts, by size.

        ``carried`` says how many first words of a piece are the last of the piece before
        it in the same text: features among these were counted there.
        """
        flat = list(chain.from_iterable(pieces))
        if not flat:
            return
        encoded = pa.array(flat, pa.binary()).dictionary_encode()
        distinct = encoded.dictionary.to_pylist()
        codes = encoded.indices.to_numpy()
        known = np.fromiter(map(self._word, distinct), np.int64, len(distinct))
        alone = (known & 0xFFFFFFFF).astype(np.uint32)
        sizes = known >> 32
        space = np.full(len(distinct), zlib.crc32(b" "), np.uint32)
        # A word after a space: the space's checksum, shifted, with the word's.
        base = np.minimum(sizes, LONG_WORD) * 1024
        spaced = alone.copy()
        for k in range(4):
            spaced ^= self.tables[base + k * 256 + (space >> np.uint32(8 * k) & np.uint32(255))]
        alone, spaced, sizes = alone[codes], spaced[codes], sizes[codes]
        lengths = [len(p) for p in pieces]
        of = np.repeat(np.arange(len(pieces)), lengths)
        starts = np.cumsum(lengths) - lengths
        old = np.arange(len(flat)) - np.repeat(starts, lengths) < np.repeat(carried, lengths)
        yield of[~old], (alone % np.uint32(BUCKETS))[~old]
        before = alone
        for more in (1, 2):
            if len(flat) <= more:
                return
            before = self._longer(before[:-1], flat[more:], spaced[more:], sizes[more:])
            good = (of[:-more] == of[more:]) & ~old[more:]
            yield of[:-more][good], (before % np.uint32(BUCKETS))[good]


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[list[bytes]], list[int], list[int]]]:
    """Words of texts in pieces of TEXT_AT_ONCE bytes: (words, how many of them are carried, text)."""
    short, owners = [], []
    for k, text in enumerate(texts):
        text = text.translate(_WORD_BYTES)
        if len(text) <= TEXT_AT_ONCE:
            short.append(text.split())
            owners.append(k)
            continue
        last: list[bytes] = []
        start = 0
        while start < len(text):
            stop = text.find(b" ", start + TEXT_AT_ONCE)
            stop = len(text) if stop < 0 else stop
            words = text[start:stop].split()
            yield [last + words], [len(last)], [k]
            last, start = (last + words)[-2:], stop
    if short:
        yield short, [0] * len(short), owners


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all ``texts`` (text) lie in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts = Features(), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text"):
            for pieces, carried, _ in _pieces(batch["text"].to_pylist()):
                for _, buckets in features.buckets(pieces, carried):
                    counts += np.bincount(buckets, minlength=BUCKETS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["bucket", "n"])

    found = texts.select(text_bytes().alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of each bucket's share in the target over that in the corpus."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = [
        (float(t) + 1) * s_all / ((float(s) + 1) * t_all) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ]
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def weighted(documents: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of each of ``documents`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches, "text"):
            n_words, n_features, weights = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for pieces, carried, owners in _pieces(batch["text"].to_pylist()):
                owner = np.array(owners)
                n_words[owner] += np.array([len(p) for p in pieces]) - carried
                for of, buckets in features.buckets(pieces, carried):
                    n_features[owner] += np.bincount(of, minlength=len(pieces))
                    sums = np.concatenate([[0], np.cumsum(gains[buckets])])
                    ends = np.searchsorted(of, np.arange(len(pieces) + 1))
                    weights[owner] += sums[ends[1:]] - sums[ends[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n_words), pa.array(n_features), pa.array(weights)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    schema = T.StructType([documents.schema["doc_id"]])
    for name in ("n_words", "n_features", "weight"):
        schema = schema.add(name, T.LongType())
    return documents.select("doc_id", text_bytes().alias("text")).mapInArrow(run, schema)


def gumbel_scores(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` (doc_id, weight) with score: the weight and 1000 times a Gumbel value of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    value = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296)))
    return rows.withColumn("score", F.col("weight") + value)


def resampled(
    documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``documents`` (doc_id, text).

    ``percent`` of the documents with ``least_words`` or more are drawn, rounded down:
    those of the highest scores, equal ones by ascending doc_id (a null after all). Their
    rank counts from 1; all others have none. doc_id is an integer. A null text has no
    words; its weight is 0. Rows that repeat an id have the same chance value and, if
    their texts are equal, consecutive places. Counts are over all rows of ``documents``
    and ``target`` (text). Only these columns are read.
    """
    gains = bucket_gains(bucket_counts(documents), bucket_counts(target))
    scored = gumbel_scores(weighted(documents, gains), seed)
    scored = scored.withColumn("short", (F.col("n_words") < least_words).cast("long")).drop("n_words")
    scored = written(scored, "resampling-scores")
    drawn = scored.where("short = 0").count() * percent // 100
    ranked = radix_ranked(scored, [("short", False), ("score", True), ("doc_id", False)])
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
