"""Quality rules: an isolation forest over rule statistics of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import columns_of, columns_of_row, free_name, row_of, slices, table, text_bytes, travels, written

travels(__name__)

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
# The base rules: fewest words, and largest share of words in repeated windows.
LEAST_WORDS = 20
MOST_REPEATED = 30
# The forest: labelled rows drawn from at most, trees, and rows in a tree.
SAMPLE_ROWS = 4096
TREES = 100
TREE_ROWS = 256
# Largest share of labelled good rows that the threshold may reject.
GOOD_LOST = 0.01

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_COUNTS = ("n_lines", "n_upper", "n_digits", "n_marks", "n_letters")
STATISTICS = ("symbols", "upper", "digits", "marks", "letters", "word_length", "dup_lines", "repeats")


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    at: dict[bytes, int] = {}
    ids = np.array([at.setdefault(w, len(at)) for w in words], np.int64)
    if len(at) == len(words):
        return 0
    width = 1
    while width < WINDOW:  # numbers windows of 2, 4 and 8 words
        pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        _, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        width *= 2
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[ids] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((edges.cumsum() > 0).sum())


def counts_of(raw: bytes) -> tuple[int, ...]:
    """COUNTS and MORE_COUNTS of a text in UTF-8."""
    text, words = raw.decode(), raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    upper = ((points >= 65) & (points <= 90)) | ((points >= 0xC0) & (points <= 0xDE) & (points != 0xD7))
    lower = ((points >= 97) & (points <= 122)) | (points >= 0xDF)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        int(upper.sum()),
        int(((points >= 48) & (points <= 57)).sum()),
        text.count("!") + text.count("?"),
        int((upper | lower).sum()),
    )


def _statistics(counts: np.ndarray) -> np.ndarray:
    """STATISTICS (shares, the same for short and long texts) of rows of counts."""
    words, chars, symbols, dup, repeat, lines, upper, digits, marks, letters = counts.T.astype(float)
    words, chars, lines = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.stack(
        [
            symbols / words, upper / chars, digits / chars, marks / words,
            letters / chars, chars / words, dup / lines, repeat / words,
        ],
        axis=1,
    )


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with COUNTS and MORE_COUNTS (long) of the whole text."""
    names = [*COUNTS, *MORE_COUNTS]
    kept = [c for c in docs.columns if c != text and c not in names]
    content = free_name(docs, "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, content):
            found = np.array([counts_of(b) for b in batch[content].to_pylist()], np.int64)
            found = found.reshape(-1, len(names))
            columns = [batch[c] for c in kept] + [pa.array(found[:, k]) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    rows = docs.select(*columns_of(docs, kept), text_bytes(text).alias(content))
    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField(n, T.LongType()) for n in names])
    return rows.mapInArrow(run, schema)


@dataclass
class Forest:
    """Trees as arrays: statistic and cut of each node, its first child, its path length."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    rows: int
    threshold: float = float("inf")

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores in 0 to 1: 2 to the minus mean path length over its expectation."""
        total = np.zeros(len(x))
        for statistic, cut, child, length in self.trees:
            at = np.zeros(len(x), np.int64)
            inner = np.flatnonzero(child[at])
            while len(inner):
                here = at[inner]
                at[inner] = child[here] + (x[inner, statistic[here]] >= cut[here])
                inner = inner[child[at[inner]] > 0]
            total += length[at]
        return 2.0 ** (-total / max(len(self.trees), 1) / max(_mean_path(self.rows), 1e-9))


def _mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    return 0.0 if n < 2 else 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def _tree(x: np.ndarray, low: np.ndarray, high: np.ndarray, random: np.random.Generator) -> tuple:
    """Random cuts of the box ``low`` to ``high``, down to single rows of ``x``.

    Cuts fall anywhere in a node's box, not only between its rows, so that a row beyond
    all good ones in a statistic that never varies among them is isolated early.
    """
    statistic, cut, child, length = [], [], [], []
    deepest = 2 * int(np.ceil(np.log2(max(len(x), 2))))

    def node() -> int:
        statistic.append(0), cut.append(0.0), child.append(0), length.append(0.0)
        return len(cut) - 1

    waiting = [(node(), np.arange(len(x)), low, high, 0)]
    while waiting:
        at, rows, low, high, depth = waiting.pop()
        spread = np.flatnonzero(high > low)
        if depth >= deepest or len(rows) < 2 or not len(spread):
            length[at] = depth + _mean_path(len(rows))
            continue
        k = int(random.choice(spread))
        statistic[at], cut[at] = k, float(random.uniform(low[k], high[k]))
        above = x[rows, k] >= cut[at]
        edge = np.where(np.arange(len(low)) == k, cut[at], np.nan)
        first = child[at] = node()
        waiting.append((first, rows[~above], low, np.where(np.isnan(edge), high, edge), depth + 1))
        waiting.append((node(), rows[above], np.where(np.isnan(edge), low, edge), high, depth + 1))
    return np.array(statistic), np.array(cut), np.array(child), np.array(length)


def fit(counted: DataFrame, labels: DataFrame) -> Forest:
    """A forest from ``counted`` (doc_id and the counts) and ``labels`` (doc_id, quality).

    The trees come from at most SAMPLE_ROWS labelled rows, those of lowest id hash: they
    isolate the good rows in the box that all rows span. The threshold comes from all labelled rows: of those that lose GOOD_LOST of the good
    rows at most, the one that finds most bad rows beyond good ones. Without good and bad
    labelled rows nothing is rejected.
    """
    names = [*COUNTS, *MORE_COUNTS]
    wanted = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    rows = counted.join(wanted.select("doc_id", "quality"), "doc_id").where(~base_failed())
    sample = rows.orderBy(F.xxhash64("doc_id"), *names).limit(SAMPLE_ROWS).select("quality", *names).collect()
    drawn = np.array(sample, np.int64).reshape(-1, 1 + len(names))
    spanned, x = _statistics(drawn[:, 1:]), _statistics(drawn[drawn[:, 0] > 0, 1:])
    if not len(x):
        return Forest([], 0)
    low, high = spanned.min(axis=0), spanned.max(axis=0)
    random = np.random.default_rng(17)
    size = min(TREE_ROWS, len(x))
    trees = [_tree(x[random.choice(len(x), size, replace=False)], low, high, random) for _ in range(TREES)]
    forest = Forest(trees, size)
    bins = (
        with_scores(rows.select("quality", *names), forest)
        .groupBy((F.col("quality") > 0).alias("good"), F.floor(F.col("score") * 1000).alias("bin"))
        .count()
        .collect()
    )
    good, bad = np.zeros(1002), np.zeros(1002)
    for row in bins:
        (good if row.good else bad)[row.bin] += row["count"]
    if good.sum() and bad.sum():
        lost, found = (c[::-1].cumsum()[::-1] for c in (good, bad))
        worth = np.where(lost <= GOOD_LOST * good.sum(), found - lost, -1.0)
        # The highest of equal thresholds.
        best = len(worth) - 1 - int(worth[::-1].argmax())
        if worth[best] > 0:
            forest.threshold = best / 1000
    return forest


def with_scores(counted: DataFrame, forest: Forest, to: str = "score") -> DataFrame:
    """``counted`` with its anomaly score."""
    names, kept = [*COUNTS, *MORE_COUNTS], [c for c in counted.columns if c != to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch[c].to_numpy() for c in names], axis=1)
            scores = forest.scores(_statistics(x)) if forest.trees else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(scores)], [*kept, to])

    schema = counted.select(*kept).schema.add(to, "double")
    return counted.select(*kept).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def verdicts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed and kept of every row of ``documents`` (doc_id, text).

    A null text has no words and fails the base rules. Rows of equal or null ids are
    judged each by its own text; null ids have no labels.
    """
    counted = written(with_counts(documents.select("doc_id", "text")), "quality-counts")
    forest = fit(counted, labels)
    return with_scores(counted, forest).select(
        "doc_id",
        *COUNTS,
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("score") < forest.threshold)).alias("kept"),
        "score",
    )


def good_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` (doc_id, text) that pass the base rules and the forest.

    A null or empty text has no words and goes; rows of equal or null ids are judged each
    by its own text, so repeated rows stay or go together. All columns are kept, whatever
    their names. No labels: the base rules alone.
    """
    counted = written(with_counts(documents.select("doc_id", "text")), "quality-counts")
    forest = fit(counted, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "content"):
            counts = np.array([counts_of(b) for b in batch["content"].to_pylist()], np.int64).reshape(-1, 10)
            passed = (counts[:, 0] >= LEAST_WORDS) & (100 * counts[:, 4] <= MOST_REPEATED * counts[:, 0])
            if forest.trees:
                passed &= forest.scores(_statistics(counts)) < forest.threshold
            yield batch.filter(pa.array(passed)).select(["row"])

    rows = documents.select(row_of(documents), text_bytes().alias("content"))
    passed_rows = rows.mapInArrow(run, rows.select("row").schema)
    return passed_rows.select(*columns_of_row(documents.columns))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
