"""Document probabilities from sums over all segmentations into public pieces."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import (
    id_remainder,
    slices,
    table,
    text_bytes,
    tokenizer_path,
    travels,
    written,
)
from tidewater.llm.lattice import Lattice, Vocabulary

travels(__name__)

# Distinct words a task holds before it passes their counts on.
WORDS_AT_ONCE = 150_000
# Words at most that every task gets; the counts of all others reach it by a join.
FREQUENT_WORDS = 100_000
# Occurrences that the vocabulary's own scores count for.
PRIOR_COUNT = 200.0
# Estimation rounds of the pieces' probabilities.
ROUNDS = 2
# Languages that are classes of their own.
CLASSES = 16
OTHERS = "(others)"


@dataclass
class Model:
    """``words``: table of word, n (all), c0.. (training, by class), s0.. (natural log)."""

    words: DataFrame
    classes: list[str]
    share: np.ndarray
    ends: np.ndarray
    totals: np.ndarray
    distinct: np.ndarray
    discounts: np.ndarray


def _word_counts(docs: DataFrame, classes: int) -> DataFrame:
    """Per word: its count in the training texts of each class and in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(classes + 1)]

        def out() -> pa.RecordBatch:
            words = list(dict.fromkeys(w for c in counts for w in c))
            by = [np.array([c[w] for w in words], np.int64) for c in counts]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(sum(by)), *map(pa.array, by[:-1])], names
            )

        for batch in slices(batches, "text"):
            for text, k in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                counts[k].update(text.lower().split())
                if sum(map(len, counts)) > WORDS_AT_ONCE:
                    yield out()
                    for c in counts:
                        c.clear()
        yield out()

    names = ["word", "n", *[f"c{k}" for k in range(classes)]]
    schema = "word binary, " + ", ".join(f"{c} long" for c in names[1:])
    counts = docs.select("text", "class").mapInArrow(run, schema)
    return counts.groupBy("word").agg(*[F.sum(c).alias(c) for c in names[1:]])


def _piece_counts(words: DataFrame, vocabulary: Vocabulary, p: np.ndarray, classes: int) -> np.ndarray:
    """Expected pieces of each class's training words, each word once.

    The pieces serve words seen seldom or never, and those resemble the list of
    distinct words more than running text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary, p)
        counts = np.zeros((len(vocabulary), classes))
        for batch in batches:
            found = [w.decode("utf-8", "replace") for w in batch[0].to_pylist()]
            weights = np.stack([batch[1 + k].to_numpy() > 0 for k in range(classes)], axis=1)
            counts += lattice.expected(found, weights.astype(float))
        rows, at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(at), pa.array(counts[rows, at])], ["piece", "class", "n"]
        )

    columns = [f"c{k}" for k in range(classes)]
    parts = words.select("word", *columns).mapInArrow(run, "piece long, class long, n double")
    counts = np.zeros((len(vocabulary), classes))
    for row in parts.groupBy("piece", "class").agg(F.sum("n").alias("n")).collect():
        counts[row.piece, row["class"]] = row.n
    return counts


def fit(docs: DataFrame, path: str) -> Model:
    """Learns from the rows of ``docs`` (text as bytes, lang, train) that have ``train``.

    A text comes from one of several classes: the languages of the training rows, the
    CLASSES most frequent, all others together as one. Counts cover all words. The
    driver gets a number for each vocabulary piece and class.
    """
    vocabulary = Vocabulary(path)
    rows = docs.where("train").groupBy("lang").count().collect()
    rows.sort(key=lambda r: (-r["count"], r.lang or ""))
    classes = [r.lang for r in rows[:CLASSES]]
    ends = [r["count"] for r in rows[:CLASSES]]
    if len(rows) > CLASSES or not rows:
        classes.append(OTHERS)
        ends.append(sum(r["count"] for r in rows[CLASSES:]))
    size = len(classes)
    at = F.lit(size - 1)
    for k, lang in enumerate(classes):
        if lang != OTHERS:
            at = F.when(F.col("lang").eqNullSafe(F.lit(lang)), F.lit(k)).otherwise(at)
    words = written(
        _word_counts(docs.select("text", F.when(F.col("train"), at).otherwise(size).alias("class")), size),
        "lm-words",
    )
    columns = [F.col(f"c{k}") for k in range(size)]
    columns.append(sum(columns[1:], columns[0]))
    seen = words.agg(
        *[F.sum(c) for c in columns],
        *[F.count_if(c > 0) for c in columns],
        *[F.count_if(c == 1) for c in columns],
        *[F.count_if(c == 2) for c in columns],
    ).first()
    sums, distinct, once, twice = np.array([x or 0 for x in seen], float).reshape(4, -1)
    end = np.array([*ends, sum(ends)], float)

    p, prior = vocabulary.prior, vocabulary.prior[:, None]
    for _ in range(ROUNDS):
        counts = _piece_counts(words, vocabulary, p, size)
        pooled = counts.sum(axis=1, keepdims=True) + PRIOR_COUNT * prior
        p = pooled[:, 0] / pooled.sum()
    by_class = counts + PRIOR_COUNT * p[:, None]
    by_class /= by_class.sum(axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary, by_class)
        for batch in batches:
            found = [w.decode("utf-8", "replace") for w in batch["word"].to_pylist()]
            logs = lattice.score(found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(logs[:, k]) for k in range(size)]], names
            )

    names = [*words.columns, *[f"s{k}" for k in range(size)]]
    schema = words.schema.simpleString()[7:-1] + "".join(f",s{k}:double" for k in range(size))
    return Model(
        written(words.mapInArrow(run, schema), "lm-model"),
        classes,
        np.array(ends, float) / max(sum(ends), 1),
        end,
        sums + end,
        distinct + (end > 0),
        np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5),
    )


def _values(model: Model) -> DataFrame:
    """Per word: base (log10), p0.. (log10, by class) and known (0/1)."""
    size = len(model.classes)
    c = sum([F.col(f"c{k}") for k in range(1, size)], F.col("c0"))
    total, distinct = model.totals[-1], model.distinct[-1]

    def discounted(count: Column, k: int) -> tuple[Column, float]:
        if not model.totals[k]:
            return F.lit(0.0), 1.0
        d, n = float(model.discounts[k]), float(model.totals[k])
        return F.greatest(count - d, F.lit(0.0)) / n, d * float(model.distinct[k]) / n

    def log_of(k: int) -> Column:
        own, freed = discounted(F.col(f"c{k}"), k)
        pooled, rest = discounted(c, size)
        counted = own + pooled * freed
        # log(counted + exp(inner)), where exp(inner) alone may be too small for a double.
        inner = F.col(f"s{k}") + float(np.log(freed * rest))
        both = F.log(counted) + F.log1p(F.exp(inner - F.log(counted)))
        return F.when(counted > 0, both).otherwise(inner) / float(np.log(10))

    return model.words.select(
        "word",
        "n",
        F.log10((c + 0.1) / float(total + 0.1 * (distinct + 1))).alias("base"),
        (c > 0).cast("long").alias("known"),
        *[log_of(k).alias(f"p{k}") for k in range(size)],
    )


def _frequent(values: DataFrame) -> pa.Table:
    """The words of the highest counts, at most FREQUENT_WORDS, whole count classes only."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 16)
    left, lowest = FREQUENT_WORDS, None
    for row in sorted(values.groupBy(level.alias("at")).count().collect(), key=lambda r: -r["at"]):
        left -= row["count"]
        if left < 0:
            break
        lowest = row["at"]
    if lowest is None:
        return values.limit(0).toArrow()
    return values.where(level >= lowest).toArrow()


def score(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with n_tokens, n_known, base_score and score.

    ``score`` is the log10 probability of the text, summed over its possible classes.
    In a class, a word's probability is its discounted share there, plus the freed mass
    times its discounted share in all classes, plus what is left times the sum over all
    its segmentations into pieces; one end follows. Frequent words are looked up in a
    table of bounded size, the others come by a join on the word. Repeated rows each
    get their result.
    """
    values, size = _values(model), len(model.classes)
    top = docs.sparkSession.sparkContext.broadcast(_frequent(values))
    total, ends = model.totals[-1], model.ends[-1]
    end_base = float(np.log10((ends + 0.1) / (total + 0.1 * (model.distinct[-1] + 1))))
    # A class without training texts ends every second token.
    taken = model.ends[:size] - model.discounts[:size]
    end_p = np.log10(np.where(taken > 0, taken / np.maximum(model.totals[:size], 1), 0.5))
    of_class = [f"p{k}" for k in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = top.value
        at = {w: k for k, w in enumerate(frequent["word"].to_pylist())}
        of_word = np.stack([frequent[c].to_numpy() for c in ("known", "base", *of_class)], axis=1)
        of_word = np.vstack([of_word, np.zeros((1, 2 + size))])
        of_end = np.array([float(ends > 0), end_base, *end_p])
        none, get = len(at), at.get
        for batch in slices(batches, "text"):
            n, sums, rare = [], [], []
            for text in batch["text"].to_pylist():
                words = text.lower().split()
                where = np.array([get(w, none) for w in words], np.int64)
                n.append(len(words) + 1)
                sums.append(of_word[where].sum(axis=0) + of_end)
                others = Counter(words[k] for k in np.flatnonzero(where == none))
                rare.append([{"word": w, "k": k} for w, k in others.items()])
            sums = np.array(sums).reshape(-1, 2 + size)
            kept = [batch[c] for c in ("_row", *columns)]
            made = [pa.array(n, pa.int64()), pa.array(sums[:, 0].astype(np.int64))]
            made += [pa.array(sums[:, 1 + k]) for k in range(1 + size)]
            yield pa.RecordBatch.from_arrays([*kept, *made, pa.array(rare, rare_type)], names)

    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64())]))
    sums = ["n_tokens", "n_known", "base_score", *of_class]
    names = ["_row", *columns, *sums, "rare"]
    source = docs.select(F.monotonically_increasing_id().alias("_row"), *columns, "text")
    schema = source.drop("text").schema.simpleString()[7:-1] + (
        ",n_tokens:bigint,n_known:bigint,base_score:double,"
        + "".join(f"{c}:double," for c in of_class)
        + "rare:array<struct<word:binary,k:bigint>>"
    )
    first = written(source.mapInArrow(run, schema), "lm-rows")
    looked_up = (
        first.select("_row", F.explode("rare").alias("r"))
        .select("_row", "r.word", "r.k")
        .join(values.drop("n"), "word")
        .select(
            "_row",
            *[F.lit(None).cast(first.schema[c].dataType).alias(c) for c in columns],
            F.lit(0).cast("long").alias("n_tokens"),
            (F.col("k") * F.col("known")).alias("n_known"),
            (F.col("k") * F.col("base")).alias("base_score"),
            *[(F.col("k") * F.col(c)).alias(c) for c in of_class],
        )
    )
    joint = [F.col(c) + float(np.log10(s)) for c, s in zip(of_class, model.share, strict=True) if s > 0]
    joint = joint or [F.col("p0")]
    best = F.greatest(*joint) if len(joint) > 1 else joint[0]
    apart = [F.pow(F.lit(10.0), x - best) for x in joint]
    return (
        first.drop("rare")
        .unionByName(looked_up)
        .groupBy("_row")
        .agg(*[F.max(c).alias(c) for c in columns], *[F.sum(c).alias(c) for c in sums])
        .withColumn("score", best + F.log10(sum(apart[1:], apart[0])))
        .drop("_row", *of_class)
    )


def lm_scores(documents: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """Scores every row of ``documents`` (doc_id, text, and lang to learn from).

    Learns from the rows whose crc32 of the id is not 0 modulo 10. A null text is
    empty and has an end only; a null id counts as the empty text in the split; an
    empty table gives an empty result.
    """
    docs = documents.select(
        "doc_id", "lang", text_bytes().alias("text"), (id_remainder("doc_id", 10) == 0).alias("held_out")
    ).withColumn("train", ~F.col("held_out"))
    model = fit(docs, vocabulary_path or tokenizer_path("piece_bpe_32k.model"))
    return score(docs, model, ["doc_id", "held_out"]).withColumn(
        "train_tokens", F.lit(int(model.totals[-1])).cast("long")
    )


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
