"""Language identification by sums over segmentations into public pieces."""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import columns_of, columns_of_row, free_name, id_remainder, row_of, slices, table, text_bytes, tokenizer_path, travels
from tidewater.llm.lattice import Lattice, Vocabulary

travels(__name__)

# Distinct words a task holds before it passes their piece counts on.
WORDS_AT_ONCE = 200_000
# Words whose scores a task keeps for later texts.
WORDS_KEPT = 150_000
# Occurrences that a language's smoothing counts for.
SMOOTHING = 500.0
UNKNOWN = "und"
PUNCTUATION = string.punctuation


def words_of(raw: bytes) -> list[str]:
    """Lower-case words between white space, without ASCII punctuation around them."""
    words = [w.strip(PUNCTUATION) for w in raw.decode().lower().split()]
    return list(filter(None, words))


@dataclass
class LanguageModel:
    vocabulary: Vocabulary
    languages: list[str]
    prior: np.ndarray
    p: np.ndarray


def fit(docs: DataFrame, path: str) -> LanguageModel:
    """Piece probabilities per language from ``docs`` (text as bytes, lang).

    Every word of every text is counted: its segmentations, weighted by the
    vocabulary's own scores, share it among the pieces. The driver gets a number for
    each piece and language.
    """
    vocabulary = Vocabulary(path)
    shares = {r.lang: r.n for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(shares)
    at = {lang: k for k, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary, vocabulary.prior)
        counts = np.zeros((len(vocabulary), len(at)))
        by_language = [Counter() for _ in at]

        def count() -> None:
            words = list(dict.fromkeys(w for by in by_language for w in by))
            for k in range(0, len(words), 10_000):
                part = words[k : k + 10_000]
                weights = np.array([[by[w] for by in by_language] for w in part], float)
                counts[:] += lattice.expected(part, weights)
            for by in by_language:
                by.clear()

        for batch in slices(batches, "text"):
            for text, lang in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                by_language[at[lang]].update(words_of(text))
                if sum(map(len, by_language)) > WORDS_AT_ONCE:
                    count()
        if any(by_language):
            count()
        rows, columns = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(columns), pa.array(counts[rows, columns])], ["piece", "lang", "n"]
        )

    parts = docs.select("text", "lang").mapInArrow(run, "piece long, lang long, n double")
    counts = np.zeros((len(vocabulary), len(languages)))
    for row in parts.groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect():
        counts[row.piece, row.lang] = row.n
    pooled = counts.sum(axis=1) + SMOOTHING * vocabulary.prior
    p = counts + SMOOTHING * (pooled / pooled.sum())[:, None]
    prior = np.array([shares[x] for x in languages], float)
    return LanguageModel(vocabulary, languages, prior / max(prior.sum(), 1.0), p / p.sum(axis=0))


def predict(
    docs: DataFrame, model: LanguageModel, text: str = "text", to: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with the columns ``to``: the predicted language and its score, the posterior probability
    of that language.

    Reads the whole text. A text that is null or has no letter, and every text if
    nothing was learned, is ``und`` with score 0. Columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c not in to]
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    content = free_name(docs, "content")
    source = docs.select(*columns_of(docs, kept), letters.alias("has_letters"), text_bytes(text).alias(content))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model.vocabulary, model.p, linear=True) if model.languages else None
        at: dict[str, int] = {}
        values = np.zeros((0, len(model.languages)))
        log_prior = np.log(model.prior)
        for batch in slices(batches, content):
            texts = [
                words_of(b) if letter and lattice else None
                for b, letter in zip(batch[content].to_pylist(), batch[len(kept)].to_pylist(), strict=True)
            ]
            if len(at) > WORDS_KEPT:
                at, values = {}, values[:0]
            new = list(dict.fromkeys(w for words in texts if words for w in words if w not in at))
            if new:
                at.update(zip(new, range(len(at), len(at) + len(new)), strict=True))
                values = np.vstack([values, lattice.score(new)])
            names, scores = [], []
            for words in texts:
                if not words:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = values[[at[w] for w in words]].sum(axis=0) + log_prior
                best = int(total.argmax())
                names.append(model.languages[best])
                scores.append(float(1.0 / np.exp(total - total[best]).sum()))
            columns = [batch[k] for k in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*kept, *to],
            )

    schema = T.StructType(source.schema.fields[:-2]).add(to[0], T.StringType()).add(to[1], T.DoubleType())
    return source.mapInArrow(run, schema)


def training_rows(documents: DataFrame) -> DataFrame:
    """The rows that may be learned from: text and lang given, not held out."""
    return documents.where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (id_remainder("doc_id", 4) != 2)
    ).select(text_bytes().alias("text"), "lang")


def languages(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``documents`` (doc_id, text, lang).

    Learns from the rows with a text and a lang whose crc32 of the id is not 2 modulo 4; a
    null id counts as the empty text. Repeated rows are learned from and predicted each;
    of equally likely languages the first by name is predicted. An empty table gives an
    empty result. Other columns are not read.
    """
    model = fit(training_rows(documents), path or tokenizer_path("piece_bpe_32k.model"))
    docs = documents.select("doc_id", "text", (id_remainder("doc_id", 4) == 2).alias("held_out"))
    return predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")


def known_language(documents: DataFrame, path: str | None = None, least: float = 0.5) -> DataFrame:
    """The rows of ``documents`` (doc_id, text, lang) whose language is told with a score of
    ``least`` or more.

    Null, empty and letterless texts go. Rows of equal ids or texts are judged each. All
    columns are kept, whatever their names.
    """
    model = fit(training_rows(documents), path or tokenizer_path("piece_bpe_32k.model"))
    told = predict(documents.select(row_of(documents), "text"), model)
    kept = told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.select(*columns_of_row(documents.columns))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))
