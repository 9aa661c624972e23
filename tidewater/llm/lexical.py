"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature has a key for each of its terms and, for a term that occurs 2, 4,
8 ... times, a further key a level. Documents of like size lie in one block, whose
signatures are stored by slices: a bitmap over the block's documents for each signature
bit. The bitmaps of a term's bits, and-ed, hold every document with the term and few
others, so a term's level is never underestimated and the weighted sum over an item's
terms bounds a document's score from above. Scores of the best bounded document of every
block give each item a score that k documents reach; every document whose bound is not
below that is scored exactly from its whole text.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import Remembered, slices, table, text_bytes, travels, written

travels(__name__)

RESULTS = 50
# A block holds so many different texts, or bytes of text, or one longer text.
BLOCK_TEXTS = 512
BLOCK_BYTES = 1 << 20
HASHES = 5
HASHES_KEPT = 500_000
# Terms whose document counts a task adds up before it hands them on.
TERMS_AT_ONCE = 200_000
# Items are searched in blocks of about so many bytes of text, one pass over the index each.
ITEM_BYTES = 128 << 10
# Terms of items summed at one time.
SUMMED_AT_ONCE = 8_192

# Letters and digits of ASCII, A-Z as a-z, and all bytes of other characters are terms'.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_TERM_BYTES).split()


def positions(hashes: np.ndarray, level: int | np.ndarray, bits: int) -> np.ndarray:
    """The signature bits of terms at a level, HASHES for each; ``bits`` is a power of two."""
    x = hashes + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    step = (x >> np.uint64(32)) | np.uint64(1)
    each = x[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return (each & np.uint64(bits - 1)).astype(np.int64)


class _Block:
    """Texts whose signatures have the same number of bits."""

    def __init__(self, bits: int):
        self.bits, self.size = bits, 0
        self.texts, self.ids, self.lengths, self.terms = [], [], [], []

    def add(self, text: bytes, ids: list, length: int, terms: tuple[np.ndarray, np.ndarray]) -> bool:
        """Takes a text with its terms' hashes and counts; true once the block is full."""
        self.texts.append(text)
        self.ids.append(ids)
        self.lengths.append(length)
        self.terms.append(terms)
        self.size += len(text)
        return len(self.texts) >= BLOCK_TEXTS or self.size >= BLOCK_BYTES

    def slices(self) -> bytes:
        hashes, counts = (np.concatenate(x) for x in zip(*self.terms, strict=True))
        rows = np.repeat(np.arange(len(self.terms)), [len(h) for h, _ in self.terms])
        bitmaps = np.zeros((self.bits, (len(self.texts) + 7) // 8), np.uint8)
        level = 0
        while len(rows):
            marks = np.repeat(np.uint8(128) >> (rows & 7).astype(np.uint8), HASHES)
            at = positions(hashes, level, self.bits).ravel()
            np.bitwise_or.at(bitmaps, (at, np.repeat(rows >> 3, HASHES)), marks)
            level += 1
            more = counts >= 1 << level
            rows, hashes, counts = rows[more], hashes[more], counts[more]
        return bitmaps.tobytes()


def _levels(counts: np.ndarray) -> np.ndarray:
    """The levels of terms with such counts: 1 for one, 2 for two or three, 3 up to seven ..."""
    return np.frexp(counts.astype(np.float64))[1]


def index_schema(documents: DataFrame) -> T.StructType:
    ids = T.ArrayType(T.ArrayType(documents.schema["doc_id"].dataType))
    rest = T.StructType.fromDDL(
        "bits int, lengths array<long>, texts array<binary>, slices binary, "
        "terms array<binary>, counts array<long>, n_documents long, n_terms long"
    )
    return T.StructType([T.StructField("ids", ids), *rest.fields])


def index_rows(documents: DataFrame) -> DataFrame:
    """The index of ``documents`` (doc_id, text): rows of blocks and rows of counts.

    A block row has bits, slices and, for each text, ids (of all its rows that met in
    one batch), lengths and texts. A count row has terms with the documents that hold
    them, or the numbers of documents and of their terms; a term may come in many rows.
    Null, empty and termless texts are in no row.
    """
    schema = index_schema(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, blocks, held = Remembered(HASHES_KEPT), {}, Counter()
        arrow, n_documents, n_terms = None, 0, 0

        def row(**values) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([values], arrow)

        def filled(b: _Block) -> pa.RecordBatch:
            return row(bits=b.bits, ids=b.ids, lengths=b.lengths, texts=b.texts, slices=b.slices())

        def hash_of(term: bytes) -> int:
            found = hashes.get(term)
            if found is None:
                hashes.put(term, found := xxhash.xxh3_64_intdigest(term))
            return found

        for batch in slices(batches, "text"):
            if arrow is None:
                id_type = batch.schema.field("doc_id").type
                long, binary = pa.int64(), pa.binary()
                arrow = pa.schema(
                    [
                        ("ids", pa.list_(pa.list_(id_type))), ("bits", pa.int32()), ("lengths", pa.list_(long)),
                        ("texts", pa.list_(binary)), ("slices", binary), ("terms", pa.list_(binary)),
                        ("counts", pa.list_(long)), ("n_documents", long), ("n_terms", long),
                    ]
                )
            rows_of = defaultdict(list)
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                rows_of[text].append(doc_id)
            words = {text: terms_of(text) for text in rows_of}
            texts = [text for text in rows_of if words[text]]
            if not texts:
                continue
            lengths = np.array([len(words[text]) for text in texts])
            copies = np.array([len(rows_of[text]) for text in texts])
            n_documents += int(copies.sum())
            n_terms += int(lengths @ copies)
            flat = pa.array(list(chain.from_iterable(words[text] for text in texts)), pa.binary()).dictionary_encode()
            del words
            terms = flat.dictionary.to_pylist()
            codes = flat.indices.to_numpy().astype(np.int64) + np.repeat(np.arange(len(texts)) * len(terms), lengths)
            pairs, counts = np.unique(codes, return_counts=True)
            of_text, codes = np.divmod(pairs, len(terms))
            documents_of = np.bincount(codes, copies[of_text], len(terms)).astype(np.int64).tolist()
            for term, n in zip(terms, documents_of, strict=True):
                held[term] += n
            hashed = np.array(list(map(hash_of, terms)), np.uint64)[codes]
            keys = np.bincount(of_text, _levels(counts)).astype(np.int64).tolist()
            ends = np.searchsorted(of_text, np.arange(len(texts) + 1)).tolist()
            for k, text in enumerate(texts):
                bits = 8 << (keys[k] - 1).bit_length()
                own = hashed[ends[k] : ends[k + 1]], counts[ends[k] : ends[k + 1]]
                if blocks.setdefault(bits, _Block(bits)).add(text, rows_of[text], int(lengths[k]), own):
                    yield filled(blocks.pop(bits))
            if len(held) >= TERMS_AT_ONCE:
                yield row(terms=list(held), counts=list(held.values()))
                held.clear()
        for block in blocks.values():
            yield filled(block)
        if held:
            yield row(terms=list(held), counts=list(held.values()))
        if n_documents:
            yield row(n_documents=n_documents, n_terms=n_terms)

    return documents.select("doc_id", text_bytes().alias("text")).mapInArrow(run, schema)


class Query:
    """Items against blocks of an index."""

    def __init__(self, items: list[list[int]], terms: list[bytes], weights: list[int], n_documents: int, n_terms: int):
        self.numbers = {t: k for k, t in enumerate(terms)}
        self.weights = np.array(weights, np.int64)
        self.n_documents, self.n_terms = n_documents, n_terms
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in terms], np.uint64)
        self.at = {}
        # Each item's terms one after another, and where each item begins.
        self.rows = np.concatenate([np.array(i, np.int64) for i in items])
        self.starts = np.concatenate([[0], np.cumsum([len(i) for i in items])])[:-1]

    def measure(self, length: int) -> int:
        """m of a document with so many terms."""
        return 100 - 50 + 50 * length * self.n_documents // self.n_terms

    def levels(self, bits: int, bitmaps: np.ndarray, texts: int) -> np.ndarray:
        """How many levels of each term each document may have: at least as many as it has."""
        out = np.zeros((len(self.hashes), texts), np.int8)
        live, level, before = np.arange(len(self.hashes)), 0, None
        while len(live):
            at = self.at.get((bits, level))
            if at is None:
                at = self.at[bits, level] = positions(self.hashes, level, bits)
            here = bitmaps[at[live, 0]]
            for k in range(1, HASHES):
                here &= bitmaps[at[live, k]]
            if before is not None:
                here &= before
            some = here.any(axis=1)
            live, before = live[some], here[some]
            out[live] += np.unpackbits(before, axis=1, count=texts).view(np.int8)
            level += 1
        return out

    def bounds(self, block: dict) -> np.ndarray:
        """Upper bounds of the scores, a row an item and a column a text of the block."""
        lengths = np.array(block["lengths"], np.int64)
        bitmaps = np.frombuffer(block["slices"], np.uint8).reshape(block["bits"], -1)
        levels = self.levels(block["bits"], bitmaps, len(lengths))
        # A term with n levels occurs less than 2^n times and no more often than there are terms.
        most = np.minimum((np.int64(1) << np.arange(int(levels.max(initial=0)) + 1))[:, None] - 1, lengths)
        m = np.array([self.measure(int(n)) for n in lengths], np.int64)
        parts = 1_000_000_000 * most // (1000 * most + 20 * m)
        terms, texts = np.nonzero(levels)
        worth = np.zeros(levels.shape, np.int64)
        worth[terms, texts] = parts[levels[terms, texts], texts] * self.weights[terms]
        out = np.empty((len(self.starts), len(lengths)), np.int64)
        ends = np.append(self.starts, len(self.rows))
        first = 0
        while first < len(self.starts):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + SUMMED_AT_ONCE, "right")) - 1)
            rows = self.rows[ends[first] : ends[last]]
            out[first:last] = np.add.reduceat(worth[rows], ends[first:last] - ends[first], axis=0)
            first = last
        return out

    def scores(self, text: bytes, length: int) -> np.ndarray:
        """The exact score of a text for every item."""
        worth, m = np.zeros(len(self.weights), np.int64), self.measure(length)
        found = [(k, n) for t, n in Counter(terms_of(text)).items() if (k := self.numbers.get(t)) is not None]
        for k, n in found:
            worth[k] = self.weights[k] * (1_000_000_000 * n // (1000 * n + 20 * m))
        return np.add.reduceat(worth[self.rows], self.starts)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _reached(blocks: DataFrame, query: Query, k: int) -> dict[int, int]:
    """For each item a score that at least ``k`` documents reach; none where fewer are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = defaultdict(list)
        for block in _block_rows(batches):
            bounds = query.bounds(block)
            first = bounds.argmax(axis=1)
            for t in np.unique(first):
                scores = query.scores(block["texts"][t], block["lengths"][t])
                copies = min(len(block["ids"][t]), k)
                for i in np.flatnonzero((first == t) & (scores > 0)).tolist():
                    best[i] += [int(scores[i])] * copies
                    if len(best[i]) > 4 * k:
                        best[i] = sorted(best[i])[-k:]
        if best:
            best = {i: sorted(scores)[-k:] for i, scores in best.items()}
            items = [i for i, scores in best.items() for _ in scores]
            scores = [s for scores in best.values() for s in scores]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(scores, pa.int64())], ["item", "score"])

    found = blocks.select("bits", "ids", "lengths", "texts", "slices").mapInArrow(run, "item int, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    kth = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).where(F.col("n") == k)
    return {r["item"]: r["score"] for r in kth.collect()}


def _searched(blocks: DataFrame, query: Query, reached: dict[int, int], n_items: int, k: int) -> DataFrame:
    """item, doc_id and score of all documents whose bound may be among the ``k`` best."""
    id_type = blocks.schema["ids"].dataType.elementType.elementType
    schema = T.StructType().add("item", T.IntegerType()).add("doc_id", id_type).add("score", T.LongType())
    least = np.array([max(1, reached.get(i, 1)) for i in range(n_items)], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrow = batch.schema.field("ids").type.value_type.value_type
            for block in _block_rows([batch]):
                possible = query.bounds(block) >= least[:, None]
                items, ids, found = [], [], []
                for t in np.flatnonzero(possible.any(axis=0)).tolist():
                    scores = query.scores(block["texts"][t], block["lengths"][t])
                    own = block["ids"][t]
                    if len(own) > k:
                        own = sorted(own, key=lambda x: (x is not None, x))[:k]
                    for i in np.flatnonzero(possible[:, t] & (scores >= least)).tolist():
                        items += [i] * len(own)
                        ids += own
                        found += [int(scores[i])] * len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int32()), pa.array(ids, arrow), pa.array(found, pa.int64())],
                    ["item", "doc_id", "score"],
                )

    return blocks.select("bits", "ids", "lengths", "texts", "slices").mapInArrow(run, schema)


def search(index: DataFrame, items: DataFrame, k: int = RESULTS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents for each of ``items``.

    ``index`` is a stored table of ``index_rows``. Every different row (item_id, text)
    of ``items`` is an item of its own; null texts and texts without a term that a
    document holds find nothing. Equal scores go by ascending doc_id, nulls first; rows
    that repeat in the documents are ranked each. No documents or items: no rows.
    """
    spark = index.sparkSession
    id_type = index.schema["ids"].dataType.elementType.elementType
    schema = T.StructType().add("item_id", items.schema["item_id"].dataType).add("rank", T.IntegerType())
    out = spark.createDataFrame([], schema.add("doc_id", id_type).add("score", T.LongType()))
    totals = index.agg(F.sum("n_documents").alias("n"), F.sum("n_terms").alias("l")).first()
    if not totals.n:
        return out
    asked = items.select("item_id", text_bytes().alias("text")).distinct()
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = math.ceil(size / ITEM_BYTES)
    blocks = index.where("slices is not null")
    for part in range(parts):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        words = [sorted(set(terms_of(bytes(r.text)))) for r in own]
        wanted = spark.createDataFrame([(t,) for t in sorted(set().union(*words))], "term binary")
        # Terms of one block of items: bounded by ITEM_BYTES.
        held = (
            index.where("terms is not null")
            .select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
            .select(F.col("x.terms").alias("term"), F.col("x.counts").alias("n"))
            .join(F.broadcast(wanted), "term")
            .groupBy("term")
            .agg(F.sum("n").alias("df"))
            .collect()
        )
        terms = [bytes(r.term) for r in held]
        weights = [math.floor(1000 * math.log((2 * totals.n + 2) / (2 * r.df + 1))) for r in held]
        number = {t: x for x, t in enumerate(terms)}
        known = [(r.item_id, [number[t] for t in ws if t in number]) for r, ws in zip(own, words, strict=True)]
        known = [(item_id, ws) for item_id, ws in known if ws]
        if not known:
            continue
        query = Query([ws for _, ws in known], terms, weights, totals.n, totals.l)
        reached = _reached(blocks, query, k)
        found = _searched(blocks, query, reached, len(known), k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(
            [(x, item_id) for x, (item_id, _) in enumerate(known)], T.StructType().add("item", T.IntegerType()).add(schema["item_id"])
        )
        ranked = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = written(ranked, "lexical-ranks") if parts == 1 else out.unionByName(written(ranked, "lexical-ranks"))
    return out


def ranked_search(documents: DataFrame, items: DataFrame, k: int = RESULTS) -> DataFrame:
    """``search`` of ``items`` (item_id, text) over ``documents`` (doc_id, text), indexed for it."""
    return search(written(index_rows(documents), "lexical-index"), items, k)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = """regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

OP11_SQL = f"""
WITH words AS (SELECT doc_id, unnest({_TERMS_SQL}) AS term FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM sizes),
held AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM held, totals GROUP BY term, big_n),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark),
scored AS (
    SELECT item_id, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (doc_id), totals
    GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
