"""Token ids in ORC files, in document order.

ORC writes the ids of a stripe with integer run-length encoding, keeps minima and
maxima of document ids per stripe and row group and a Bloom filter on them, so that
readers take stripes in parallel and skip those without the wanted documents.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidewater.llm.common import Remembered, kept, slices, table, text_bytes, tokenizer_path, travels
from tidewater.session import work_dir

travels(__name__)

END_ID = 1
# Words without punctuation whose ids a worker process keeps for later texts.
WORDS_KEPT = 150_000
# Runs of letters that the library gets as one text.
WORDS_TOGETHER = 1_000
PUNCTUATION = ".,!?:;"
# Bytes of text encoded at one time, one longer text aside: columns, not Python objects.
ENCODED_AT_ONCE = 4 << 20


class WordEncoder:
    """Encodes each word between white space once while it is remembered.

    The vocabulary's rules never look over white space, take letters of either case as
    the same, part a letter or digit from ASCII punctuation behind it, and end each run
    of letters with an id that no run has before its end.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.words = Remembered(WORDS_KEPT)
        self.last: dict[str, bool] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True

    def _library(self, words: list[str]) -> list[bytes]:
        """The ids of each of ``words``, which hold no white space."""
        encode = self.tokenizer.encode_batch_fast
        runs = [k for k, text in enumerate(words) if text.isalpha()]
        out: list[bytes | None] = [None] * len(words)
        # Runs of letters go as one text for each WORDS_TOGETHER, cut after their ends.
        together = [runs[k : k + WORDS_TOGETHER] for k in range(0, len(runs), WORDS_TOGETHER)]
        joined = encode([" ".join([words[k] for k in part]) for part in together], add_special_tokens=False)
        for part, found in zip(together, joined, strict=True):
            ids = np.array(found.ids, np.int32)
            edges = np.flatnonzero(self.ends[ids]) + 1
            if len(edges) == len(part):
                raw, first = ids.tobytes(), 0
                for k, last in zip(part, (4 * edges).tolist(), strict=True):
                    out[k] = raw[first:last]
                    first = last
        others = [k for k, ids in enumerate(out) if ids is None]
        for k, found in zip(others, encode([words[k] for k in others], add_special_tokens=False), strict=True):
            out[k] = struct.pack(f"={len(found.ids)}i", *found.ids)
        return out

    def _parts_from_punctuation(self, last: str) -> bool:
        """Whether punctuation behind this character is a run of its own.

        The rules see the normalised text, in which some letters end in a mark, and a
        mark and punctuation are one run.
        """
        found = self.last.get(last)
        if found is None:
            plain = self.tokenizer.normalizer.normalize_str(last) if last.isalnum() else ""
            found = self.last[last] = bool(plain) and plain[-1].isalnum()
        return found

    def _cut(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words without their last punctuation, where it is a run of its own, and which these are."""
        cores = pc.utf8_rtrim(words, PUNCTUATION)
        sizes = pc.binary_length(cores).to_numpy()
        shorter = (sizes > 0) & (sizes < pc.binary_length(words).to_numpy())
        last = pc.utf8_slice_codeunits(cores, -1).dictionary_encode()
        parts = np.array([self._parts_from_punctuation(c) for c in last.dictionary.to_pylist()], bool)
        cut = shorter & parts[last.indices.to_numpy()] if len(parts) else shorter
        return pc.if_else(pa.array(cut), cores, words), cut

    def _ids(self, words: pa.Array) -> pa.ListArray:
        """The ids of different words."""
        texts = words.to_pylist()
        known, older, missing = self.words.turn(), self.words.old, []
        found = list(map(known.get, texts))
        for k in [k for k, ids in enumerate(found) if ids is None]:
            ids = older.get(texts[k])
            if ids is None:
                missing.append(k)
            else:
                found[k] = known[texts[k]] = ids
        for k, ids in zip(missing, self._library([texts[k] for k in missing]), strict=True):
            found[k] = known[texts[k]] = ids
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        # Special tokens are told apart by case.
        plain = pa.array([t if b"<|" in t else t.lower() for t in texts], pa.binary()).cast(pa.string())
        split = pc.ascii_split_whitespace(plain)
        owners = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
        flat = split.flatten()
        some = pc.not_equal(pc.binary_length(flat), 0)
        owners, flat = owners[some.to_numpy(zero_copy_only=False)], flat.filter(some)
        if not len(flat):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        words = flat.dictionary_encode()
        which, words = words.indices.to_numpy(), words.dictionary
        cores, cut = self._cut(words)
        tails = _tails(words, cores, cut)
        parts = pa.concat_arrays([cores, tails]).dictionary_encode()
        ids = self._ids(parts.dictionary)
        part = parts.indices.to_numpy()
        core_of, tail_of = part[: len(words)], np.zeros(len(words), np.int64)
        tail_of[cut] = part[len(words) :]
        # Each word's place is that of its first part; cut words have a second one.
        more = cut[which]
        at = np.arange(len(which)) + np.cumsum(more) - more
        sequence = np.empty(len(which) + int(more.sum()), np.int64)
        sequence[at] = core_of[which]
        sequence[at[more] + 1] = tail_of[which[more]]
        sizes = np.diff(ids.offsets.to_numpy())
        per_word = sizes[core_of[which]] + np.where(more, sizes[tail_of[which]], 0)
        counts = np.bincount(owners, per_word, len(texts)).astype(np.int64)
        return ids.take(pa.array(sequence)).flatten().to_numpy(), counts


def _tails(words: pa.Array, cores: pa.Array, cut: np.ndarray) -> pa.Array:
    """What follows the core of the words that are cut."""
    words = words.filter(pa.array(cut))
    before = pc.binary_length(cores.filter(pa.array(cut))).to_numpy()
    starts = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words)] + before
    sizes = pc.binary_length(words).to_numpy() - before
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    data = np.frombuffer(words.buffers()[2], np.uint8)[at] if len(at) else np.zeros(0, np.uint8)
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(data))


def token_schema(documents: DataFrame) -> T.StructType:
    """Columns of the files; ids of documents keep their type."""
    rest = T.StructType.fromDDL("part int, part_start long, n_tokens int, ids array<int>")
    return T.StructType([documents.schema["doc_id"], *rest.fields])


def encode(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``token_schema`` rows from ``docs`` (doc_id, text as bytes), whose partitions hold ascending ids.

    ``part_start`` counts the ids before a document in its partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = kept(f"word encoder of {path}", lambda: WordEncoder(path))
        part, start = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", ENCODED_AT_ONCE):
            ids, sizes = encoder.encode(batch["text"].to_pylist())
            ends = np.cumsum(sizes)
            flat = np.insert(ids, ends, end_id).astype(np.int32)
            sizes = sizes + 1
            starts = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(np.full(len(sizes), part, np.int32)),
                    pa.array(starts),
                    pa.array(sizes.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                ["doc_id", "part", "part_start", "n_tokens", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, token_schema(docs))


def write_token_files(documents: DataFrame, folder: str, path: str, end_id: int = END_ID) -> None:
    """Writes the ids of every whole text, in ascending order of doc_id, to ORC ``folder``.

    A null text is empty and has the end id only; null ids come first; rows of equal
    ids come in the order of a hash of their text, and may lie in several files. No
    documents leave files without rows. Ids of any type that ORC orders will do; no
    other column is read.
    """
    docs = documents.select("doc_id", text_bytes().alias("text"))
    # Rows that share an id, and copies of one row, are spread over tasks too.
    docs = docs.withColumns({"h": F.xxhash64("text"), "n": F.monotonically_increasing_id()})
    ordered = docs.repartitionByRange("doc_id", "h", "n").sortWithinPartitions("doc_id", "h", "n")
    (
        encode(ordered, path, end_id)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(16 << 20))
        .option("orc.compress", "ZSTD")
        .orc(folder)
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids of the files.

    A part's ids are counted from its last document; the table of parts has a row for
    each partition written.
    """
    rows = spark.read.orc(folder)
    sizes = rows.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("n")).collect()
    offset, offsets = 0, []
    for row in sorted(sizes, key=lambda r: r.part):
        offsets.append((row.part, offset))
        offset += row.n
    before = spark.createDataFrame(offsets, "part int, before long")
    return rows.join(F.broadcast(before), "part").select(
        "doc_id",
        (F.col("part_start") + F.col("before")).alias("start"),
        F.col("n_tokens").cast("long").alias("n_tokens"),
        "ids",
    )


def documents_in(spark: SparkSession, folder: str, doc_ids: Sequence) -> DataFrame:
    """The stored rows of some documents.

    Readers leave out stripes and row groups whose range or Bloom filter has none of
    the ids.
    """
    return spark.read.orc(folder).where(F.col("doc_id").isin(list(doc_ids)))


def with_crc32(rows: DataFrame, ids: str = "ids", to: str = "ids_crc32") -> DataFrame:
    """``rows`` with the crc32 of ``ids`` as little-endian 32-bit integers, without the ids."""
    kept = [c for c in rows.columns if c not in (ids, to)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch[ids]
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in kept], pa.array(sums, pa.int64())], [*kept, to]
            )

    return rows.mapInArrow(run, rows.select(*kept).schema.add(to, "long"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_path("word_bpe_49k.json"))
    return with_crc32(read_token_files(spark, folder))
