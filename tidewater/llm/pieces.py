"""SentencePiece encoding and decoding for merge-type vocabularies.

A word's adjacent symbol pairs wait in an agenda ordered by the score of the piece
they form; the best pair, the leftmost among equals, merges first. Words are encoded
once per task, or worker process, while it remembers them, and each newly met word is
compared with the sentencepiece library.
"""

from __future__ import annotations

import heapq
import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import Remembered, columns_of, free_name, kept, slices, table, text_bytes, tokenizer_path, travels

travels(__name__)

MARK = "▁"
# Words, and parts of words, whose ids a task keeps for later texts, and a worker process.
WORDS_KEPT = 120_000
WORDS_KEPT_BY_WORKER = 300_000
# Words up to this length have their agenda in a list.
SHORT = 48
NONE = float("-inf")


class MergeEncoder:
    """A merge-type (BPE) vocabulary file with byte fallback and identity normalisation.

    Other files are refused: unigram vocabularies, files that rewrite characters and
    files with pieces over a word's end, since words are encoded one by one.
    """

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.library
        if model.normalize(" Ａﬁ  é\n") != f"{MARK}{MARK}Ａﬁ{MARK}{MARK}é\n":
            raise ValueError("the vocabulary's normalisation is not the identity")
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.texts: list[str | int | None] = []
        for i in range(model.get_piece_size()):
            piece, text = model.id_to_piece(i), None
            if model.is_byte(i):
                text = int(piece[3:5], 16)
                self.byte_ids[text] = i
            elif model.is_unknown(i):
                text = model.decode([i])
            elif not (model.is_control(i) or model.is_unused(i)):
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"a piece goes over a word's end: {piece!r}")
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                text = piece.replace(MARK, " ")
            self.texts.append(text)
        if len(self.byte_ids) < 256:
            raise ValueError("the vocabulary has no byte fallback")
        self.marked = {i for piece, i in self.ids.items() if piece.startswith(MARK)}
        self.special = np.array([not isinstance(t, str) for t in self.texts])
        self.beside = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        self.words, self.segments = Remembered(words_kept), Remembered(words_kept)
        self.unproven: list[tuple[str, bytes]] = []

    def merged(self, word: str) -> list[str]:
        """The symbols of ``word`` after all merges."""
        if len(word) > SHORT:
            return self._merged_long(word)
        # The agenda of a short word is the list of its pairs' scores, left to right.
        get, symbols = self.scores.get, list(word)
        agenda = [get(a + b, NONE) for a, b in zip(word, word[1:])]
        while agenda and (best := max(agenda)) != NONE:
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = get(symbols[i - 1] + symbols[i], NONE)
            if i < len(agenda):
                agenda[i] = get(symbols[i] + symbols[i + 1], NONE)
        return symbols

    def _merged_long(self, word: str) -> list[str]:
        """The same with the agenda in a heap, from which stale pairs are skipped."""
        scores, symbols = self.scores, list(word)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            score = scores.get(pair := symbols[i] + symbols[j])
            if score is not None:
                heapq.heappush(agenda, (-score, i, pair))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            j = right[i] if symbols[i] else n
            # A pair goes stale when one of its sides has merged otherwise.
            if j >= n or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
                offer(i, right[i])
            if left[i] >= 0:
                offer(left[i], i)
        return [s for s in symbols if s]

    def _segment_ids(self, segment: str) -> bytes:
        ids = self.segments.get(segment)
        if ids is None:
            out: list[int] = []
            for symbol in self.merged(segment):
                found = self.ids.get(symbol)
                if found is not None:
                    out.append(found)
                else:
                    out.extend(self.byte_ids[b] for b in symbol.encode())
            ids = struct.pack(f"={len(out)}i", *out)
            self.segments.put(segment, ids)
            if segment[0] == MARK:
                self.unproven.append((segment, ids))
        return ids

    def _word_ids(self, word: str) -> bytes:
        """Parts a word from punctuation behind it where no piece has both side by side."""
        core = word.rstrip(".,!?:;")
        n = len(core)
        if 1 < n < len(word) and (core[-1], word[n]) not in self.beside:
            return self._segment_ids(core) + self._segment_ids(word[n:])
        return self._segment_ids(word)

    def _check(self) -> None:
        """Compares the words met since the last call with the library."""
        # The library puts one mark before the text, so the word's own first mark goes;
        # no text gives a mark alone, which is the piece itself.
        proven = [(w, ids) for w, ids in self.unproven if w != MARK]
        texts = [w[1:].replace(MARK, " ") for w, _ in proven]
        found = self.library.encode(texts, num_threads=1)
        flat = np.fromiter(itertools.chain.from_iterable(found), np.int32)
        if flat.tobytes() != b"".join([ids for _, ids in proven]):
            for (word, ids), other in zip(proven, found, strict=True):
                if np.frombuffer(ids, np.int32).tolist() != other:
                    raise RuntimeError(f"the library encodes {word!r} otherwise")
        self.unproven.clear()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        get, put, out = self.words.get, self.words.put, []
        for text in texts:
            if not text:
                out.append(np.zeros(0, np.int32))
                continue
            if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
                words = re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))
            else:
                words = (MARK + text.replace(" ", f" {MARK}")).split(" ")
            parts = list(map(self.words.new.get, words))
            if None in parts:
                for k, ids in enumerate(parts):
                    if ids is None:
                        word = words[k]
                        ids = get(word)
                        if ids is None:
                            ids = self._word_ids(word)
                            put(word, ids)
                        parts[k] = ids
            out.append(np.frombuffer(b"".join(parts), np.int32))
        self._check()
        return out

    def decode_array(self, ids: np.ndarray) -> str:
        """``decode`` with less work where no single bytes occur."""
        if len(ids) == 0 or self.special[ids].any() or int(ids[0]) not in self.marked:
            return self.decode(ids.tolist())
        return "".join(map(self.texts.__getitem__, ids.tolist()))[1:]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: byte runs as UTF-8, without the first word's mark."""
        parts: list[str] = []
        run = bytearray()
        first = True
        for i in ids:
            text = self.texts[i]
            if first and text is not None:
                first = False
                if isinstance(text, str):
                    text = text.removeprefix(" ") if i in self.marked else text
            if isinstance(text, int):
                run.append(text)
                continue
            if run:
                parts.append(_from_bytes(run))
                run.clear()
            if text is not None:
                parts.append(text)
        if run:
            parts.append(_from_bytes(run))
        return "".join(parts)


def kept_encoder(path: str) -> MergeEncoder:
    """The encoder of a file, which stays in a worker process with its words.

    Words that a failed task left uncompared are still compared by the next one.
    """
    return kept(f"merge encoder of {path}", lambda: MergeEncoder(path, WORDS_KEPT_BY_WORKER))


def _from_bytes(run: bytearray) -> str:
    """Each byte outside a valid character becomes one replacement character."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[i : i + n]).decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


def encode(
    docs: DataFrame,
    text: str = "text",
    to: str = "ids",
    decoded: str | None = None,
    path: str | None = None,
    keep_words: bool = False,
) -> DataFrame:
    """``docs`` with the ids of ``text`` in place of the text, as array<int> ``to``.

    Whole texts, without begin or end ids. A null text is empty and has no ids.
    ``decoded`` names a column for what the ids decode to. Columns that have these names
    already are replaced. ``keep_words`` leaves the encoder and its words in the worker
    processes for later tasks, where their memory is not needed by other work.
    """
    path = path or tokenizer_path("piece_bpe_32k.model")
    kept = [c for c in docs.columns if c not in (text, to, decoded)]
    content = free_name(docs, "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(path) if keep_words else MergeEncoder(path)
        for batch in slices(batches, content):
            ids = encoder.encode([b.decode() for b in batch[content].to_pylist()])
            starts = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate([*ids, np.zeros(0, np.int32)])
            columns = [batch[k] for k in range(len(kept))]
            columns.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat)))
            if decoded:
                columns.append(pa.array(map(encoder.decode_array, ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [*kept, to, *([decoded] if decoded else [])]
    rows = docs.select(*columns_of(docs, kept), text_bytes(text).alias(content))
    schema = T.StructType(rows.schema.fields[:-1]).add(to, T.ArrayType(T.IntegerType()))
    schema = schema.add(decoded, T.StringType()) if decoded else schema
    return rows.mapInArrow(run, schema)


def decode(docs: DataFrame, ids: str = "ids", to: str = "decoded", path: str | None = None) -> DataFrame:
    """``docs`` with the text of ``ids`` added; null ids give an empty text."""
    path = path or tokenizer_path("piece_bpe_32k.model")
    kept = [c for c in docs.columns if c != to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = MergeEncoder(path)
        for batch in batches:
            texts = [encoder.decode(x or []) for x in batch[ids].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in kept], pa.array(texts, pa.string())], [*kept, to]
            )

    return docs.select(*kept).mapInArrow(run, docs.select(*kept).schema.add(to, "string"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, decoded="decoded", keep_words=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
