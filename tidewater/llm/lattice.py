"""Log-space sums over all segmentations of words into vocabulary pieces.

Words are processed together by length: the arcs of all words of a length form one
array, and the forward recursion runs over character positions. A character that is
no piece stands for the bytes of its UTF-8 form. ``L`` models (languages, say) are
scored at once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import sentencepiece

from tidewater.llm.common import travels

travels(__name__)

MARK = "▁"
# Words longer than this are summed position by position.
LONG = 64
# Arcs held at one time.
ARCS_AT_ONCE = 400_000


class Vocabulary:
    """The pieces of a public vocabulary file: rows 0..n-1, single bytes included.

    ``prior`` turns the file's scores into probabilities. Scores of a merge-type file
    are negated ranks, which a Zipf law maps to frequencies.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rows: dict[str, int] = {}
        self.byte_rows: dict[int, int] = {}
        scores = []
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_rows[int(piece[3:5], 16)] = len(scores)
            else:
                self.rows[piece] = len(scores)
            scores.append(model.get_score(i))
        rank = -np.asarray(scores)
        lowest = rank[rank < 1e8].max()
        for row in self.byte_rows.values():
            rank[row] = lowest
        self.prior = 1.0 / (np.minimum(rank, lowest) + 3.0)
        self.prior /= self.prior.sum()

    def __len__(self) -> int:
        return len(self.prior)


class _PieceTable:
    """Row of every piece by a 64-bit hash of its characters, for arrays of substrings."""

    BITS = 17
    ODD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, at: dict[str, int]):
        hashes = np.array([self.of_piece(piece) for piece in at], np.uint64)
        rows = np.array(list(at.values()), np.int64)
        self.levels: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        # What shares a slot goes to a further table with other slots.
        while len(hashes):
            shift = np.uint64(64 - self.BITS - len(self.levels))
            slots, first = np.unique((hashes * self.ODD) >> shift, return_index=True)
            keys, values = np.zeros(1 << self.BITS, np.uint64), np.zeros(1 << self.BITS, np.int64)
            slots = slots & np.uint64((1 << self.BITS) - 1)
            keys[slots], values[slots] = hashes[first], rows[first]
            self.levels.append((shift, keys, values))
            left = self.find(hashes) != rows
            hashes, rows = hashes[left], rows[left]

    @classmethod
    def of_piece(cls, piece: str) -> int:
        h = 0
        for c in piece:
            h = ((h ^ ord(c)) + 1) * int(cls.ODD) % 2**64
        return h

    @classmethod
    def longer(cls, h: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Hashes of substrings made one character longer."""
        return ((h ^ codes) + np.uint64(1)) * cls.ODD

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rows, 0 where there is no such piece."""
        mixed = hashes * self.ODD
        out = np.zeros(hashes.shape, np.int64)
        for shift, keys, values in self.levels:
            slots = ((mixed >> shift) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)
            np.copyto(out, values[slots], where=keys[slots] == hashes)
        return out


def _log_sum(terms: np.ndarray) -> np.ndarray:
    top = terms.max(axis=0)
    return top + np.log(np.exp(terms - top).sum(axis=0))


class Lattice:
    """Marginal log-probabilities of words under ``p`` (pieces x L)."""

    def __init__(self, vocabulary: Vocabulary, p: np.ndarray, linear: bool = False):
        """``linear`` sums probabilities themselves where they are no smaller than 1e-250."""
        self.linear = linear
        p = p.reshape(len(vocabulary), -1)
        # Row 0 is the arc that does not exist.
        self.log_p = np.vstack([np.full((1, p.shape[1]), -np.inf), np.log(p)])
        self.p = np.exp(self.log_p)
        self.at = {piece: row + 1 for piece, row in vocabulary.rows.items()}
        self.byte_at = {b: row + 1 for b, row in vocabulary.byte_rows.items()}
        self.longest = max(map(len, self.at))
        self.known = {c for c in self.at if len(c) == 1}
        self.size = len(vocabulary)
        self.extra: list[list[int]] = []
        self.table = _PieceTable(self.at)
        self.spans: dict[int, list[tuple[int, int]]] = {}

    def _learn(self, word: str) -> None:
        """Gives every character without a piece a row of its bytes' sum."""
        rows = []
        for c in set(word) - self.known:
            parts = [self.byte_at[b] for b in c.encode("utf-8", "surrogatepass")]
            self.at[c] = len(self.log_p) + len(rows)
            self.known.add(c)
            self.extra.append(parts)
            rows.append(self.log_p[parts].sum(axis=0))
        self.log_p = np.vstack([self.log_p, *rows])
        self.p = np.exp(self.log_p)
        self.table = _PieceTable(self.at)

    def _arcs(self, words: Sequence[str], n: int) -> np.ndarray:
        """Rows of the substrings of ``words``, all of length ``n``, by end and start."""
        if n not in self.spans:
            self.spans[n] = [
                (i, j) for j in range(1, n + 1) for i in range(max(0, j - self.longest), j)
            ]
        text = "".join(words)
        if not self.known.issuperset(text):
            self._learn(text)
        at = {span: k for k, span in enumerate(self.spans[n])}
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.reshape(len(words), n).T.astype(np.uint64)
        arcs = np.empty((len(at), len(words)), np.int64)
        hashes = np.zeros_like(codes)
        for k in range(1, min(n, self.longest) + 1):
            hashes = self.table.longer(hashes[: n - k + 1], codes[k - 1 :])
            arcs[[at[i, i + k] for i in range(n - k + 1)]] = self.table.find(hashes)
        return arcs

    def _forward_linear(self, arcs: np.ndarray, n: int) -> np.ndarray:
        total = np.empty((n + 1, arcs.shape[1], self.p.shape[1]))
        total[0] = 1.0
        k = 0
        for j in range(1, n + 1):
            first = max(0, j - self.longest)
            np.einsum("iwl,iwl->wl", total[first:j], self.p[arcs[k : k + j - first]], out=total[j])
            k += j - first
        return total

    def _forward(self, arcs: np.ndarray, n: int) -> np.ndarray:
        width = arcs.shape[1]
        total = np.empty((n + 1, width, self.log_p.shape[1]))
        total[0] = 0.0
        k = 0
        for j in range(1, n + 1):
            first = max(0, j - self.longest)
            terms = total[first:j] + self.log_p[arcs[k : k + j - first]]
            total[j] = _log_sum(terms)
            k += j - first
        return total

    def _long(self, word: str) -> np.ndarray:
        if not self.known.issuperset(word):
            self._learn(word)
        get, recent = self.at.get, [np.zeros(self.log_p.shape[1])]
        for j in range(1, len(word) + 1):
            first = max(0, j - self.longest)
            arcs = [get(word[i:j], 0) for i in range(first, j)]
            recent = recent[-self.longest :]
            recent.append(_log_sum(np.array(recent) + self.log_p[arcs]))
        return recent[-1]

    def _by_length(self, words: Sequence[str]):
        groups = defaultdict(list)
        for at, w in enumerate(words):
            groups[len(w)].append(at)
        for n, where in groups.items():
            step = max(1, ARCS_AT_ONCE // (n * min(n, self.longest)))
            for k in range(0, len(where), step):
                yield n, where[k : k + step]

    def score(self, words: Sequence[str]) -> np.ndarray:
        """Natural-log probability of each word (words x L), a word mark before it."""
        words = [MARK + w for w in words]
        out = np.zeros((len(words), self.log_p.shape[1]))
        for n, where in self._by_length(words):
            if n > LONG:
                for at in where:
                    out[at] = self._long(words[at])
                continue
            arcs = self._arcs([words[at] for at in where], n)
            if not self.linear:
                out[where] = self._forward(arcs, n)[n]
                continue
            found = self._forward_linear(arcs, n)[n]
            small = np.flatnonzero((found < 1e-250).any(axis=1))
            with np.errstate(divide="ignore"):
                found = np.log(found)
            if len(small):
                found[small] = self._forward(arcs[:, small], n)[n]
            out[where] = found
        return out

    def expected(self, words: Sequence[str], weights: np.ndarray) -> np.ndarray:
        """Expected piece counts (pieces x columns of ``weights``) under model 0.

        A word over ``LONG`` characters is counted in parts of that length.
        """
        cut, owner = [], []
        for at, w in enumerate(words):
            w = MARK + w
            for k in range(0, len(w), LONG):
                cut.append(w[k : k + LONG])
                owner.append(at)
        weights = weights[np.array(owner, np.int64)] if owner else weights
        counts = np.zeros((self.size + 1, weights.shape[1]))
        for n, where in self._by_length(cut):
            arcs = self._arcs([cut[at] for at in where], n)
            spans = self.spans[n]
            before = self._forward(arcs, n)[:, :, 0]
            log_p = self.log_p[:, 0][arcs]
            after = np.empty((n + 1, len(where)))
            after[n] = 0.0
            starts = defaultdict(list)
            for k, (i, _) in enumerate(spans):
                starts[i].append(k)
            ends = np.array([j for _, j in spans])
            for i in range(n - 1, -1, -1):
                after[i] = _log_sum(log_p[starts[i]] + after[ends[starts[i]]])
            first = np.array([i for i, _ in spans])
            share = np.exp(before[first] + log_p + after[ends] - before[n])
            for c in range(weights.shape[1]):
                found = np.bincount(
                    arcs.ravel(),
                    (share * weights[where, c]).ravel(),
                    minlength=len(self.log_p),
                )
                counts[:, c] += found[: self.size + 1]
                for k, parts in enumerate(self.extra):
                    if found[self.size + 1 + k]:
                        np.add.at(counts[:, c], parts, found[self.size + 1 + k])
        return counts[1:]
