"""Secrets in texts: known forms, and strings too random to be words.

Candidates of the second kind are runs of a character class. Over each run slides a
window whose Shannon entropy follows from the counts of its characters, one more and one
less at each step. Windows at or over the class's entropy make a span, unless an
allow-list knows the run.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import columns_of_row, row_of, slices, table, travels

travels(__name__)

# Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


@dataclass(frozen=True)
class CharacterClass:
    """Runs of a class, the window over them and the bits a character a window must reach.

    A run counts only if it holds a character of each pattern of ``needs``.
    """

    name: str
    run: str
    window: int
    bits: float
    needs: tuple[str, ...]


# Random characters of the classes have, over these windows, 3.2, 3.9 and 4.2 bits on
# average, less 0.15 for one window of six; words of a language have 3.5 or fewer and no
# digits among their letters.
CLASSES = (
    CharacterClass("hex", r"[0-9a-fA-F]{20,}", 20, 2.9, (r"[0-9]", r"[a-fA-F]")),
    CharacterClass("lower", r"[a-z0-9]{20,}", 20, 3.6, (r"[0-9].*[0-9].*[0-9]", r"[a-z]")),
    CharacterClass("upper", r"[A-Z0-9]{20,}", 20, 3.6, (r"[0-9].*[0-9].*[0-9]", r"[A-Z]")),
    CharacterClass("base64", r"[A-Za-z0-9+/_-]{24,}={0,2}", 24, 3.9, (r"[0-9]", r"[a-z]", r"[A-Z]")),
)
# Runs that are no secrets, as patterns of whole runs: unique identifiers, documented
# example keys, and the alphabets themselves.
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r".*(?i:example|sample|dummy|placeholder|changeme|your[-_]?(key|token|secret)).*",
    r".*(?i:abcdefghijklmnop|0123456789abcdef|1234567890).*",
)


def windows_over(run: str, size: int, bits: float) -> Iterator[tuple[int, int, float]]:
    """(start, end, highest entropy) of the joined windows of ``run`` that reach ``bits``.

    Entropy is in bits a character: log2(size) less the mean of log2 of the characters'
    counts, which a step changes in two terms.
    """
    if len(run) < size:
        return
    terms = [0.0] + [c * math.log2(c) for c in range(1, size + 1)]
    counts: dict[str, int] = {}
    weighted, most = 0.0, math.log2(size)
    start = end = -1
    best = 0.0
    for at, entering in enumerate(run):
        if at >= size:
            leaving = run[at - size]
            n = counts[leaving]
            weighted += terms[n - 1] - terms[n]
            counts[leaving] = n - 1
        n = counts.get(entering, 0)
        weighted += terms[n + 1] - terms[n]
        counts[entering] = n + 1
        if at < size - 1:
            continue
        entropy = most - weighted / size
        # Sums of a step's terms are not exact.
        if entropy >= bits - 1e-9:
            first = at - size + 1
            if start >= 0 and first <= end:
                end, best = at + 1, max(best, entropy)
            else:
                if start >= 0:
                    yield start, end, best
                start, end, best = first, at + 1, entropy
    if start >= 0:
        yield start, end, best


class Scanner:
    """Finds the spans of a text."""

    def __init__(self, classes: Sequence[CharacterClass] = CLASSES, allowed: Sequence[str] = ALLOWED):
        self.classes = [(c, re.compile(c.run), [re.compile(p) for p in c.needs]) for c in classes]
        self.allowed = [re.compile(p) for p in allowed]
        least = min((c.window for c in classes), default=0)
        self.candidates = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % least)

    def known(self, text: str) -> list[tuple[str, int, int]]:
        """Spans of the known forms, leftmost first within a kind."""
        out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        out += [("hex", *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
        return out

    def random(self, text: str) -> list[tuple[str, int, int, float]]:
        """Spans of random strings with their highest entropy; spans of classes that meet are one."""
        found = []
        for candidate in self.candidates.finditer(text):
            whole = candidate[0]
            if any(p.fullmatch(whole) for p in self.allowed):
                continue
            for kind, runs, needs in self.classes:
                for run in runs.finditer(whole):
                    part = run[0]
                    if not all(p.search(part) for p in needs) or any(p.fullmatch(part) for p in self.allowed):
                        continue
                    first = candidate.start() + run.start()
                    found += [(first + a, first + b, bits) for a, b, bits in windows_over(part, kind.window, kind.bits)]
        out: list[tuple[str, int, int, float]] = []
        for start, end, bits in sorted(found):
            if out and start < out[-1][2]:
                kind, before, last, most = out[-1]
                out[-1] = (kind, before, max(last, end), max(most, bits))
            else:
                out.append(("entropy", start, end, bits))
        return out

    def spans(self, text: str) -> list[dict]:
        """All spans by start, then kind as in KINDS."""
        found = [(*x, None) for x in self.known(text)] + self.random(text)
        found.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
        return [{"kind": k, "start": a, "end": b, "bits": e, "secret": text[a:b]} for k, a, b, e in found]


SPANS = "array<struct<kind: string, start: int, end: int, bits: double, secret: string>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("bits", pa.float64()), ("secret", pa.string())])
)


def scan(
    documents: DataFrame, to: str = "secrets", classes: Sequence[CharacterClass] = CLASSES, allowed: Sequence[str] = ALLOWED
) -> DataFrame:
    """``documents`` (text) with the spans of secrets in ``to``, in place of such a column.

    A span has kind, start and end (code points, end exclusive), bits (of ``entropy``
    spans: the highest entropy of a window) and the text itself. Spans of different kinds
    may cover the same text. Null and empty texts have none; equal rows stay apart; all
    other columns are kept as they are.
    """
    names = [c for c in documents.columns if c != to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allowed)
        for batch in slices(batches, "text"):
            spans = [scanner.spans(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(spans, _ARROW_SPANS)], ["row", "spans"])

    rows = documents.select(row_of(documents, names), "text")
    schema = T.StructType([rows.schema["row"], T.StructField("spans", T.DataType.fromDDL(SPANS))])
    return rows.mapInArrow(run, schema).select(*columns_of_row(names), F.col("spans").alias(to))


def _listed(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digests(documents: DataFrame) -> DataFrame:
    """doc_id, the numbers of spans of the known forms, their digest, and all spans as text."""
    found = scan(documents.select("doc_id", "text"), "secrets")
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("secrets")).alias("spans"),
    )


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))
