"""Ranks by a distributed LSD radix sort.

Rows of integer columns lie in blocks of BLOCK_ROWS, each one row of a stored table with
its rows as bytes. A pass over a digit is a stable counting sort: every block's counts of
the digit's values, added up over smaller values and earlier blocks, are the offsets to
which the block's rows go; they are dealt to the blocks that hold these places. Passes
run from the least significant digit of the last key to the most significant one of the
first. No task holds more than a block and what it deals out of one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import travels, written

travels(__name__)

DIGIT_BITS = 10
BLOCK_ROWS = 16_384
BLOCKS = "block long, rows binary, counts array<int>"


class CompositeKey:
    """The digits of a key made of several columns, each ascending or descending.

    A column's values count from its least (or greatest) one, and take as many bits as
    their range needs; a null has one more bit and comes last.
    """

    def __init__(self, parts: Sequence[tuple[int, bool, int, int, bool]]):
        # (column, descending, least, greatest, nulls), the most significant first.
        self.parts, self.bits = [], 0
        for column, descending, least, greatest, nulls in reversed(parts):
            width = (greatest - least).bit_length()
            self.parts.append((self.bits, width, column, greatest if descending else least, descending, nulls))
            self.bits += width + nulls

    @property
    def digits(self) -> int:
        return max(1, -(-self.bits // DIGIT_BITS))

    def digit(self, rows: np.ndarray, number: int) -> np.ndarray:
        """Digit ``number`` (0 is the least significant) of rows; their last column has null marks."""
        out = np.zeros(len(rows), np.uint64)
        first, last = number * DIGIT_BITS, (number + 1) * DIGIT_BITS
        for offset, width, column, start, descending, nulls in self.parts:
            if offset >= last or offset + width + nulls <= first:
                continue
            null = (rows[:, -1] >> column) & 1
            # Differences are right modulo 2^64, whatever the range.
            origin = np.array(start, np.int64).astype(np.uint64)
            value = rows[:, column].astype(np.uint64)
            value = origin - value if descending else value - origin
            value = np.where(null == 1, np.uint64(0), value)
            for at, size, bits in ((offset, width, value), (offset + width, int(nulls), null.astype(np.uint64))):
                if size and at < last and at + size > first:
                    out |= bits << np.uint64(at - first) if at >= first else bits >> np.uint64(first - at)
        return (out & np.uint64((1 << DIGIT_BITS) - 1)).astype(np.int64)


def _block_batch(block: int, rows: np.ndarray, key: CompositeKey, digit: int) -> pa.RecordBatch:
    """A row of BLOCKS, its counts those of ``digit``, if there is one."""
    counts = []
    if digit < key.digits:
        counts = np.bincount(key.digit(rows, digit), minlength=1 << DIGIT_BITS).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([rows.tobytes()], pa.binary()), pa.array([counts], pa.list_(pa.int32()))],
        ["block", "rows", "counts"],
    )


def _in_blocks(rows: DataFrame, key: CompositeKey) -> DataFrame:
    """``rows`` in blocks in no stated order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            columns = [c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns]
            marks = np.zeros(batch.num_rows, np.int64)
            for k, c in enumerate(batch.columns):
                marks |= c.is_null().to_numpy(zero_copy_only=False).astype(np.int64) << k
            held.append(np.column_stack([*columns, marks]).astype(np.int64))
            size += batch.num_rows
            while size >= BLOCK_ROWS:
                whole = np.concatenate(held)
                yield _block_batch(number, whole[:BLOCK_ROWS], key, 0)
                number, held, size = number + 1, [whole[BLOCK_ROWS:]], size - BLOCK_ROWS
        if size:
            yield _block_batch(number, np.concatenate(held), key, 0)

    return rows.mapInArrow(run, BLOCKS)


def _offsets(blocks: DataFrame) -> DataFrame:
    """block and offsets: for each digit value where the block's first row with it goes."""
    counts = blocks.select("block", F.posexplode("counts").alias("digit", "n")).where("n > 0")
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # 2^DIGIT_BITS rows at most.
    smaller = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    starts = totals.select("digit", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("start"))
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(F.broadcast(starts), "digit")
    # As many entries a block as a digit has values.
    return placed.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("digit", (F.col("start") + F.col("before")).alias("at")))).alias("offsets")
    )


def _pass(blocks: DataFrame, key: CompositeKey, digit: int, width: int, total: int) -> DataFrame:
    """``blocks`` with their rows sorted by ``digit``, rows of equal digits in their order."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, offsets in zip(batch["rows"], batch["offsets"], strict=True):
                rows = np.frombuffer(raw.as_py(), np.int64).reshape(-1, width)
                digits = key.digit(rows, digit)
                start = np.zeros(1 << DIGIT_BITS, np.int64)
                for value, at in offsets.as_py():
                    start[value] = at
                order = np.argsort(digits, kind="stable")
                digits = digits[order]
                first = np.searchsorted(digits, digits, "left")
                places = start[digits] + np.arange(len(rows)) - first
                rows = rows[order]
                to = places // BLOCK_ROWS
                edges = np.flatnonzero(np.diff(to, prepend=-1))
                ends = np.append(edges[1:], len(to))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(to[edges]),
                        pa.array([places[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
                        pa.array([rows[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
                    ],
                    ["block", "places", "rows"],
                )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = None, None
        for batch in batches:
            for to, places, part in zip(batch["block"].to_pylist(), batch["places"], batch["rows"], strict=True):
                if to != block:
                    if block is not None:
                        yield _block_batch(block, rows, key, digit + 1)
                    block, rows = to, np.empty((min(BLOCK_ROWS, total - to * BLOCK_ROWS), width), np.int64)
                at = np.frombuffer(places.as_py(), np.int64) - to * BLOCK_ROWS
                rows[at] = np.frombuffer(part.as_py(), np.int64).reshape(-1, width)
        if block is not None:
            yield _block_batch(block, rows, key, digit + 1)

    dealt = blocks.select("block", "rows").join(_offsets(blocks), "block").select("rows", "offsets")
    dealt = dealt.mapInArrow(deal, "block long, places binary, rows binary")
    return dealt.repartition("block").sortWithinPartitions("block").mapInArrow(gather, BLOCKS)


def radix_ranked(rows: DataFrame, by: Sequence[tuple[str, bool]], to: str = "rank") -> DataFrame:
    """``rows`` with ``to``, their place from 1 in the order of ``by`` (column, descending).

    All columns are made long integers; a column that is called ``to`` is replaced. Nulls
    come last in either direction; rows equal in all of ``by`` take consecutive places in
    no stated order. No rows give no rows.
    """
    names = [c for c in rows.columns if c != to]
    rows = written(rows.select(*[F.col(f"`{c}`").cast("long").alias(c) for c in names]), "radix-rows")
    if len(names) > 62:
        raise ValueError("too many columns to carry")
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(F.col(f"`{c}`")).alias(f"{name}{k}") for k, (c, _) in enumerate(by) for name, f in (("a", F.min), ("b", F.max), ("c", F.count))],
    ).first()
    key = CompositeKey(
        [
            (names.index(c), descending, found[f"a{k}"] or 0, found[f"b{k}"] or 0, found[f"c{k}"] < found.n)
            for k, (c, descending) in enumerate(by)
        ]
    )
    blocks = written(_in_blocks(rows, key), "radix-blocks")
    for digit in range(key.digits):
        blocks = written(_pass(blocks, key, digit, len(names) + 1, found.n), f"radix-pass-{digit}")

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch["block"].to_pylist(), batch["rows"], strict=True):
                sorted_rows = np.frombuffer(raw.as_py(), np.int64).reshape(-1, len(names) + 1)
                place = block * BLOCK_ROWS + 1 + np.arange(len(sorted_rows), dtype=np.int64)
                null = [((sorted_rows[:, -1] >> k) & 1).astype(bool) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(sorted_rows[:, k].copy(), mask=null[k]) for k in range(len(names))], pa.array(place)],
                    [*names, to],
                )

    schema = T.StructType([T.StructField(c, T.LongType()) for c in [*names, to]])
    return blocks.select("block", "rows").mapInArrow(out, schema)
