"""Row-level update, delete and upsert on a DataFrame.

Plain files have no UPDATE, DELETE or MERGE, so each operator returns the whole
new table, to be written as the next snapshot. A target row is touched when the
condition is TRUE; FALSE and NULL leave it alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.hashes import row_hash
from tidewater.operators.joins import balanced_join

_COPIES = "_copies"
_NEW = "_new"
_KEYS = "_key_"


def update_rows(
    df: DataFrame, condition: Column, assignments: Mapping[str, Column]
) -> DataFrame:
    """Rows meeting ``condition`` get the new values, all computed from old ones."""
    types = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            F.when(condition, assignments[c].cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in assignments
            else F.col(c)
            for c in df.columns
        ]
    )


def delete_rows(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~F.coalesce(condition, F.lit(False)))


def one_per_key(
    source: DataFrame, keys: Sequence[str], newest_by: str | None = None
) -> DataFrame:
    """One row per key: the keys as ``_key_i``, a source row as the struct
    ``_new`` and the number of source rows in ``_copies``.

    Rows with a NULL key match nothing and are left out. Copies of a hot key are
    combined before the shuffle.
    """
    row = F.struct(*source.columns)
    if newest_by:
        pick = F.max_by(row, F.struct(F.col(newest_by), row_hash(source)))
    else:
        pick = F.first(row)
    return (
        source.dropna(subset=list(keys))
        .groupBy(*[F.col(k).alias(f"{_KEYS}{i}") for i, k in enumerate(keys)])
        .agg(pick.alias(_NEW), F.count(F.lit(1)).alias(_COPIES))
    )


def key_pairs(keys: Sequence[str]) -> list[tuple[str, str]]:
    """The join keys of a frame with ``keys`` and a ``one_per_key`` frame."""
    return [(key, f"{_KEYS}{i}") for i, key in enumerate(keys)]


def matched_rows(
    target: DataFrame, latest: DataFrame, keys: Sequence[str], allow_copies: bool = False
) -> DataFrame:
    """Target rows beside their ``one_per_key`` row, whose columns are NULL where
    there is none."""
    matched = balanced_join(target, latest, key_pairs(keys), "left")
    return matched if allow_copies else reject_copies(matched)


def unmatched_rows(
    target: DataFrame, source: DataFrame, latest: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Source rows whose key no target row has.

    Reads the target's keys only. They are first reduced to those in the source,
    by a broadcast of the source's keys when it is small, and combined before any
    shuffle.
    """
    source_keys = latest.drop(_NEW, _COPIES)
    present = balanced_join(target.select(*keys), source_keys, key_pairs(keys), "left_semi")
    known = present.distinct().toDF(*[f"{_KEYS}{i}" for i in range(len(keys))])
    return balanced_join(source, known, key_pairs(keys), "left_anti")


def reject_copies(df: DataFrame) -> DataFrame:
    """Fails the job when a matched row has several source rows.

    In a filter, so that no later column pruning can remove the check.
    """
    return df.where(
        F.when(
            F.col(_COPIES) > 1,
            F.raise_error(F.lit("several source rows match one target row")),
        ).otherwise(F.lit(True))
    )


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, str] | None = None,
    insert: Mapping[str, str] | None = None,
    on_duplicate: str = "error",
    newest_by: str | None = None,
) -> DataFrame:
    """MERGE ``source`` into ``target`` on equal ``keys``.

    Matched target rows take the source columns named by ``update`` (target
    column -> source column), unmatched source rows are inserted with ``insert``;
    both default to all target columns. A NULL source key never matches.

    Several source rows for one matched key fail the job, or with
    ``on_duplicate="keep_last"`` the one with the largest ``newest_by`` wins, for
    inserts too.

    The target is read once in full and once for its keys only. Neither read
    shuffles it while Spark can broadcast the source, by its own size limit;
    beyond that both become shuffled joins.
    """
    if on_duplicate not in ("error", "keep_last"):
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    if on_duplicate == "keep_last" and newest_by is None:
        raise ValueError("keep_last needs newest_by")
    everything = {c: c for c in target.columns}
    update = dict(update) if update is not None else everything
    insert = dict(insert) if insert is not None else everything
    types = {f.name: f.dataType for f in target.schema}

    latest = one_per_key(
        source, keys, newest_by if on_duplicate == "keep_last" else None
    )
    matched = matched_rows(target, latest, keys, on_duplicate == "keep_last")
    hit = F.col(_COPIES).isNotNull()
    updated = matched.select(
        *[
            F.when(hit, F.col(f"{_NEW}.{update[c]}").cast(types[c]))
            .otherwise(F.col(c))
            .alias(c)
            if c in update
            else F.col(c)
            for c in target.columns
        ]
    )

    incoming = source
    if on_duplicate == "keep_last":
        incoming = latest.select(f"{_NEW}.*").unionByName(
            source.where(" OR ".join(f"`{k}` IS NULL" for k in keys))
        )
    inserted = unmatched_rows(target, incoming, latest, keys).select(
        *[
            (F.col(insert[c]) if c in insert else F.lit(None)).cast(types[c]).alias(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(inserted)
