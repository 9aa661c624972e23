"""Slowly changing dimensions: type 1 latest rows and type 2 history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.hashes import row_hash
from tidewater.operators import merge
from tidewater.operators.joins import balanced_join

# The column names and the open end of a validity range.
EFFECTIVE = "effective_business_date"
END = "end_date"
LATEST = "latest"
OPEN_END = "9999-12-31"


def new_versions(source: DataFrame, date: str = "business_date") -> DataFrame:
    """Source rows as open versions: valid from their date, without an end."""
    attributes = [c for c in source.columns if c != date]
    return source.select(
        *attributes,
        F.col(date).alias(EFFECTIVE),
        F.lit(OPEN_END).alias(END),
        F.lit(True).alias(LATEST),
    )


def scd1_merge(
    latest: DataFrame, source: DataFrame, key: str, on_duplicate: str = "error"
) -> DataFrame:
    """Newest row per key: known keys are replaced, new ones added.

    There is no date guard: an older file merged later wins. Keys missing from
    the source stay.
    """
    return merge.merge_rows(
        latest,
        source,
        [key],
        on_duplicate=on_duplicate,
        newest_by=EFFECTIVE if on_duplicate == "keep_last" else None,
    )


def scd2_merge(
    history: DataFrame,
    source: DataFrame,
    key: str,
    on_duplicate: str = "error",
    guard_late: bool = False,
) -> DataFrame:
    """MERGE new versions (see ``new_versions``) into a history.

    Every source row of a known key closes that key's open rows at its date and
    opens one new row per row it closed; a row of an unknown or NULL key is
    simply opened. Attributes are not compared, so an unchanged row opens a new
    version too. ``guard_late`` ignores rows that are not newer than the key's
    open version.

    ``history`` may be the open rows alone when every key has one, as this merge
    keeps it; the closed rows then need not be read at all.
    """
    if on_duplicate == "keep_last":
        source = newest_rows(source, key)
    elif on_duplicate != "error":
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    if guard_late:
        source = _without_late_rows(history, source, key)

    columns = history.columns
    latest = merge.one_per_key(source.select(*columns), [key])
    matched = merge.matched_rows(history, latest, [key])
    closes = F.coalesce(F.col(LATEST), F.lit(False)) & F.col("_new").isNotNull()
    changed = {END: F.col(f"_new.{EFFECTIVE}"), LATEST: F.lit(False)}
    old = F.struct(*columns)
    closed = F.struct(*[changed.get(c, F.col(c)).alias(c) for c in columns])
    # A closed row is followed by the new version that it made room for.
    versions = F.when(closes, F.array(closed, F.col("_new"))).otherwise(F.array(old))
    kept = matched.select(F.explode(versions).alias("row")).select("row.*")

    unknown = merge.unmatched_rows(history, source.select(*columns), latest, [key])
    return kept.unionByName(unknown)


def newest_rows(source: DataFrame, key: str) -> DataFrame:
    """The newest row per key, and all rows with a NULL key."""
    picked = merge.one_per_key(source, [key], newest_by=EFFECTIVE)
    return picked.select("_new.*").unionByName(source.where(F.col(key).isNull()))


def _without_late_rows(history: DataFrame, source: DataFrame, key: str) -> DataFrame:
    open_rows = history.where(F.col(LATEST)).select(key, EFFECTIVE)
    keys = source.select(F.col(key).alias("_key_0")).dropna().distinct()
    touched = (
        balanced_join(open_rows, keys, [(key, "_key_0")], "left_semi")
        .groupBy(F.col(key).alias("_key_0"))
        .agg(F.max(EFFECTIVE).alias("_open_from"))
    )
    return (
        balanced_join(source, touched, [(key, "_key_0")], "left")
        .where(F.col("_open_from").isNull() | (F.col(EFFECTIVE) > F.col("_open_from")))
        .select(*source.columns)
    )


def _at(rows: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Rows of ``dates``."""
    return rows.where(F.col(EFFECTIVE).isin(list(dates)))


def keys_to_splice(
    open_rows: DataFrame, source: DataFrame, key: str, replaced: DataFrame | None = None
) -> DataFrame:
    """The keys, as ``_key_0``, whose intervals a merge of ``source`` cannot just extend.

    They have several source rows or one that is not newer than the key's open row, or
    are among the keys of ``replaced``. NULL is not a key.
    """
    incoming = (
        source.dropna(subset=[key])
        .groupBy(F.col(key).alias("_key_0"))
        .agg(F.min(EFFECTIVE).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    )
    known = (
        balanced_join(
            open_rows.select(key, EFFECTIVE), incoming.select("_key_0"), [(key, "_key_0")], "left_semi"
        )
        .groupBy(F.col(key).alias("_known"))
        .agg(F.max(EFFECTIVE).alias("_open_from"))
    )
    late = (
        balanced_join(incoming, known, [("_key_0", "_known")], "left")
        .where((F.col("_rows") > 1) | (F.col("_first") <= F.col("_open_from")))
        .select("_key_0")
    )
    if replaced is not None:
        late = late.unionByName(replaced.dropna(subset=[key]).select(F.col(key).alias("_key_0")))
    return late.distinct()


def intervals(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with end and openness from the dates of their key.

    A row ends at the key's next later date. Rows that share key and date get the same
    interval; each row with a NULL key is open. A key's rows number at most its dates.
    """
    alone = F.when(F.col(key).isNull(), row_hash(rows))
    by_key = Window.partitionBy(key, alone)
    following = F.lead(EFFECTIVE).over(by_key.orderBy(EFFECTIVE))
    next_row = rows.withColumn("_next", F.when(F.col(key).isNotNull(), following))
    # Of rows that share a date only the last sees a later one.
    later = F.max(F.when(F.col("_next") > F.col(EFFECTIVE), F.col("_next")))
    next_date = next_row.withColumn("_next", later.over(Window.partitionBy(key, alone, EFFECTIVE)))
    changed = {
        END: F.coalesce(F.col("_next"), F.lit(OPEN_END)),
        LATEST: F.col("_next").isNull(),
    }
    return next_date.select(*[changed.get(c, F.col(c)).alias(c) for c in rows.columns])


def splice_rows(
    existing: DataFrame, source: DataFrame, key: str, replaced_dates: Sequence[str] = ()
) -> DataFrame:
    """``source`` spliced into the ``existing`` rows of its keys, both open and closed.

    A source row takes the place of all existing rows of its key and date; the others
    stay but for those of ``replaced_dates``, whose rows are all in the source.
    """
    if replaced_dates:
        existing = existing.where(~F.col(EFFECTIVE).isin(list(replaced_dates)))
    taken = source.select(F.col(key).alias("_key_0"), F.col(EFFECTIVE).alias("_key_1")).dropna().distinct()
    kept = balanced_join(existing, taken, [(key, "_key_0"), (EFFECTIVE, "_key_1")], "left_anti")
    return intervals(kept.unionByName(source.select(*existing.columns)), key)


def scd2_splice(
    history: DataFrame, source: DataFrame, key: str, replaced_dates: Sequence[str] = ()
) -> DataFrame:
    """A history with ``source`` rows of any dates in their places: late ones, corrected
    ones and several a key.

    Gives what merging all deliveries in the order of their dates would give, the last
    delivery of a key and date counting: intervals of the keys that the source touches
    are computed anew. ``replaced_dates`` are dates that the source holds in full; rows
    that the history has for them, and the source no longer, go. Source rows that share
    key and date are all kept, with one interval. Rows with a NULL key are only added,
    or replaced with their date.
    """
    replaced = _at(history, replaced_dates)
    keys = (
        source.select(F.col(key).alias("_key_0"))
        .unionByName(replaced.select(F.col(key).alias("_key_0")))
        .dropna()
        .distinct()
    )
    touched = balanced_join(history, keys, [(key, "_key_0")], "left_semi")
    others = balanced_join(history, keys, [(key, "_key_0")], "left_anti")
    if replaced_dates:
        others = others.where(F.col(key).isNotNull() | ~F.col(EFFECTIVE).isin(list(replaced_dates)))
    return others.unionByName(splice_rows(touched, source, key, replaced_dates))


def _one_per_date(key: str, date: str, following: Column, unmatched: Column) -> Column:
    """The following date, or a failure where it is the row's own."""
    return F.when(
        ~unmatched & (following == F.col(date)),
        F.raise_error(F.lit(f"several rows of one {key} and {date}")),
    ).otherwise(F.when(~unmatched, following))


def scd2_backfill(
    source: DataFrame, key: str, date: str = "business_date"
) -> DataFrame:
    """The history that merging the dates one by one would give, in one shuffle.

    Needs one row per key and date, and fails otherwise; a key's rows number at most
    the dates. A NULL key never matches, so each of its rows stays open.
    """
    attributes = [c for c in source.columns if c != date]
    unmatched = F.col(key).isNull()
    # NULL keys are spread by a hash of the row instead of meeting in one window.
    alone = F.when(unmatched, row_hash(source))
    by_key = Window.partitionBy(key, alone).orderBy(date)
    chained = source.withColumn("_next", F.lead(date).over(by_key))
    following = _one_per_date(key, date, F.col("_next"), unmatched)
    return chained.select(
        *attributes,
        F.col(date).alias(EFFECTIVE),
        F.coalesce(following, F.lit(OPEN_END)).alias(END),
        following.isNull().alias(LATEST),
    )


def scd1_backfill(
    source: DataFrame, key: str, date: str = "business_date"
) -> DataFrame:
    """The newest row per key of many dates, combined before the shuffle.

    Rows with a NULL key are all kept, as in ``scd1_merge``.
    """
    keyed = new_versions(source, date)
    return newest_rows(keyed, key)

