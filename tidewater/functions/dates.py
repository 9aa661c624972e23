"""Business dates taken from file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_date(path: Column) -> Column:
    """``s3://b/dir/index_20211201.csv`` -> ``20211201``.

    The text after the last ``_`` of the file name without its last extension.
    A name that only starts with dots, such as ``.csv``, has no extension.
    """
    name = F.substring_index(path, "/", -1)
    stem = F.regexp_replace(name, r"^(\.*[^.].*)\.[^.]*$", "$1")
    return F.substring_index(stem, "_", -1)


def canonical_date(compact: Column) -> Column:
    """``20211201`` -> ``2021-12-01``; a malformed date fails the job.

    Anything but eight digits leaves dashes only, which are no date.
    """
    dashed = F.regexp_replace(
        compact, r"(?s)^(?:([0-9]{4})([0-9]{2})([0-9]{2})|.*)$", "$1-$2-$3"
    )
    return F.coalesce(
        dashed.try_cast("date").cast("string"),
        F.when(
            compact.isNotNull(),
            F.raise_error(F.concat(F.lit("not a yyyyMMdd date: "), compact)),
        ),
    )


def business_date(path: Column) -> Column:
    """The canonical date in a file path."""
    return canonical_date(file_date(path))


def iso_day(ts: Column) -> Column:
    """A timestamp's day as an ISO string; independent of the session time zone
    for ``timestamp_ntz``."""
    return ts.cast("date").cast("string")
