"""The nested records of the domain: accounts of positions, securities of industries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater.operators import nested

# The fields of the records.
INDUSTRY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
POSITION = T.StructType(
    [
        T.StructField("market_value", T.DoubleType()),
        T.StructField("exposure", T.StringType()),
        T.StructField("account_id", T.LongType()),
        T.StructField("security_id", T.LongType()),
    ]
)
SECURITY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("cusip", T.StringType()),
        T.StructField("industries", T.ArrayType(INDUSTRY)),
    ]
)
ACCOUNT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("positions", T.ArrayType(POSITION)),
    ]
)


def accounts_with_positions(accounts: DataFrame, positions: DataFrame) -> DataFrame:
    """Flat accounts (id, name, description) with their positions, by security."""
    lists = nested.nest(
        positions, "account_id", "security_id", POSITION.names, "positions"
    )
    return nested.attach(accounts, "id", lists, "account_id", "positions")


def securities_with_industries(
    securities: DataFrame, industries: DataFrame, security_id: str = "security_id"
) -> DataFrame:
    """Flat securities with their industries, which name their ``security_id``."""
    lists = nested.nest(industries, security_id, "id", INDUSTRY.names, "industries")
    return nested.attach(securities, "id", lists, security_id, "industries")
