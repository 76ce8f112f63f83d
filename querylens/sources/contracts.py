"""Raw tables and the columns the jobs expect of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The key's type is not part of the contract (None): any type that can be compared is accepted.
SEARCH_EXPORT: dict[str, T.DataType | None] = {
    "restaurant_id": None,
    "domain": T.StringType(),
    "_updated_at": T.TimestampType(),
    "_created_at": T.TimestampType(),
    "status": T.StringType(),
    "data": T.StringType(),
}

LABEL_EXPORT: dict[str, T.DataType | None] = {
    "restaurant_id": None,
    "cuisines": T.StringType(),
}

_TIMES = (T.TimestampType, T.TimestampNTZType)


def conform(df: DataFrame, contract: dict[str, T.DataType | None]) -> DataFrame:
    """Select the contract's columns under lower-case names; fail on a missing or mistyped one."""
    found = {f.name.lower(): f for f in df.schema.fields}
    missing = [name for name in contract if name not in found]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    for name, wanted in contract.items():
        actual = found[name].dataType
        if wanted is None or actual == wanted or isinstance(wanted, _TIMES) and isinstance(actual, _TIMES):
            continue
        raise ValueError(f"column {name} is {actual.simpleString()}, expected {wanted.simpleString()}")
    return df.select(*[F.col(f"`{found[name].name}`").alias(name) for name in contract])


def read_source(spark: SparkSession, location: str, fmt: str | None = None) -> DataFrame:
    """Read a path in the given format, or a catalog table when no format is named."""
    return spark.read.format(fmt).load(location) if fmt else spark.table(location)


def read_search_export(spark: SparkSession, location: str, fmt: str | None = "parquet") -> DataFrame:
    return conform(read_source(spark, location, fmt), SEARCH_EXPORT)


def read_label_export(spark: SparkSession, location: str, fmt: str | None = "parquet") -> DataFrame:
    return conform(read_source(spark, location, fmt), LABEL_EXPORT)
