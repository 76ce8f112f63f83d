"""Declared data checks, each reported as its number of failing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


@dataclass(frozen=True)
class Check:
    """One test of a column.

    ``not_null`` counts rows, only those meeting ``where`` if given;
    ``accepted_values`` counts rows with a value outside ``values``, NULL
    passing; ``unique`` counts the values that occur more than once.
    """

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    where: str | None = None

    def fails(self) -> Column:
        column = F.col(self.column)
        if self.kind == "not_null":
            failing = column.isNull()
        elif self.kind == "accepted_values":
            failing = ~column.isin(*self.values)
        else:
            raise ValueError(f"{self.kind} is not a row check")
        return F.expr(self.where) & failing if self.where else failing

    def label(self) -> str:
        return f"{self.kind} where {self.where}" if self.where else self.kind


def not_null(table: str, *columns: str, where: str | None = None) -> list[Check]:
    return [Check(table, c, "not_null", where=where) for c in columns]


SEARCH_TYPES = ("Branded", "Unbranded")
GRAINS = ("restaurant", "cuisine", "global")

CHECKS: tuple[Check, ...] = (
    *not_null("search_export", "restaurant_id", "domain", "data", "_updated_at"),
    *not_null("label_export", "restaurant_id", "cuisines"),
    *not_null("queries", "restaurant_id", "domain", "clicks", "ctr", "impressions", "position", "query"),
    *not_null("label_names", "cuisine"),
    Check("label_names", "cuisine", "unique"),
    *not_null("classified_queries", "restaurant_id", "domain"),
    Check("classified_queries", "search_type", "accepted_values", SEARCH_TYPES),
    *not_null("restaurant_metrics", "restaurant_id", "pct_clicks"),
    Check("restaurant_metrics", "search_type", "accepted_values", SEARCH_TYPES),
    *not_null("cuisine_metrics", "cuisine", "pct_clicks"),
    Check("cuisine_metrics", "search_type", "accepted_values", SEARCH_TYPES),
    Check("unified_metrics", "grain", "accepted_values", GRAINS),
    *not_null("unified_metrics", "restaurant_id", where="grain = 'restaurant'"),
    *not_null("unified_metrics", "cuisine", where="grain = 'cuisine'"),
    Check("unified_metrics", "search_type", "accepted_values", SEARCH_TYPES),
    *not_null("unified_metrics", "pct_clicks"),
    *not_null(
        "ctr_residual",
        "restaurant_id", "pos_bin", "avg_position", "ctr", "expected_ctr", "total_impressions", "total_clicks",
    ),
)

_RESULT = "struct<table_name:string,column_name:string,check_name:string,failing_rows:bigint>"


def _result(check: Check, failing: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.label()).alias("check_name"),
        failing.alias("failing_rows"),
    ).cast(_RESULT)


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counts = df.agg(*[F.count_if(c.fails()).alias(f"c{i}") for i, c in enumerate(checks)])
    return counts.select(F.inline(F.array(*[_result(c, F.col(f"c{i}")) for i, c in enumerate(checks)])))


def _unique_check(df: DataFrame, check: Check) -> DataFrame:
    repeated = df.where(F.col(check.column).isNotNull()).groupBy(check.column).count().where("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(_result(check, F.col("n")))))


def quality_report(tables: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS) -> DataFrame:
    """One row per check of the given tables; the row checks of a table share one scan."""
    parts = []
    for name, df in tables.items():
        mine = [c for c in checks if c.table == name]
        by_row = [c for c in mine if c.kind != "unique"]
        if by_row:
            parts.append(_row_checks(df, by_row))
        parts += [_unique_check(df, c) for c in mine if c.kind == "unique"]
    return reduce(DataFrame.unionByName, parts)


class WatchedChecks:
    """Row checks that are counted while tables are written, so that none is read again for them.

    ``watch`` adds the counts of a table's checks to its plan; they are there
    once the plan is written. Put it where rows pass once, at the end of a
    written plan or on an input of one without a shuffle: Spark counts each
    task that ends the job once, repeated ones too.
    """

    def __init__(self, checks: Sequence[Check] = CHECKS):
        self.checks = checks
        self.seen: list[tuple[list[Check], Observation]] = []

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        mine = [c for c in self.checks if c.table == name and c.kind != "unique"]
        if not mine:
            return df
        seen = Observation(f"checks of {name}")
        self.seen.append((mine, seen))
        return df.observe(seen, *[F.count(F.when(c.fails(), 1)).alias(f"c{i}") for i, c in enumerate(mine)])

    def report(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
        """As ``quality_report``, once all watched tables are written; only columns that must be unique are read from ``tables``."""
        rows = [(c.table, c.column, c.label(), seen.get[f"c{i}"]) for mine, seen in self.seen for i, c in enumerate(mine)]
        counted = spark.createDataFrame(rows, _RESULT.removeprefix("struct<").removesuffix(">"))
        unique = [_unique_check(tables[c.table], c) for c in self.checks if c.kind == "unique" and c.table in tables]
        return reduce(DataFrame.unionByName, unique, counted)
