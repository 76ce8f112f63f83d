"""From the raw exports to the metric tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

from querylens.functions.brands import OVERRIDES, Rule
from querylens.operators.classify import classify_each_once, classify_queries
from querylens.operators.flatten import flatten_labels, flatten_search_export, label_names
from querylens.operators.metrics import (
    collapse_queries,
    cuisine_metrics,
    restaurant_metrics,
    unified_metrics,
)
from querylens.operators.quality import WatchedChecks, quality_report
from querylens.operators.residual import ctr_residual
from querylens.sources.scratch import materialize
from querylens.sources.sinks import write_clustered, write_full


@dataclass(frozen=True)
class Build:
    """The tables of one run."""

    search_export: DataFrame
    label_export: DataFrame
    queries: DataFrame
    labels: DataFrame
    label_names: DataFrame
    classified_queries: DataFrame
    unified_metrics: DataFrame
    restaurant_metrics: DataFrame
    cuisine_metrics: DataFrame
    ctr_residual: DataFrame
    # The declared checks as counted while the tables were written, if they were.
    watched: WatchedChecks | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name != "watched"}

    def check(self) -> DataFrame:
        if self.watched:
            return self.watched.report(self.queries.sparkSession, self.tables())
        return quality_report(self.tables())


def metrics_from_queries(
    queries: DataFrame, labels: DataFrame, rules: Sequence[Rule] = OVERRIDES, exact_distinct: bool = False
) -> DataFrame:
    """Unified metrics straight from flat queries; each distinct query is classified once."""
    classified = classify_queries(collapse_queries(queries), label_names(labels), rules, with_score=False)
    if exact_distinct:
        classified = materialize(classified, "classified")
    return unified_metrics(classified, labels, exact_distinct, queries_once=True)


def build(
    search_export: DataFrame, label_export: DataFrame, rules: Sequence[Rule] = OVERRIDES, root: str | None = None
) -> Build:
    """All tables from the raw exports.

    With ``root`` each table is written under it, the unified one clustered,
    and the next is computed from what was written, so that documents are
    parsed and each query of a domain classified once. The declared checks are
    counted while writing. Without it only the unified metrics
    are stored, in scratch, for the three tables and the checks that read
    them; classified queries remain a plan.
    """

    def keep(name: str, df: DataFrame) -> DataFrame:
        if not root:
            return df
        path = f"{root.rstrip('/')}/{name}"
        write = write_clustered if name == "unified_metrics" else write_full
        write(watched.watch(name, df), path)
        return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)

    def read(name: str, df: DataFrame) -> DataFrame:
        return watched.watch(name, df) if root else df

    watched = WatchedChecks()
    queries = keep("queries", flatten_search_export(read("search_export", search_export)))
    labels = keep("labels", flatten_labels(read("label_export", label_export)))
    names = keep("label_names", label_names(labels))
    classify = classify_each_once if root else classify_queries
    classified = keep("classified_queries", classify(queries, names, rules))
    if root:
        unified = keep("unified_metrics", unified_metrics(classified, labels))
    else:
        unified = materialize(metrics_from_queries(queries, labels, rules), "unified")
    return Build(
        search_export=search_export,
        label_export=label_export,
        queries=queries,
        labels=labels,
        label_names=names,
        classified_queries=classified,
        unified_metrics=unified,
        restaurant_metrics=keep("restaurant_metrics", restaurant_metrics(unified)),
        cuisine_metrics=keep("cuisine_metrics", cuisine_metrics(unified)),
        ctr_residual=keep("ctr_residual", ctr_residual(unified)),
        watched=watched if root else None,
    )
