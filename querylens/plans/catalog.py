"""The registered queries, each over whole tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from querylens.functions import brands as rules
from querylens.functions.text import brand_name, normalize_query
from querylens.functions.variant import parse_document, variant_bigint
from querylens.operators import history, maintained, metrics
from querylens.operators.classify import classify_queries, clean_queries, with_label_match
from querylens.operators.flatten import flatten_labels, flatten_search_export, label_names
from querylens.operators.quality import Check, not_null, quality_report
from querylens.operators.ranks import with_place
from querylens.operators.residual import ctr_residual
from querylens.operators.rule_index import with_any_rule
from querylens.operators.shares import share_of_total
from querylens.plans import shapes
from querylens.plans.build import build, metrics_from_queries
from querylens.sources.contracts import read_label_export, read_search_export
from querylens.sources.incremental import LoadTable, incremental_read, latest_per_key, upsert
from querylens.sources.late import late_arrivals
from querylens.sources.scratch import materialize, scratch_path
from querylens.sources.sinks import write_clustered, write_full
from querylens.streaming.upsert import read_file_stream, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SPLIT_TIME = "2024-01-20 00:00:00"
ARRIVALS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
SNAPSHOT_DATES = tuple(datetime.date(2024, 1, day) for day in (8, 15, 22, 29))
AS_OF = datetime.date(2024, 1, 18)
# Rows of a user beyond which the line of events is cut, so that some users are cut at every scale.
SMALL_SLICE = 50

QUERY, BRAND, RAW = "query_cleaned", "domain_name_cleaned", "query_raw"


# --- inputs ----------------------------------------------------------------


def flat_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.search_queries(spark, sf_dir).drop("l_orderkey", "reported")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_labels(shapes.label_export(spark, sf_dir))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct queries per domain, with how often each occurs, cleaned."""
    both = flat_queries(spark, sf_dir).select("query", "domain")
    both = both.unionByName(shapes.rule_queries(spark, sf_dir).select("query", "domain"))
    return clean_queries(both.groupBy("query", "domain").agg(F.count(F.lit(1)).alias("n_rows")))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_names(labels(spark, sf_dir)).unionByName(shapes.rule_names(spark)).distinct()


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.table(spark, sf_dir, "events")


def metric_rows(df: DataFrame) -> DataFrame:
    """Positions are sums of doubles: rounded, the order of addition does not show."""
    return df.withColumn("avg_position", F.round("avg_position", 6))


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_from_queries(flat_queries(spark, sf_dir), labels(spark, sf_dir))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    collapsed = metrics.collapse_queries(flat_queries(spark, sf_dir))
    classified = classify_queries(collapsed, label_names(labels(spark, sf_dir)), with_score=False)
    return metrics.entity_totals(classified, queries_once=True)


# --- JSON and labels -------------------------------------------------------


def q_flatten_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = parse_document(F.col("props"))
    return events(spark, sf_dir).select("event_id", variant_bigint(document, "$[0].k").alias("k"))


def q_flatten_search_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_search_export(shapes.search_export(spark, sf_dir))


def q_flatten_dirty_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_search_export(shapes.dirty_export(spark, sf_dir))


def q_flatten_dirty_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_labels(shapes.dirty_labels(spark, sf_dir))


def q_label_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_names(labels(spark, sf_dir))


# --- text and rules --------------------------------------------------------


def q_normalize_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = flat_queries(spark, sf_dir).select("query")
    both = both.unionByName(shapes.rule_queries(spark, sf_dir).select("query"))
    counted = both.groupBy("query").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn(QUERY, normalize_query(F.col("query")))


def q_brand_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = flat_queries(spark, sf_dir).select("domain")
    domains = domains.unionByName(shapes.rule_queries(spark, sf_dir).select("domain"))
    counted = domains.groupBy("domain").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn(BRAND, brand_name(F.col("domain")))


def q_jaro_winkler_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    distinct = pairs(spark, sf_dir).select(QUERY, BRAND).distinct()
    return distinct.withColumn("score", F.round(rules.similarity(F.col(QUERY), F.col(BRAND)), 6))


def _rule_query(flag: str, test: Callable[[Column, Column, Column], Column]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = test(F.col(QUERY), F.col(BRAND), F.col(RAW))
        return pairs(spark, sf_dir).select(RAW, "domain", "n_rows", found.alias(flag))

    return run


def q_exclude_false_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = with_label_match(pairs(spark, sf_dir), names(spark, sf_dir))
    found = rules.exclude_false_positives(F.col(QUERY), F.col(BRAND), F.col(RAW), F.col("label"))
    return labelled.select(RAW, "domain", "n_rows", found.alias("excluded"))


def q_classify_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = classify_queries(flat_queries(spark, sf_dir), q_label_names(spark, sf_dir))
    return classified.withColumn("jarrow_similarity", F.round("jarrow_similarity", 6))


def q_classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = (
        shapes.rule_queries(spark, sf_dir)
        .groupBy("query", "domain")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("clicks").alias("clicks"))
    )
    return classify_queries(counted, names(spark, sf_dir), with_score=False)


# --- metrics ---------------------------------------------------------------


def q_entity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_rows(metrics.entity_metrics(materialize(totals(spark, sf_dir), "totals")))


def q_attributed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_rows(metrics.attributed_metrics(totals(spark, sf_dir), labels(spark, sf_dir)))


def q_global_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_rows(metrics.global_metrics(totals(spark, sf_dir)))


def q_unified_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_rows(unified(spark, sf_dir))


def q_exact_distinct_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = metrics_from_queries(flat_queries(spark, sf_dir), labels(spark, sf_dir), exact_distinct=True)
    return metric_rows(exact.where("grain <> 'restaurant'"))


def q_restaurant_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metrics.restaurant_metrics(unified(spark, sf_dir))
    order = [F.col(c).asc_nulls_last() for c in ("restaurant_id", "search_type", "domain")]
    return metric_rows(with_place(rows, order))


def q_cuisine_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metrics.cuisine_metrics(unified(spark, sf_dir))
    return metric_rows(with_place(rows, [F.col(c).asc_nulls_last() for c in ("cuisine", "search_type")]))


def q_sketched_distinct_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = labels(spark, sf_dir)
    collapsed = metrics.collapse_queries(flat_queries(spark, sf_dir))
    classified = materialize(classify_queries(collapsed, label_names(labelled), with_score=False), "classified")
    sketches = materialize(metrics.query_sketches(classified), "sketches")
    sums = materialize(metrics.entity_totals(classified, queries_once=True), "totals")
    return metric_rows(metrics.sketched_distinct_metrics(sums, labelled, sketches).where("grain <> 'restaurant'"))


def q_ctr_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = (
        "avg_position",
        "expected_ctr",
        "position_ctr_residual",
        "nboi_click_gap_pct",
        "nboi_click_opportunity",
        "residual_z_score",
    )
    # Adding zero turns a rounded -0.0 into 0.0.
    return ctr_residual(unified(spark, sf_dir)).withColumns({c: F.round(c, 6) + F.lit(0.0) for c in measures})


def q_build_from_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = build(shapes.search_export(spark, sf_dir), shapes.label_export(spark, sf_dir))
    return metric_rows(built.unified_metrics)


def q_full_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "build")
    built = build(shapes.search_export(spark, sf_dir), shapes.label_export(spark, sf_dir), root=root)
    return metric_rows(built.restaurant_metrics)


def q_declared_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "build")
    return build(shapes.search_export(spark, sf_dir), shapes.label_export(spark, sf_dir), root=root).check()


def q_clustered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "unified_metrics")
    write_clustered(unified(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    return metric_rows(stored.where("grain = 'restaurant' AND search_type = 'Branded'").select(*metrics.UNIFIED))


def q_share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = shapes.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_returnflag",
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    by_supplier = share_of_total(lines, ["l_suppkey"], {"pct_of_supplier": "quantity"})
    return share_of_total(by_supplier, ["l_returnflag"], {"pct_of_flag": "quantity"}, source=lines)


# --- loads -----------------------------------------------------------------


def _state(df: DataFrame) -> DataFrame:
    return df.select("user_id", "event_id", F.date_format("ts", TIME_FORMAT).alias("ts"), "event_type", "value")


def _before(df: DataFrame, time: str) -> DataFrame:
    return df.where(F.col("ts") < F.lit(time).cast(df.schema["ts"].dataType))


def q_incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(spark, sf_dir)
    return _state(incremental_read(source, _before(source, SPLIT_TIME), "ts"))


def q_latest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(spark, sf_dir)
    keys, order = ["user_id"], ["ts", "event_id"]
    target = materialize(latest_per_key(_before(source, SPLIT_TIME), keys, order), "target")
    delta = materialize(latest_per_key(incremental_read(source, target, "ts"), keys, order), "delta")
    return _state(upsert(target, delta, keys))


def _load_table(spark: SparkSession, name: str) -> LoadTable:
    return LoadTable(spark, scratch_path(spark, name), ["user_id"], ["ts", "event_id"])


def _arrived(spark: SparkSession, sf_dir: str) -> LoadTable:
    table = _load_table(spark, "loads")
    for time in ARRIVALS:
        table.merge_new(_before(events(spark, sf_dir), time), "ts")
    table.merge_new(events(spark, sf_dir), "ts")
    return table


def q_merge_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(_arrived(spark, sf_dir).current())


def q_compact_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(_arrived(spark, sf_dir).compact(scratch_path(spark, "compacted")).current())


def q_load_search_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw export loaded in three steps, the latest document of each restaurant kept, then flattened."""
    raw = scratch_path(spark, "search_export")
    write_full(shapes.search_export(spark, sf_dir), raw)
    source = read_search_export(spark, raw)
    table = LoadTable(spark, scratch_path(spark, "loaded"), ["restaurant_id"], ["_updated_at"])
    newest = source.agg(F.max("_updated_at")).first()[0]
    for share in (3, 2, 1):
        step = F.lit(shapes.LOADED).cast("timestamp")
        until = step + (F.lit(newest) - step) / share
        table.merge_new(source.where(F.col("_updated_at") <= until), "_updated_at")
    return flatten_search_export(table.current())


def _third(rows: DataFrame, load: int) -> DataFrame:
    """A load: a third of the orders, of all restaurants, then of every second, then of every third."""
    return rows.where((F.col("l_orderkey") % 3 == load) & (F.col("restaurant_id") % (load + 1) == 0))


def q_maintained_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics after three loads, each of which replaces the rows of its restaurants."""
    labelled = labels(spark, sf_dir)
    known = materialize(label_names(labelled), "known-names")
    rows = shapes.search_queries(spark, sf_dir)
    state = maintained.start(_third(rows, 0), lambda df: classify_queries(df, known, with_score=False))
    for load in (1, 2):
        state = maintained.apply_load(state, _third(rows, load), lambda df: classify_queries(df, known, with_score=False))
    return metric_rows(metrics.all_grains(state.totals, labelled))


def q_late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load brings when every seventh event came late, and what the same load brings once more: nothing."""
    source = events(spark, sf_dir)
    loaded = _before(source, SPLIT_TIME).where("event_id % 7 <> 0")
    found = []
    for load in (1, 2):
        new = materialize(late_arrivals(source, loaded, ["user_id", "event_id"], "ts"), "late")
        found.append(_state(new).withColumn("load", F.lit(load)))
        loaded = loaded.unionByName(new)
    return found[0].unionByName(found[1])


def q_refresh_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label export written over an earlier copy, read back and flattened."""
    path = scratch_path(spark, "label_export")
    for _ in range(2):
        write_full(shapes.label_export(spark, sf_dir), path)
    return flatten_labels(read_label_export(spark, path))


def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, so that the table may be one file as well as a folder of files.
    stream = read_file_stream(spark, f"{sf_dir}/events.parque[t]", events(spark, sf_dir).schema)
    table = _load_table(spark, "stream")
    stream_upsert(stream, table, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return _state(table.current())


def q_mixed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, a stream, a compaction and a fresh stream; each brings rows that no other step has brought before."""
    rows = events(spark, sf_dir)
    stream = read_file_stream(spark, f"{sf_dir}/events.parque[t]", rows.schema)
    table = _load_table(spark, "mixed")
    table.merge_new(_before(rows, ARRIVALS[0]), "ts")
    stream_upsert(_before(stream, ARRIVALS[1]), table, scratch_path(spark, "first-checkpoint")).awaitTermination()
    table = table.compact(scratch_path(spark, "mixed-compacted"))
    stream_upsert(stream, table, scratch_path(spark, "fresh-checkpoint")).awaitTermination()
    return _state(table.current())


# --- history ---------------------------------------------------------------


def q_snapshot_in_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(spark, sf_dir)
    path = scratch_path(spark, "snapshots")
    for date in SNAPSHOT_DATES:
        state = latest_per_key(_before(source, f"{date} 00:00:00"), ["user_id"], ["ts", "event_id"])
        history.snapshot_dimension(state.select("user_id", "event_type"), date, path)
    facts = source.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.max("event_id").alias("last_id"))
    joined = history.snapshot_in_effect(facts, spark.read.parquet(path), ["user_id"], AS_OF)
    return joined.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def _intervals(df: DataFrame) -> DataFrame:
    return history.scd2_intervals(df, ["user_id"], "ts", ["event_type"], order=["event_id"])


def _with_text_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, TIME_FORMAT) for c in columns})


def q_scd2_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_text_times(_intervals(events(spark, sf_dir)), "effective_start_date", "effective_end_date")


def _interval_join(how: str, slice_rows: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = events(spark, sf_dir)
        purchase = F.col("event_type") == "purchase"
        facts = source.where(purchase).select("user_id", "event_id", "ts", "value")
        joined = history.scd2_join(facts, _intervals(source.where(~purchase)), ["user_id"], "ts", how, slice_rows)
        return _with_text_times(joined, "ts", "effective_start_date", "effective_end_date")

    return run


def q_asof_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuisine metrics of each month by the cuisines stored last before it."""
    labelled = labels(spark, sf_dir)
    path = scratch_path(spark, "cuisine-snapshots")
    shapes.dated_labels(labelled).write.partitionBy("snapshot_date").parquet(path)
    queries = metrics.collapse_queries(shapes.search_queries(spark, sf_dir), ["reported"])
    classified = classify_queries(queries, label_names(labelled), with_score=False)
    found = metric_rows(metrics.asof_metrics(classified, spark.read.parquet(path), "reported"))
    return found.withColumns({c: F.col(c).cast("string") for c in ("reported", "snapshot_date")})


# --- checks ----------------------------------------------------------------


def broken_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The flat tables, and copies with faults put in."""
    queries, labelled = flat_queries(spark, sf_dir), labels(spark, sf_dir)
    classified = shapes.rule_queries(spark, sf_dir).select(
        "restaurant_id",
        F.when(F.col("impressions") > 40, F.col("domain")).alias("domain"),
        F.when(F.col("clicks") > 2, F.lit("Other")).otherwise(F.lit("Branded")).alias("search_type"),
    )
    return {
        "queries": queries,
        "label_names": label_names(labelled),
        "broken_queries": queries.withColumn("query", F.when(F.col("clicks") > 0, F.col("query"))),
        "broken_label_names": labelled.select(F.when(F.col("cuisine") != "ring", F.col("cuisine")).alias("cuisine")),
        "broken_classified": classified,
    }


BROKEN_CHECKS = (
    *not_null("queries", "restaurant_id", "domain", "clicks", "ctr", "impressions", "position", "query"),
    *not_null("label_names", "cuisine"),
    Check("label_names", "cuisine", "unique"),
    *not_null("broken_queries", "clicks", "query"),
    *not_null("broken_queries", "query", where="impressions > 0"),
    *not_null("broken_label_names", "cuisine"),
    Check("broken_label_names", "cuisine", "unique"),
    *not_null("broken_classified", "domain"),
    Check("broken_classified", "search_type", "accepted_values", ("Branded", "Unbranded")),
)


def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(broken_tables(spark, sf_dir), BROKEN_CHECKS)


def q_indexed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which distinct queries any of the rules made from the parts fits."""
    found = with_any_rule(pairs(spark, sf_dir), shapes.part_rules(spark, sf_dir))
    return found.select(RAW, "domain", "n_rows", "ruled")


QUERIES: dict[str, Query] = {
    "flatten_props": q_flatten_props,
    "flatten_search_export": q_flatten_search_export,
    "flatten_dirty_export": q_flatten_dirty_export,
    "flatten_labels": labels,
    "flatten_dirty_labels": q_flatten_dirty_labels,
    "label_names": q_label_names,
    "normalize_query": q_normalize_query,
    "brand_name": q_brand_name,
    "jaro_winkler_score": q_jaro_winkler_score,
    "match_fuzzy": _rule_query("matched", lambda q, b, r: rules.match_fuzzy(q, b)),
    "match_substring": _rule_query("matched", lambda q, b, r: rules.match_substring(q, b)),
    "match_tokens": _rule_query("matched", rules.match_tokens),
    "match_prefix": _rule_query("matched", lambda q, b, r: rules.match_prefix(q, b)),
    "exclude_false_positives": q_exclude_false_positives,
    "brand_overrides": _rule_query("overridden", rules.brand_overrides),
    "indexed_rules": q_indexed_rules,
    "classify_queries": q_classify_queries,
    "classify_rules": q_classify_rules,
    "entity_metrics": q_entity_metrics,
    "attributed_metrics": q_attributed_metrics,
    "global_metrics": q_global_metrics,
    "unified_metrics": q_unified_metrics,
    "exact_distinct_metrics": q_exact_distinct_metrics,
    "sketched_distinct_metrics": q_sketched_distinct_metrics,
    "restaurant_metrics": q_restaurant_metrics,
    "cuisine_metrics": q_cuisine_metrics,
    "ctr_residual": q_ctr_residual,
    "build_from_exports": q_build_from_exports,
    "full_build": q_full_build,
    "declared_checks": q_declared_checks,
    "clustered_table": q_clustered_table,
    "share_of_total": q_share_of_total,
    "incremental_read": q_incremental_read,
    "late_arrivals": q_late_arrivals,
    "latest_upsert": q_latest_upsert,
    "merge_loads": q_merge_loads,
    "compact_loads": q_compact_loads,
    "mixed_loads": q_mixed_loads,
    "load_search_export": q_load_search_export,
    "maintained_metrics": q_maintained_metrics,
    "refresh_labels": q_refresh_labels,
    "stream_upsert": q_stream_upsert,
    "snapshot_in_effect": q_snapshot_in_effect,
    "scd2_intervals": q_scd2_intervals,
    "scd2_join": _interval_join("inner", history.SLICE_ROWS),
    "scd2_join_slices": _interval_join("inner", SMALL_SLICE),
    "scd2_join_left": _interval_join("left", SMALL_SLICE),
    "asof_metrics": q_asof_metrics,
    "quality_report": q_quality_report,
}
