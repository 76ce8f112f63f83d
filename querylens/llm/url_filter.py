"""URL filter: rules by host and path, and boosted trees on lexical features for the URLs that no rule fits.

The URLs that a rule fits are the labelled ones. The trees learn from them
what blocked URLs look like, by features of the text alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from querylens.operators.joins import lookup_join
from querylens.sources.scratch import materialize

# Labelled URLs that the trees are fitted on, at most; beyond it they are drawn by a hash of their text.
SAMPLE = 200_000
TREES = 20
DEPTH = 4
SEED = 7

_NUMBERS = (
    "length",
    "host_length",
    "path_length",
    "depth",
    "labels",
    "digit_ratio",
    "host_digit_ratio",
    "hyphens",
    "entropy",
    "parameters",
    "has_fragment",
    "is_https",
    "longest_label",
)
_SUFFIXES = ("suffix", "domain", "first_folder")
FEATURES = (*_NUMBERS, *(f"{s}_{x}" for s in _SUFFIXES for x in ("rate", "seen")))


@dataclass(frozen=True)
class Rule:
    """Allow or block a host, its subdomains, and the paths that start with ``path``."""

    host: str
    path: str
    block: bool

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", False),
    Rule("example.com", "/en/", True),
    Rule("www.example.com", "/en/", False),
    Rule("net", "/es/", True),
    Rule("net", "/fr/", True),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark or hash, A to Z in lower case; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(rules: Sequence[Rule], field) -> Column:
    """``field`` of the longest rule that fits the columns ``host`` and ``path``; NULL if none does."""
    chosen = F.lit(None)
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        inside = (F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")
        chosen = F.when(inside & F.col("path").startswith(rule.path), F.lit(field(rule))).otherwise(chosen)
    return chosen


def _count(text: Column, what: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(what), F.lit("")))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _digits(text: Column) -> Column:
    return _ratio(F.char_length(F.regexp_replace(text, "[^0-9]", "")), F.char_length(text))


def _entropy(text: Column) -> Column:
    """Bits per character of the text's own distribution of characters."""
    total = F.char_length(text)

    def add(sum_: Column, char: Column) -> Column:
        share = (total - F.char_length(F.replace(text, char, F.lit("")))) / total
        return sum_ - share * F.log2(share)

    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.when(total > 0, F.aggregate(chars, F.lit(0.0), add)).otherwise(0.0)


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with host, path, the numeric features, and the suffixes whose statistics are features."""
    text = F.coalesce(F.col(url), F.lit(""))
    placed = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    longest = F.aggregate(labels, F.lit(0), lambda m, x: F.greatest(m, F.char_length(x)))
    made = {
        "length": F.char_length(text),
        "host_length": F.char_length(host),
        "path_length": F.char_length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")),
        "labels": F.size(labels),
        "digit_ratio": _digits(text),
        "host_digit_ratio": _digits(host),
        "hyphens": _count(host, "-"),
        "entropy": _entropy(text),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")),
        "has_fragment": F.contains(text, F.lit("#")).cast("int"),
        "is_https": F.lower(text).startswith("https://").cast("int"),
        "longest_label": longest,
    }
    numbers = {name: column.cast("double") for name, column in made.items()}
    suffixes = {
        "suffix": F.substring_index(host, ".", -1),
        "domain": F.substring_index(host, ".", -2),
        "first_folder": F.split_part(path, F.lit("/"), F.lit(2)),
    }
    return placed.withColumns({**numbers, **suffixes})


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """Per kind and value of a suffix: the smoothed share of blocked URLs (``rate``) and the logarithm of their number (``seen``).

    Counted over all labelled URLs; hot suffixes are combined before the shuffle.
    """
    kinds = F.array(*[F.struct(F.lit(s).alias("kind"), F.col(s).alias("value")) for s in _SUFFIXES])
    each = labelled.select("block", F.explode(kinds).alias("s")).groupBy("s.kind", "s.value")
    sums = each.agg(F.sum("block").alias("blocked"), F.count(F.lit(1)).alias("n"))
    rate = (F.col("blocked") + 1) / (F.col("n") + 2)
    return sums.select("kind", "value", rate.alias("rate"), F.log1p("n").alias("seen"))


def with_statistics(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    """``rows`` with the statistics of their suffixes; those of an unknown one are 0.5 and 0."""
    for kind in _SUFFIXES:
        of_kind = statistics.where(F.col("kind") == kind).select(
            F.col("value").alias(kind), F.col("rate").alias(f"{kind}_rate"), F.col("seen").alias(f"{kind}_seen")
        )
        rows = lookup_join(rows, of_kind, [kind]).fillna({f"{kind}_rate": 0.5, f"{kind}_seen": 0.0})
    return rows


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def fit_trees(labelled: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH) -> GBTClassificationModel | None:
    """Trees fitted on distinct labelled rows with features; None if there are fewer than two kinds of labels.

    Beyond ``sample`` rows, a share of them is drawn by a hash of the URL's text.
    """
    counts = {r["block"]: r["n"] for r in labelled.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    share = min(1.0, sample / sum(counts.values()))
    drawn = labelled if share == 1 else labelled.where(F.pmod(F.xxhash64("url_text"), F.lit(1 << 30)) < share * (1 << 30))
    model = GBTClassifier(labelCol="block", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=SEED, cacheNodeIds=False)
    return model.fit(_assembled(drawn))


def judge_urls(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    sample: int = SAMPLE,
    threshold: float = 0.5,
) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, score) of each row of ``pages``.

    The longest rule that fits decides. Other URLs are blocked if the trees'
    probability of a blocked URL, ``score``, reaches ``threshold``. If no URL
    is labelled, or all alike, ``score`` is that label's (0 for none). NULL
    URLs, and those without ``://``, have an empty host and path, fit no rule
    with a host, and are scored like any text. Repeated rows are judged alike,
    and an empty table gives an empty one. Other columns are not read.
    """
    urls = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    urls = lexical(urls).withColumn("rule", longest_rule(rules, lambda r: r.text).cast("string"))
    urls = urls.withColumn("block", longest_rule(rules, lambda r: int(r.block)).cast("double"))
    urls = materialize(urls, "url-features")
    # The trees see every URL once, however many pages have it.
    labelled = urls.where("block is not null").withColumnRenamed("url", "url_text").drop("page_id")
    labelled = labelled.dropDuplicates(["url_text"])
    statistics = materialize(suffix_statistics(labelled), "suffixes")
    model = fit_trees(materialize(with_statistics(labelled, statistics), "labelled-urls"), sample)
    if model is None:
        alike = urls.agg(F.max("block")).first()[0] or 0.0
        scored = urls.withColumn("score", F.lit(alike))
    else:
        scored = model.transform(_assembled(with_statistics(urls, statistics)))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    blocked = F.coalesce(F.col("block") > 0, F.col("score") >= threshold)
    verdict = F.when(blocked, "block").otherwise("allow").alias("verdict")
    return scored.select("page_id", "url", "host", "path", "rule", verdict, "score")
