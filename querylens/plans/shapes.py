"""Search-shaped inputs derived from the star-schema tables."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from querylens.operators.joins import lookup_join
from querylens.sources.scan import balanced, heavy_tasks
from querylens.sources.scratch import materialize

# Orders whose lines share one export document: bounds a document's size whatever the data's.
ORDERS_PER_DOCUMENT = 4096
LOADED = "2024-01-01"
# When the cuisines were stored.
SET_DATES = tuple(datetime.date(*day) for day in ((1996, 7, 1), (1998, 1, 1), (1999, 3, 15), (2000, 6, 1)))

# Test inputs, queries and domains in which each rule of the classification decides some pair.
RULE_CASES = (
    ("pizza dados", "dadospizzaok.com"),
    ("dadospizzaok", "dadospizzaok.com"),
    ("ovn bellingham", "ovnwoodfiredpizza.com"),
    ("thai", "thaibasil.com"),
    ("pizza", "pizzapalace.com"),
    ("tacos near me", "tacosbymax.com"),
    ("tacos", "tacosbymax.com"),
    ("fries near me", "friesandmore.com"),
    ("fries", "friesandmore.com"),
    ("x", "xfood.com"),
    ("a pizza place", "amore.com"),
    ("smash burger", "smashsd.com"),
    ("smashed", "smashsd.com"),
    ("flavorful curry", "flavorsofindia.com"),
    ("flavors of india", "flavorsofindia.com"),
    ("mediterranean", "mediterraneangrill.com"),
    ("my pie", "pizzayourway.com"),
    ("tacos and beer vegas", "tbmx1.com"),
    ("henry higgins", "hhboiledbagels.com"),
    ("goodfellas", "tharealgoodfellas.com"),
    ("saigon 8", "saigon8vegas.com"),
    ("the modern vegan", "tmvrestaurants.com"),
    ("el sombrero", "thesombrero.com"),
    ("chubbfather", "thechubbfather.com"),
    ("aarus", "aaruz.com"),
    ("aarus indian", "aaruz.com"),
    ("pepz stadium", "stadiumpepz.com"),
    ("threes", "3happinessomaha.com"),
    ("three  happiness", "3happinessomaha.com"),
    ("dialogue cafe la", "dialogcafe.com"),
    ("best delivery pizza chicago", "bestpizza.com"),
    ("Pizza Dados", "dadospizzaok.com"),
    ("sushi downtown", "dadospizzaok.com"),
    ("pizza dados near me", "dadospizzaok.com"),
    ("joe's menu", "joes.com"),
    ("a & r tacos", "tacosaandr.com"),
    ("big bowl", "big-bowl.com"),
    ("bowl", "big-bowl.com"),
    ("indian in seattle taste", "tasteofindia.com"),
    ("anything", "nodotdomain"),
    ("the delaware pub", "delawarepubandgrill.com"),
    ("", "foo.com"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _word(name: Column, i: int) -> Column:
    return F.split(name, " ")[i]


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A restaurant per supplier: the domain, and the words and type of the part it is named after."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey")
    key, adjective, noun = F.col("s_suppkey"), _word(F.col("p_name"), 0), _word(F.col("p_name"), 1)
    host = (
        F.when(key % 5 == 0, F.concat_ws("-", adjective, noun))
        .when(key % 5 == 1, F.concat(noun, adjective, F.lit("ok")))
        .otherwise(F.concat(adjective, noun))
    )
    suffix = F.when(key % 2 == 0, F.lit(".com")).otherwise(F.lit(".net"))
    return supplier.join(part, supplier.s_suppkey == part.p_partkey).select(
        key.alias("restaurant_id"),
        F.concat(host, suffix).alias("domain"),
        noun.alias("noun"),
        F.lower("p_type").alias("kind"),
    )


def _measures() -> list[Column]:
    quantity = F.col("l_quantity")
    return [
        F.floor(quantity * F.col("l_tax")).cast("bigint").alias("clicks"),
        F.col("l_tax").alias("ctr"),
        F.when(F.col("l_linenumber") == 7, F.lit(0)).otherwise(quantity).cast("bigint").alias("impressions"),
        (1 + F.round(F.col("l_discount") * 100)).cast("double").alias("position"),
    ]


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat search query per line item, with the order it comes from and the month it is reported for."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    lines = balanced(table(spark, sf_dir, "lineitem"))
    name, number = F.col("p_name"), F.col("l_linenumber")
    adjective, noun = _word(name, 0), _word(name, 1)
    query = (
        F.when(number == 1, name)
        .when(number == 2, F.concat(name, F.lit(" near me")))
        .when(number == 3, F.concat(name, F.lit(" menu")))
        .when(number == 4, F.concat(name, F.lit(" $20")))
        .when(number == 5, F.concat(noun, F.lit("s")))
        .when(number == 6, F.concat(adjective, F.lit(" "), noun, F.lit("s & grill")))
        .otherwise(adjective)
    )
    domains = materialize(brands(spark, sf_dir).select("restaurant_id", "domain"), "domains")
    searched = lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.col("l_suppkey").alias("restaurant_id"),
        "l_orderkey",
        F.trunc("l_shipdate", "month").alias("reported"),
        *_measures(),
        query.alias("query"),
    )
    return lookup_join(searched, domains, ["restaurant_id"], how="inner").select(
        "restaurant_id", "domain", "clicks", "ctr", "impressions", "position", "query", "l_orderkey", "reported"
    )


def rule_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat search query per line item, out of the cases above, some with an order number added."""
    case = F.pmod(F.col("l_partkey") + F.col("l_linenumber"), F.lit(len(RULE_CASES))).cast("int")

    def pick(i: int) -> Column:
        return F.get(F.array(*[F.lit(c[i]) for c in RULE_CASES]), case)

    extended = F.col("l_linenumber") % 3 == 0
    query = F.when(extended, F.concat(pick(0), F.lit(" "), F.col("l_orderkey") % 100)).otherwise(pick(0))
    return balanced(table(spark, sf_dir, "lineitem")).select(
        F.col("l_suppkey").alias("restaurant_id"), pick(1).alias("domain"), *_measures(), query.alias("query")
    )


def rule_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("thai",), ("indian",), ("pizza",), ("mediterranean",)], "cuisine string")


def search_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat queries packed into JSON documents, several per restaurant.

    Rows are dealt to the documents' tasks before they are gathered: Spark
    would otherwise sort all of them ahead of the shuffle too, to gather the few of a document that a task reads.
    The tasks are many, as what reads the documents mostly parses them in the same tasks.
    """
    record = F.struct(F.array("query").alias("keys"), "clicks", "ctr", "impressions", "position")
    first_order = F.floor(F.col("l_orderkey") / ORDERS_PER_DOCUMENT)
    loaded = F.lit(LOADED).cast("timestamp")
    document = ("restaurant_id", "domain", "chunk")
    return (
        search_queries(spark, sf_dir)
        .withColumn("chunk", first_order)
        .repartition(heavy_tasks(spark), *document)
        .groupBy(*document)
        .agg(F.to_json(F.struct(F.collect_list(record).alias("rows"))).alias("data"))
        .select(
            "restaurant_id",
            "domain",
            (loaded + F.make_dt_interval(F.lit(0), F.lit(0), F.col("chunk").cast("int"))).alias("_updated_at"),
            loaded.alias("_created_at"),
            F.lit("done").alias("status"),
            "data",
        )
    )


def label_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON list of cuisines for nine restaurants in ten; every seventh lists its first one twice."""
    names = F.array("noun", "kind")
    repeated = F.when(F.col("restaurant_id") % 7 == 0, F.array("noun")).otherwise(F.array())
    return (
        brands(spark, sf_dir)
        .where("restaurant_id % 10 <> 0")
        .select("restaurant_id", F.to_json(F.concat(names, repeated)).alias("cuisines"))
    )


def _picked(texts: list[Column], case: Column) -> Column:
    return F.get(F.array(*texts), F.pmod(case, F.lit(len(texts))).cast("int"))


def _filled(texts: Sequence[str | None], case: Column, value: Column) -> Column:
    """The text that is picked, with each ``@`` replaced by a value; the others aren't made."""
    return F.replace(_picked([F.lit(t).cast("string") for t in texts], case), F.lit("@"), value.cast("string"))


# Test inputs: documents of an export as they shouldn't be, and some that are right; @ is a number.
DIRTY_DOCUMENTS = (
    '{"rows":[{"keys":["first @"],"clicks":@,"ctr":0.5},{"keys":["second","x"],"clicks":1,"position":2}]}',
    "bad{@",
    '{"x":@}',
    '{"rows":null}',
    '{"rows":[]}',
    '{"rows":@}',
    None,
    '{"rows":{"a":{"clicks":@}}}',
    '{"rows":[{"clicks":@.6}]}',
    '{"rows":[{"clicks":"@"}]}',
    '{"rows":[{"clicks":"x@"}]}',
    '{"rows":[{"keys":[],"clicks":@}]}',
    '{"rows":[{"keys":[null],"clicks":@}]}',
    '{"rows":[{"keys":["  a @ "]}]}',
    '{"rows":[{"clicks":@}]}] trailing',
    "{'rows':[{'clicks':@}]}",
    '{"rows":[{"clicks":@},NaN]}',
    '{"rows":[{"clicks":0}],"rows":[{"clicks":@}]}',
    '{"rows":[{"clicks":0,"clicks":@}]}',
    '{"rows":[null,@]}',
)
# Lists of cuisines likewise; @ is a name.
DIRTY_LABELS = (
    '["  @ "]',
    '["\\"@\\"", " \\" @"]',
    "bad[@",
    '"@"',
    '[null, "@"]',
    '["@"]] trailing',
    '{"a":"@ "}',
    '[" \\" "]',
    "[5]",
    None,
    "['@']",
)


def dirty_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per line item, out of the cases above."""
    number = F.floor("l_quantity").cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("restaurant_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("domain"),
        _filled(DIRTY_DOCUMENTS, F.col("l_orderkey") + F.col("l_linenumber"), number).alias("data"),
    )


def dirty_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of cuisines per part, out of the cases above."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("restaurant_id"), _filled(DIRTY_LABELS, F.col("p_partkey"), F.col("p_name")).alias("cuisines")
    )


def dated_labels(labels: DataFrame) -> DataFrame:
    """The labels as they were on several dates: a fourth of the restaurants is missing, a third serves fusion."""
    stored = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(d).alias("snapshot_date")) for i, d in enumerate(SET_DATES)])
    dated = labels.select("restaurant_id", "cuisine", F.inline(stored)).where((F.col("restaurant_id") + F.col("i")) % 4 != 0)
    fusion = (F.col("restaurant_id") + F.col("i")) % 3 == 0
    return dated.select("snapshot_date", "restaurant_id", F.when(fusion, "fusion").otherwise(F.col("cuisine")).alias("cuisine"))


def part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule (brand, pattern, field, regex) for each part, from the two words of its name; many are alike."""
    part = table(spark, sf_dir, "part")
    adj, noun, key = _word(F.col("p_name"), 0), _word(F.col("p_name"), 1), F.col("p_partkey")
    tail = F.substring(noun, F.lit(2), F.lit(3))
    brand = _picked([F.concat(adj, F.lit("%")), F.concat(F.lit("%"), noun, F.lit("%")), F.concat(F.lit("%"), tail, F.lit("%ok")), F.lit("%")], key)
    like = _picked([F.concat(F.lit("%"), noun, F.lit("s%")), F.concat(adj, F.lit(" "), noun, F.lit("_%")), F.concat(F.lit("_%"), tail, F.lit("% near%"))], key)
    regex = (key % 4 == 1) & (key % 5 == 0)
    field = F.when(regex | (key % 3 == 2), "raw").otherwise("query")
    return part.select(
        brand.alias("brand"),
        F.when(regex, F.concat(F.lit("^"), adj, F.lit(".*(menu|near)"))).otherwise(like).alias("pattern"),
        field.alias("field"),
        regex.alias("regex"),
    )
