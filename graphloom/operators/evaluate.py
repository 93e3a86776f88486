"""Evaluation of answers: precision and recall, match modes, histograms, exemplars and paired runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def precision_recall(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(id, precision, recall): both inputs have id and item; 0 where a side is empty."""
    e = expected.distinct().withColumn("e", F.lit(1))
    f = found.distinct().withColumn("f", F.lit(1))
    n = e.join(f, ["id", "item"], "full_outer").groupBy("id").agg(F.count("e").alias("ne"), F.count("f").alias("nf"), F.sum(F.coalesce("e", F.lit(0)) * F.coalesce("f", F.lit(0))).alias("both"))
    rate = lambda total: F.when(F.col(total) > 0, F.round(F.col("both") / F.col(total), 4)).otherwise(F.lit(0.0))
    return n.select("id", rate("nf").alias("precision"), rate("ne").alias("recall"))


def match_mode(overlap: Column, equal: Column) -> Column:
    """exact, high_partial, partial, weak or none, from equality and the share of expected words."""
    return F.when(equal, "exact").when(overlap >= 0.75, "high_partial").when(overlap >= 0.4, "partial").when(overlap > 0, "weak").otherwise("none")


def histograms(results: DataFrame, *columns: str) -> DataFrame:
    """(what, value, n): counts by each column, in one pass over grouping sets."""
    long = results.select(F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).cast("string").alias("value")) for c in columns])).alias("e"))
    return long.groupBy("e.what", "e.value").agg(F.count("*").alias("n"))


def exemplars(results: DataFrame, category: str, *order: Column) -> DataFrame:
    """The first result of each category."""
    return results.withColumn("__r", F.row_number().over(Window.partitionBy(category).orderBy(*order))).where("__r = 1").drop("__r")


def aligned(pairs: DataFrame) -> DataFrame:
    """(n_pairs, same_intent, same_plan, share): over rows with intents and plans of both runs."""
    return pairs.agg(
        F.count("*").alias("n_pairs"),
        F.count_if(F.col("intent_a") == F.col("intent_b")).alias("same_intent"),
        F.count_if(F.col("plan_a") == F.col("plan_b")).alias("same_plan"),
        F.coalesce(F.round(F.avg((F.col("intent_a") == F.col("intent_b")).cast("double")), 4), F.lit(0.0)).alias("share"),
    )


def equivalence(a: DataFrame, b: DataFrame) -> DataFrame:
    """(only_a, only_b, both, status) of two results of one query."""
    cols = a.columns
    n = a.distinct().withColumn("__a", F.lit(1)).join(b.distinct().withColumn("__b", F.lit(1)), cols, "full_outer")
    out = n.agg(F.count_if(F.col("__b").isNull()).alias("only_a"), F.count_if(F.col("__a").isNull()).alias("only_b"), F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("both"))
    return out.withColumn("status", F.when((F.col("only_a") == 0) & (F.col("only_b") == 0), "equivalent").when(F.col("both") > 0, "partial").otherwise("failed"))
