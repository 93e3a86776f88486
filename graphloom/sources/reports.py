"""Sinks of reports, registries and catalogs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_report(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines behind those that are there; each run has its time."""
    rows.withColumn("written_at", F.current_timestamp()).write.mode("append").json(path)


def write_registry(registry: DataFrame, path: str) -> None:
    """Minted names (key, name), a row a key, ordered by key."""
    registry.groupBy("key").agg(F.min("name").alias("name")).orderBy("key").write.mode("overwrite").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, name string").parquet(path)


def write_terms(terms: DataFrame, path: str) -> None:
    """A term cache: one JSON object with its time, count and terms (term, uri), which ``chunks.read_terms`` takes."""
    one = terms.agg(F.sort_array(F.collect_set(F.struct("term", "uri"))).alias("terms"))
    one.select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at"), F.size("terms").alias("total_terms"), "terms").coalesce(1).write.mode("overwrite").json(path)


def policy_matrix(spark: SparkSession, plans: Iterable[tuple[str, object]]) -> DataFrame:
    """(family, steps, widest, bounded): of each family how many steps it has, the widest bound, and whether all have one."""
    rows = [(name, len(p.steps), max((s.most or 0 for s in p.steps), default=0), all(s.most is not None for s in p.steps)) for name, p in plans]
    return spark.createDataFrame(rows, "family string, steps int, widest int, bounded boolean")


def rules(spark: SparkSession, **ordered: Iterable[tuple[str, str]]) -> DataFrame:
    """(rules, position, pattern, result): ordered rules of normalisation and rendering as rows, to be written as a catalog."""
    rows = [(name, i, a, b) for name, of in ordered.items() for i, (a, b) in enumerate(of)]
    return spark.createDataFrame(rows, "rules string, position int, pattern string, result string")


def catalog(spark: SparkSession, plans: Iterable[tuple[str, object]]) -> DataFrame:
    """(family, step, predicate, incoming, most, describe): plans of families as rows, to be written as a catalog."""
    rows = [(name, i, s.predicate, s.incoming, s.most, ",".join(p.describe)) for name, p in plans for i, s in enumerate(p.steps)]
    return spark.createDataFrame(rows, "family string, step int, predicate string, incoming boolean, most int, describe string")
