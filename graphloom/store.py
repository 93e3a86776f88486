"""The engine's store: a triple set behind views, with queries, updates and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import answer, patterns, plan, retrieve


class GraphStore:
    """Triples (s, p, o, kind, lang) of a schema graph and a data graph, as one set behind the view ``triples``."""

    def __init__(self, *graphs: DataFrame, view: str = "triples"):
        self.view = view
        whole = graphs[0]
        for g in graphs[1:]:
            whole = whole.unionByName(g)
        self._use(whole.distinct())

    def _use(self, triples: DataFrame) -> None:
        self.triples = triples
        triples.createOrReplaceTempView(self.view)

    @property
    def spark(self) -> SparkSession:
        return self.triples.sparkSession

    def select(self, sql: str) -> DataFrame:
        """A query over the view; unbound values are null."""
        return self.spark.sql(sql)

    def ask(self, sql: str) -> bool:
        return not self.spark.sql(sql).isEmpty()

    def size(self) -> int:
        return self.triples.count()

    def add(self, triples: DataFrame) -> GraphStore:
        self._use(patterns.union(self.triples, triples))
        return self

    def remove(self, triples: DataFrame) -> GraphStore:
        self._use(patterns.without(self.triples, triples))
        return self

    def publish(self, path: str) -> int:
        """Write the set by predicate, so that patterns with a bound predicate read only its files; gives its size."""
        self.triples.repartition("p", F.pmod(F.xxhash64("s"), F.lit(16))).write.mode("overwrite").partitionBy("p").parquet(path)
        return self.spark.read.parquet(path).count()

    @classmethod
    def load(cls, spark: SparkSession, path: str, view: str = "triples") -> GraphStore:
        return cls(spark.read.parquet(path), view=view)

    def health(self) -> dict:
        """State and size; never raises."""
        try:
            return {"available": True, "empty": self.triples.isEmpty(), "triples": self.size()}
        except Exception as e:  # the state of a store is asked for when it may be broken
            return {"available": False, "error": str(e).splitlines()[0]}

    def run(self, p: retrieve.Plan) -> DataFrame:
        return retrieve.run_plan(self.triples, p)

    def answer(self, questions: DataFrame) -> DataFrame:
        """Answers of questions (id, text), all at once: candidates by words, their triples as evidence, rendered values."""
        found = plan.generic_candidates(questions, self.triples)
        rows = found.select("id", F.col("node").alias("s"), F.col("score").alias("shared")).join(self.triples.where("p <> 'type'").select("s", "p", "o"), "s")
        return answer.rendered(questions, rows)
