"""Readers and writers of reports, extraction input and question sets, as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DENSITY = "chunk_id long, manual_id string, text string, n_words long, n_terms long, density double, level string"
INPUT = "chunk_id long, manual_id string, pages array<string>, section string, title string, text string, source_language string, chunk_hash string"
_QUESTION = "question_id string, question string, answer string, intent string, expected_uris array<string>, evaluation_mode string"
QUESTIONS = f"{_QUESTION}, group_name string, language string"


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON array or of JSON lines, with the columns of the schema; null where a row lacks one."""
    return spark.read.schema(schema).json(path, multiLine=not path.endswith("l"))


def write_rows(rows: DataFrame, path: str, schema: str, *order: str) -> None:
    """Rows with the columns of the schema, those it lacks as null, as JSON lines in order."""
    want = rows.sparkSession.createDataFrame([], schema).schema
    out = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want])
    out.orderBy(*order).write.mode("overwrite").json(path)


def read_density(spark: SparkSession, path: str) -> DataFrame:
    return read_rows(spark, path, DENSITY)


def write_density(report: DataFrame, path: str) -> None:
    write_rows(report, path, DENSITY, "chunk_id")


def read_input(spark: SparkSession, path: str) -> DataFrame:
    return read_rows(spark, path, INPUT)


def write_input(payload: DataFrame, path: str) -> None:
    write_rows(payload, path, INPUT, "chunk_id")


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """Questions of a set in any of three shapes: blocks [{group, questions: [...]}], pairs {pairs: [{case_id, questions:
    {es, en}, expected_answer, expected_uris}]} (a row a language), or a plain array of questions. One file, one shape."""
    raw = spark.read.text(path, wholetext=True).select("value")
    item = f"struct<{_QUESTION.replace(' ', ':').replace(',:', ',')}>"
    blocks = raw.select(F.explode(F.from_json("value", f"array<struct<group:string,questions:array<{item}>>>")).alias("b")).select(F.col("b.group").alias("group_name"), F.explode("b.questions").alias("q"))
    blocks = blocks.select("q.*", "group_name", F.lit(None).cast("string").alias("language"))
    pair = "struct<case_id:string,category:string,questions:map<string,string>,expected_answer:string,expected_uris:array<string>>"
    pairs = raw.select(F.explode(F.from_json(F.get_json_object("value", "$.pairs"), f"array<{pair}>")).alias("p")).select("p.*", F.explode("p.questions").alias("language", "question"))
    pairs = pairs.select(F.col("case_id").alias("question_id"), "question", F.col("expected_answer").alias("answer"), F.lit(None).cast("string").alias("intent"), "expected_uris", F.lit(None).cast("string").alias("evaluation_mode"), F.col("category").alias("group_name"), "language")
    plain = raw.select(F.explode(F.from_json("value", f"array<{item}>")).alias("q")).select("q.*", F.lit(None).cast("string").alias("group_name"), F.lit(None).cast("string").alias("language")).where("question IS NOT NULL")
    return blocks.unionByName(pairs).unionByName(plain)


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths, once each in order; an error names those that don't exist."""
    once = list(dict.fromkeys(p.rstrip("/") for p in paths))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    missing = [p for p in once if not (h := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(h)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    return once
