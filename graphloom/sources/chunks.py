"""Readers of chunked text, term caches and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER = r"--- Pages: \[([^\]]*)\] \| Section: ([^|]*) \| Title: (.*?) ---"


#: What Windows Latin has in place of the control characters of ISO Latin.
_WINDOWS = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def decoded(content: Column) -> Column:
    """Bytes as text: UTF-8 (with or without a mark), else Windows Latin, and ISO Latin where that has no character."""
    utf8 = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string"))
    return F.regexp_replace(F.coalesce(utf8, F.translate(F.decode(content, "ISO-8859-1"), "".join(_WINDOWS), "".join(_WINDOWS.values()))), "^﻿", "")


def parse(files: DataFrame) -> DataFrame:
    """(source, pos, pages, section, title, text) of texts (source, text) by their chunk headers.

    A text without any header is one chunk without pages, section and title; what stands before the first header is
    left out; empty chunks stay.
    """
    marked = files.select("source", F.regexp_replace("text", HEADER, "\u0001$0\u0002").alias("t"))
    parts = marked.select("source", F.posexplode(F.split("t", "\u0001")).alias("pos", "part"), F.contains("t", F.lit("\u0001")).alias("has"))
    head, body = F.substring_index("part", "\u0002", 1), F.regexp_replace("part", "(?s)^[^\u0002]*\u0002", "")
    group = lambda i: F.regexp_extract(head, HEADER, i)
    known = parts.where("NOT has OR pos > 0")
    return known.select(
        "source", F.when(F.col("has"), F.col("pos") - 1).otherwise(0).alias("pos"),
        F.when(F.col("has"), F.filter(F.split(group(1), r"\s*,\s*"), lambda x: x != "")).otherwise(F.array().cast("array<string>")).alias("pages"),
        F.when(F.col("has"), F.trim(group(2))).otherwise("").alias("section"),
        F.when(F.col("has"), F.trim(group(3))).otherwise("-").alias("title"),
        F.regexp_replace(F.when(F.col("has"), body).otherwise(F.col("part")), r"^\s+|\s+$", "").alias("text"),
    )


def read(spark: SparkSession, *paths: str) -> DataFrame:
    """Chunks of text files, each file a source."""
    files = spark.read.format("binaryFile").load(list(paths))
    return parse(files.select(F.col("path").alias("source"), decoded(F.col("content")).alias("text")))


def read_terms(spark: SparkSession, path: str, days: int = 30) -> DataFrame:
    """Terms of a JSON cache {generated_at, terms: [{term, ...}]} no older than so many days; none from an older one."""
    cache = spark.read.schema("generated_at timestamp, terms array<struct<term:string,uri:string>>").json(path, multiLine=True)
    fresh = cache.where(F.col("generated_at") >= F.current_timestamp() - F.make_dt_interval(F.lit(days)))
    return fresh.select(F.explode("terms").alias("t")).select("t.term", "t.uri").dropDuplicates(["term"])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(id, signature, status) of a JSON manifest, under ``chunks`` or at the top."""
    entry = "map<string,struct<signature:string,status:string>>"
    raw = spark.read.text(path, wholetext=True)
    under = F.from_json(F.get_json_object("value", "$.chunks"), entry)
    entries = raw.select(F.explode(F.coalesce(under, F.from_json("value", entry))).alias("id", "e"))
    return entries.select(F.col("id").cast("long").alias("id"), "e.signature", "e.status")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The manifest as JSON lines, by id."""
    manifest.orderBy("id").write.mode("overwrite").json(path)
