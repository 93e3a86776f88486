"""Extraction runs: a pluggable extractor over chunks with retries, error classes, statuses and an incremental rebuild."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ingest

#: (class, pattern in the message), the first that matches (fixed values).
ERRORS = (
    ("rate_limit", r"rate.?limit|429|too many requests|quota"),
    ("timeout", r"time[d]? ?out|deadline"),
    ("connection", r"connection|refused|reset|unreachable|dns"),
    ("server", r"\b50[0-9]\b|internal server|unavailable|overloaded"),
    ("syntax", r"parse|syntax|unexpected|expected"),
    ("semantic", r"validation|unknown (class|property|predicate)|missing type"),
    ("empty", r"empty (response|result)|no content"),
)
#: Classes that another try can mend.
RETRYABLE = ("rate_limit", "timeout", "connection", "server")


@dataclass(frozen=True)
class Retry:
    """How often to try, and the seconds to wait before each further try."""

    tries: int = 3
    backoff: tuple[float, ...] = (0.0, 1.0, 4.0)

    def wait(self, attempt: int) -> float:
        return self.backoff[min(attempt, len(self.backoff) - 1)]


PROFILES = {"none": Retry(1, (0.0,)), "default": Retry(), "patient": Retry(5, (0.0, 2.0, 8.0, 30.0, 60.0)), "eager": Retry(3, (0.0,))}


def error_class(message: Column) -> Column:
    """The class of an error message; other if no pattern matches."""
    return F.coalesce(*[F.when(message.rlike(f"(?i){p}"), c) for c, p in ERRORS], F.lit("other"))


def _class_of(message: str) -> str:
    import re

    return next((c for c, p in ERRORS if re.search(p, message, re.I)), "other")


def informative(c: Column) -> Column:
    """Whether a chunk says anything: more than twelve characters, some letters among them."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return (F.length(t) > 12) & t.rlike(r"\p{L}")


def extract(chunks: DataFrame, extractor: Callable[[str], str], retry: Retry = PROFILES["default"]) -> DataFrame:
    """(id, output, status, error, attempts): an extractor's output for each chunk (id, text).

    The extractor is any function from text to text; errors that another try can mend are tried again, all others
    are kept with the chunk, so that no chunk stops a run. Chunks that say nothing are not sent.
    """
    kind = chunks.schema["id"].dataType
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, send in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if not send:
                    out.append((None, "skipped", None, 0))
                    continue
                message = None
                for attempt in range(retry.tries):
                    time.sleep(retry.wait(attempt))
                    try:
                        out.append((extractor(t), "ok", None, attempt + 1))
                        break
                    except Exception as e:  # an extractor may fail in any way; the row says how
                        message = f"{type(e).__name__}: {e}"
                        if _class_of(message) not in RETRYABLE or attempt + 1 == retry.tries:
                            out.append((None, "error", message, attempt + 1))
                            break
            cols = [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.string(), pa.string(), pa.string(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["id", "output", "status", "error", "attempts"])

    src = chunks.select("id", "text", F.coalesce(informative(F.col("text")), F.lit(False)).alias("send"))
    return src.mapInArrow(run, f"id {kind.simpleString()}, output string, status string, error string, attempts int")


def status_report(results: DataFrame) -> DataFrame:
    """(status, class, n): how many chunks ended how."""
    what = F.when(F.col("status") == "error", error_class(F.col("error"))).otherwise(F.lit(""))
    return results.groupBy("status", what.alias("class")).agg(F.count("*").alias("n"))


def incremental(chunks: DataFrame, manifest: DataFrame, extractor: Callable[[str], str], retry: Retry = PROFILES["default"]) -> tuple[DataFrame, DataFrame]:
    """(results of what had to be done again, the manifest that follows): chunks are id, text, signature."""
    todo = ingest.actions(chunks, manifest).where("action = 'regenerate'").select("id")
    results = extract(chunks.join(todo, "id", "left_semi"), extractor, retry)
    done = results.select("id", "status").join(chunks.select("id", "signature"), "id").select("id", "signature", "status")
    kept = manifest.join(todo, "id", "left_anti").join(chunks.select("id"), "id", "left_semi").select("id", "signature", "status")
    return results, kept.unionByName(done)


def succeeded(results: DataFrame) -> DataFrame:
    """(n, n_ok, complete): whether every chunk that was sent came back."""
    return results.agg(F.count("*").alias("n"), F.count_if(F.col("status") != "error").alias("n_ok")).withColumn("complete", F.col("n") == F.col("n_ok"))
