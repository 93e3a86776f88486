"""Staged runs: stages in order with records of what each did, checks of what came out, and the decision that follows."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Stage:
    """A named function of the results so far; an optional one may fail without ending the run."""

    name: str
    run: Callable[[dict[str, Any]], Any]
    optional: bool = False


@dataclass
class Run:
    """Results by stage, and a record a stage: name, status (ok, failed, skipped), seconds, error."""

    results: dict[str, Any] = field(default_factory=dict)
    records: list[dict] = field(default_factory=list)

    @property
    def complete(self) -> bool:
        return all(r["status"] == "ok" for r in self.records)


def run_stages(stages: Iterable[Stage], given: dict[str, Any] | None = None) -> Run:
    """Run stages in order. After one that fails and isn't optional, the others are skipped; the records say so."""
    out, stopped = Run(dict(given or {})), False
    for stage in stages:
        if stopped:
            out.records.append({"name": stage.name, "status": "skipped", "seconds": 0.0, "error": None})
            continue
        began, message = time.monotonic(), None
        try:
            out.results[stage.name] = stage.run(out.results)
        except Exception as e:  # a stage may fail in any way; its record says how
            message, stopped = f"{type(e).__name__}: {e}", not stage.optional
        out.records.append({"name": stage.name, "status": "failed" if message else "ok", "seconds": round(time.monotonic() - began, 3), "error": message})
    return out


def checked(*reports: tuple[str, DataFrame]) -> DataFrame:
    """(name, n, n_ok, ok) of reports with a column ok: a report passes if it has rows and all of them are ok."""
    out = None
    for name, rows in reports:
        one = rows.agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok")).select(F.lit(name).alias("name"), "n", "n_ok", ((F.col("n") > 0) & (F.col("n") == F.col("n_ok"))).alias("ok"))
        out = one if out is None else out.unionByName(one)
    return out


def decision(checks: DataFrame) -> DataFrame:
    """(ready, blockers) of checks (name, ok): ready if there are any and all pass; blockers are those that don't."""
    return checks.agg((F.count("*") > 0).alias("any"), F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("name")))).alias("blockers")).select((F.col("any") & (F.size("blockers") == 0)).alias("ready"), "blockers")


def with_fallback(models: Iterable[tuple[str, Callable[[str], str]]], accept: Callable[[str], bool] = bool) -> Callable[[str], str]:
    """An extractor that asks models in order until one gives what is accepted; else the last one's error, or that all were refused."""
    chain = list(models)

    def ask(prompt: str) -> str:
        last: Exception | None = None
        for _, model in chain:
            try:
                if accept(out := model(prompt)):
                    return out
            except Exception as e:  # the next model may do it
                last = e
        raise last or ValueError("empty response from " + ", ".join(name for name, _ in chain))

    return ask


def failure_records(results: DataFrame, prompt_version: str, models: list[str]) -> DataFrame:
    """(chunk_id, prompt_version, model_chain, error_class, error_message) of the chunks that an extraction gave up on."""
    from .orchestrate import error_class

    bad = results.where("status = 'error'")
    return bad.select(F.col("id").alias("chunk_id"), F.lit(prompt_version).alias("prompt_version"), F.array(*map(F.lit, models)).alias("model_chain"), error_class(F.col("error")).alias("error_class"), F.col("error").alias("error_message"))


#: What bringing in one document leaves behind, by suffix of its file or folder (fixed values).
ARTIFACTS = ("density_report.json", "language_report.json", "extraction_input.json", "manifest.json", "graphs", "debug", "merged.ttl", "onboarding_report.json", "evaluation_report.json", "evaluation_debug.json", "decision.json")


def profile(name: str, source: str, folder: str) -> dict[str, str]:
    """Where the artifacts of one source go: a path an artifact, all under one prefix made of its file's name, else of the given name."""
    stem = source.replace("\\", "/").rstrip("/").rpartition("/")[2].rpartition(".")
    plain = lambda x: re.sub(r"[^a-z0-9]+", "_", x.lower()).strip("_")
    prefix = plain(stem[0] or stem[2]) or plain(name) or "source"
    return {"name": name, "source": source, "prefix": prefix, **{a.partition(".")[0]: f"{folder.rstrip('/')}/{prefix}_{a}" for a in ARTIFACTS}}
