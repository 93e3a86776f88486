"""Language identification by Bayesian fusion of evidence.

A document's language has the posterior of four kinds of evidence: its text (byte trigrams, multinomial),
the language its markup or metadata declares, the suffix of its address, and its host. Text counts are
gathered for each declared language over all documents; declarations are noisy but mostly right, so each
language's own text dominates its counts. How often a declaration or a suffix goes with a language is
counted from what the texts say. Host priors are smoothed hierarchically: a host's counts towards its
suffix's, these towards the whole corpus's, all by grouped aggregation.

Trigrams of one text depend on each other, so a text's log likelihood counts like ``TEXT_WEIGHT`` trigrams
at most: long texts outweigh the other evidence, short ones listen to it.

A language is a declared code whose texts hold at least ``MIN_TRIGRAMS`` trigrams, however few of the documents
declare it; by the 676 codes of two letters the tables that reach the driver are bounded whatever the corpus.
Without any such code, every declared one is a language.

Beside this contest of the declared languages, a text is held against its best one alone (``lang_fits``): texts of a
language that none declares, or of none, take more bits a trigram than that language's own.

Defined cases: a null or empty text, or one without letters, has no text evidence and is decided by the
rest; null declarations, hosts and suffixes are no evidence; repeated rows are judged each for itself; of
languages that are equally likely the first by code is named; texts of any length are read whole; further columns
stay as they are, but for those with the names of results; an empty table gives an empty result. Without any
declaration in the corpus the language is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

SLOTS = 1 << 14
#: Groups of tables that a language's counts are summed in first.
FAN = 256
TEXT_WEIGHT = 200.0
#: Pseudo-counts with which a level of the hierarchy weighs on the one below.
HOST_STRENGTH, SUFFIX_STRENGTH = 20.0, 50.0
#: Trigrams in the texts of a declared code from which it is a language, whatever the size of the corpus.
MIN_TRIGRAMS = 200
#: A document is kept if its posterior is at least this, its text doesn't contradict that language, and fits it.
MIN_CONFIDENCE = 0.5
#: A text fits if its trigrams take at most so many bits more each than the language's own texts do on average, with so
#: many standard errors for its length. On sf0.1, 99.9 % of the texts take less than 2.7 more; of those whose language
#: was left out of the counts, 99 % take over 4.6 with en, es or fr left out, 95 % over 5.4 with any left out.
MAX_EXCESS, ERRORS = 3.0, 3.0

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def declared_code(col: Column) -> Column:
    """The two-letter code of a declaration such as en, EN-us or fr_CA; else null."""
    code = F.lower(F.regexp_extract(F.trim(col), r"^([A-Za-z]{2})(?:[-_].*)?$", 1))
    return F.when(code != "", code)


def trigram_slots(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased bytes, with every run of other characters as one space."""
    b = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    b = np.where(_LETTER[b], b, 32)
    b = b[(b != 32) | np.concatenate(([True], b[:-1] != 32))] if len(b) else b
    if not (b != 32).any():
        return np.zeros(0, np.int64)
    b = np.concatenate(([32], b, [32])).astype(np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    return (h >> np.uint32(18)).astype(np.int64)


def _text_counts(src: DataFrame) -> dict[str, np.ndarray]:
    """Trigram counts for each declared language, over all documents: by task, then in two levels of sums, so that no
    group holds more tables than a part in ``FAN`` of the tasks, or FAN; 676 rows at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, code in zip(batch.column(0), batch.column(1).to_pylist()):
                if code is not None:
                    slots = trigram_slots(text.as_py() or "")
                    counts[code] = counts.get(code, 0) + np.bincount(slots, minlength=SLOTS)
        yield pa.RecordBatch.from_pydict({"code": pa.array(list(counts), pa.string()), "counts": pa.array([c.astype(np.int64).tobytes() for c in counts.values()], pa.binary())})

    def merge(t: pa.Table) -> pa.Table:
        total = np.zeros(SLOTS, np.int64)
        for c in t.column("counts"):
            total += np.frombuffer(c.as_buffer(), np.int64)
        return pa.table({"code": [t.column("code")[0].as_py()], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "code string, counts binary"
    by_task = src.select("text", "declared").mapInArrow(run, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    merged = by_task.groupBy("code", "part").applyInArrow(merge, schema).groupBy("code").applyInArrow(merge, schema)
    rows = merged.collect()
    counts = {r["code"]: np.frombuffer(r["counts"], np.int64) for r in sorted(rows, key=lambda r: r["code"])}
    return {c: n for c, n in counts.items() if n.sum() >= MIN_TRIGRAMS} or counts


def _log_table(counts: DataFrame, key: str, n: int, prior, strength: float) -> DataFrame:
    """(key, logs): smoothed log shares of the languages for each key. counts: key, k, n."""
    by = counts.groupBy(key).agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("of"))
    share = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: (F.coalesce(F.try_element_at("of", k), F.lit(0)) + F.lit(strength) * F.element_at(prior, k + 1)) / (F.col("all") + F.lit(strength)))
    return by.select(key, share.alias("share"))


def identify(
    docs: DataFrame,
    declared: Column | None = None,
    host: Column | None = None,
    suffix: Column | None = None,
    text_col: str = "text",
) -> DataFrame:
    """The rows with ``lang_id`` (code), ``lang_confidence`` (its posterior), ``lang_text`` (by the text alone) and ``lang_fits`` (the text fits that language), these null without letters."""
    none = F.lit(None).cast("string")
    docs = docs.drop("lang_id", "lang_confidence", "lang_text", "lang_fits")  # results take the place of columns of their names
    # the rows' own columns go by number until the end, so that none can clash with those made here
    given = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    text_at = f"c{docs.columns.index(text_col)}"
    named = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)],
        (declared_code(declared) if declared is not None else none).alias("__declared"),
        (host if host is not None else none).alias("__host"),
        (F.lower(suffix) if suffix is not None else none).alias("__suffix"),
    )
    src = named.select(F.col(text_at).alias("text"), F.col("__declared").alias("declared"))
    counts = _text_counts(src)
    codes = list(counts)
    if not codes:
        return named.select(*given, none.alias("lang_id"), F.lit(None).cast("double").alias("lang_confidence"), none.alias("lang_text"), F.lit(None).cast("boolean").alias("lang_fits"))
    k = len(codes)
    total = np.array([counts[c] for c in codes], np.float64) + 0.5
    weights = np.log(total / total.sum(1, keepdims=True)).T.astype(np.float32).copy()
    # mean and deviation of a trigram's log share in each language's own texts
    own = np.array([counts[c] / max(1, counts[c].sum()) for c in codes]).T
    mean = (own * weights).sum(0)
    deviation = np.sqrt(np.maximum(0, (own * weights**2).sum(0) - mean**2))

    keep = named.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs, fits = [], []
            for text in batch.column(batch.schema.get_field_index(text_at)):
                slots = trigram_slots(text.as_py() or "")
                n = len(slots)
                if n:
                    sums = sum(weights[slots[a : a + 65536]].sum(0, dtype=np.float64) for a in range(0, n, 65536))
                    best = int(np.argmax(sums))
                    fits.append(bool(mean[best] - sums[best] / n <= MAX_EXCESS * math.log(2) + ERRORS * deviation[best] / math.sqrt(n)))
                    logs.append((sums / n * (n * TEXT_WEIGHT / (n + TEXT_WEIGHT))).tolist())
                else:
                    fits.append(None)
                    logs.append(None)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(logs, pa.list_(pa.float64())), pa.array(fits, pa.bool_())], names=[*keep, "__logs", "__fits"])

    schema = T.StructType([*named.schema.fields, T.StructField("__logs", T.ArrayType(T.DoubleType())), T.StructField("__fits", T.BooleanType())])
    scored = named.mapInArrow(run, schema)
    best = F.expr("array_position(__logs, array_max(__logs)) - 1")
    seen = cut(scored.where("__logs IS NOT NULL").groupBy("__declared", "__host", "__suffix", best.cast("int").alias("k")).agg(F.count("*").alias("n")))

    # the corpus, then its suffixes, then their hosts; at most one row a language or declaration reaches the driver
    whole = {r["k"]: r["n"] for r in seen.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    every = sum(whole.values())
    base = np.array([(whole.get(i, 0) + 1) / (every + k) for i in range(k)])
    base_col = F.array(*map(F.lit, base.tolist()))
    by_suffix = seen.groupBy("__suffix", "k").agg(F.sum("n").alias("n"))
    suffixes = _log_table(by_suffix, "__suffix", k, base_col, SUFFIX_STRENGTH).where("__suffix IS NOT NULL").withColumnRenamed("share", "__suffix_share")
    by_host = seen.where("__host IS NOT NULL").groupBy("__host", "__suffix", "k").agg(F.sum("n").alias("n"))
    host_rows = by_host.join(suffixes, "__suffix", "left").withColumn("__prior", F.coalesce("__suffix_share", base_col))
    hosts = (
        host_rows.groupBy("__host", "__suffix")
        .agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("of"), F.first("__prior").alias("__prior"))
        .select(
            "__host", "__suffix",
            F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (F.coalesce(F.try_element_at("of", i), F.lit(0)) + F.lit(HOST_STRENGTH) * F.element_at("__prior", i + 1)) / (F.col("all") + F.lit(HOST_STRENGTH))).alias("__host_share"),
        )
    )
    # chance of each declaration in each language, from at most 676 times k counts
    said: dict[str, np.ndarray] = {}
    for r in seen.where("__declared IS NOT NULL").groupBy("__declared", "k").agg(F.sum("n").alias("n")).collect():
        said.setdefault(r["__declared"], np.ones(k))[r["k"]] += r["n"]
    in_language = sum(said.values()) if said else np.ones(k)
    table = F.create_map(*chain.from_iterable((F.lit(c), F.array(*map(F.lit, np.log(v / in_language).tolist()))) for c, v in said.items())) if said else F.lit(None).cast("map<string,array<double>>")
    zeros = F.array(*[F.lit(0.0)] * k)
    out = (
        scored.join(hosts, (scored["__host"] == hosts["__host"]) & scored["__suffix"].eqNullSafe(hosts["__suffix"]), "left")
        .drop(hosts["__host"])
        .drop(hosts["__suffix"])
        .join(suffixes, "__suffix", "left")
    )
    prior = F.transform(F.coalesce("__host_share", "__suffix_share", base_col), lambda x: F.log(x))
    told = F.coalesce(F.try_element_at(table, F.col("__declared")), zeros) if said else zeros
    text = F.coalesce("__logs", zeros)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    out = out.withColumn("__post", add(add(prior, told), text)).withColumn("__top", F.array_max("__post"))
    names = F.array(*map(F.lit, codes))
    at = F.array_position("__post", F.col("__top")).cast("int")
    norm = F.aggregate(F.transform("__post", lambda x: F.exp(x - F.col("__top"))), F.lit(0.0), lambda s, x: s + x)
    by_text = F.expr("array_position(__logs, array_max(__logs))").cast("int")
    return out.select(
        *given,
        F.element_at(names, at).alias("lang_id"),
        (F.lit(1.0) / norm).alias("lang_confidence"),
        F.when(F.col("__logs").isNotNull(), F.element_at(names, by_text)).alias("lang_text"),
        F.col("__fits").alias("lang_fits"),
    )


def verdict(allowed: tuple[str, ...] | None = None) -> Column:
    """Whether an identified row is kept: confident, with a text that reads as that language and fits it, in an allowed language (any by default)."""
    kept = F.col("lang_text").eqNullSafe(F.col("lang_id")) & F.coalesce("lang_fits", F.lit(False)) & (F.coalesce("lang_confidence", F.lit(0.0)) >= MIN_CONFIDENCE)
    return kept & F.col("lang_id").isin(*allowed) if allowed else kept


def page_evidence(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """The rows with text, declared, host and suffix taken from markup and address; they take the place of columns of
    these names. Null markup or address: an empty text, no declaration, no host."""
    html, url = F.coalesce(html_col, F.lit("")), F.coalesce(url_col, F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"(?s)<[^>]*>", " "), r"&#?\w+;", " ")
    some = lambda c: F.when(c != "", c)
    host = some(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)))
    return pages.select(
        *[F.col(f"`{c}`") for c in pages.columns if c not in ("text", "declared", "host", "suffix")],
        text.alias("text"),
        some(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z_-]+)", 1)).alias("declared"),
        host.alias("host"),
        some(F.regexp_extract(host, r"\.([^.]+)$", 1)).alias("suffix"),
    )
