"""Host-level quality rules with shrunk failure rates.

1. Each document is measured and held against document rules.
2. Failures are counted per host (pre-aggregated, so a host with a third of
   all rows costs a row per task).
3. A beta prior is fitted to the hosts' own rates by moments, and each host's
   rate is shrunk towards it: a host with three documents, all failing, isn't
   judged like one with three thousand.
4. Verdicts are joined back; a document of a rejected host is not kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import staged
from medallion.llm.textstats import document_stats
from medallion.llm.words import slices

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class HostRules:
    """min_words and max_repeat_pct: the base rule. max_symbols_pct (symbols
    per 100 words) and max_dup_lines_pct count as failures of the host only.
    max_host_rate: a host whose shrunk failure rate lies above it is rejected.
    salts: parts over which the documents of one host are dealt in the join.
    """

    min_words: int = 10
    max_repeat_pct: int = 20
    max_symbols_pct: int = 50
    max_dup_lines_pct: int = 50
    max_host_rate: float = 0.5
    salts: int = 16


def measure(documents: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the measures of each document."""

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in slices(batch.column(2)):
                found = document_stats(data, at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), *[pa.array(found[m]) for m in MEASURES]],
                    names=["doc_id", "host", *MEASURES],
                )

    rows = documents.select(F.col("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(stats, f"doc_id {kind}, host string, " + ", ".join(f"{m} long" for m in MEASURES))


def host_verdicts(measured: DataFrame, rules: HostRules) -> DataFrame:
    """host, n_docs, n_failed, rate (shrunk), host_rejected; one row per host."""
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(
        F.sum("n_failed").alias("failed"), F.sum("n_docs").alias("docs"),
        F.avg(rate).alias("mean"), F.var_pop(rate).alias("var"), F.avg(1 / F.col("n_docs")).alias("noise"),
    ).first()
    a, b = beta_prior(moments["failed"] or 0, moments["docs"] or 0, moments["mean"] or 0.0, moments["var"] or 0.0, moments["noise"] or 0.0)
    shrunk = (F.col("n_failed") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
    return hosts.withColumn("rate", shrunk).withColumn("host_rejected", F.col("rate") > F.lit(rules.max_host_rate))


def beta_prior(failed: int, docs: int, mean: float, var: float, noise: float) -> tuple[float, float]:
    """Beta(a, b) from the hosts' rates: mean and variance, less the variance
    that counting alone makes (``noise`` is the mean of 1 / documents). The
    pooled rate is the centre; the strength is held in 1 to 1e6."""
    centre = min(max(failed / docs if docs else 0.0, 1e-6), 1 - 1e-6)
    own = mean * (1 - mean)
    between = var - own * noise
    strength = min(max(own / between - 1, 1.0), 1e6) if between > 0 and own > 0 else 1e6
    return centre * strength, (1 - centre) * strength


def judge(documents: DataFrame, rules: HostRules | None = None, host: str = "source") -> DataFrame:
    """doc_id, the measures, base_failed, host, host_rate, host_rejected and
    kept; one row per input row.

    A null or empty text has no words and fails the base rule. A null host is
    the empty host. Repeated rows each count. An empty table gives no rows.
    Other columns are not read.
    """
    rules = rules or HostRules()
    n = F.col("n_words")
    base = (n < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * n)
    failed = (
        base | (100 * F.col("n_symbols") > rules.max_symbols_pct * n)
        | (100 * F.col("n_dup_lines") > rules.max_dup_lines_pct * F.col("n_lines"))
    )
    measured = staged(
        measure(documents, host).withColumn("base_failed", base).withColumn("failed", failed), "host-rules"
    )
    salt = F.pmod(F.hash("doc_id", "n_words", "word_chars"), F.lit(rules.salts))
    verdicts = host_verdicts(measured, rules).select(
        F.col("host").alias("__host"), F.round("rate", 9).alias("host_rate"), "host_rejected",
        F.explode(F.sequence(F.lit(0), F.lit(rules.salts - 1))).alias("__salt"),
    )
    joined = measured.withColumn("__at", salt).join(
        verdicts, (F.col("host") == F.col("__host")) & (F.col("__at") == F.col("__salt")), "left"
    )
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host", "host_rate", "host_rejected",
    )
