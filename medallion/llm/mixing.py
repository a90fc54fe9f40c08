"""Mixing documents to target shares by iterative proportional fitting.

Tokens are summed per cell of (source, language, topic). Languages and topics
that the targets don't name are one category ``*`` of their dimension. The
``max_sources`` sources with most rows are categories of their own, all others
one, so the cells are bounded. The cell table is raked: each dimension in turn
is scaled to its target shares until all hold. A document's probability is its
cell's factor times one constant that makes the expected number of kept tokens
the wanted one, at most 1; a hash of its id decides.

What the targets don't name is never mixed out: it shares the target of ``*``
in proportion to its tokens, and where ``*`` has no positive target it keeps
the share of the tokens that it has, and the named categories divide the rest.
"""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.sharding import uniform

OTHER = "*"
DIMENSIONS = ("source", "lang", "topic")
MAX_CELLS = 100_000

#: Topics in order; the first whose condition holds is taken.
TOPICS: tuple[tuple[str, str], ...] = (
    ("licensed", r"__text RLIKE '(?i)\\b(license|licensed|copyright|rights reserved)\\b'"),
    ("contact", "contains(__text, '@')"),
    ("markup", r"10 * regexp_count(__text, '[#*$%&|<>{}=]') > __tokens"),
    ("short", "__tokens < 50"),
    ("prose", "true"),
)

TARGETS: dict[str, dict[str, float]] = {
    "source": {"src0": 0.30, OTHER: 0.70},
    "lang": {"en": 0.60, "de": 0.15, "fr": 0.15, "es": 0.10},
    "topic": {"prose": 0.72, "licensed": 0.08, "contact": 0.08, "markup": 0.07, "short": 0.05},
}


@dataclass(frozen=True)
class MixParams:
    """targets: shares per dimension, scaled to 1 over the categories that
    occur; see the module text for what they don't name. keep: share of all
    tokens to keep. topics: see :data:`TOPICS`. max_sources: sources that are
    categories without being named. converged: largest gap of a share for
    which the targets count as met."""

    targets: Mapping[str, Mapping[str, float]] = field(default_factory=lambda: TARGETS)
    keep: float = 0.9
    topics: Sequence[tuple[str, str]] = TOPICS
    tolerance: float = 1e-10
    max_rounds: int = 2000
    seed: str = "mix"
    max_sources: int = 200
    converged: float = 1e-6


@dataclass
class Raked:
    """Cells (category per dimension) with tokens, raking factor and
    probability. sources: those that are categories without being named.
    relaxed: how far the targets were moved to the observed shares."""

    cells: list[tuple[str, ...]]
    tokens: np.ndarray
    factors: np.ndarray
    probabilities: np.ndarray
    residual: float
    sources: list[str] = field(default_factory=list)
    relaxed: float = 0.0


def rake(counts: Mapping[tuple[str, ...], float], targets: Sequence[Mapping[str, float]], tolerance: float, max_rounds: int) -> tuple[np.ndarray, float]:
    """Factors per cell (in the order of ``counts``) that bring the marginal
    shares of counts * factor to the targets, and the largest gap left.

    A category without tokens leaves the others its share and its cells their
    factor; a category with tokens and no target share gets factor 0.
    """
    cells, tokens = list(counts), np.array(list(counts.values()), float)
    factors = np.ones(len(cells))
    sides = []
    for d, wanted in enumerate(targets):
        names = sorted({c[d] for c in cells})
        of = np.array([names.index(c[d]) for c in cells], int)
        have = np.bincount(of, tokens, minlength=len(names))
        share = np.array([float(wanted.get(n, 0.0)) for n in names]) * (have > 0)
        if share.sum() <= 0:
            raise ValueError(f"no category of dimension {d} that occurs has a target share")
        sides.append((of, share / share.sum() * tokens.sum(), (have == 0).astype(float)))
    gap = 0.0
    for _ in range(max_rounds):
        gap = 0.0
        for of, wanted, empty in sides:
            now = np.bincount(of, tokens * factors, minlength=len(wanted))
            gap = max(gap, float(np.abs(now - wanted).max() / max(tokens.sum(), 1)))
            factors *= np.divide(wanted, now, out=empty.copy(), where=now > 0)[of]
        if gap <= tolerance:
            break
    return factors, gap


def completed(counts: Mapping[tuple[str, ...], float], targets: Sequence[Mapping[str, float]]) -> list[dict[str, float]]:
    """The targets of all categories that occur, see the module text; those
    that a target of 0 names keep it."""
    out = []
    for d, wanted in enumerate(targets):
        have: Counter = Counter()
        for cell, tokens in counts.items():
            have[cell[d]] += tokens
        shares = {n: float(t) for n, t in wanted.items() if n != OTHER and have[n] > 0}
        rest = {n: t for n, t in have.items() if t > 0 and n not in shares}
        own = float(wanted.get(OTHER, 0.0))
        if rest and own <= 0:
            own, named = sum(rest.values()) / sum(have.values()), sum(shares.values())
            shares = {n: t / named * (1 - own) if named else 0.0 for n, t in shares.items()}
        out.append(shares | {n: own * t / sum(rest.values()) for n, t in rest.items()})
    return out


def rake_or_relax(counts: Mapping[tuple[str, ...], float], params: MixParams) -> tuple[np.ndarray, float, float]:
    """Factors per cell, the largest gap, and how far targets were relaxed.

    Targets can contradict each other, as when a source has one language
    only; raking would then drive whole cells to 0. First the sources that
    the targets don't name are raked as one category; then all targets are
    moved to the observed shares, which always hold, by steps of a tenth.
    """
    targets = [params.targets[d] for d in DIMENSIONS]
    wanted = completed(counts, targets)
    factors, gap = rake(counts, wanted, params.tolerance, params.max_rounds)
    if gap <= params.converged:
        return factors, gap, 0.0
    coarse = [(c[0] if c[0] in targets[0] else OTHER, *c[1:]) for c in counts]
    merged: Counter = Counter()
    for cell, tokens in zip(coarse, counts.values(), strict=True):
        merged[cell] += tokens
    merged_factors, gap = rake(merged, completed(merged, targets), params.tolerance, params.max_rounds)
    if gap <= params.converged:
        of = dict(zip(merged, merged_factors, strict=True))
        return np.array([of[c] for c in coarse]), gap, 0.0
    observed = completed(counts, [{}] * len(targets))
    for tenth in range(1, 11):
        mixed = []
        for given, have in zip(wanted, observed, strict=True):
            scale = sum(given.values())
            # a category that a target of 0 names stays out
            mixed.append({n: (1 - tenth / 10) * t / scale + tenth / 10 * have[n] if t > 0 else 0.0 for n, t in given.items()})
        factors, gap = rake(counts, mixed, params.tolerance, params.max_rounds)
        if gap <= params.converged:
            break
    return factors, gap, tenth / 10


def calibrate(tokens: np.ndarray, factors: np.ndarray, keep: float) -> np.ndarray:
    """min(1, c * factor) with c so that the kept tokens are ``keep`` of all,
    or as near as the cells with a factor allow."""
    wanted = keep * tokens.sum()
    if wanted >= tokens[factors > 0].sum():
        return (factors > 0).astype(float)
    lo, hi = 0.0, 1.0
    while (np.minimum(1, hi * factors) * tokens).sum() < wanted:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (np.minimum(1, mid * factors) * tokens).sum() < wanted else (lo, mid)
    return np.minimum(1, hi * factors)


def _category(value: Column, names: Sequence[str]) -> Column:
    named = [n for n in names if n != OTHER]
    return F.when(value.isin(named), value).otherwise(F.lit(OTHER)) if named else F.lit(OTHER)


def described(documents: DataFrame, params: MixParams, sources: Sequence[str] = ()) -> DataFrame:
    """``documents`` with __text, __tokens, the category of each dimension
    (__source, __lang, __topic) and __own_source, the source's category when
    ``sources`` are categories too; null values are the category ``*``."""
    rows = documents.withColumn("__text", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.withColumn("__tokens", F.regexp_count("__text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))
    topic = F.lit(None).cast("string")
    for name, condition in reversed(params.topics):
        topic = F.when(F.expr(condition), F.lit(name)).otherwise(topic)
    rows = rows.withColumn("__named", topic).withColumn("__topic", _category(F.col("__named"), list(params.targets["topic"])))
    rows = rows.withColumn("__own_source", _category(F.col("source"), [*params.targets["source"], *sources]))
    return rows.withColumn("__source", _category(F.col("source"), list(params.targets["source"]))).withColumn(
        "__lang", _category(F.col("lang"), list(params.targets["lang"]))
    )


def common_sources(documents: DataFrame, params: MixParams) -> list[str]:
    """At most ``max_sources`` sources with most rows that the targets don't name."""
    unnamed = documents.where(F.col("source").isNotNull() & ~F.col("source").isin([*params.targets["source"], OTHER]))
    top = unnamed.groupBy("source").count().orderBy(F.desc("count"), "source").limit(params.max_sources)
    return sorted(r["source"] for r in top.collect())


CELL = ("__own_source", "__lang", "__topic")


def fit(documents: DataFrame, params: MixParams) -> Raked:
    """Rake the token counts of all documents. At most the product of the
    categories, ``max_sources`` and those of the targets, comes to the driver."""
    bound = int(np.prod([len(params.targets[d]) + 1 + (params.max_sources if d == "source" else 0) for d in DIMENSIONS]))
    if bound > MAX_CELLS:
        raise ValueError(f"the targets span {bound} cells; at most {MAX_CELLS} are raked on the driver")
    sources = common_sources(documents, params)
    rows = described(documents, params, sources).groupBy(*CELL).agg(F.sum("__tokens").alias("n")).orderBy(*CELL).collect()
    counts = {tuple(r[n] for n in CELL): float(r["n"]) for r in rows}
    tokens = np.array(list(counts.values()))
    if not tokens.sum():
        return Raked(list(counts), tokens, np.ones(len(counts)), np.ones(len(counts)), 0.0, sources)
    factors, gap, relaxed = rake_or_relax(counts, params)
    if relaxed or gap > params.converged:
        warnings.warn(f"the mix targets can't hold together: moved by {relaxed:.0%} to the observed shares, gap {gap:.2g}", stacklevel=2)
    return Raked(list(counts), tokens, factors, calibrate(tokens, factors, params.keep), gap, sources, relaxed)


def weighted(documents: DataFrame, raked: Raked, params: MixParams) -> DataFrame:
    """:func:`described` rows with __weight, __probability and __kept. The
    cell table is broadcast; its size is bounded, see :func:`fit`."""
    spark = documents.sparkSession
    cells = spark.createDataFrame(
        [(*c, float(f), float(p)) for c, f, p in zip(raked.cells, raked.factors, raked.probabilities, strict=True)],
        ", ".join(f"__c_{d} string" for d in DIMENSIONS) + ", __weight double, __probability double",
    )
    rows = described(documents, params, raked.sources)
    match = [F.col(own) == F.col(f"__c_{d}") for own, d in zip(CELL, DIMENSIONS, strict=True)]
    joined = rows.join(F.broadcast(cells), match[0] & match[1] & match[2])
    place = uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(params.seed))
    return joined.withColumn("__kept", place < F.col("__probability"))


def mix(documents: DataFrame, params: MixParams | None = None) -> DataFrame:
    """doc_id, source, lang, topic (categories), n_tokens, weight,
    probability and kept; one row per input row.

    A null or empty text has no tokens, topic ``short`` and its cell's
    probability; sources and languages that are null or not named are ``*``
    (the weights of such sources may differ). Repeated rows share one decision. Without any token all are kept; an empty table gives no
    rows; other columns are not read.
    """
    p = params or MixParams()
    own = documents.select("doc_id", "text", "source", "lang")
    return weighted(own, fit(own, p), p).select(
        "doc_id", F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"),
        F.col("__tokens").alias("n_tokens"), F.col("__weight").alias("weight"), F.col("__probability").alias("probability"),
        F.col("__kept").alias("kept"),
    )


def sample(documents: DataFrame, params: MixParams | None = None) -> DataFrame:
    """The rows of ``documents`` that the mix keeps, all columns as they are,
    whatever their names. Null, unknown and empty values, repeated rows and
    tables without a token are as in :func:`mix`; an empty table stays empty."""
    p = params or MixParams()
    row = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in documents.columns])
    own = documents.select("doc_id", "text", "source", "lang", row.alias("__row"))
    raked = fit(own.drop("__row"), p)
    return weighted(own, raked, p).where("__kept").select("__row.*")
