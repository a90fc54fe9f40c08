"""How five document filters act on each other in every order.

A document fails some of the filters A to E. It survives a subset of them
if it fails none of its members, so its *survival word* has 32 bits, one per
subset, bit S set when the document survives S. Adding up the words of a
part's documents bit by bit gives the survivors of every subset, and from
those 32 numbers follow the outcomes of all 120 orders: a filter at some step
removes the survivors of the steps before it less the survivors of those
steps and itself.

The bits are added with carry-save adders: three words of equal weight become
a sum word and a carry word of twice the weight, for whole arrays of words at
once, until two words a weight are left to be read bit by bit. Tasks add the
words of their batches; Spark sums the 32 counts of each part and label class.

Filters, on whole texts (a null text is empty):

* A: fewer than 50 words
* B: 100 * distinct words < 65 * words
* C: 100 * capitals A-Z > 5 * code points
* D: holds any of ``#$%&*|``
* E: the same text stands in a row with a smaller doc_id

Rows without doc_id have no smaller one and are smaller than none, so they
don't fail E and have no labels. Repeated rows count each; rows of equal
doc_id aren't smaller than each other. A document is good (toxic) if any
label row of its doc_id has quality (toxic) 1. Null and empty sources are one
part. An empty table has no parts and gives no rows. Only doc_id, source and
text are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import staged
from medallion.llm.words import SPACE, runs, slices, span_hashes

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
ALL = SUBSETS - 1
#: survival word of each set of failed filters
SURVIVAL = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], np.uint32)
_BITS = np.arange(SUBSETS, dtype=np.uint32)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
# Fixed value: the characters of filter D.
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#$%&*|")] = True
OUTCOME = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@dataclass(frozen=True)
class FilterLimits:
    """min_words of A, min_distinct of B and max_capitals of C in percent."""

    min_words: int = 50
    min_distinct: int = 65
    max_capitals: int = 5


def _totals(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    run = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=run[1:])
    return run[at[1:]] - run[at[:-1]]


def failed_filters(data: np.ndarray, at: np.ndarray, limits: FilterLimits) -> np.ndarray:
    """For each text of (bytes, offsets): the filters A to D that it fails, A as bit 0."""
    starts, ends = runs(~SPACE[data], at)
    first = np.searchsorted(starts, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    hashes = span_hashes(data, starts, ends)
    order = np.lexsort((hashes, row))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[1:] != row[:-1])
    n_words, n_distinct = np.diff(first), _totals(new, first)
    chars = _totals((data & 0xC0) != 0x80, at)
    fails = [
        n_words < limits.min_words,
        100 * n_distinct < limits.min_distinct * n_words,
        100 * _totals(_UPPER[data], at) > limits.max_capitals * chars,
        _totals(_MARKS[data], at) > 0,
    ]
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set, by carry-save addition."""
    counts, weight, level = np.zeros(SUBSETS, np.int64), 1, words
    while len(level):
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c = level[:third], level[third : 2 * third], level[2 * third : 3 * third]
            odd = a ^ b
            carries.append((a & b) | (odd & c))
            level = np.concatenate([odd ^ c, level[3 * third :]])
        for word in level:
            counts += weight * ((word >> _BITS) & np.uint32(1)).astype(np.int64)
        level = np.concatenate(carries) if carries else level[:0]
        weight *= 2
    return counts


def judged_texts(documents: DataFrame, limits: FilterLimits) -> DataFrame:
    """doc_id, part, digest of the text, and the failed filters among A to D."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in slices(batch.column(3)):
                kept = [batch.column(k).slice(i, j - i) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(failed_filters(data, at, limits))], names=["doc_id", "part", "digest", "fails"]
                )

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        "doc_id", F.coalesce(F.col("source"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, part string, digest binary, fails int")


def with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with filter E in ``fails``. Only texts of several ids are
    joined back, one row each from a table of their own, so a text of a third
    of all rows is a skewed side that adaptive execution can split."""
    ids = rows.groupBy("digest").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    smallest = staged(ids.where("lo < hi").select("digest", "lo"), "audit-repeated")
    joined = rows.join(smallest, "digest", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("lo"), F.lit(False))
    return joined.select("doc_id", "part", F.when(copy, F.col("fails") + (1 << FILTERS.index("E"))).otherwise(F.col("fails")).alias("fails"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails and the label class: 1 if good, plus 2 if toxic."""
    found = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        (F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")) + 2 * F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int"))).alias("label")
    )
    return rows.join(found, "doc_id", "left").select("part", "fails", F.coalesce("label", F.lit(0)).cast("int").alias("label"))


def subset_survivors(rows: DataFrame) -> DataFrame:
    """part, subset, and how many of its documents survive the subset: all, good and toxic ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column(0).dictionary_encode()
            words = SURVIVAL[batch.column(1).to_numpy(zero_copy_only=False)]
            group = part.indices.to_numpy(zero_copy_only=False) * 4 + batch.column(2).to_numpy(zero_copy_only=False)
            order = np.argsort(group, kind="stable")
            group, words = group[order], words[order]
            ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
            begin = 0
            for end in ends[ends > 0]:
                name, label = part.dictionary[int(group[begin]) // 4], int(group[begin]) % 4
                counts = positional_counts(words[begin:end])
                begin = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()] * SUBSETS, pa.string()), pa.array(np.arange(SUBSETS, dtype=np.int32)), pa.array(counts),
                     pa.array(counts * (label & 1)), pa.array(counts * (label >> 1))],
                    names=["part", "subset", "n", "good", "toxic"],
                )

    counted = rows.select("part", "fails", "label").mapInArrow(run, "part string, subset int, n long, good long, toxic long")
    return counted.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, filters before it, filter of the step as a bit) of all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order):
            out.append(("".join(FILTERS[x] for x in order), step + 1, before, 1 << f))
            before |= 1 << f
    return out


def outcomes(survivors: DataFrame) -> DataFrame:
    """One row per part, order and step from the survivors of the part's subsets."""
    steps = _steps()
    before = np.array([s[2] for s in steps])
    bit = np.array([s[3] for s in steps])
    names = pa.array([s[0] for s in steps]), pa.array(np.array([s[1] for s in steps], np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                table = np.zeros((SUBSETS, 3), np.int64)
                for x in counts:
                    table[x["subset"]] = x["n"], x["good"], x["toxic"]
                lost = table[before] - table[before | bit]
                removed = lost[:, 0]
                shapley = np.zeros(SUBSETS, np.int64)
                np.add.at(shapley, bit, removed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(steps), pa.string()), *names, pa.array(table[before | bit, 0]), pa.array(removed),
                     pa.array(table[0, 0] - table[bit, 0] - removed), pa.array(table[ALL ^ bit, 0] - table[ALL, 0]),
                     pa.array(lost[:, 1]), pa.array(lost[:, 2]), pa.array(shapley[bit])],
                    names=["part", "filter_order", "step", *OUTCOME],
                )

    per_part = survivors.groupBy("part").agg(F.collect_list(F.struct("subset", "n", "good", "toxic")).alias("counts"))
    return per_part.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in OUTCOME))


def audit_filters(documents: DataFrame, labels: DataFrame, limits: FilterLimits | None = None) -> DataFrame:
    """part, filter_order, step and the counts of :data:`OUTCOME`, for every
    part and each of the five steps of all 120 orders.

    kept: left after this step; removed: by this step; redundant: failing its
    filter but removed earlier; unique_fails: failing no other filter;
    good_lost and toxic_lost: removed here, by label; shapley: removed by the
    step's filter, summed over all orders.
    """
    rows = staged(judged_texts(documents, limits or FilterLimits()), "audit-texts")
    return outcomes(subset_survivors(with_labels(with_copies(rows), labels)))
