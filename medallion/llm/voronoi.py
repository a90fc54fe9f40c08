"""Exact nearest vectors by inner product: a Voronoi kNN join.

Components are floored multiples, ``floor(scale * x)``, so scores are
integers and ties are exact.

1. Of equal vectors only the ``k + 1`` with the smallest ids can be in any
   result, so a vector that a third of all rows share is reduced before the
   join (each task first, then over all).
2. Pivots are cluster centres of a bounded sample of the data. Queries and
   data belong to the cell of their nearest pivot.
3. Each query's score with its ``k + 1``-th best vector of the sample is a
   lower bound of what it will find. A cell's queries are summarised by their
   radius around the pivot and the smallest of these bounds.
4. For a query q of cell a and any x: ``<q, x> <= <a, x> + radius * |x|``. A
   vector goes to a group of queries only if for some of the group's cells
   this reaches the cell's bound; a data cell whose summary (its radius and
   longest vector) can't reach it isn't looked at for that group.
5. A group is solved in pieces: all its queries against a share of its data,
   one matrix product a piece, ``k + 1`` vectors kept for each query. The
   pieces' results are ranked together.

Groups hold about ``queries_per_group`` queries (small cells are put together,
large ones dealt out), so data is copied once a group at most, and less where
the bounds rule it out. Where vectors have no clusters the bounds rule out
nothing and the join is a block join of the query set with all rows.

Rows without id or vector, or with a null or non-finite component, take no
part. Vectors of different lengths don't meet. Ties go to the smaller id. Of
repeated rows each is a query and a candidate of the others, but not of
itself. An empty table or no query gives no rows. Scores that 64 bits can't
hold raise OverflowError. Only the id and vector columns are read, so other
columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import staged

#: room for rounding in the bounds, relative to the product of lengths
_ROUNDING = 1e-9
_VECTORS = "vec_id long, dim int, vector binary"


@dataclass(frozen=True)
class SearchParams:
    """k: results a query. scale: of the components. pivots and sample: cells
    per vector length, and the rows they are fitted on and bounds are taken
    from (both bounded: sample * length * 8 bytes are sent to each task).
    queries_per_group, rows_per_piece: of the local joins."""

    k: int = 5
    scale: int = 256
    pivots: int = 64
    sample: int = 2048
    queries_per_group: int = 4096
    rows_per_piece: int = 50_000


@dataclass(frozen=True)
class Cells:
    """Pivots of one vector length, with the sample they come from."""

    pivots: np.ndarray
    sample: np.ndarray

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its pivot) of each row."""
        squared = (self.pivots**2).sum(1)[None] - 2 * x @ self.pivots.T
        cell = np.argmin(squared, axis=1) if len(x) else np.zeros(0, np.int64)
        return cell, np.linalg.norm(x - self.pivots[cell], axis=1)

    def bounds(self, x: np.ndarray, k: int) -> np.ndarray:
        """A score that each row reaches with at least ``k`` vectors beside
        itself, if the sample has that many."""
        out, at = np.full(len(x), -np.inf), len(self.sample) - k - 1
        for begin in range(0, len(x) if at >= 0 else 0, 512):
            out[begin : begin + 512] = np.partition(products(x[begin : begin + 512], self.sample), at, axis=1)[:, at]
        return out


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows, as 64-bit integers."""
    largest = (np.abs(x).max(initial=0)) * (np.abs(y).max(initial=0)) * max(1, x.shape[1])
    if largest < 2**53:
        return np.rint(x @ y.T).astype(np.int64)
    if largest < 2**63 and max(np.abs(x).max(), np.abs(y).max()) < 2**53:
        return x.astype(np.int64) @ y.astype(np.int64).T
    raise OverflowError("inner products of these vectors need more than 64 bits")


def _pack(x: np.ndarray) -> bytes:
    """A whole-numbered vector in the fewest bytes a component that hold it."""
    largest = np.abs(x).max(initial=0)
    return (x + 0.0).astype("<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<f8").tobytes()


def _matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    """The packed vectors, each of ``dim`` components, as rows."""
    if not dim or not blobs:
        return np.zeros((len(blobs), dim))
    kinds = {2 * dim: "<i2", 4 * dim: "<i4", 8 * dim: "<f8"}
    sizes = np.array([len(b) for b in blobs])
    out = np.empty((len(blobs), dim))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out[rows] = np.frombuffer(b"".join(blobs[r] for r in rows), kinds[int(size)]).reshape(-1, dim)
    return out


def whole_vectors(data: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id, dim, vector: floored components, packed, of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            at = lists.offsets.to_numpy()
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * float(scale))
            dim = np.diff(at)
            blobs = [_pack(flat[a:b]) for a, b in zip(at[:-1] - at[0], at[1:] - at[0], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(dim.astype(np.int32)), pa.array(blobs, pa.binary())], names=["vec_id", "dim", "vector"]
            )

    x = F.col("vector")
    given = data.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return given.where(F.col("vec_id").isNotNull() & x.isNotNull() & finite).mapInArrow(run, _VECTORS)


def without_idle_copies(vectors: DataFrame, k: int) -> DataFrame:
    """Of equal vectors the ``k + 1`` rows with the smallest ids. Spark keeps
    that many per task before the rows are shuffled."""
    place = Window.partitionBy("dim", "vector").orderBy("vec_id")
    return vectors.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1).drop("place")


def fit_cells(data: DataFrame, p: SearchParams) -> dict[int, Cells]:
    """Cells for each vector length of a bounded sample: rows picked by their
    hash, about twice as many as needed, and of these the ones with the
    smallest, so that the same data always gives the same cells."""
    spread = 1 << 20
    share = -(-2 * p.sample * spread // max(1, data.count()))
    place = F.xxhash64("vector", "vec_id")
    rows = data.where(F.pmod(place, F.lit(spread)) < share).orderBy(place, "vec_id").limit(p.sample).collect()
    cells = {}
    for dim in sorted({r.dim for r in rows if r.dim}):
        x = _matrix([bytes(r.vector) for r in rows if r.dim == dim], dim)
        pivots = np.unique(x, axis=0)
        pivots = pivots[np.linspace(0, len(pivots) - 1, min(p.pivots, len(pivots))).astype(int)].copy()
        for _ in range(5):
            cell, _ = Cells(pivots, x).nearest(x)
            for c in range(len(pivots)):
                if (cell == c).any():
                    pivots[c] = x[cell == c].mean(axis=0)
        cells[dim] = Cells(pivots, x)
    return cells


def in_cells(vectors: DataFrame, cells: dict[int, Cells], k: int, with_bound: bool) -> DataFrame:
    """``vectors`` with cell (-1 for a length that the sample lacks), apart
    (distance to the pivot), length and, for queries, bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                x = _matrix(part.column(2).to_pylist(), int(dim))
                long = np.linalg.norm(x, axis=1)
                cell, far, bound = np.full(len(at), -1), long, np.full(len(at), -np.inf)
                if int(dim) in cells:
                    cell, far = cells[int(dim)].nearest(x)
                    if with_bound:
                        bound = cells[int(dim)].bounds(x, k)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell.astype(np.int32)), pa.array(far), pa.array(long), pa.array(bound)],
                    names=["vec_id", "dim", "vector", "cell", "apart", "length", "bound"],
                )

    return vectors.mapInArrow(run, f"{_VECTORS}, cell int, apart double, length double, bound double")


@dataclass(frozen=True)
class QueryCell:
    """What is known of a cell's queries: how far they lie from the pivot, and
    the score that every one of them reaches. ``groups``: first group and how many."""

    dim: int
    cell: int
    rows: int
    radius: float
    bound: float
    groups: tuple[int, int]


def query_cells(queries: DataFrame, per_group: int) -> list[QueryCell]:
    """Summaries of the query cells (pivots of each length at most), with
    their groups: neighbours in the list share one until it is full."""
    rows = queries.groupBy("dim", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("apart").alias("radius"), F.min("bound").alias("bound")
    ).orderBy("dim", "cell").collect()
    out, group, room, last = [], -1, 0, None
    for r in rows:
        if r.n > room or r.dim != last:
            group = out[-1].groups[0] + out[-1].groups[1] if out else 0
            parts = -(-r.n // per_group)
            room = per_group - r.n if parts == 1 else 0
        else:
            parts, room = 1, room - r.n
        out.append(QueryCell(r.dim, r.cell, r.n, r.radius, r.bound, (group, parts)))
        last = r.dim
    return out


def _group_of(cells: list[QueryCell]) -> Column:
    """The group of a query row: its cell's, dealt by id where it has several."""
    found = F.map_from_entries(F.array(*[
        F.struct(F.concat_ws(":", F.lit(c.dim), F.lit(c.cell)), F.struct(F.lit(c.groups[0]).alias("first"), F.lit(c.groups[1]).alias("many")))
        for c in cells
    ]))
    mine = found[F.concat_ws(":", "dim", "cell")]
    return (mine["first"] + F.pmod(F.xxhash64("vec_id"), mine["many"])).cast("int")


def needed_by(cells: dict[int, Cells], queries: list[QueryCell], summaries: dict[tuple[int, int], tuple[float, float]]) -> Callable:
    """A function (dim, cells, vectors, lengths) -> one mask for each group of queries that may need some of the rows."""

    def masks(dim: int, cell: np.ndarray, x: np.ndarray, length: np.ndarray) -> dict[int, np.ndarray]:
        out: dict[int, np.ndarray] = {}
        for q in queries:
            if q.dim != dim:
                continue
            centre = cells[dim].pivots[q.cell] if q.cell >= 0 else np.zeros(dim)
            reach = np.zeros(len(x), bool)
            for c in np.unique(cell):
                rows = np.flatnonzero(cell == c)
                far, longest = summaries[dim, int(c)]
                middle = cells[dim].pivots[c] if c >= 0 else np.zeros(dim)
                slack = _ROUNDING * (np.linalg.norm(centre) + q.radius + 1) * (longest + 1)
                if centre @ middle + np.linalg.norm(centre) * far + q.radius * longest + slack >= q.bound:
                    reach[rows] = x[rows] @ centre + q.radius * length[rows] + slack >= q.bound
            for g in range(q.groups[0], q.groups[0] + q.groups[1]):
                out[g] = out.get(g, False) | reach
        return {g: m for g, m in out.items() if m.any()}

    return masks


def replicated(data: DataFrame, masks: Callable, pieces: int) -> DataFrame:
    """grp, piece, dim, vec_id, vector: the data that each group of queries needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                ids, cell, length = (part.column(k).to_numpy() for k in (0, 3, 5))
                x = _matrix(part.column(2).to_pylist(), int(dim))
                dealt = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(pieces)
                for group, mask in masks(int(dim), cell, x, length).items():
                    for piece in np.unique(dealt[mask]):
                        take = np.flatnonzero(mask & (dealt == piece))
                        keys = [pa.array(np.full(len(take), v, np.int32)) for v in (group, piece, dim)]
                        yield pa.RecordBatch.from_arrays(
                            [*keys, *(part.column(k).take(pa.array(take)) for k in (0, 2))], names=["grp", "piece", "dim", "vec_id", "vector"]
                        )

    return data.mapInArrow(run, "grp int, piece int, dim int, vec_id long, vector binary")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` highest scores of a row, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        found = np.flatnonzero(scores >= least)
    else:
        found = np.arange(len(scores))
    return found[np.lexsort((ids[found], -scores[found]))[:k]]


def solved(queries: DataFrame, data: DataFrame, pieces: int, k: int) -> DataFrame:
    """grp, place (of the query in its group), query_id, own (its score with
    itself), vec_id, score: each query's ``k + 1`` best of each piece. All
    pieces of a group get its queries, which ``queries_per_group`` bounds."""

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: [] for c in ("place", "query_id", "own", "vec_id", "score")}
        if left.num_rows and right.num_rows:
            dim = right.column("dim")[0].as_py()
            left = left.take(pc.sort_indices(left, [("vec_id", "ascending"), ("vector", "ascending")]))
            (q_ids, q), (ids, x) = ((t.column("vec_id").to_numpy(), _matrix(t.column("vector").to_pylist(), dim)) for t in (left, right))
            for begin in range(0, len(q), 64):
                scores = products(q[begin : begin + 64], x)
                for row, place in enumerate(range(begin, min(begin + 64, len(q)))):
                    top = best(scores[row], ids, k + 1)
                    own = int(products(q[place : place + 1], q[place : place + 1])[0, 0])
                    for name, values in (("place", place), ("query_id", q_ids[place]), ("own", own)):
                        out[name].append(np.full(len(top), values, np.int64))
                    out["vec_id"].append(ids[top])
                    out["score"].append(scores[row][top])
        columns = {c: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64)) for c, v in out.items()}
        group = left.column("grp")[0].as_py() if left.num_rows else -1
        return pa.table({"grp": pa.array([group] * len(columns["place"]), pa.int32()), **columns})

    each = queries.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    return each.groupBy("grp", "piece").cogroup(data.groupBy("grp", "piece")).applyInArrow(
        solve, "grp int, place long, query_id long, own long, vec_id long, score long"
    )


def nearest(
    data: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", params: SearchParams | None = None
) -> DataFrame:
    """query_id, rank, vec_id, score: for every row of ``data`` that
    ``is_query`` (a condition on vec_id) picks, its ``k`` best other rows."""
    p = params or SearchParams()
    spark = data.sparkSession
    every = staged(whole_vectors(data, id_col, vector_col, p.scale), "search-vectors")
    least = staged(without_idle_copies(every, p.k), "search-data")
    cells = fit_cells(least, p)
    asked = staged(in_cells(every.where(is_query), cells, p.k, True), "search-queries")
    groups = query_cells(asked, p.queries_per_group)
    if not groups:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    placed = staged(in_cells(least, cells, p.k, False), "search-cells")
    per_cell = placed.groupBy("dim", "cell").agg(F.max("apart").alias("far"), F.max("length").alias("longest"), F.count(F.lit(1)).alias("n"))
    found = per_cell.collect()  # a row per cell, at most pivots of each length in the sample
    summaries = {(r.dim, r.cell): (r.far, r.longest) for r in found}
    pieces = max(1, -(-sum(r.n for r in found) // p.rows_per_piece))
    wanted = staged(replicated(placed, needed_by(cells, groups, summaries), pieces), "search-replicas")
    results = solved(asked.select(_group_of(groups).alias("grp"), "vec_id", "vector"), wanted, pieces, p.k)

    query = Window.partitionBy("grp", "place")
    order = query.orderBy(F.col("score").desc(), "vec_id")
    first = results.withColumn("at", F.row_number().over(order)).where(F.col("at") <= p.k + 1)
    itself = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own"))
    where_own = F.min(F.when(itself, F.col("at"))).over(query)
    others = first.withColumn("own_at", F.coalesce(where_own, F.lit(p.k + 1))).where("at <> own_at")
    return others.select(
        "query_id", (F.col("at") - F.when(F.col("at") > F.col("own_at"), 1).otherwise(0)).cast("int").alias("rank"), "vec_id", "score"
    )
