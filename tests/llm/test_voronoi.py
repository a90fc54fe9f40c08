import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import voronoi
from medallion.llm.voronoi import SearchParams, nearest

SCHEMA = "vec_id long, embedding array<float>, score string, place string, cell string"


def brute(rows, k=5, every=50):
    """Each query's k best other rows, in exact integers."""
    usable = [
        (i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, q) in enumerate(usable):
        if i % every == 0:
            scores = [(-sum(a * b for a, b in zip(q, x, strict=True)), j) for n, (j, x) in enumerate(usable) if n != at and len(x) == len(q)]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA).repartition(4)


def found(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def rows_of(df):
    return [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]


@pytest.mark.parametrize("params", [
    SearchParams(), SearchParams(pivots=8, sample=64, queries_per_group=3, rows_per_piece=50), SearchParams(pivots=1, sample=2),
])
def test_real_vectors_equal_brute_force(llm_spark, params):
    data = llm_spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert found(nearest(data, F.col("vec_id") % 50 == 0, params=params)) == brute(rows_of(data))


def test_awkward_rows(llm_spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(-100, 60)]
    rows += [(None, [1.0, 0.0, 0.0, 0.0]), (200, None), (250, [1.0, None, 0.0, 0.0]), (300, [float("nan")] * 4), (350, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(400, []), (401, []), (450, [0.5, 0.5]), (451, [0.25, -0.5]), (500, [3.0] * 7), (550, [-0.0, 0.0, -0.0, 0.0]), (551, [0.0] * 4)]
    rows += [(50, rows[5][1]), (50, rows[150][1]), (50, rows[150][1])]  # repeated rows and a repeated id
    rows += [(600, [40_000.0, 0.0, 1.0, -1.0]), (601, [2e7, 1.0, 0.0, 0.0])]
    data = frame(llm_spark, rows)
    for params in (SearchParams(), SearchParams(pivots=3, sample=12, queries_per_group=2, rows_per_piece=20)):
        assert found(nearest(data, F.col("vec_id") % 50 == 0, params=params)) == brute(rows_of(data))


def test_fewer_rows_than_wanted_and_none(llm_spark):
    data = frame(llm_spark, [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (50, [1.0, 2.0])])
    assert found(nearest(data, F.col("vec_id") % 50 == 0)) == brute(rows_of(data))
    assert nearest(data.where("vec_id = 1"), F.col("vec_id") % 50 == 0).collect() == []
    assert nearest(data.where("false"), F.col("vec_id") % 50 == 0).collect() == []


def test_a_vector_of_a_third_of_all_rows(llm_spark):
    rng = np.random.default_rng(4)
    rows = [(i, [0.5, 0.5, -0.5, 0.5] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(1500)]
    data = frame(llm_spark, rows)
    wanted = brute(rows_of(data))
    assert found(nearest(data, F.col("vec_id") % 50 == 0, params=SearchParams(rows_per_piece=200, queries_per_group=7))) == wanted
    every = voronoi.whole_vectors(data, "vec_id", "embedding", 256)
    assert voronoi.without_idle_copies(every, 5).count() == 1000 + 6


def test_bounds_leave_far_clusters_out(llm_spark, monkeypatch):
    """With clusters, a group gets only the data that its bound can't rule out, and loses nothing."""
    rng = np.random.default_rng(6)
    centres = np.eye(12)[:6] * 3
    rows = [(i, (centres[i % 6] + rng.normal(size=12) * 0.05).tolist()) for i in range(1200)]
    copied = []
    real = voronoi.replicated

    def counted(*args):
        out = real(*args)
        copied.append((out.count(), out.select("grp").distinct().count()))
        return out

    monkeypatch.setattr(voronoi, "replicated", counted)
    data = frame(llm_spark, rows)
    got = found(nearest(data, F.col("vec_id") % 50 == 0, params=SearchParams(pivots=6, sample=300, queries_per_group=4)))
    assert got == brute(rows_of(data))
    (n, groups), = copied
    assert groups > 1 and n < 0.5 * groups * 1200


def test_scores_beyond_64_bits_raise():
    big = np.full((1, 2), 2.0**40)
    with pytest.raises(OverflowError):
        voronoi.products(big, big)
    edge = np.array([[2.0**30, 1.0]])
    assert voronoi.products(edge, edge)[0, 0] == 2**60 + 1
