import zlib

import numpy as np

from medallion.llm import quality


def test_held_out_accuracy(llm_spark):
    documents = llm_spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = llm_spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.score_documents(documents, labels).collect()
    assert len(rows) == documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.95


def test_labels_of_held_out_rows_change_nothing(llm_spark, sample_documents):
    labels = llm_spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(string(doc_id)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    score = lambda y: {r.doc_id: r.score for r in quality.score_documents(sample_documents, y).collect()}
    a, b = score(labels), score(turned)
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_awkward_rows(llm_spark, odd_documents, no_documents):
    labels = llm_spark.createDataFrame(
        [(1, 1), (1, 0), (2, 1), (3, 0), (4, 0), (6, 1), (7, 1), (9, 0), (10, 0), (None, 1), (8, None)], "doc_id long, quality int"
    )
    rows = quality.score_documents(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count() and len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    alone = quality.score_documents(odd_documents, labels.where("false")).collect()
    assert {r.predicted for r in alone} == {1} and all(0.49 < r.score < 0.51 for r in alone)
    kept = quality.keep_good(odd_documents, labels)
    assert kept.schema == odd_documents.schema and kept.count() <= odd_documents.count()
    assert quality.score_documents(no_documents, labels).count() == 0


def test_isotonic_pools_violators():
    x, y = quality.isotonic(np.arange(5.0), np.array([0.1, 0.4, 0.2, 0.9, 0.8]), np.ones(5))
    assert np.allclose(y, [0.1, 0.3, 0.85]) and np.allclose(x, [0, 1.5, 3.5])


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    size, width = 4000, 2.0
    model = quality.QualityModel(
        np.zeros(4), np.ones(4), rng.normal(0, 1 / width, (4, size)), rng.uniform(0, 2 * np.pi, size), np.zeros(size + 1), np.zeros(1), np.zeros(1)
    )
    x = rng.normal(size=(6, 4))
    z = model.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * width**2))
    assert np.abs(z @ z.T - exact).max() < 0.08
