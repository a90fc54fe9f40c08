import re

import numpy as np
import pytest

from medallion.llm import jaccard
from medallion.llm.common import components


def brute(rows, params):
    """(shingle count, smallest reachable id) per id, from all pairs."""
    sets = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        k = params.shingle
        sets[doc_id] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    label = {d: d for d in sets}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= params.percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {d: (len(sets[d]), top(d)) for d in ids}


def found(documents, params):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(documents, params).collect()}


def planted(seed, n):
    rng = np.random.default_rng(seed)
    bases = [[f"w{x}" for x in rng.integers(0, 400, rng.integers(3, 70))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(bases[rng.integers(0, 8)])
        for _ in range(rng.integers(0, 5)):
            words[rng.integers(0, len(words))] = f"w{rng.integers(0, 400)}"
        rows.append((i, " ".join(words[: max(1, len(words) - rng.integers(0, 4))])))
    return rows


@pytest.mark.parametrize(("shingle", "percent"), [(3, 90), (2, 80)])
def test_components_equal_comparing_all_pairs(llm_spark, shingle, percent):
    params = jaccard.JaccardParams(shingle=shingle, percent=percent, shingles_per_bucket=2000)
    rows = [*planted(shingle, 260), (900, None), (901, ""), (902, "a"), (903, "A"), (904, "a b")]
    assert found(llm_spark.createDataFrame(rows, "doc_id long, text string").repartition(4), params) == brute(rows, params)


def test_a_passage_and_copies_that_a_third_of_all_rows_share(llm_spark):
    """Common parts are reduced to stars in each batch; nothing is lost between their members."""
    rng = np.random.default_rng(11)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage[: 25 + i % 16] + [f"w{x}" for x in rng.integers(0, 60, 6 + i % 5)])) for i in range(150)]
    rows += [(1000 + i, text) for i, text in planted(3, 150)]
    params = jaccard.JaccardParams(shingle=2, percent=80, shingles_per_bucket=500, common_part=2)
    assert found(llm_spark.createDataFrame(rows, "doc_id long, text string").repartition(3), params) == brute(rows, params)


def test_fine_sketches_bound_the_difference_at_any_length():
    rng = np.random.default_rng(7)
    for n, m in ((3, 4), (100, 130), (500, 2000), (3000, 2500)):
        pool = rng.integers(0, 2**64, max(n, m) + 300, dtype=np.uint64)
        a, b = np.unique(rng.choice(pool, n, False)), np.unique(rng.choice(pool, m, False))
        apart = len(np.setxor1d(a, b))
        assert jaccard.fine_distance(jaccard.fine_sketch(a), jaccard.fine_sketch(b)) <= apart
        assert jaccard.fine_distance(jaccard.fine_sketch(a), jaccard.fine_sketch(a)) == 0


def test_keep_one_leaves_columns_of_any_name_alone(llm_spark):
    rows = [(1, "a b c d", "x", "y", "z", "v"), (2, "a b c d", "p", "q", "r", "s"), (3, "other words here", "1", "2", "3", "4")]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, __id string, __own string, `row` string, `a.b` string")
    kept = jaccard.keep_one(docs, jaccard.JaccardParams(shingle=2, percent=80))
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]


def test_a_chain_of_links_through_a_rejected_neighbour(llm_spark):
    """Members of a shared part that fail against its smallest node are still compared with each other."""
    base = [f"t{i}" for i in range(200)]
    rows = [(i, " ".join(base[i * 3 :] + [f"e{k}" for k in range(i * 3)])) for i in range(12)]
    params = jaccard.JaccardParams(shingle=1, percent=90)
    assert found(llm_spark.createDataFrame(rows, "doc_id long, text string"), params) == brute(rows, params)


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(5)
    for _ in range(30):
        a, b = (" ".join(f"w{x}" for x in rng.integers(0, 90, 60)).encode() for _ in range(2))
        data, at = np.frombuffer(a + b, np.uint8), np.array([0, len(a), len(a + b)])
        sets = jaccard.shingle_sets(data, at, 1)
        x, y = (set(sets.shingles[sets.first[k] : sets.first[k + 1]].tolist()) for k in (0, 1))
        apart = np.bitwise_count((sets.folded()[0] ^ sets.folded()[1]).view(np.uint64)).sum()
        assert apart <= len(x ^ y)


def test_awkward_rows(odd_documents, no_documents):
    params = jaccard.JaccardParams(shingle=3, percent=90)
    rows = jaccard.near_duplicates(odd_documents, params).collect()
    assert len(rows) == odd_documents.count()
    assert {(r.component_id) for r in rows if r.doc_id in (1, 2)} == {1}
    assert all(r.component_id == r.doc_id for r in rows if r.doc_id not in (1, 2))
    assert [r.n_shingles for r in rows if r.doc_id in (3, 4, 5)] == [0, 0, 0]
    kept = jaccard.keep_one(odd_documents, params)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 3, 4, 5, 6, 7, None, 8, 9, 10, 10]))
    assert jaccard.near_duplicates(no_documents, params).count() == 0 and jaccard.keep_one(no_documents, params).count() == 0


def test_components_of_a_long_path_and_a_hub(llm_spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, x) for x in range(2, 60)] + [(7, 7)]
    got = {r.node: r.component for r in components(llm_spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{x: 1 for x in range(2, 60)}}
