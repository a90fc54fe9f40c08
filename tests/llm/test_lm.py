import math
import re
import zlib
from collections import Counter

import pytest

from medallion.llm import lm


def brute(rows, p):
    texts = [(d, [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)})), "\n"]) for d, t in rows]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    c = Counter(w for d, ws in texts if not held(d) for w in ws)
    n, v = sum(c.values()), len(c)
    norm = n + 0.5 * (v + 1)
    kind = lambda w: w if c[w] >= p.core_min or w == "\n" else None
    rare = [w for w in c if kind(w) is None]
    rare_n = sum(c[w] for w in rare)
    root = lambda k: (rare_n + 0.5 * (len(rare) + 1) if k is None else c[k] + 0.5) / norm
    grams = Counter()
    for d, ws in texts:
        whole = ["\n", *map(kind, ws)]
        if not held(d):
            grams.update(tuple(whole[i : i + k]) for k in range(2, p.order + 1) for i in range(len(whole) - k + 1))
    out = []
    for d, ws in texts:
        score, past = 0.0, ("\n",)
        for w in ws:
            k = kind(w)
            step = root(k)
            for length in range(1, len(past) + 1):
                h = past[-length:]
                seen = grams[h] if length > 1 else rare_n if h[0] is None else c[h[0]]
                step = (grams[(*h, k)] + p.mu * step) / (seen + p.mu)
            score += math.log10(step if k is not None else step * (c[w] + 0.5) / norm / root(None))
            past = (*past, k)[-(p.order - 1) :]
        out.append((d, held(d), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / norm) for w in ws), score))
    return out


def assert_same(documents, p):
    want = brute([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], p)
    got = [tuple(r) for r in lm.score_texts(documents, p).collect()]
    key = lambda r: (str(r[0]), round(r[6], 4))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-6)


@pytest.mark.parametrize("params", [
    lm.LmParams(), lm.LmParams(core_min=4, mu=5.0, block_tokens=5000, entries_per_bucket=1000),
    lm.LmParams(order=2), lm.LmParams(order=5, mu=2.0, block_tokens=9000), lm.LmParams(core_min=1, block_tokens=20000),
])
def test_equals_counting_in_one_place(sample_documents, odd_documents, params):
    assert_same(sample_documents.repartition(3), params)
    assert_same(odd_documents, params)


def test_the_model_beats_the_base_on_held_out_texts(llm_spark):
    rows = lm.score_texts(llm_spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), lm.LmParams(core_min=10)).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_no_training_text_and_empty_table(llm_spark, no_documents):
    only_held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = lm.score_texts(llm_spark.createDataFrame([(only_held, "a b")], "doc_id long, text string")).first()
    assert (row.n_known, row.train_tokens, row.base_score, row.score) == (0, 0, 0.0, 0.0)
    assert lm.score_texts(no_documents).count() == 0


def test_the_registered_model_beats_the_base_and_a_model_of_frequent_words(llm_spark):
    documents = llm_spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm.score_texts(documents).where("held_out").collect()
    frequent = lm.score_texts(documents, lm.LmParams(core_min=100)).where("held_out").collect()
    assert sum(r.score for r in rows) > max(sum(r.base_score for r in rows), sum(r.score for r in frequent))


def test_the_registered_model_beats_the_bigrams(llm_spark):
    documents = llm_spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows, pairs = (lm.score_texts(documents, p).where("held_out").collect() for p in (None, lm.LmParams(order=2)))
    assert sum(r.score for r in rows) > sum(r.score for r in pairs)


def test_a_pair_of_rare_words_counts(llm_spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 != 1]
    rows = [(i, f"rare{i} pair{i} common words") for i in ids] + [(1000 + i, f"pair{i} rare{i} words common") for i in ids[:3]]
    got = {r.doc_id: r for r in lm.score_texts(llm_spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    i = ids[0]
    assert got[i].score - got[i].base_score > got[1000 + i].score - got[1000 + i].base_score
    assert_same(llm_spark.createDataFrame(rows, "doc_id long, text string"), lm.LmParams())
