import re
from itertools import permutations

import numpy as np
import pytest

from medallion.llm.filteraudit import SURVIVAL, audit_filters, positional_counts

EMPTY_LABELS = "doc_id long, quality int, toxic int"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
    }


def brute(docs, labels):
    rows = []
    for doc_id, text, source in docs:
        copy = any(t == text and i is not None and doc_id is not None and i < doc_id for i, t, _ in docs)
        mine = [x for x in labels if doc_id is not None and x[0] == doc_id]
        rows.append((source, fails(text) | {"E": copy}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if r[1][f]], [r for r in left if not r[1][f]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(r[1][f] for r in own) - len(gone),
                    sum(r[1][f] and sum(r[1].values()) == 1 for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(removed_by[f])
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in df.collect()
    }


def plain(df):
    return [(r.doc_id, r.text or "", r.source or "") for r in df.collect()]


def test_awkward_rows_equal_brute_force(llm_spark, odd_documents):
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (6, None, 1), (9, 0, 0), (None, 1, 1), (99, 1, 1)]
    got = found(audit_filters(odd_documents, llm_spark.createDataFrame(labels, EMPTY_LABELS)))
    assert got == brute(plain(odd_documents), labels)


def test_real_documents_equal_brute_force(llm_spark, sample_documents):
    labels = llm_spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = found(audit_filters(sample_documents, labels))
    assert got == brute(plain(sample_documents), [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert len(got) == 600 * len({part for part, _, _ in got})


def test_one_text_in_a_third_of_all_rows(llm_spark):
    rows = [(i, "copied text" if i % 3 == 0 else f"own text {i}", "src0" if i % 2 else None) for i in range(900)]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = found(audit_filters(docs, llm_spark.createDataFrame([], EMPTY_LABELS)))
    assert got["", "EABCD", 1][1] + got["src0", "EABCD", 1][1] == 299


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 100, 10_001])
def test_carry_save_counts_are_plain_counts(n):
    words = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    words[: n // 3] = 0xFFFFFFFF
    assert positional_counts(words).tolist() == [int(((words >> np.uint32(b)) & 1).sum()) for b in range(32)]


def test_survival_words_name_the_subsets_without_a_failed_filter():
    for failed in range(32):
        assert [bool(int(SURVIVAL[failed]) >> s & 1) for s in range(32)] == [s & failed == 0 for s in range(32)]


def test_empty_table(llm_spark, no_documents):
    assert audit_filters(no_documents, llm_spark.createDataFrame([], EMPTY_LABELS)).collect() == []
