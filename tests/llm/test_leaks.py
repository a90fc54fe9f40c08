import math
import re
from collections import Counter

import numpy as np

from medallion.llm import leaks


def brute(documents, items, p):
    """Best weighted share over all windows of every document and item."""
    cut = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    words = {i: cut(t) for i, t in items}
    own = {i: grams(w) for i, w in words.items()}
    holders = Counter(g for s in own.values() for g in s)
    weigh = lambda s: sum(math.log1p(len(own) / holders[g]) for g in s)
    out = {}
    for doc_id, text in documents:
        w = cut(text)
        for i, s in own.items():
            size = max(len(words[i]), 1)
            best = max((weigh(grams(w[k : k + size]) & s) / max(weigh(s), 1e-12) for k in range(max(1, len(w) - size + 1))), default=0)
            if best >= p.similarity - 1e-9 and s:
                out[doc_id, i] = best
    return out


def planted(seed=2):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(0, 3000)}"
    items = [(i, " ".join(word() for _ in range(rng.integers(6, 45)))) for i in range(20)] + [(90, "one two"), (91, "")]
    documents = []
    for d in range(120):
        text, passage = [word() for _ in range(rng.integers(0, 120))], items[rng.integers(0, 20)][1].split()
        at, how = rng.integers(0, len(text) + 1), rng.integers(0, 6)
        if how == 1:
            passage[rng.integers(0, len(passage))] = "zzz"
        if how == 2:
            passage = passage[: int(len(passage) * rng.uniform(0.6, 1))]
        if how == 3:
            passage.insert(rng.integers(0, len(passage)), "xx")
        if how == 4:
            passage = [x.upper() + "," for x in passage]
        documents.append((d, " ".join(text[:at] + (passage if how < 5 else []) + text[at:])))
    return [*documents, (500, None), (501, ""), (502, "One, two!"), (503, "one two three")], items


def test_finds_what_all_windows_hold(llm_spark):
    p = leaks.LeakParams()
    documents, items = planted()
    rows = leaks.find_leaks(
        llm_spark.createDataFrame(documents, "doc_id long, text string"),
        llm_spark.createDataFrame([*items, (92, None), (None, "x")], "item_id int, text string"), params=p,
    ).collect()
    got, want = {(r.doc_id, r.item_id): r.similarity for r in rows}, brute(documents, items, p)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got) and {(502, 90), (503, 90)} <= got.keys()


def test_items_of_few_words_are_found_in_longer_texts(llm_spark):
    items = [(1, "alpha beta gamma delta"), (2, "Alpha, BETA"), (3, "omega"), (4, "gamma"), (5, "one two three four five")]
    documents = [(1, "x y alpha beta gamma delta z"), (2, "alpha-beta"), (3, "beta alpha"), (4, " ".join(["w"] * 300 + ["omega"])), (5, "one two three four")]
    rows = leaks.find_leaks(
        llm_spark.createDataFrame(documents, "doc_id long, text string"), llm_spark.createDataFrame(items, "item_id int, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id, r.first_word) for r in rows} == {(1, 1, 2), (1, 2, 2), (1, 4, 4), (2, 2, 0), (4, 3, 300)}
    assert {(r.doc_id, r.item_id) for r in rows} == brute(documents, items, leaks.LeakParams()).keys()


def test_items_in_blocks_give_the_same_documents(llm_spark):
    documents, items = planted(3)
    docs = llm_spark.createDataFrame(documents, "doc_id long, text string").selectExpr("*", "'x' AS item_id", "1 AS similarity")
    bench = llm_spark.createDataFrame(items, "item_id long, text string")
    one = leaks.find_leaks(docs, bench)
    many = leaks.find_leaks(docs, bench, params=leaks.LeakParams(item_block_bytes=2000))
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in many.collect()}
    clean = leaks.drop_leaked(docs, bench)
    assert clean.schema == docs.schema
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in documents} - {r.doc_id for r in one.collect()}
    assert leaks.find_leaks(docs, bench.where("false")).count() == 0 and leaks.find_leaks(docs.where("false"), bench).count() == 0


def test_pieces_guarantee_the_radius():
    rng = np.random.default_rng(4)
    items = rng.integers(0, 2**63, 50, dtype=np.uint64)
    prints = np.array([items[k % 50] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k % 40, replace=False))) for k in range(400)], np.uint64)
    for radius, blocks in ((26, 4), (3, 4), (10, 8)):
        window, item = leaks.within(prints, items, radius, blocks)
        exact = np.argwhere(np.bitwise_count(prints[:, None] ^ items[None]) <= radius)
        assert {*zip(window.tolist(), item.tolist(), strict=True)} == {*map(tuple, exact.tolist())}


def repeated(n_items=240, seed=6):
    """Items of which a third are copies of one, and texts that hold it with one word changed."""
    rng = np.random.default_rng(seed)
    text = lambda n: [f"w{k}" for k in rng.integers(0, 9000, n)]
    base = text(45)
    items = [(i, " ".join(base if i % 3 == 0 else text(45))) for i in range(n_items)]
    documents = []
    for d in range(40):
        passage = [*base]
        passage[d % 45] = "zzz"
        documents.append((d, " ".join(text(3) + passage + text(2))))
    return documents, items


def test_changed_copies_of_a_repeated_item(llm_spark):
    p = leaks.LeakParams()
    documents, items = repeated()
    rows = leaks.find_leaks(
        llm_spark.createDataFrame(documents, "doc_id long, text string"), llm_spark.createDataFrame(items, "item_id int, text string"), params=p,
    ).collect()
    got, want = {(r.doc_id, r.item_id): r.similarity for r in rows}, brute(documents, items, p)
    assert len(want) == 40 * 80 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_similarities_do_not_depend_on_the_blocks(llm_spark):
    rng = np.random.default_rng(8)
    text = lambda n: [f"w{k}" for k in rng.integers(0, 9000, n)]
    intro = text(12)
    items = [(i, " ".join((intro if i % 4 else []) + text(20))) for i in range(60)]
    documents = [(i, " ".join(text(4) + t.split()[rng.integers(0, 6) :] + text(3))) for i, t in items]
    docs, bench = llm_spark.createDataFrame(documents, "doc_id long, text string"), llm_spark.createDataFrame(items, "item_id long, text string")
    want = brute(documents, items, leaks.LeakParams())
    assert 20 < len(want) < 60 * 60
    for size in (8 << 20, 2000, 1):
        rows = leaks.find_leaks(docs, bench, params=leaks.LeakParams(item_block_bytes=size)).collect()
        got = {(r.doc_id, r.item_id): r.similarity for r in rows}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
