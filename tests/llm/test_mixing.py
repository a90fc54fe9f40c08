import numpy as np
import pytest

from medallion.llm import mixing


def test_raked_weights_meet_the_targets(llm_spark, sample_documents):
    rows = mixing.mix(sample_documents).collect()
    assert len(rows) == sample_documents.count()
    tokens = np.array([r.n_tokens for r in rows], float)
    weight = np.array([r.weight for r in rows]) * tokens
    for side, name in (("source", "source"), ("lang", "lang"), ("topic", "topic")):
        have = {r[name] for r in rows}
        total = sum(v for k, v in mixing.TARGETS[side].items() if k in have)
        for category in have:
            share = weight[[r[name] == category for r in rows]].sum() / weight.sum()
            assert share == pytest.approx(mixing.TARGETS[side].get(category, 0) / total, abs=1e-6)
    expected = (np.array([r.probability for r in rows]) * tokens).sum()
    assert expected == pytest.approx(0.9 * tokens.sum(), rel=1e-6)


def test_rake_equals_a_plain_loop():
    rng = np.random.default_rng(1)
    counts = {(a, b): float(rng.integers(1, 50)) for a in "xyz" for b in "pq"}
    targets = [{"x": 0.5, "y": 0.3, "z": 0.2}, {"p": 0.4, "q": 0.6}]
    factors, gap = mixing.rake(counts, targets, 1e-12, 1000)
    table = np.array(list(counts.values())).reshape(3, 2)
    total = table.sum()
    for _ in range(1000):
        table *= (np.array([0.5, 0.3, 0.2]) * total / table.sum(1))[:, None]
        table *= (np.array([0.4, 0.6]) * total / table.sum(0))[None]
    assert gap < 1e-12 and np.allclose(np.array(list(counts.values())) * factors, table.ravel())


def test_calibration_caps_at_one():
    p = mixing.calibrate(np.array([10.0, 10, 80]), np.array([5.0, 1, 1]), 0.5)
    assert p[0] == 1 and (p * [10, 10, 80]).sum() == pytest.approx(50)
    assert list(mixing.calibrate(np.array([1.0, 1]), np.array([0.0, 2]), 0.9)) == [0, 1]


def test_decisions_follow_the_probability_and_the_id(llm_spark):
    rows = [(i, "some words of a text " * 12, "en" if i % 3 else "de", f"src{i % 5}") for i in range(6000)]
    documents = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    p = mixing.MixParams(targets={"source": {"*": 1.0}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"prose": 1.0}}, keep=0.6)
    got = mixing.mix(documents, p).collect()
    for lang in ("en", "de"):
        own = [r for r in got if r.lang == lang]
        assert np.mean([r.kept for r in own]) == pytest.approx(own[0].probability, abs=0.04)
    kept = {r.doc_id for r in mixing.sample(documents, p).collect()}
    assert kept == {r.doc_id for r in got if r.kept}


def test_awkward_rows(odd_documents, no_documents):
    got = mixing.mix(odd_documents).collect()
    assert len(got) == odd_documents.count() and len({r.kept for r in got if r.doc_id == 2}) == 1
    kept = mixing.sample(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == sum(r.kept for r in got)
    assert mixing.mix(no_documents).count() == 0 and mixing.sample(no_documents).count() == 0
    assert mixing.mix(odd_documents.where("doc_id IN (3, 4)")).where("kept").count() == 2
    with pytest.raises(ValueError, match="no category"):
        mixing.rake({("a",): 1.0}, [{"b": 1.0}], 1e-9, 5)


def test_null_and_unnamed_categories_are_not_mixed_out(llm_spark):
    texts = ["some plain words of a text " * 12, "all rights reserved words " * 20, "# * $ % & | " * 9, "few words", None]
    rows = [(i, texts[i % 5], ["en", "de", None, "pt", "zh"][i % 7 % 5], [None, "src0", "src1", "src2"][i % 4]) for i in range(4200)]
    documents = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(documents).collect()
    assert len(got) == len(rows) and min(r.probability for r in got) > 0
    kept = {r.doc_id for r in got if r.kept}
    for k in (2, 3):
        assert {r[k] for r in rows if r[0] in kept} == {r[k] for r in rows}
    tokens, weight = sum(r.n_tokens for r in got), sum(r.n_tokens * r.weight for r in got)
    of = {r[0]: r for r in rows}
    unnamed = [r for r in got if of[r.doc_id][2] in (None, "pt", "zh")]
    assert {r.lang for r in unnamed} == {"*"}
    assert sum(r.n_tokens * r.weight for r in unnamed) / weight == pytest.approx(sum(r.n_tokens for r in unnamed) / tokens, abs=1e-6)


def test_sample_leaves_columns_of_any_name_alone(llm_spark):
    names = ["__topic", "__kept", "__Named", "__weight", "__c_lang", "__row", "__text", "row", "a.b"]
    rows = [(i, f"some words of text {i}", "en", f"src{i % 3}", *[f"{n}-{i}" for n in names]) for i in range(40)]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names))
    kept = mixing.sample(docs)
    decided = {r.doc_id for r in mixing.mix(docs).where("kept").collect()}
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == sorted(r for r in rows if r[0] in decided)


def test_only_unknown_languages_and_sources_with_tokens(llm_spark):
    rows = [(i, "some plain words of a text " * 12, [None, "pt"][i % 2], [None, "web", "books"][i % 3]) for i in range(600)]
    documents = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(documents).collect()
    assert {round(r.probability, 6) for r in got} == {0.9} and 480 < sum(r.kept for r in got) < 600
    assert mixing.sample(documents.withColumn("lang", mixing.F.lit(None).cast("string"))).count() > 480


def test_sources_of_the_data_keep_their_shares():
    counts = {(s, lang, "prose"): n for (s, lang), n in
              {("src0", "en"): 10.0, ("web", "en"): 60, ("web", "de"): 10, ("books", "en"): 5, ("books", "de"): 40, ("*", "en"): 20, ("*", "xx"): 10}.items()}
    p = mixing.MixParams()
    factors, gap, relaxed = mixing.rake_or_relax(counts, p)
    assert gap < 1e-6 and not relaxed and factors.min() > 0
    new = dict(zip(counts, np.array(list(counts.values())) * factors, strict=True))
    share = {s: sum(n for c, n in new.items() if c[0] == s) / sum(new.values()) for s in ("src0", "web", "books", "*")}
    assert share == pytest.approx({"src0": 0.3, "web": 0.7 * 70 / 145, "books": 0.7 * 45 / 145, "*": 0.7 * 30 / 145}, abs=1e-6)


def test_targets_that_contradict_each_other_drop_no_cell():
    counts = {("src0", "de", "prose"): 50.0, ("web", "en", "prose"): 30.0, ("web", "de", "prose"): 20.0, ("empty", "en", "prose"): 0.0}
    factors, gap, relaxed = mixing.rake_or_relax(counts, mixing.MixParams(targets={**mixing.TARGETS, "lang": {"en": 0.9, "de": 0.1}}))
    assert gap < 1e-6 and 0 < relaxed <= 1 and factors.min() > 0.01
