import re
from collections import Counter

from medallion.llm import hostrules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_measures_and_base_rule(odd_documents, sample_documents):
    for documents in (odd_documents, sample_documents):
        texts = Counter((r.doc_id, brute(r.text)) for r in documents.select("doc_id", "text").collect())
        got = hostrules.judge(documents).collect()
        assert Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == texts
        for r in got:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert r.kept == (not r.base_failed and not r.host_rejected)


def test_small_hosts_are_shrunk_and_bad_hosts_rejected(llm_spark):
    good, bad = "a clean text with quite enough words to pass every single rule", "too short"
    rows = [(i, good if i % 20 else bad, f"h{i % 10}") for i in range(1000)]
    rows += [(2000 + i, bad if i % 10 else good, "junk") for i in range(300)] + [(3000, bad, "tiny"), (3001, good, "tiny")]
    got = hostrules.judge(llm_spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    rate = {r.host: r.host_rate for r in got}
    assert {r.host for r in got if r.host_rejected} == {"junk"} and rate["tiny"] < 0.5
    assert not any(r.kept for r in got if r.host == "junk") and all(r.kept for r in got if r.doc_id % 20 and r.doc_id < 1000)


def test_beta_prior_recovers_a_known_spread():
    a, b = hostrules.beta_prior(200, 1000, 0.2, 0.2 * 0.8 / 11, 0.0)
    assert abs(a - 2) < 0.01 and abs(b - 8) < 0.01
    assert sum(hostrules.beta_prior(0, 0, 0.0, 0.0, 0.0)) > 0


def test_empty_table(no_documents):
    assert hostrules.judge(no_documents).count() == 0
