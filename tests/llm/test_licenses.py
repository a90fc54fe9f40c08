import random
import re

from medallion.llm import licenses


def brute(text, p=licenses.ScanParams()):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    base, labels, score = [], set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        want = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    for template, label in licenses.TEMPLATES.items():
        want, step = set(template.split()), p.block_words // 2
        while step < len(template.split()):
            step *= 2
        for b in range(0, len(words), step):
            share = len(want & set(words[b : b + 2 * step])) / len(want)
            if share >= p.containment:
                labels.add(label)
                score = max(score, share)
    places = [i for i, _ in base]
    return (
        len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})),
        ",".join(sorted(labels | {x for _, x in base})), 1.0 if base else score,
    )


def rows_of(documents):
    key = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return sorted(((r.doc_id, *[r[k] for k in key]) for r in licenses.scan(documents).collect()), key=str)


def test_equals_comparing_every_block(odd_documents, llm_spark):
    assert rows_of(odd_documents) == sorted(((r.doc_id, *brute(r.text)) for r in odd_documents.collect()), key=str)
    near = [
        "Licensed under the Apache License, Version 2", "LICENSED UNDER THE APACHE version two", "rights all x reserved",
        "x " * 15 + "released " + "y " * 14 + "under the mit license", "cc by-nc 4.0 licensed under", "mit\x00license mit-LICENSE",
        "Kind mit licenſe", "you can redistribute it under the terms of the gnu general license", "x " * 40 + "gnu general public license",
    ]
    rng = random.Random(4)
    for body in (t for t in licenses.TEMPLATES if len(t.split()) > 16):
        for lost in (0, 3, 6, 9, 12, 20):
            words = body.split()
            for k in rng.sample(range(len(words)), min(lost, len(words))):
                words[k] = rng.choice(["other", "x", "words"])
            near.append(" ".join(["before"] * rng.randrange(90) + words + ["after"] * rng.randrange(70)).upper())
    documents = llm_spark.createDataFrame(list(enumerate(near)), "doc_id long, text string")
    assert rows_of(documents) == sorted(((i, *brute(t)) for i, t in enumerate(near)), key=str)


def test_a_template_of_hundreds_of_words(llm_spark):
    words = [f"t{i}" for i in range(700)]
    rows = [(1, " ".join(["a"] * 1000 + words[:600] + ["b"] * 400)), (2, " ".join(words[:500])), (3, " ".join(words[::-1]))]
    found = licenses.scan(llm_spark.createDataFrame(rows, "doc_id long, text string"), phrases={}, templates={" ".join(words): "long"})
    assert {r.doc_id: (r.labels, round(r.score, 6)) for r in found.collect()} == {1: ("long", round(600 / 700, 6)), 2: ("", 0.0), 3: ("long", 1.0)}


def test_empty_table(no_documents):
    assert licenses.scan(no_documents).count() == 0
