import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from medallion.llm import tokenfiles as tf

PARAMS = tf.TokenFileParams(tokenizer=public_tokenizers.path("word_bpe_49k.json"), block_tokens=3000, checkpoint_every=7)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=600), st.integers(9, 16), st.integers(1, 50))
def test_codes_are_canonical_limited_and_reversible(ids, max_bits, every):
    ids = np.array(ids)
    counts = np.bincount(ids, minlength=500)
    lengths = tf.code_lengths(counts, max_bits)
    assert lengths.max() <= max_bits and (lengths > 0).sum() == (counts > 0).sum()
    assert sum(2.0 ** -int(x) for x in lengths if x) <= 1
    bits, checkpoints = tf.pack(ids, tf.canonical_codes(lengths), lengths, every)
    symbol, size = tf.decoding_table(lengths, max_bits)
    assert (tf.unpack(bits, len(ids), checkpoints, every, symbol, size, max_bits) == ids).all()
    half = len(checkpoints) // 2  # a reader may start at any checkpoint
    assert (tf.unpack(bits, len(ids) - half * every, checkpoints[half:], every, symbol, size, max_bits) == ids[half * every :]).all()


def test_lengths_are_optimal_where_the_limit_does_not_bind():
    assert list(tf.code_lengths(np.array([1, 1, 2, 4, 0]), 8)) == [3, 3, 2, 1, 0]
    limited = tf.code_lengths(np.array([1, 1, 2, 4, 8, 16, 32]), 3)
    assert limited.max() == 3 and sum(2.0 ** -int(x) for x in limited) == 1
    with pytest.raises(ValueError, match="more than 2 bits"):
        tf.code_lengths(np.ones(5, int), 2)


def expected(documents):
    encoder = Tokenizer.from_file(PARAMS.tokenizer)
    rows = sorted(((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out, start


def test_files_hold_what_the_library_gives(odd_documents, sample_documents):
    for documents in (odd_documents, sample_documents):
        want, total = expected(documents)
        got = sorted(tf.encode_and_read(documents, PARAMS).collect(), key=lambda r: r.start)
        key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])  # noqa: E731  rows of one id may stand in either order
        assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=key) == sorted(want, key=key)
        assert [r.doc_id for r in got] == [w[0] for w in want]
        assert [r.start for r in got] == list(np.cumsum([0, *[r.n_tokens for r in got]])[:-1]) and got[-1].start + got[-1].n_tokens == total


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aZ é'É.,!?<>|_\x00\t\ńİK½²…—東7ſß-" + "st"), max_size=40), min_size=1, max_size=4))
def test_chunks_give_the_ids_of_whole_texts(texts):
    import pyarrow as pa

    from medallion.llm.words import buffers

    texts = [*texts, "<|endoftext|>, x<|startoftext|>.", "don't it's. 's"]
    cache = tf.worker_cache(PARAMS)
    ids, counts = cache.document_ids(*buffers(pa.array(texts)))
    ends = np.cumsum(counts)
    for text, s, e in zip(texts, ends - counts, ends, strict=True):
        assert list(ids[s:e]) == [*cache.encoder.encode(text, add_special_tokens=False).ids, 1]


def test_empty_table(no_documents):
    assert tf.encode_and_read(no_documents, PARAMS).count() == 0
