import zlib
from collections import Counter

from pyspark.sql import functions as F

from medallion.llm import sharding


def test_slots_are_gapless_and_sizes_whole(odd_documents):
    rows = sharding.shard_documents(odd_documents, shards=3).collect()
    assert len(rows) == odd_documents.count()
    for shard in range(3):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    texts = {r.doc_id: r.text for r in odd_documents.where("doc_id < 10").collect()}
    for r in rows:
        if r.doc_id in texts:
            raw = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
    assert len({r.shard for r in rows if r.doc_id == 2}) == 1
    assert len({r.shard for r in rows if r.doc_id is None}) == 1


def test_growth_moves_rows_into_the_new_shard_only(sample_documents):
    rows = sharding.shard_documents(sample_documents, shards=24).collect()
    again = {r.doc_id: r.shard for r in sharding.shard_documents(sample_documents, shards=25).collect()}
    assert all(r.grown_shard in (r.shard, 24) and again[r.doc_id] == r.grown_shard for r in rows)
    assert 0 < sum(r.grown_shard == 24 for r in rows) < len(rows) / 8


def test_weights_set_the_shares(llm_spark):
    ids = llm_spark.range(6000).select(F.col("id").alias("doc_id"))
    share = Counter(r.shard for r in sharding.assign(ids, "doc_id", {0: 1.0, 1: 3.0, 2: 0.0}).collect())
    assert share[2] == 0 and 2.6 < share[1] / share[0] < 3.4
    kept = {r.doc_id: r.shard for r in sharding.assign(ids, "doc_id", {0: 1.0, 1: 3.0}).collect()}
    fewer = {r.doc_id: r.shard for r in sharding.assign(ids, "doc_id", {1: 3.0, 5: 1.0}).collect()}
    assert all(fewer[k] in (1, 5) and (v != 1 or fewer[k] in (1, 5)) for k, v in kept.items())


def test_empty_table(no_documents):
    assert sharding.shard_documents(no_documents).count() == 0
