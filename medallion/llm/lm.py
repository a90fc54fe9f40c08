r"""Log-probabilities of texts from a weighted backoff automaton.

The model is one of n-grams up to ``order`` over the words of the training
texts. Words that occur there less than ``core_min`` times are one class, whose
words share its probability in proportion to their unigram probability; by
default there are none. With counts c, N
training tokens, V different ones, and h' for a history h without its first
token:

    P(w)      = (c(w) + 0.5) / (N + 0.5 (V + 1))
    P(k | h)  = (c(h k) + mu P(k | h')) / (c(h) + mu)  k: a word or the class
    P(w | h)  = P(k | h), times P(w) / P(class) for a word of the class

As an automaton every history of one to ``order`` - 1 tokens that training
texts have is a state, and every k seen after it an arc. Where there is none,
a failure arc of weight mu / (c(h) + mu) leads to the state of h' (from one
token to the root, which holds P(k)), and so on. A text starts in the state of
the end token, and its end is a token too. One pass from left to right carries
the state: the arc that a token takes in the state of h says how often h k
stands in training texts, which is the count of the state it leads to.

Texts are kept in blocks of tokens. Counts never need the whole vocabulary
in one place: a block sends its different words (later: its different pairs,
then longer n-grams), cut by hash, to the buckets that add up their counts over
all blocks, and gets the totals back. The totals of each length are a table in
the shared folder, so the shuffle files of one exchange can go before the next. A word that fills a third of the corpus costs one
number per block. Buckets grow in number with what the blocks send.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import fold, release, staged
from medallion.llm.words import mix, slices, words

FOLDS = 5
HELD_OUT = 1
END = np.uint64(0x5851F42D4C957F2D)
OTHERS = np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class LmParams:
    """order: tokens of the longest n-grams, 2 or more. core_min: training
    occurrences from which a word is a state and an arc of its own (0: every
    word, whose n-grams are then counted without a join). mu: weight
    of the shorter history in every state. block_tokens: tokens of a block (one
    longer text is a block of its own). entries_per_bucket: words or n-grams
    that the blocks send to a bucket, about."""

    order: int = 3
    core_min: int = 0
    mu: float = 50.0
    block_tokens: int = 1_500_000
    entries_per_bucket: int = 1_000_000


def pack(values: np.ndarray) -> bytes:
    """An unsigned array as zstd of its byte planes, which keeps small numbers small."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpack(data: bytes, n: int, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data, n * kind.itemsize, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Rising 64-bit keys as their steps."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, "u8"), dtype=np.uint64)


def by_use(uses: np.ndarray) -> np.ndarray:
    """The places of a block's keys, most used first: tokens are stored as
    ranks in this order, which are small numbers."""
    return np.argsort(-uses.astype(np.int64), kind="stable").astype(np.uint32)


def token_blocks(documents: DataFrame, params: LmParams) -> DataFrame:
    """Blocks of tokenized texts.

    block, doc_ids, held (per text), lengths (tokens with the end), n_tokens,
    n_keys, and packed: keys (different token hashes in order), uses and
    counts (their occurrences, and those in training texts), tokens (rank of
    every token's key by use).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        kept: list[tuple] = []
        size = 0

        def row() -> pa.RecordBatch:
            hashes = np.concatenate([x[3] for x in kept])
            lengths, held = np.concatenate([x[2] for x in kept]), np.concatenate([x[1] for x in kept])
            ids = pa.concat_arrays([x[0] for x in kept])
            keys, place = np.unique(hashes, return_inverse=True)
            counts = np.bincount(place[~np.repeat(held, lengths)], minlength=len(keys)).astype(np.uint32)
            uses = np.bincount(place, minlength=len(keys)).astype(np.uint32)
            rank = np.empty(len(keys), np.uint32)
            rank[by_use(uses)] = np.arange(len(keys))
            packed = [pack_sorted(keys), pack(uses), pack(counts), pack(rank[place])]
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([held.tolist()], pa.list_(pa.bool_())), pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([len(hashes)], pa.int64()), pa.array([len(keys)], pa.int64()), *[pa.array([x], pa.binary()) for x in packed]],
                names=["block", "doc_ids", "held", "lengths", "n_tokens", "n_keys", "keys", "uses", "counts", "tokens"],
            )

        for batch in batches:
            held_out = np.asarray(batch.column(1)) == HELD_OUT
            for i, j, data, at in slices(batch.column(2)):
                w = words(data, at, lower=True)
                hashes = np.insert(w.hashes, w.first[1:], END)
                kept.append((batch.column(0).slice(i, j - i), held_out[i:j], w.counts + 1, hashes))
                size += len(hashes)
                if size >= params.block_tokens:
                    yield row()
                    block, size = block + 1, 0
                    kept.clear()
        if kept:
            yield row()

    rows = documents.select("doc_id", fold(F.col("doc_id"), FOLDS).alias("fold"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"block long, doc_ids array<{kind}>, held array<boolean>, lengths array<long>, n_tokens long, "
        "n_keys long, keys binary, uses binary, counts binary, tokens binary",
    )


def _buckets(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins in sorted keys: a bucket is a range of hashes."""
    tops = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, tops), [len(keys)]])


def _sent(block: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    cut = _buckets(keys, bits)
    used = [k for k in range(1 << bits) if cut[k] < cut[k + 1]]
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(np.full(len(used), block)),
         pa.array([cut[k + 1] - cut[k] for k in used], pa.int64()),
         pa.array([pack_sorted(keys[cut[k] : cut[k + 1]]) for k in used], pa.binary()),
         pa.array([pack(counts[cut[k] : cut[k + 1]].astype(np.uint32)) for k in used], pa.binary())],
        names=["bucket", "block", "size", "keys", "counts"],
    )


_SENT = "bucket int, block long, size long, keys binary, counts binary"
_TOTALS = "block long, bucket int, totals binary, n long, v long, rare_n long, rare_v long"


def add_counts(sent: DataFrame, core_min: int) -> DataFrame:
    """The totals of what the blocks sent: for every (block, bucket) the
    counts over all blocks in the order sent. On one row of each bucket: n
    and v, its count and its different keys with a count, and rare_n and
    rare_v, the same of keys below ``core_min`` (but the end)."""

    def add(group: pa.Table) -> pa.Table:
        size = group.column("size").to_pylist()
        sent_keys = [unpack_sorted(d, k) for d, k in zip(group.column("keys").to_pylist(), size, strict=True)]
        counts = [unpack(d, k, "u4") for d, k in zip(group.column("counts").to_pylist(), size, strict=True)]
        keys, back = np.unique(np.concatenate(sent_keys), return_inverse=True)
        totals = np.bincount(back, np.concatenate(counts), minlength=len(keys)).astype(np.int64)
        cut = np.concatenate([[0], np.cumsum(size)])
        rare = (totals < core_min) & (keys != END)
        sums = np.zeros((4, group.num_rows), np.int64)
        sums[:, 0] = totals.sum(), (totals > 0).sum(), totals[rare].sum(), (totals[rare] > 0).sum()
        own = totals[back]
        return pa.table({
            "block": group.column("block"), "bucket": group.column("bucket"),
            "totals": pa.array([pack(own[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
            **{name: pa.array(s) for name, s in zip(("n", "v", "rare_n", "rare_v"), sums, strict=True)},
        })

    return sent.groupBy("bucket").applyInArrow(add, _TOTALS)


def _bits(entries: int, per_bucket: int) -> int:
    return max(4, int(np.ceil(np.log2(max(1, entries / per_bucket)))))


def send_words(blocks: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, n, keys, counts = (batch.column(c)[k].as_py() for c in range(4))
                yield _sent(block, unpack_sorted(keys, n), unpack(counts, n, "u4"), bits)

    return blocks.select("block", "n_keys", "keys", "counts").mapInArrow(run, _SENT)


@dataclass
class BlockTexts:
    """One block with the totals of its words (0 where they are not given)."""

    ids: pa.Array
    held: np.ndarray
    lengths: np.ndarray
    tokens: np.ndarray
    totals: np.ndarray
    keys: np.ndarray

    @classmethod
    def read(cls, block: pa.Table, totals: pa.Table | None, bits: int) -> BlockTexts:
        one = {c: block.column(c)[0] for c in block.column_names}
        n = one["n_keys"].as_py()
        keys = unpack_sorted(one["keys"].as_py(), n)
        tokens = by_use(unpack(one["uses"].as_py(), n, "u4"))[unpack(one["tokens"].as_py(), one["n_tokens"].as_py(), "u4")]
        ids = one["doc_ids"].values if "doc_ids" in one else pa.nulls(0)
        counted = np.zeros(n, np.int64) if totals is None else gathered(totals, keys, bits)
        return cls(ids, np.asarray(one["held"].values), np.asarray(one["lengths"].values), tokens, counted, keys)

    def classes(self, core_min: int) -> tuple[np.ndarray, np.ndarray]:
        """(class of every token, hash of every class): words from ``core_min``
        in the order of their hashes, and the class of all others last."""
        core = (self.totals >= core_min) | (self.keys == END)
        number = np.full(len(self.keys), core.sum(), np.int32)
        number[core] = np.arange(core.sum(), dtype=np.int32)
        return number[self.tokens], np.append(self.keys[core], OTHERS)

    def pairs(self, core_min: int) -> tuple[np.ndarray, np.ndarray]:
        """(class of the token before, class) of every token; the end comes before a first token."""
        own, hashes = self.classes(core_min)
        end = int(np.searchsorted(hashes[:-1], END))
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = end
        return before, own

    def gram_keys(self, order: int, core_min: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For n-grams of two tokens up to ``order``: (their different hashes
        in order, place in them of the n-gram that ends with every token, -1
        where fewer tokens stand before it)."""
        hashes = self.classes(core_min)[1]
        before, own = self.pairs(core_min)
        first = np.cumsum(self.lengths) - self.lengths
        keys = hashes
        for _ in range(order - 1):
            whole = before >= 0
            local, back = np.unique(before[whole].astype(np.int64) * len(hashes) + own[whole], return_inverse=True)
            grams = mix(keys[local // len(hashes)] * _PAIR + hashes[local % len(hashes)])
            by_hash = np.argsort(grams)
            rank = np.empty(len(by_hash), np.int32)
            rank[by_hash] = np.arange(len(by_hash), dtype=np.int32)
            keys, place = grams[by_hash], np.full(len(own), -1, np.int32)
            place[whole] = rank[back]
            del whole, local, back, grams, by_hash, rank  # a suspended generator would keep them
            yield keys, place
            before[1:] = place[:-1]
            before[first] = -1


def gathered(totals: pa.Table, keys: np.ndarray, bits: int) -> np.ndarray:
    """The totals of a block's keys, from its rows of all buckets."""
    cut = _buckets(keys, bits)
    out = np.zeros(len(keys), np.int64)
    for bucket, data in zip(totals.column("bucket").to_pylist(), totals.column("totals").to_pylist(), strict=True):
        out[cut[bucket] : cut[bucket + 1]] = unpack(data, int(cut[bucket + 1] - cut[bucket]), "i8")
    return out


def send_grams(blocks: DataFrame, totals: DataFrame, order: int, bits: int, gram_bits: int, params: LmParams) -> DataFrame:
    """What the blocks send of their n-grams of ``order`` tokens. Where every
    word is a state the blocks stay where they are; else they are joined with
    the totals of their words, which tell the class of each."""
    def sent(block: pa.Table, own: pa.Table | None) -> pa.RecordBatch:
        texts = BlockTexts.read(block, own, bits)
        *_, (keys, place) = texts.gram_keys(order, params.core_min)
        place = place[~np.repeat(texts.held, texts.lengths)]
        counts = np.bincount(place[place >= 0], minlength=len(keys))
        return _sent(block.column("block")[0].as_py(), keys, counts, gram_bits)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield sent(pa.Table.from_batches([batch.slice(k, 1)]), None)

    def joined(block: pa.Table, own: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.Table.from_batches([_sent(0, np.zeros(0, np.uint64), np.zeros(0), gram_bits)])
        return pa.Table.from_batches([sent(block, own)])

    needed = blocks.select("block", "held", "lengths", "n_tokens", "n_keys", "keys", "uses", "tokens")
    if params.core_min <= 0:
        return needed.mapInArrow(alone, _SENT)
    return needed.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(joined, _SENT)


def traverse(
    texts: BlockTexts, gram_totals: list[Callable[[np.ndarray], np.ndarray]], n: int, v: int, others: tuple[int, int], params: LmParams,
) -> dict[str, np.ndarray]:
    """Scores of the block's texts. ``gram_totals``: for each length from two,
    the totals of n-grams by their keys. ``others``: training occurrences and
    different words of the class below ``core_min``."""
    norm = n + 0.5 * (v + 1)
    root_word = (texts.totals + 0.5) / norm
    core = (texts.totals >= params.core_min) | (texts.keys == END)
    # the class also holds the one unknown word that the base counts
    root_others = (others[0] + 0.5 * (others[1] + 1)) / norm
    root = np.append(root_word[core], root_others)
    before, own = texts.pairs(params.core_min)
    state = np.append(texts.totals[core], others[0]).astype(float)[before]
    del before
    step = root[own]
    first = np.cumsum(texts.lengths) - texts.lengths
    for (keys, place), totals_of in zip(texts.gram_keys(params.order, params.core_min), gram_totals, strict=True):
        arc = np.append(totals_of(keys), 0)[place].astype(float)
        whole = place >= 0
        step[whole] = ((arc + params.mu * step) / (state + params.mu))[whole]
        state[1:] = arc[:-1]
        state[first] = 0
    base = np.log10(root_word)[texts.tokens]
    step = np.log10(step)
    rare = own == len(root) - 1
    step[rare] += base[rare] - np.log10(root_others)
    known = (texts.totals > 0)[texts.tokens]
    return {
        "n_known": np.add.reduceat(known.astype(np.int64), first), "base_score": np.add.reduceat(base, first),
        "score": np.add.reduceat(step, first),
    }


def score_texts(documents: DataFrame, params: LmParams | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score;
    one row per input row.

    Scores are base-10 logarithms of the text's probability with its end. A
    null or empty text is its end alone. Repeated rows are counted and scored
    each. Without training texts all counts are 0 and every token has
    probability 1. An empty table gives no rows; other columns are not read.
    """
    p = params or LmParams()
    spark = documents.sparkSession
    blocks = staged(token_blocks(documents, p), "lm-blocks")
    entries = blocks.agg(F.sum("n_keys"), F.sum("n_tokens")).first()
    bits = _bits(entries[0] or 0, p.entries_per_bucket)
    gram_bits = _bits((entries[1] or 0) // 2, p.entries_per_bucket)
    totals = staged(add_counts(send_words(blocks, bits), p.core_min), "lm-words")
    sums = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "rare_n", "rare_v")]).first()
    n, v, others = sums["n"], sums["v"], (sums["rare_n"], sums["rare_v"])
    words_back = totals.select("block", F.lit(1).alias("length"), "bucket", "totals")
    back = words_back
    for length in range(2, p.order + 1):
        sent = send_grams(blocks, words_back, length, bits, gram_bits, p)
        counted = staged(add_counts(sent, p.core_min).select("block", F.lit(length).alias("length"), "bucket", "totals"), f"lm-{length}-grams")
        back = back.unionByName(counted)
        del sent
        release(spark)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(block: pa.Table, own: pa.Table) -> pa.Table:
        lengths = np.asarray(own.column("length"))

        def of(length: int) -> pa.Table:
            return own.filter(pa.array(lengths == length))

        texts = BlockTexts.read(block, of(1), bits)
        grams = [lambda keys, k=k: gathered(of(k), keys, gram_bits) for k in range(2, p.order + 1)]
        found = traverse(texts, grams, n, v, others, p)
        return pa.table({
            "doc_id": texts.ids, "held_out": pa.array(texts.held), "n_tokens": pa.array(texts.lengths),
            "n_known": pa.array(found["n_known"]), "train_tokens": pa.array(np.full(len(texts.held), n, np.int64)),
            "base_score": pa.array(found["base_score"]), "score": pa.array(found["score"]),
        })

    return blocks.drop("counts").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
