"""Token-id files: canonical length-limited Huffman codes of global counts.

1. Texts are tokenized; each document's ids end with an end id.
2. Ids are counted over all documents and code lengths (at most
   ``max_bits``) are found by package-merge; codes are canonical, so the
   lengths are the whole codebook.
3. Documents are dealt in ascending doc_id order and written in blocks of
   about ``block_tokens`` ids, each block a bit string that can be decoded on
   its own, with the bit offset of every ``checkpoint_every``-th id.
4. A reader decodes each block from all its checkpoints at once with a table
   over the next ``max_bits`` bits.

The files are Parquet tables in one folder: ``blocks`` (part, block,
first_token, doc_ids, doc_tokens, checkpoints, bits) and ``codebook`` (id,
bits). Spark's writer commits them, so a lost task leaves no half file.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import staged
from medallion.llm.words import LOWER, SPACE, Words, buffers, runs, slices, span_hashes
from medallion.session import checkpoint_root

END_ID = 1


@dataclass(frozen=True)
class TokenFileParams:
    """tokenizer: path of a tokenizers-library JSON file. by_chunks: encode
    each different chunk (a space-separated word without its closing ASCII
    punctuation, that punctuation, A-Z as a-z) once and join the ids. Only
    for tokenizers that drop white space, fold case and never let a token
    span a letter or digit and an ASCII mark, as word_bpe_49k; then the ids
    are those of the whole text. vocabulary: ids are below it. cache_chunks:
    chunks that a worker remembers."""

    tokenizer: str
    by_chunks: bool = True
    vocabulary: int = 49_408
    end_id: int = END_ID
    max_bits: int = 16
    block_tokens: int = 1 << 20
    checkpoint_every: int = 256
    cache_chunks: int = 2_000_000

    @property
    def id_type(self) -> np.dtype:
        return np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")


_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = ~_ALNUM[33:127]


def chunks(data: np.ndarray, at: np.ndarray) -> Words:
    """The words of the rows, closing ASCII marks after a letter or digit
    apart. Words with ``<`` are whole and keep their case, since they may
    hold the tokenizer's special strings."""
    starts, ends = runs(~SPACE[data], at)
    first = np.searchsorted(starts, at)
    lowered = LOWER[data]
    special = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == ord("<"), out=special[1:])
    held = special[ends] > special[starts]
    for k in np.flatnonzero(held):
        lowered[starts[k] : ends[k]] = data[starts[k] : ends[k]]
    if len(starts):
        body = np.maximum.accumulate(np.where(_MARK[lowered], -1, np.arange(len(data))))[ends - 1] + 1
        cut = (body > starts) & (body < ends) & _ALNUM[lowered[body - 1]] & ~held
        where = np.flatnonzero(cut) + 1
        tails = ends[cut]
        ends[cut] = body[cut]
        starts, ends = np.insert(starts, where, body[cut]), np.insert(ends, where, tails)
        first = first + np.concatenate([[0], np.cumsum(cut)])[first]
    return Words(lowered, starts, ends, first, span_hashes(lowered, starts, ends))


class ChunkCache:
    """Ids of the chunks met so far: hashes in order, and each one's place in
    one array of ids. Forgetting costs time and changes nothing."""

    def __init__(self, params: TokenFileParams):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.params = params
        self.encoder = Tokenizer.from_file(params.tokenizer)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.array([self.params.end_id], self.params.id_type)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    def places(self, w: Words) -> np.ndarray:
        """Index into start / length of each chunk, new ones encoded first."""
        different, at, back = np.unique(w.hashes, return_index=True, return_inverse=True)
        if len(self.known) > self.params.cache_chunks:
            self.clear()
        place = np.searchsorted(self.known, different)
        new = place == len(self.known)
        new[~new] = self.known[place[~new]] != different[~new]
        if new.any():
            raw, spans = w.data.tobytes(), at[new]
            found = self.encode([raw[s:e].decode("utf-8", "replace") for s, e in zip(w.starts[spans], w.ends[spans], strict=True)])
            length = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), self.params.id_type, int(length.sum()))
            first = len(self.ids) + np.cumsum(length) - length
            self.ids = np.concatenate([self.ids, flat])
            into = place[new]
            self.known = np.insert(self.known, into, different[new])
            self.start = np.insert(self.start, into, first)
            self.length = np.insert(self.length, into, length)
            place = place + np.cumsum(new) - new
        return place[back]

    def document_ids(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, ids per row), ends included."""
        if not self.params.by_chunks:
            raw = data.tobytes()
            found = self.encode([raw[s:e].decode("utf-8", "replace") for s, e in zip(at[:-1], at[1:], strict=True)])
            counts = np.fromiter((len(x) + 1 for x in found), np.int64, len(found))
            return np.array([y for x in found for y in [*x, self.params.end_id]], self.params.id_type), counts
        w = chunks(data, at)
        place = self.places(w)
        start = np.insert(self.start[place], w.first[1:], 0)
        length = np.insert(self.length[place], w.first[1:], 1)
        out_at = np.concatenate([[0], np.cumsum(length)])
        ids = self.ids[np.repeat(start - out_at[:-1], length) + np.arange(out_at[-1])]
        ends = out_at[w.first + np.arange(len(at))]
        return ids, np.diff(ends)


_CACHES: dict[TokenFileParams, ChunkCache] = {}


def worker_cache(params: TokenFileParams) -> ChunkCache:
    """One cache per Python worker, kept for its next task."""
    if params not in _CACHES:
        _CACHES.clear()
        _CACHES[params] = ChunkCache(params)
    return _CACHES[params]


def tokenize(documents: DataFrame, params: TokenFileParams) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(params)
        for batch in batches:
            for i, j, data, at in slices(batch.column(1)):
                ids, counts = cache.document_ids(data, at)
                ends = np.concatenate([[0], np.cumsum(counts)]) * params.id_type.itemsize
                column = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(ends), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(counts), column.cast(pa.binary())], names=["doc_id", "n_tokens", "ids"]
                )

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary")


def count_ids(tokens: DataFrame, params: TokenFileParams) -> np.ndarray:
    """Occurrences of each id in all documents; at most ``vocabulary`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(params.vocabulary, np.int64)
        for batch in batches:
            total += np.bincount(buffers(batch.column(0))[0].view(params.id_type), minlength=params.vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])

    total = np.zeros(params.vocabulary, np.int64)
    for row in tokens.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        total[row["id"]] = row["n"]
    return total


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge); 0 for
    ids that never occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need codes of more than {max_bits} bits")
    if n <= 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order]
    level, single = coins, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([coins, pairs])
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        single.append(rank < n)
    take, own = 2 * n - 2, np.zeros(n, np.uint8)
    for flags in reversed(single):
        k = int(flags[:take].sum())
        own[:k] += 1
        take = 2 * (take - k)
    lengths[order] = own
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id), each one more than the last, shifted to its length."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for symbol in order:
        code <<= int(lengths[symbol]) - before
        before = int(lengths[symbol])
        codes[symbol] = code
        code += 1
    return codes


def decoding_table(lengths: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For every value of the next ``max_bits`` bits: the id and its length."""
    codes = canonical_codes(lengths)
    symbol, size = np.zeros(1 << max_bits, np.uint32), np.ones(1 << max_bits, np.uint8)
    for s in np.flatnonzero(lengths):
        free = max_bits - int(lengths[s])
        lo = int(codes[s]) << free
        symbol[lo : lo + (1 << free)] = s
        size[lo : lo + (1 << free)] = lengths[s]
    return symbol, size


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
    """(bit string, bit offset of every ``every``-th id). Codes that share a
    64-bit word have no bit in common, so a word is the sum of its parts."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    begin = ends - size
    word, left = begin >> 6, 64 - (begin & 63) - size
    code = codes[ids]
    whole = np.where(left >= 0, code << np.maximum(left, 0).astype(np.uint64), code >> np.maximum(-left, 0).astype(np.uint64))
    out = np.zeros(int(ends[-1] >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out[word[first]] = np.add.reduceat(whole, first)
    over = np.flatnonzero(left < 0)
    out[word[over] + 1] += code[over] << (64 + left[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: int(ends[-1] + 7) // 8], begin[::every]


def unpack(bits: bytes, n: int, checkpoints: np.ndarray, every: int, symbol: np.ndarray, size: np.ndarray, max_bits: int) -> np.ndarray:
    """The ``n`` ids of a block, one id from every checkpoint at a time."""
    if max_bits > 24:
        raise ValueError("the table looks at 24 bits at most")
    raw = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
    window = (raw[:-3] << np.uint32(24)) | (raw[1:-2] << np.uint32(16)) | (raw[2:-1] << np.uint32(8)) | raw[3:]
    out = np.zeros((len(checkpoints), every), np.uint32)
    at = checkpoints.astype(np.int64).copy()
    drop, mask = np.uint32(32 - max_bits), np.uint32((1 << max_bits) - 1)
    last = len(window) - 1
    for k in range(every):
        seen = (window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32) >> drop) & mask
        out[:, k] = symbol[seen]
        at += size[seen]
    return out.ravel()[:n]


def write_token_files(tokens: DataFrame, path: str, params: TokenFileParams) -> None:
    """Write staged :func:`tokenize` rows below ``path`` in ascending doc_id order."""
    spark = tokens.sparkSession
    lengths = code_lengths(count_ids(tokens, params), params.max_bits)
    codes = canonical_codes(lengths)
    book = [(int(s), int(lengths[s])) for s in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, first = TaskContext.get().partitionId(), 0, 0
        kept: list[tuple] = []
        held = 0

        def block_row() -> pa.RecordBatch:
            ids = np.concatenate([np.frombuffer(x[2], params.id_type) for x in kept])
            bits, checkpoints = pack(ids, codes, lengths, params.checkpoint_every)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([[x[0] for x in kept]], pa.list_(kind)), pa.array([[x[1] for x in kept]], pa.list_(pa.int64())),
                 pa.array([checkpoints], pa.list_(pa.int64())), pa.array([bits], pa.binary())],
                names=["part", "block", "first_token", "doc_ids", "doc_tokens", "checkpoints", "bits"],
            )

        for batch in batches:
            kind = batch.schema.field(0).type
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                kept.append((row[0], row[1], row[2].as_buffer()))
                held += row[1]
                if held >= params.block_tokens:
                    yield block_row()
                    block, first, held = block + 1, first + held, 0
                    kept.clear()
        if kept:
            yield block_row()

    key = tokens.schema["doc_id"].dataType.simpleString()
    ordered = (
        tokens.withColumn("__row", F.monotonically_increasing_id())
        .repartitionByRange(F.col("doc_id"), F.col("__row")).sortWithinPartitions("doc_id", "__row")
    )
    ordered.select("doc_id", "n_tokens", "ids").mapInArrow(
        blocks,
        f"part int, block int, first_token long, doc_ids array<{key}>, doc_tokens array<long>, checkpoints array<long>, bits binary",
    ).write.option("compression", "none").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, params: TokenFileParams) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    book = spark.read.parquet(f"{path}/codebook").collect()
    lengths = np.zeros(params.vocabulary, np.uint8)
    for row in book:
        lengths[row["id"]] = row["bits"]
    symbol, size = decoding_table(lengths, params.max_bits)
    files = spark.read.parquet(f"{path}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                counts = np.asarray(batch.column(3)[k].values, np.int64)
                checkpoints = np.asarray(batch.column(4)[k].values, np.int64)
                ids = unpack(
                    batch.column(5)[k].as_py(), int(counts.sum()), checkpoints, params.checkpoint_every, symbol, size, params.max_bits
                ).astype("<u4")
                ends = np.cumsum(counts)
                begin = ends - counts
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(begin, ends, strict=True)]
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column(0)[k].as_py(), np.int32)), batch.column(2)[k].values,
                     pa.array(batch.column(1)[k].as_py() + begin), pa.array(counts), pa.array(crc, pa.int64())],
                    names=["part", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    rows = files.select("part", "first_token", "doc_ids", "doc_tokens", "checkpoints", "bits").mapInArrow(
        run, f"part int, doc_id {kind}, place long, n_tokens long, ids_crc32 long"
    )
    totals = files.groupBy("part").agg(F.sum(F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("__part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    return rows.join(offsets, F.col("part") == F.col("__part")).select(
        "doc_id", (F.col("__before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_and_read(documents: DataFrame, params: TokenFileParams) -> DataFrame:
    """Tokenize, write the files, and describe every document as read back.

    A null or empty text is the end id alone. Null doc_ids come first; rows
    of equal doc_id keep the order of the staged table and each is written.
    An empty table gives no rows; other columns are not read.
    """
    spark = documents.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/tokens-{uuid.uuid4().hex[:12]}"
    write_token_files(staged(tokenize(documents, params), "token-ids"), path, params)
    return read_token_files(spark, path, params)
