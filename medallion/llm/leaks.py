"""Benchmark decontamination by SimHash windows.

Items and documents are cut into words of digits, letters and characters
beyond ASCII (A-Z as a-z), so punctuation and case don't hide a passage, and
words into shingles of five. A shingle weighs ``ln(1 + items / items with
it)``, counted over all items, so wording that many items share counts little.

1. Windows as long as an item are set where one of its shingles stands in a
   document: one that begins with the shingle and one on its diagonal. Any
   other window can be moved right to the next shingle of the item without
   losing one, so the best window of every item is among these.
2. Each window and item gets a 64-bit SimHash of its weighted shingles; a
   shingle that no item holds has no weight in a window.
3. A pair of a window and an item that share a shingle is a candidate unless
   the fingerprints prove it apart. Let the item weigh t and the window u. At
   similarity s they share s t or more, so the window lacks (1 - s) t of the
   item at most and holds u - s t besides. A bit of the item whose sum lies
   further than (1 - s) t + (u - s t) from 0 is then the same in the window,
   so the radius of the pair is the number of its other bits. No pair at s or
   more is lost, whatever the items have in common.
4. Candidates are verified exactly: the weight of the item's shingles that
   stand in the window, over the weight of all its shingles.

Items are the stated query set: they are taken in blocks of bounded size,
each held against all documents. A block gets the counts of its shingles over
all blocks, so similarities don't depend on how the items are cut into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import drop_staged, staged
from medallion.llm.words import Words, buffers, mix, slices, whole_hash, windows, words

_TABLE_BITS = 20
_ENTRIES = 1 << 20


def _separators() -> np.ndarray:
    out = np.zeros(256, bool)
    out[:128] = True
    for lo, hi in ((48, 58), (65, 91), (97, 123)):
        out[lo:hi] = False
    return out


SEPARATOR = _separators()


@dataclass(frozen=True)
class LeakParams:
    """similarity: least weighted share of an item's shingles in a window.
    item_block_bytes: text of the items
    that are held against the documents at a time."""

    shingle: int = 5
    similarity: float = 0.8
    item_block_bytes: int = 8 << 20


def text_words(data: np.ndarray, at: np.ndarray) -> Words:
    return words(data, at, lower=True, space=SEPARATOR)


@dataclass
class ItemIndex:
    """A block of items: ids; the different shingles of each (sorted by hash,
    with item and weight); where windows are set for a shingle (by hash, with
    place in the item and the item's words, once for all items alike); total
    weight, fingerprint and the 64 bit sums' distances from 0 of each item;
    the different word counts of items with fewer words than a shingle."""

    ids: list
    hashes: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    set_hashes: np.ndarray
    set_places: np.ndarray
    set_sizes: np.ndarray
    total: np.ndarray
    prints: np.ndarray
    margins: np.ndarray
    table: np.ndarray
    short_sizes: tuple[int, ...]

    @classmethod
    def build(cls, ids: list, texts: list[str], n_items: int, holders: DataFrame, params: LeakParams) -> ItemIndex:
        """``n_items``: of all blocks; ``holders``: see :func:`shingle_holders`."""
        data, at = buffers(pa.array(texts, pa.large_string()))
        w = text_words(data, at)
        item, start, gram = windows(w, params.shingle, whole_if_short=True)
        place = start - w.first[item]
        order = np.lexsort((place, item, gram))
        item, place, gram = item[order], place[order], gram[order]
        new = np.ones(len(gram), bool)
        new[1:] = (item[1:] != item[:-1]) | (gram[1:] != gram[:-1])
        kinds, kind = np.unique(gram, return_inverse=True)
        weight = np.log1p(n_items / holders_of(kinds, holders)[kind])
        once = np.where(new, weight, 0.0)
        total = np.bincount(item, once, minlength=len(ids))
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[(gram & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)] = True
        by_item = np.argsort(item, kind="stable")
        sums = bit_sums(gram[by_item], once[by_item], np.searchsorted(item[by_item], np.arange(len(ids) + 1)))
        at_set = np.lexsort((w.counts[item], place, gram))
        sets = np.stack([gram.view(np.int64), place, w.counts[item]], 1)[at_set]
        sets = sets[np.concatenate([[True], (sets[1:] != sets[:-1]).any(1)])] if len(sets) else sets
        return cls(
            ids, gram[new], item[new], weight[new], sets[:, 0].copy().view(np.uint64), sets[:, 1], sets[:, 2], total, signs(sums), np.abs(sums), table,
            tuple(np.unique(w.counts[(w.counts > 0) & (w.counts < params.shingle)]).tolist()),
        )


def bit_sums(grams: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run [first[i], first[i + 1]) of weighted shingles and each of 64
    bits, the weight of the shingles with the bit less that of the others."""
    out = np.zeros((len(first) - 1, 64))
    spread = mix(grams)
    for bit in range(64):
        run = np.concatenate([[0.0], np.cumsum(np.where(spread >> np.uint64(bit) & np.uint64(1), weights, -weights))])
        out[:, bit] = run[first[1:]] - run[first[:-1]]
    return out


def signs(sums: np.ndarray) -> np.ndarray:
    """The 64-bit SimHash of each row of bit sums."""
    return ((sums > 0).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)


def near(prints: np.ndarray, held: np.ndarray, item: np.ndarray, index: ItemIndex, similarity: float) -> np.ndarray:
    """Which pairs of a window (fingerprint, weight) and an item lie within
    the radius that follows from their weights, see the module text."""
    out = np.zeros(len(item), bool)
    for lo in range(0, len(item), 1 << 16):
        own = item[lo : lo + (1 << 16)]
        reach = held[lo : lo + (1 << 16)] + (1 - 2 * similarity) * index.total[own] + 1e-6 * (1 + index.total[own])
        radius = (index.margins[own] <= reach[:, None]).sum(1)
        out[lo : lo + (1 << 16)] = np.bitwise_count(prints[lo : lo + (1 << 16)] ^ index.prints[own]) <= radius
    return out


def within(prints: np.ndarray, items: np.ndarray, radius: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """All (window, item) within one radius for all: those near in one of the
    pieces, then by whole distance. Every pair is compared; :func:`leaks`
    compares pairs that share a shingle, each by its own radius."""
    width = 64 // blocks
    pairs = []
    step = max(1, (1 << 22) // max(1, len(items)))
    for lo in range(0, len(prints), step):
        apart = prints[lo : lo + step, None] ^ items[None, :]
        near = np.zeros(apart.shape, bool)
        for k in range(blocks):
            piece = apart >> np.uint64(k * width) & np.uint64((1 << width) - 1)
            near |= np.bitwise_count(piece) <= radius // blocks
        window, item = np.nonzero(near)
        ok = np.bitwise_count(apart[window, item]) <= radius
        pairs.append((window[ok] + lo, item[ok]))
    return (np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])) if pairs else (np.zeros(0, int), np.zeros(0, int))


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def leaks(data: np.ndarray, at: np.ndarray, index: ItemIndex, params: LeakParams) -> Found:
    """(row, item, similarity, first word of the best window) of every leak in the rows."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    if not len(index.hashes):
        return none
    w = text_words(data, at)
    parts = [_window_leaks(w, at, index, params, none), *[_short_leaks(w, size, index) for size in index.short_sizes]]
    rows, candidate, share, begin = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((begin, -share, candidate, rows))
    rows, candidate, share, begin = rows[order], candidate[order], share[order], begin[order]
    best = np.ones(len(rows), bool)
    best[1:] = (rows[1:] != rows[:-1]) | (candidate[1:] != candidate[:-1])
    return rows[best], candidate[best], share[best], begin[best]


def _short_leaks(w: Words, size: int, index: ItemIndex) -> Found:
    """Items of ``size`` words, fewer than a shingle has: wherever these words stand in a row."""
    row, start, gram = windows(w, size, whole_if_short=False)
    gram = whole_hash(gram, size)
    lo = np.searchsorted(index.hashes, gram)
    many = np.searchsorted(index.hashes, gram, side="right") - lo
    hit = np.repeat(np.arange(len(gram)), many)
    entry = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(len(hit))
    return row[hit], index.items[entry], np.ones(len(hit)), start[hit] - w.first[row[hit]]


def _window_leaks(w: Words, at: np.ndarray, index: ItemIndex, params: LeakParams, none: Found) -> Found:
    """Every window that holds enough of an item's shingles."""
    row, start, gram = windows(w, params.shingle, whole_if_short=True)
    maybe = np.flatnonzero(index.table[(gram & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)])
    lo = np.searchsorted(index.set_hashes, gram[maybe])
    hi = np.searchsorted(index.set_hashes, gram[maybe], side="right")
    many = hi - lo
    if not many.sum():
        return none
    hit = np.repeat(maybe, many)
    entry = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(len(hit))
    begin, end = w.first[row[hit]], w.first[row[hit] + 1]
    size = index.set_sizes[entry]
    latest = np.maximum(end - size, begin)
    firsts = [np.clip(start[hit] - index.set_places[entry], begin, latest), np.minimum(start[hit], latest)]
    spans = np.unique(np.concatenate([np.stack([row[hit], f, np.minimum(f + size, end)], 1) for f in firsts]), axis=0)

    gram_row_first = np.searchsorted(row, np.arange(len(at)))
    from_gram = gram_row_first[spans[:, 0]] + spans[:, 1] - w.first[spans[:, 0]]
    n_grams = np.maximum(spans[:, 2] - spans[:, 1] - params.shingle + 1, 1)
    cut = np.concatenate([[0], np.cumsum(n_grams)])
    of = np.repeat(from_gram - cut[:-1], n_grams) + np.arange(cut[-1])
    seen = gram[of]
    span = np.repeat(np.arange(len(spans)), n_grams)
    order = np.lexsort((seen, span))
    seen, span = seen[order], span[order]
    new = np.ones(len(seen), bool)
    new[1:] = (seen[1:] != seen[:-1]) | (span[1:] != span[:-1])
    seen, span = seen[new], span[new]
    lo = np.searchsorted(index.hashes, seen)
    many = np.searchsorted(index.hashes, seen, side="right") - lo
    seen, span, lo, many = seen[many > 0], span[many > 0], lo[many > 0], many[many > 0]
    weight = index.weights[lo]
    first_gram = np.searchsorted(span, np.arange(len(spans) + 1))
    held = np.bincount(span, weight, minlength=len(spans))
    prints = signs(bit_sums(seen, weight, first_gram))
    entries = np.concatenate([[0], np.cumsum(many)])
    parts = [none[:3]]
    a = 0
    while a < len(spans):
        # spans whose shingles have at most so many holders together, one at least
        z = max(a + 1, int(np.searchsorted(entries[first_gram], entries[first_gram[a]] + _ENTRIES, side="right")) - 1)
        g = slice(first_gram[a], first_gram[z])
        entry = np.repeat(lo[g] - (entries[g] - entries[first_gram[a]]), many[g]) + np.arange(entries[first_gram[z]] - entries[first_gram[a]])
        own, of = index.items[entry], np.repeat(span[g], many[g])
        enough = held[of] >= params.similarity * index.total[own] - 1e-6
        entry, own, of = entry[enough], own[enough], of[enough]
        pair, back = np.unique(of * len(index.ids) + own, return_inverse=True)
        window, candidate = pair // len(index.ids), pair % len(index.ids)
        ok = near(prints[window], held[window], candidate, index, params.similarity)
        share = np.bincount(back, index.weights[entry], minlength=len(pair)) / np.maximum(index.total[candidate], 1e-12)
        ok &= share >= params.similarity - 1e-9
        parts.append((window[ok], candidate[ok], share[ok]))
        a = z
    window, candidate, share = (np.concatenate(x) for x in zip(*parts, strict=True))
    return spans[window, 0], candidate, share, spans[window, 1] - w.first[spans[window, 0]]


def shingle_holders(items: DataFrame, params: LeakParams) -> DataFrame:
    """gram (hash), holders: the shingles that two or more of all items hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in slices(batch.column(0)):
                row, _, gram = windows(text_words(data, at), params.shingle, whole_if_short=True)
                order = np.lexsort((gram, row))
                row, gram = row[order], gram[order]
                new = np.ones(len(gram), bool)
                new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(gram[new].view(np.int64))], names=["gram"])

    return items.select("text").mapInArrow(run, "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")


def holders_of(grams: np.ndarray, holders: DataFrame) -> np.ndarray:
    """The holders of each of a block's different shingles (sorted); only the
    counts of these come to the driver."""
    out = np.ones(len(grams), np.int64)
    if not len(grams):
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint64)
            yield batch.filter(pa.array(grams[np.minimum(np.searchsorted(grams, own), len(grams) - 1)] == own))

    found = holders.mapInArrow(run, "gram long, holders long").toArrow()
    out[np.searchsorted(grams, found.column("gram").to_numpy().view(np.uint64))] = found.column("holders").to_numpy()
    return out


def item_blocks(items: DataFrame, id_col: str, params: LeakParams) -> Iterator[ItemIndex]:
    """Indexes of consecutive items; a block closes when its text reaches
    ``item_block_bytes``. Items without an id or text are left out."""
    given = items.where(F.col(id_col).isNotNull() & F.col("text").isNotNull()).select(id_col, "text")
    n_items = given.count()
    if not n_items:
        return
    holders = staged(shingle_holders(given, params), "leaks-holders")
    ids, texts, size = [], [], 0
    for row in given.orderBy(id_col, "text").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1].encode())
        if size >= params.item_block_bytes:
            yield ItemIndex.build(ids, texts, n_items, holders, params)
            ids, texts, size = [], [], 0
    if ids:
        yield ItemIndex.build(ids, texts, n_items, holders, params)
    drop_staged(holders)


def find_leaks(documents: DataFrame, items: DataFrame, id_col: str = "item_id", params: LeakParams | None = None) -> DataFrame:
    """doc_id, item_id, similarity, first_word (of the best window): one row
    per document row and item that it leaks.

    A null or empty text leaks nothing, an item without words is in no
    document, equal items are both reported and repeated rows each. An item
    with fewer words than a shingle is found wherever its words stand in a
    row. Empty tables give no rows; other columns are not read.
    """
    p = params or LeakParams()
    rows = documents.select("doc_id", "text")
    kind, item_kind = rows.schema["doc_id"].dataType.simpleString(), items.schema[id_col].dataType.simpleString()
    item_kind = "long" if item_kind in ("tinyint", "smallint", "int") else item_kind

    def against(index: ItemIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, j, data, at in slices(batch.column(1)):
                    row, item, share, begin = leaks(data, at, index, p)
                    if len(row):
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).slice(i, j - i).take(pa.array(row)), pa.array(index.ids).take(pa.array(item)),
                             pa.array(share), pa.array(begin)], names=["doc_id", "item_id", "similarity", "first_word"],
                        )
        return run

    schema = f"doc_id {kind}, item_id {item_kind}, similarity double, first_word long"
    found = [rows.mapInArrow(against(index), schema) for index in item_blocks(items, id_col, p)]
    if not found:
        return documents.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def drop_leaked(documents: DataFrame, items: DataFrame, id_col: str = "item_id", params: LeakParams | None = None) -> DataFrame:
    """The rows of ``documents`` that leak no item, all columns as they are,
    whatever their names; one pass per block of items, without a shuffle. Null
    and empty texts stay, and so do rows without doc_id that leak nothing;
    repeated rows share their verdict. Without items all rows stay."""
    p = params or LeakParams()
    text = documents.columns.index("text")

    def against(index: ItemIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, j, data, at in slices(batch.column(text)):
                    clean = np.ones(j - i, bool)
                    clean[leaks(data, at, index, p)[0]] = False
                    yield batch.slice(i, j - i).filter(pa.array(clean))
        return run

    for index in item_blocks(items, id_col, p):
        documents = documents.mapInArrow(against(index), documents.schema)
    return documents
