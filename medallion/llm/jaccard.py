"""Near-duplicate documents by an exact Jaccard join of word shingles.

A document's set is its different word shingles. Sets are XOR-hashed into
parity sketches: every shingle flips one place, so equal shingles cancel and
the Hamming distance of two sketches is at most their symmetric difference.

For a threshold t two linked sets of a and b shingles differ in at most
``(1 - t) / (1 + t) * (a + b)`` shingles. Sizes are cut into bands of ratio
1 / t, so a pair lies in one band or in two that adjoin. A band's sketch is
cut into more parts than its largest pair can differ in; by the pigeonhole
principle some part of a linked pair is equal, so joining equal parts finds
every link. Empty parts are equal too often: a band has ``slack`` parts more
than needed, and a set with at most ``slack`` empty parts leaves them out.

A part that many sets share doesn't become all their pairs. Sets equal as a
whole are one node from the start. Nodes that share a part are paired with its
smallest node only, and these pairs are verified. A part of two nodes is done
with that. Of a *crowded* part, one of three or more nodes, the nodes are kept
as its members: what its star may have missed lies between members of
different components, and only these are paired, less those of the part's
largest component among themselves. Then no unverified pair is left that could
link two components. A part that many texts of one batch share is reduced to
its star before the shuffle, and its other members pass by the shuffle in
even shares, so no task gets all of them.

Candidates are verified in three steps: their 512-bit parity sketches, then
finer sketches of four bits a shingle, then the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import components, drop_staged, release, staged
from medallion.llm.words import buffers, mix, slices, windows, words

FOLD_BITS = 512
FOLD_WORDS = FOLD_BITS // 64
SKETCH = [f"s{k}" for k in range(FOLD_WORDS)]
_PART = np.uint64(0xA24BAED4963EE407)
_BAND = np.uint64(0x9FB21C651E98DF25)


@dataclass(frozen=True)
class JaccardParams:
    """shingle: words of a shingle; a text with fewer words is one shingle.
    percent: linked when 100 * intersection >= percent * union.
    shingles_per_bucket: documents' shingles per bucket of the part join.
    common_part: sets of a batch that share a part before its star is made there."""

    shingle: int = 5
    percent: int = 80
    shingles_per_bucket: int = 4_000_000
    common_part: int = 32
    max_size: int = field(default=1 << 40, repr=False)

    def bound(self, total: int | np.ndarray) -> int | np.ndarray:
        """Largest symmetric difference of a linked pair with ``total`` shingles in both."""
        return (100 - self.percent) * total // (100 + self.percent)

    @cached_property
    def bands(self) -> np.ndarray:
        """Largest size of each band; band k starts one above band k - 1."""
        tops, low = [], 1
        while low < self.max_size:
            tops.append(max(low, low * 100 // self.percent))
            low = tops[-1] + 1
        return np.array(tops, np.int64)

    @cached_property
    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of parts, slack) of the band in which the larger set lies."""
        need = self.bound(2 * self.bands) + 1
        smallest = np.maximum(self.bands * self.percent // 100 * self.percent // 100, 1)
        empty = need * np.exp(-smallest / need)
        slack = np.where(need > 1, np.ceil(empty + 4 * np.sqrt(empty)).astype(np.int64), 0)
        return need + slack, slack


@dataclass
class ShingleSets:
    """Different shingles of the rows of a chunk: hashes in order inside each
    row, and where each row begins."""

    first: np.ndarray
    shingles: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.sizes)

    def totals(self, values: np.ndarray) -> np.ndarray:
        run = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=run[1:])
        return run[self.first[1:]] - run[self.first[:-1]]

    def nodes(self) -> np.ndarray:
        """64-bit identity of each set, as a signed number; 0 only when empty."""
        own = mix(self.totals(mix(self.shingles ^ _PART)) + self.sizes.astype(np.uint64))
        own[self.sizes == 0] = 0
        return own.view(np.int64)

    def folded(self) -> np.ndarray:
        """Parity sketch of :data:`FOLD_BITS` bits, as rows of 64-bit words."""
        n = len(self.first) - 1
        at = self.rows() * FOLD_BITS + (self.shingles & np.uint64(FOLD_BITS - 1)).astype(np.int64)
        odd = (np.bincount(at, minlength=n * FOLD_BITS) & 1).astype(np.uint8)
        return np.packbits(odd.reshape(n, FOLD_BITS), axis=1).view(np.int64)


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> ShingleSets:
    w = words(data, at, lower=True)
    row, _, gram = windows(w, size, whole_if_short=True)
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    row, gram = row[new], gram[new]
    return ShingleSets(np.searchsorted(row, np.arange(len(at))), gram)


def part_keys(sets: ShingleSets, params: JaccardParams) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every sketch part by which a row can meet others: its own
    band's, and the next band's if a set of that band can be linked to it."""
    sizes = sets.sizes
    filled = np.flatnonzero(sizes)
    own = np.searchsorted(params.bands, sizes)
    rows, keys = [], []
    for step in (0, 1):
        band = own + step
        take = filled if step == 0 else filled[sizes[filled] * 100 >= params.percent * (params.bands[own[filled]] + 1)]
        if not len(take):
            continue
        count, slack = params.parts[0][band[take]], params.parts[1][band[take]]
        begin = np.concatenate([[0], np.cumsum(count)])
        place = np.full(len(sizes), -1)
        place[take] = np.arange(len(take))
        of = place[sets.rows()]
        mine = of >= 0
        of, gram = of[mine], sets.shingles[mine]
        spread = mix(gram + _BAND * (band[take][of] + 1).astype(np.uint64))
        part = ((spread >> np.uint64(32)) * count[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        flat = begin[of] + part
        sketch = np.zeros(begin[-1], np.uint64)
        np.bitwise_xor.at(sketch, flat, mix(spread))
        full = np.bincount(flat, minlength=begin[-1]) > 0
        row = np.repeat(np.arange(len(take)), count)
        number = np.arange(begin[-1]) - begin[row]
        n_empty = np.bincount(row[~full], minlength=len(take))
        emit = full | (n_empty > slack)[row]
        key = mix(sketch + mix(number.astype(np.uint64) * _PART + (band[take][row] + 1).astype(np.uint64) * _BAND))
        rows.append(take[row[emit]])
        keys.append(key[emit])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(keys)


def members(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different (key, node) in order, as keys, nodes, the smallest node
    of each one's key and how many nodes its key has."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes = keys[new], nodes[new]
    first = np.flatnonzero(np.concatenate([keys[:1] == keys[:1], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(first, len(keys)))
    return keys, nodes, np.repeat(nodes[first], sizes), np.repeat(sizes, sizes)


def fine_sketch(shingles: np.ndarray) -> bytes:
    """Parity sketch of four or more bits a shingle, a power of two in length."""
    bits = max(FOLD_BITS, 1 << int(4 * len(shingles) - 1).bit_length())
    odd = (np.bincount((shingles >> np.uint64(16) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).tobytes()


def fine_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of the two sketches' sets;
    the longer sketch is folded to the length of the shorter."""
    x, y = sorted((np.frombuffer(v, np.uint64) for v in (a, b)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def document_sets(documents: DataFrame, params: JaccardParams) -> DataFrame:
    """doc_id, text_hash, n_shingles, node, the folded sketch s0..s7 and the fine one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in slices(batch.column(2)):
                sets = shingle_sets(data, at, params.shingle)
                folded = sets.folded()
                fine = [fine_sketch(sets.shingles[p:q]) for p, q in zip(sets.first[:-1], sets.first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(sets.sizes), pa.array(sets.nodes()),
                     *[pa.array(np.ascontiguousarray(folded[:, k])) for k in range(FOLD_WORDS)], pa.array(fine, pa.binary())],
                    names=["doc_id", "text_hash", "n_shingles", "node", *SKETCH, "fine"],
                )

    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, text_hash long, n_shingles long, node long, " + ", ".join(f"{s} long" for s in SKETCH) + ", fine binary"
    )


def part_members(documents: DataFrame, buckets: int, params: JaccardParams) -> DataFrame:
    """What nodes that share a sketch part need compared: rows (a, b) of a
    part's smallest node and another one, and rows (key, a) of the members of
    crowded parts. A pair may come more than once."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[], []]
            for _, _, data, at in slices(batch.column(0)):
                sets = shingle_sets(data, at, params.shingle)
                row, key = part_keys(sets, params)
                found[0].append(key)
                found[1].append(sets.nodes()[row])
            if not found[0]:
                continue
            keys, nodes, low, size = members(np.concatenate(found[0]), np.concatenate(found[1]))
            common = size > params.common_part
            away = common & (nodes != low)
            loose = np.stack([keys[away].view(np.int64), nodes[away], low[away]], 1)
            keys, nodes, common = keys[~away], nodes[~away], common[~away]
            of = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cut = np.searchsorted(of, np.arange(buckets + 1))
            shares = np.array_split(loose, buckets)
            used = [k for k in range(buckets) if cut[k] < cut[k + 1] or len(shares[k])]
            blobs = [
                [x[cut[k] : cut[k + 1]].tobytes() for k in used] for x in (keys, nodes)
            ] + [[keys[cut[k] : cut[k + 1]][common[cut[k] : cut[k + 1]]].tobytes() for k in used], [shares[k].tobytes() for k in used]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), *[pa.array(b, pa.binary()) for b in blobs]], names=["bucket", "keys", "nodes", "common", "loose"]
            )

    def join(group: pa.Table) -> pa.Table:
        column = {c: buffers(group.column(c))[0].view(np.int64) for c in ("keys", "nodes", "common", "loose")}
        keys, nodes, low, size = members(column["keys"].view(np.uint64), column["nodes"])
        loose = column["loose"].reshape(-1, 3)
        crowded = (size > 2) | np.isin(keys, column["common"].view(np.uint64))
        other = nodes != low
        pairs = np.unique(np.concatenate([np.stack([low[other], nodes[other]], 1), loose[:, [2, 1]]]), axis=0)
        a = np.concatenate([pairs[:, 0], nodes[crowded], loose[:, 1]])
        key = np.concatenate([keys[crowded].view(np.int64), loose[:, 0]])
        none = len(pairs) + len(key)
        return pa.table({
            "key": pa.array(np.concatenate([np.zeros(len(pairs), np.int64), key]), mask=np.arange(none) < len(pairs)),
            "a": pa.array(a),
            "b": pa.array(np.concatenate([pairs[:, 1], np.zeros(len(key), np.int64)]), mask=np.arange(none) >= len(pairs)),
        })

    packed = documents.select("text").mapInArrow(pack, "bucket int, keys binary, nodes binary, common binary, loose binary")
    return packed.groupBy("bucket").applyInArrow(join, "key long, a long, b long")


def _near(a: str, b: str, params: JaccardParams) -> Column:
    """The folded sketches of two rows don't rule a link out."""
    apart = sum((F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(FOLD_WORDS)), F.lit(0))
    total = F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")
    return apart * (100 + params.percent) <= (100 - params.percent) * total


def node_texts(known: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the wanted classes, from their smallest documents."""
    reps = wanted.select("node", F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    own = known.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__hash"), "text")
    return own.join(reps, ["__id", "__hash"]).dropDuplicates(["__id", "__hash"]).select("node", "text")


def close_pairs(pairs: DataFrame, classes: DataFrame, params: JaccardParams) -> DataFrame:
    """The pairs (a, b) that their fine sketches don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column(2).to_numpy()
            apart = np.array([fine_distance(x, y) for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)], np.int64)
            keep = pa.array(apart <= params.bound(total))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], names=["a", "b"])

    ends = [classes.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("fine").alias(f"fine_{c}")) for c in "ab"]
    both = pairs.select("a", "b").join(ends[0], "a").join(ends[1], "b")
    return both.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("total"), "fine_a", "fine_b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, params: JaccardParams) -> DataFrame:
    """The pairs (a, b) that are linked, by the exact Jaccard similarity of
    their sets. Pairs are dealt into buckets by ``a`` and by a share of ``b``,
    and a node is sent once to each bucket that has pairs of it, so a node of
    many pairs is neither copied once a pair nor met in one task only."""
    n = pairs.count()
    width = max(12, -(-n // 2048))
    bucket = F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), F.lit(64))), F.lit(width)).cast("int")
    dealt = pairs.select("a", "b", bucket.alias("bucket"))
    wanted = dealt.select(F.col("bucket").alias("to"), F.col("a").alias("node")).union(dealt.select("bucket", "b")).distinct()
    sent = wanted.join(texts.select("node", "text"), "node")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        sets: dict[int, np.ndarray] = {}
        nodes = right.column("node").to_numpy()
        for i, _, data, at in slices(right.column("text").combine_chunks()):
            part = shingle_sets(data, at, params.shingle)
            for k in range(len(at) - 1):
                sets[int(nodes[i + k])] = part.shingles[part.first[k] : part.first[k + 1]]
        a, b = left.column("a").to_numpy(), left.column("b").to_numpy()
        ok = np.zeros(len(a), bool)
        for k in range(len(a)):
            x, y = sets[int(a[k])], sets[int(b[k])]
            common = len(np.intersect1d(x, y, assume_unique=True))
            ok[k] = 100 * common >= params.percent * (len(x) + len(y) - common)
        return pa.table({"a": pa.array(a[ok]), "b": pa.array(b[ok])})

    return dealt.groupBy("bucket").cogroup(sent.groupBy("to")).applyInArrow(run, "a long, b long")


def mixed_parts(crowded: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, main, node, component) of the members (key, node) of crowded
    parts that more than one component has; ``main`` is one of the part's
    components with the most members."""
    labelled = staged(_labelled(crowded, parts), "part-members")
    sizes = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("kinds")
    ).where("kinds > 1").select("key", "main")
    return labelled.join(staged(main, "part-mains"), "key")


def cross_pairs(shared: DataFrame, sets: DataFrame, params: JaccardParams) -> DataFrame:
    """(a, b) of different components that share a sketch part and aren't
    ruled out by their sketches (``sets``: node, n_shingles, s0..s7). Members
    of a part's main component meet only members of others, so a large
    component isn't joined with itself."""
    described = staged(shared.join(sets, "node"), "part-sketches")
    x, y = described.where("component <> main").alias("x"), described.alias("y")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component"))
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    return x.join(y, apart & once & _near("x", "y", params)).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    ).distinct()


def _labelled(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """``nodes`` (node, ...) with its component; a node without an edge is its own."""
    named = parts.select(F.col("node").alias("__node"), "component")
    return nodes.join(named, F.col("node") == F.col("__node"), "left").withColumn(
        "component", F.coalesce("component", "node")
    ).drop("__node")


def _classes(filled: DataFrame) -> DataFrame:
    """One row per different set: its smallest document and its sketch."""
    same = ["n_shingles", *SKETCH, "fine"]
    return filled.groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), *[F.first(s).alias(s) for s in same]
    ).select("node", "rep.doc_id", "rep.text_hash", *same)


def _described(pairs: DataFrame, classes: DataFrame, params: JaccardParams) -> DataFrame:
    """Candidate pairs (a, b) and whether their sketches allow a link."""
    a, b = classes.alias("a"), classes.alias("b")
    both = pairs.alias("c").join(a, F.col("c.a") == F.col("a.node")).join(b, F.col("c.b") == F.col("b.node"))
    return both.select("c.a", "c.b", _near("a", "b", params).alias("near"))


def _ends(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes that stand in some pair (a, b)."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    return classes.select("node", "doc_id", "text_hash").join(nodes, "node", "left_semi")


def near_duplicates(documents: DataFrame, params: JaccardParams | None = None) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id; one row per input row.

    ``component_id`` is the smallest doc_id that links reach. A null or empty
    text has no shingle and is linked with nothing; so is a row without
    doc_id, whose component_id is null. Repeated rows are linked if they have
    a word. An empty table gives no rows; other columns are not read.
    """
    p = params or JaccardParams()
    sets = staged(document_sets(documents, p), "shingle-sets")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(12, -(-total // p.shingles_per_bucket))
    spark = documents.sparkSession
    filled = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = staged(_classes(filled), "shingle-classes")
    known = documents.where(F.col("doc_id").isNotNull())
    found = staged(part_members(known, int(buckets), p), "shingle-found")
    release(spark)
    pairs = staged(_described(found.where("key IS NULL").select("a", "b").distinct(), classes, p), "shingle-pairs")
    crowded = found.where("key IS NOT NULL").select("key", F.col("a").alias("node")).distinct()
    close = staged(close_pairs(pairs.where("near"), classes, p), "shingle-close")
    texts = staged(node_texts(known, _ends(close, classes)), "shingle-texts")
    release(spark)
    links = staged(verified(close, texts, p), "shingle-links")
    parts = staged(components(links), "shingle-parts")
    release(spark)
    sketches = classes.select("node", "n_shingles", *SKETCH)
    crossing = cross_pairs(mixed_parts(crowded, parts), sketches, p).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    across = staged(close_pairs(crossing, classes, p), "shingle-across")
    release(spark)
    drop_staged(found, pairs, texts, close)
    if not across.isEmpty():
        texts = staged(node_texts(known, _ends(across, classes)), "shingle-texts")
        more = staged(verified(across, texts, p), "shingle-more")
        parts = staged(components(links.union(more)), "shingle-parts")
        drop_staged(texts, more)
    drop_staged(across, links)
    release(spark)

    ids = _labelled(classes.select("node", "doc_id"), parts)
    smallest = ids.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = ids.join(smallest, "component").select(F.col("node").alias("__node"), "component_id")
    linked = filled.join(named, F.col("node") == F.col("__node")).select("doc_id", "text_hash", "n_shingles", "component_id")
    alone = sets.where("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone)


def keep_one(documents: DataFrame, params: JaccardParams | None = None) -> DataFrame:
    """The rows of ``documents`` with one document of each group left: the one
    with the smallest doc_id. Rows without words (null and empty texts) or
    without doc_id stay; of repeated rows one stays. All columns are as they
    are, whatever their names. An empty table stays empty."""
    row = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in documents.columns])
    carried = documents.select(
        row.alias("row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("\0")).alias("id"), F.xxhash64("text").alias("own")
    )
    found = near_duplicates(documents, params).where("doc_id <=> component_id")
    stay = found.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("\0")).alias("id"), F.col("text_hash").alias("own")).distinct()
    return carried.join(stay, ["id", "own"], "left_semi").dropDuplicates(["id", "own"]).select("row.*")
