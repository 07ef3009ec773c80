"""N-gram Jaccard join: all texts within Jaccard distance EPS of each other, counted and as connected groups.

1 - |x & y| / |x | y| is a metric on shingle sets, so regions around pivots can be joined one by one:

* **Level 0, single shingles as pivots.** Unrelated texts all lie at distance 1, so pivots that are documents
  cannot part a corpus. Pivots of one shingle can. With any fixed order on shingles a text lies nearest to its
  first shingle, and a text within EPS of x lacks at most n // 5 of the n shingles of x (the triangle inequality
  for the symmetric difference). So the window of x spans its first n // 5 + 1 shingles, and two linked texts share
  one of these regions. The order puts shingles that few documents hold first; counts over the whole corpus,
  kept in a table of fixed size, decide. Any order is exact; this one keeps regions of common passages empty.
  Texts of a region whose sizes are too far apart are not tied.
* Regions that overlap are fused (components of the candidate graph), so a text travels once. The larger a corpus, the more
  texts share a rare shingle by chance, until one component holds them all. What is fused is therefore parted again by
  regions of pairs of neighbours in the order: if y lacks a shingles of x and has b others, 5 a + 4 b <= n, and at most
  2 a + b <= 2 n / 5 pairs of x are no pairs of y (a shingle that y lacks ends two, one between ends one). So linked texts
  share one of their first 2 n // 5 + 1 pairs. Linked texts lie in one component of either kind; a **cell** is what two
  such components have in common.
* **Below, documents as pivots.** A cell is split into Voronoi regions; x also enters the region of a later
  pivot q if d(x, q) - d(x, home) <= 2 EPS, which holds for every x within EPS of a text at home there. Regions
  are joined in the same way until they are small, then pair by pair. A pair belongs to the region in which its later
  member is at home, so every link is counted once. Without counts, texts that are already connected are skipped.
  A cell beyond ``max_elements`` is split this way by Spark first; one that does not shrink, told before anything is written,
  and one whose members and shingles make too much work for a task, is dealt into blocks, each pair of which is a cell. In
  memory, members whose regions would hold as many pairs as they do are compared at once. No text, region or link is dropped.

Equal sets are one node from the start: a node is a 64-bit fingerprint of the set, so copies meet inside tasks.
A link of two nodes counts as many links of documents as there are pairs of their copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from goldrec.llm import words
from goldrec.llm.common import BROADCAST_LIMIT, FOREST, connected_components, contract, forest_components, slices
from goldrec.session import stage

#: Texts link when PART * intersection >= SHARE * union.
PART, SHARE = 100, 80
EPS = 1 - SHARE / PART
U = np.uint64
#: Sizes are compared in steps of 1.25 ** (1 / SIZE_STEPS); linked sets lie at most one factor of 1.25 apart.
SIZE_BITS, SIZE_STEPS = 12, 8
#: Counters of the shingle table, and the row groups it is merged in.
SLOT_BITS, PART_BITS = 25, 6
#: Shingles a cell may hold to be joined in one task.
MAX_ELEMENTS = 4_000_000
#: Members times shingles of a cell to be joined in one task.
MAX_WORK = 1_600_000_000
PIVOTS = 8
#: How much more than a cell the regions of its pivots may hold together.
GROWTH = 1.5


def set_nodes(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Fingerprint of each set: two sums of mixed members, mixed together with the size."""
    total = np.concatenate(([U(0)], np.cumsum(words.mix(hashes))))
    other = np.concatenate(([U(0)], np.cumsum(words.mix(hashes ^ U(0x5851F42D4C957F2D)))))
    low, high = bounds[:-1], bounds[1:]
    node = words.mix(total[high] - total[low]) + words.mix((other[high] - other[low]) ^ (high - low).astype(U))
    return words.mix(node).view(np.int64)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and node of each text (the last column), behind the other columns."""
    for batch in batches:
        *others, text = batch.columns
        for low, high, data, off in slices(text):
            bounds, hashes = words.shingle_sets(data, off)
            yield pa.record_batch([*(c.slice(low, high - low) for c in others), np.diff(bounds), set_nodes(bounds, hashes)], [*batch.schema.names[:-1], "n", "node"])


def _encode(slots: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Sorted slots as (part, width, differences)."""
    slots.sort()
    shift = SLOT_BITS - PART_BITS
    edges = np.searchsorted(slots, np.arange((1 << PART_BITS) + 1) << shift)
    for part in range(1 << PART_BITS):
        own = slots[edges[part] : edges[part + 1]] - (part << shift)
        if len(own):
            steps = np.diff(own, prepend=0)
            width = 1 if steps.max() < 256 else 2 if steps.max() < 65536 else 4
            yield part, width, steps.astype(f"u{width}").tobytes()


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush():
        rows = list(_encode(np.concatenate(held)))
        return pa.record_batch([[r[0] for r in rows], [r[1] for r in rows], pa.array([r[2] for r in rows], pa.binary())], ["part", "width", "steps"])

    for batch in batches:
        for _, _, data, off in slices(batch.column(0)):
            h = words.shingle_sets(data, off)[1]
            held.append((h & U((1 << SLOT_BITS) - 1)).astype(np.int64))
            size += len(h)
            if size >= 3_000_000:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, width, steps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part not in counts:
                counts[part] = np.zeros(1 << (SLOT_BITS - PART_BITS), np.int64)
            at = np.cumsum(np.frombuffer(steps, f"u{width}").astype(np.int64))
            counts[part] += np.bincount(at, minlength=len(counts[part]))
    for part, c in counts.items():
        level = np.minimum(255, 8 * np.log2(np.maximum(c, 1))).astype(np.uint8)
        yield pa.record_batch([[part], pa.array([level.tobytes()], pa.binary())], ["part", "level"])


def shingle_levels(docs: DataFrame) -> np.ndarray:
    """How common each shingle slot is over all documents, in eighths of an octave; 2**SLOT_BITS bytes at any input size."""
    rows = (
        docs.select("text").mapInArrow(_slots, "part long, width long, steps binary")
        .repartition(1 << (PART_BITS - 1), "part").mapInArrow(_levels, "part long, level binary")
    )
    table = np.zeros(1 << SLOT_BITS, np.uint8)
    size = 1 << (SLOT_BITS - PART_BITS)
    for r in rows.toLocalIterator():
        table[r.part * size : (r.part + 1) * size] = np.frombuffer(r.level, np.uint8)
    return table


def _star(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a row of sorted keys is the first of its run, and where that first row is."""
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    return first, np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))


def _windows(levels, wanted=None):
    """Rows (key, node): a text enters the region of each shingle in its window. A key is the shingle and the size class.

    With a filter of nodes, its texts enter the regions of pairs of neighbours in the order instead: the first 2 n / 5 + 1 pairs.
    Of the texts of one batch in one region and class only the first is sent on; the others are tied to it by a region of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        bits = None if wanted is None else wanted.value
        for batch in batches:
            keys, nodes = [], []
            for _, _, data, off in slices(batch.column(0)):
                bounds, hashes = words.shingle_sets(data, off)
                sizes = np.diff(bounds)
                node = set_nodes(bounds, hashes)
                row = np.repeat(np.arange(len(sizes)), sizes)
                level = table[hashes & U((1 << SLOT_BITS) - 1)].astype(U)
                order = np.argsort((row.astype(U) << U(HASH_ROW)) | (level << U(HASH_ROW - 8)) | (words.mix(hashes) >> U(72 - HASH_ROW)))
                rank = np.arange(len(row)) - bounds[:-1][row]
                # the order keeps the rows in place, so what stands at a position belongs to the row of that position
                if bits is None:
                    at = np.flatnonzero(rank < (sizes // 5 + 1)[row])
                    region = hashes[order[at]]
                else:
                    width = np.where(_passes(bits, node), np.minimum(2 * sizes // 5 + 1, sizes - 1), 0)
                    at = np.flatnonzero(rank < width[row])
                    region = words.mix(hashes[order[at]] * U(3) + hashes[order[np.minimum(at + 1, len(order) - 1)]])
                step = (SIZE_STEPS * np.log(np.maximum(sizes, 1)) / np.log(PART / SHARE)).astype(U)
                keys.append(((region << U(SIZE_BITS)) | step[row[at]]).view(np.int64))
                nodes.append(node[row[at]])
            if not keys or not sum(map(len, keys)):
                continue
            k, v = np.concatenate(keys), np.concatenate(nodes)
            order = np.lexsort((v, k))
            k, v = k[order], v[order]
            first, at = _star(k)
            tied = ~first & (v != v[at])
            pairs = np.unique(np.stack((v[at][tied], v[tied]), 1), axis=0)
            own = (words.mix(pairs[:, 0].view(U) * U(3) + pairs[:, 1].view(U)) >> U(SIZE_BITS) << U(SIZE_BITS)).view(np.int64)
            yield pa.record_batch([np.concatenate((k[first], own, own)), np.concatenate((v[first], pairs[:, 0], pairs[:, 1]))], ["key", "node"])

    return run


#: Bits below the row number in the sort key of a window.
HASH_ROW = 52


def _tie_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate edges of regions that arrive sorted by key: each text with the first of its run.

    A run ends with its shingle, or where the next size is too far from the last one for any link across.
    """
    last_key, hub = None, None
    for batch in batches:
        k, v = (np.asarray(c) for c in batch.columns)
        if not len(k):
            continue
        shingle, step = k >> SIZE_BITS, k & ((1 << SIZE_BITS) - 1)
        first = np.ones(len(k), bool)
        first[1:] = (shingle[1:] != shingle[:-1]) | (step[1:] - step[:-1] > SIZE_STEPS + 1)
        at = np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))
        hubs = v[at]
        if last_key is not None and shingle[0] == last_key >> SIZE_BITS and step[0] - (last_key & ((1 << SIZE_BITS) - 1)) <= SIZE_STEPS + 1:
            hubs[at == 0] = hub
        last_key, hub = int(k[-1]), hubs[-1]
        tied = hubs != v
        pairs = np.unique(np.stack((hubs[tied], v[tied]), 1), axis=0)
        yield pa.record_batch([pairs[:, 0], pairs[:, 1]], ["a", "b"])


def _overlapping(docs: DataFrame, windows) -> DataFrame:
    """(node, label): texts whose regions overlap, directly or through others, share a label."""
    rows = docs.select("text").mapInArrow(windows, "key long, node long")
    regions = rows.repartition(F.shiftright("key", SIZE_BITS)).sortWithinPartitions("key")
    return forest_components(regions.mapInArrow(lambda batches: contract(_tie_regions(batches)), FOREST))


def candidate_cells(docs: DataFrame, levels) -> DataFrame:
    """(node, label): texts that may link share a label; texts without candidates are left out.

    They overlap in regions of single shingles and in regions of pairs, which chance does not fill.
    """
    single = stage(_overlapping(docs, _windows(levels)), "single")
    if single.isEmpty():
        return single
    held = docs.sparkSession.sparkContext.broadcast(node_filter(single))
    pairs = _overlapping(docs, _windows(levels, held)).withColumnRenamed("label", "of_pairs")
    cells = stage(single.join(pairs, "node").select("node", F.xxhash64("label", "of_pairs").alias("label")), "both")
    held.destroy()
    shared = cells.groupBy("label").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("label")
    return cells.join(shared, "label").select("node", "label")


#: Bits of a mask: two sets of a region are a pair of it if their masks together have all bits. Each level of
#: regions has a bit, which members that are not at home lack; the two sides of a pair of blocks have one each.
FULL, LEVEL_BIT, BLOCK_BITS, REGION_BIT = -1, 0, (16, 17), 18


class Region:
    """Texts joined in memory: flat shingle numbers, bounds, who is connected with whom, and with copies the links of each."""

    def __init__(self, sets: list[np.ndarray], copies: np.ndarray | None = None, masks: np.ndarray | None = None):
        self.copies = copies
        self.masks = np.full(len(sets), FULL, np.int64) if masks is None else masks
        self.links = np.zeros(len(sets), np.int64)
        self.size = np.array([len(s) for s in sets])
        values, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.low = np.cumsum(self.size) - self.size
        self.mark = np.zeros(len(values), bool)
        self.group = np.arange(len(sets))

    def shared(self, p: int, members: np.ndarray) -> np.ndarray:
        """Intersection sizes of p with the members."""
        own = self.flat[self.low[p] : self.low[p] + self.size[p]]
        self.mark[own] = True
        size = self.size[members]
        first = np.cumsum(size) - size
        at = np.repeat(self.low[members] - first, size) + np.arange(size.sum())
        got = np.add.reduceat(self.mark[self.flat[at]].astype(np.int64), first)
        self.mark[own] = False
        return got

    def link(self, p: int, members: np.ndarray) -> np.ndarray:
        """Connect p with each member within EPS; returns the distances."""
        both = self.shared(p, members)
        union = self.size[members] + self.size[p] - both
        self.near = PART * both >= SHARE * union
        near = members[self.near]
        old = np.unique(self.group[np.append(near, p)])
        if len(old) > 1:
            self.group[np.isin(self.group, old)] = old[0]
        return 1 - both / union

    def join(self, members: np.ndarray, masks: np.ndarray | None = None, bit: int = REGION_BIT) -> None:
        """Connect all linked pairs among the members, or count those whose masks allow it."""
        masks = self.masks[members] if masks is None else masks
        if len(members) < 2 or self.copies is None and (self.group[members] == self.group[members[0]]).all():
            return
        if len(members) <= 2 * PIVOTS or bit > 62:
            self.pairs(members, masks)
            return
        step = len(members) / PIVOTS
        pivots = members[(np.arange(PIVOTS) * step).astype(int)]
        d = np.stack([self.link(p, members) for p in pivots])
        home = d.argmin(0)
        nearest = d.min(0)
        regions = [(home == j) | ((home < j) & (d[j] - nearest <= 2 * EPS + 1e-9)) for j in range(PIVOTS)]
        if 2 * sum(int(region.sum()) ** 2 for region in regions) > len(members) ** 2:  # together as many pairs, again on every level below
            self.pairs(members, masks, d)
            return
        for j, region in enumerate(regions):
            own = np.where(home == j, masks, masks & ~np.int64(1 << bit))[region]
            self.join(members[region], own, bit + 1)

    def pairs(self, members: np.ndarray, masks: np.ndarray, d: np.ndarray | None = None) -> None:
        """Compare the pairs with sizes and all pivot distances within EPS: those to be counted, or those not yet connected."""
        for i, x in enumerate(members[:-1]):
            rest = np.arange(i + 1, len(members))
            n = self.size[members[rest]]
            wanted = (masks[rest] | masks[i]) == FULL
            if self.copies is None:
                wanted &= self.group[members[rest]] != self.group[x]
            rest = rest[wanted & (PART * np.minimum(n, self.size[x]) >= SHARE * np.maximum(n, self.size[x]))]
            if d is not None and len(rest):
                rest = rest[(np.abs(d[:, rest] - d[:, i : i + 1]) <= EPS + 1e-9).all(0)]
            if len(rest):
                self.link(x, members[rest])
                if self.copies is not None:
                    near = members[rest[self.near]]
                    self.links[x] += self.copies[near].sum()
                    self.links[near] += self.copies[x]


def region_groups(sets: list[np.ndarray]) -> np.ndarray:
    """A group number per non-empty set; equal numbers mean connected by links."""
    region = Region(sets)
    region.join(np.arange(len(sets)))
    return region.group


def _filter_slots(node: np.ndarray) -> np.ndarray:
    return (words.mix(node.view(U)) >> U(64 - FILTER_BITS)).astype(np.int64)


def _passes(bits: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Whether the filter lets each node pass."""
    at = _filter_slots(node)
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0


def _filter_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, bits) of nodes that arrive by part."""
    shift = FILTER_BITS - PART_BITS
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        at = _filter_slots(np.asarray(batch.column(0)))
        for part in np.unique(at >> shift):
            own = at[at >> shift == part] - (int(part) << shift)
            found.setdefault(int(part), np.zeros(1 << (shift - 3), np.uint8))
            np.bitwise_or.at(found[int(part)], own >> 3, (1 << (own & 7)).astype(np.uint8))
    for part, bits in found.items():
        yield pa.record_batch([[part], pa.array([bits.tobytes()], pa.binary())], ["part", "bits"])


def node_filter(cells: DataFrame) -> np.ndarray:
    """Bits of the hashed nodes in cells; 2**FILTER_BITS bits at any number of them."""
    table = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    size = 1 << (FILTER_BITS - PART_BITS - 3)
    tasks = cells.select("node").mapInArrow(_filter_parts, "part long, bits binary")
    merged = tasks.repartition(1 << (PART_BITS - 1), "part").mapInArrow(_merge_parts, "part long, bits binary")
    for r in merged.toLocalIterator():
        table[r.part * size : (r.part + 1) * size] = np.frombuffer(r.bits, np.uint8)
    return table


def _merge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = np.frombuffer(bits, np.uint8)
            found[part] = found[part] | own if part in found else own
    for part, bits in found.items():
        yield pa.record_batch([[part], pa.array([bits.tobytes()], pa.binary())], ["part", "bits"])


def _sets_of(wanted):
    """(node, n, shingles) of texts that the filter lets pass: all in cells and a few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        bits = wanted.value
        for batch in batches:
            for _, _, data, off in slices(batch.column(0)):
                bounds, hashes = words.shingle_sets(data, off)
                node = set_nodes(bounds, hashes)
                out = []
                for i in np.flatnonzero((np.diff(bounds) > 0) & _passes(bits, node)):
                    if node[i] not in seen:
                        seen.add(node[i])
                        out.append(i)
                if len(seen) > 500_000:
                    seen.clear()
                if out:
                    blobs = [hashes[bounds[i] : bounds[i + 1]].tobytes() for i in out]
                    yield pa.record_batch([node[out], np.diff(bounds)[out], pa.array(blobs, pa.binary())], ["node", "n", "shingles"])

    return run


#: Bits of the filter of nodes in cells.
FILTER_BITS = 27
SET_COLUMNS = ["cell", "node", "n", "shingles", "copies", "mask"]


def cell_sets(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """The shingle sets of all texts in cells (node, label, copies), once or a few times each."""
    held = docs.sparkSession.sparkContext.broadcast(node_filter(cells))
    sets = docs.select("text").mapInArrow(_sets_of(held), "node long, n long, shingles binary")
    rows = sets.join(cells, "node").withColumn("cell", F.col("label")).withColumn("mask", F.lit(FULL).cast("long"))
    return rows.select(*SET_COLUMNS)


def _rows_by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray], list[int], list[int]]]:
    """Nodes, sets, copies and masks of each cell of rows sorted by cell; a node counts once."""
    cell, held = None, ([], [], [], [])
    seen: set[int] = set()
    for batch in batches:
        blobs = batch.column(3)
        columns = (batch.column(i).to_pylist() for i in (0, 1, 4, 5))
        for i, (c, v, copies, mask) in enumerate(zip(*columns, strict=True)):
            if c != cell:
                if held[0]:
                    yield held
                cell, held, seen = c, ([], [], [], []), set()
            if v not in seen:
                seen.add(v)
                for part, x in zip(held, (v, np.frombuffer(blobs[i].as_py(), U), copies, mask), strict=True):
                    part.append(x)
    if held[0]:
        yield held


def _join_cells(count: bool):
    """Rows (a, b, links): b is connected with a, the smallest of its group in this cell, and has so many links here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, links = [], [], []

        def rows():
            return pa.record_batch([pa.array(x, pa.int64()) for x in (a, b, links)], ["a", "b", "links"])

        for nodes, sets, copies, masks in _rows_by_cell(batches):
            if len(nodes) > 1:
                region = Region(sets, np.array(copies) if count else None, np.array(masks))
                region.join(np.arange(len(sets)))
                ids = np.array(nodes)
                # the smallest node stands for its group in this cell
                order = np.lexsort((ids, region.group))
                first, at = _star(region.group[order])
                keep = ~first | (region.links[order] > 0)
                a.extend(ids[order][at][keep])
                b.extend(ids[order][keep])
                links.extend(region.links[order][keep])
            if len(a) > 50_000:
                yield rows()
                a, b, links = [], [], []
        yield rows()

    return run


def _voronoi(pivots, bit: int, weigh: bool = False):
    """Rows (kind 0: link a, b; kind 1: set of a sub-region) of texts in large cells; to ``weigh`` the sub-regions, rows (cell, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = {c: [(v, np.frombuffer(s, U)) for v, s in rows] for c, rows in pivots.value.items()}
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            cells, weights = [], []
            for c, v, n, s, copies, mask in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                own = np.frombuffer(s, U)
                outside = mask & ~(1 << bit)
                d = []
                for p, q in around[c]:
                    both = len(np.intersect1d(own, q, assume_unique=True))
                    union = len(own) + len(q) - both
                    d.append(1 - both / union)
                    if PART * both >= SHARE * union and p != v:
                        for column, x in zip(out, (0, p, v, None, None, None, None, None), strict=True):
                            column.append(x)
                home = int(np.argmin(d))
                for j in range(home, len(d)):
                    if d[j] - d[home] <= 2 * EPS + 1e-9:
                        cells.append(c)
                        weights.append(n)
                        if weigh:
                            continue
                        sub = int(words.mix(np.array([np.int64(c).astype(U) * U(31) + U(j + 1)]))[0].astype(np.int64))
                        for column, x in zip(out, (1, None, v, sub, n, s, copies, mask if j == home else outside), strict=True):
                            column.append(x)
            if weigh:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in (cells, weights)], ["cell", "n"])
                continue
            types = (pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(x, t) for x, t in zip(out, types, strict=True)], ["kind", "a", "node", "cell", "n", "shingles", "copies", "mask"])

    return run


def _deal(cells: DataFrame, blocks) -> DataFrame:
    """Each pair of blocks of a cell as a cell of its own; ``blocks`` is their number."""
    own = F.pmod(F.xxhash64("node"), blocks)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: F.struct(F.least(j, own).alias("x"), F.greatest(j, own).alias("y")))
    # of two blocks the pairs across count, as those inside have a cell of their own
    low, high = (~(1 << x) for x in BLOCK_BITS)
    side = F.when(F.col("pair.x") == F.col("pair.y"), F.lit(FULL)).when(F.col("pair.x") == own, F.lit(low)).otherwise(F.lit(high))
    dealt = cells.select("*", F.explode(F.array_distinct(pairs)).alias("pair")).withColumn("mask", F.col("mask").bitwiseAND(side.cast("long")))
    return dealt.withColumn("cell", F.xxhash64("cell", "pair")).select(*SET_COLUMNS)


def _split(sets: DataFrame, max_elements: int, max_work: int, levels: int = 4) -> tuple[DataFrame, DataFrame | None]:
    """Sets in cells that one task can hold and join, and the links found on the way."""
    spark = sets.sparkSession
    done, links = [], []
    too_large, too_much = F.col("elements") > max_elements, F.col("elements") * F.col("members") > max_work
    small = lambda rows, count: F.broadcast(rows) if count * 24 <= BROADCAST_LIMIT else rows
    for level in range(levels + 1):
        weight = sets.groupBy("cell").agg(F.sum("n").alias("elements"), F.count(F.lit(1)).alias("members"))
        weight = stage(weight.where((F.col("members") > 2) & (too_large | too_much)), "weights")
        how_many, busy = weight.agg(F.count_if(too_large), F.count_if(~too_large)).first()
        dealt, parted = weight, 0
        if how_many and level < levels and how_many <= 4096:
            big = sets.join(small(weight.where(too_large).select("cell"), how_many), "cell")
            order = W.partitionBy("cell").orderBy(F.xxhash64("node", F.lit(level)), "node")
            chosen = big.select("cell", "node", "shingles").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PIVOTS)
            pivots: dict[int, list] = {}
            for r in chosen.toLocalIterator():  # PIVOTS rows for each of at most 4096 cells
                pivots.setdefault(r.cell, []).append((r.node, bytes(r.shingles)))
            held = spark.sparkContext.broadcast(pivots)
            # texts close to no pivot, or to several, enter many regions: a cell whose regions would hold much more than it is dealt
            grown = big.select(*SET_COLUMNS).mapInArrow(_voronoi(held, LEVEL_BIT + level, True), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("grown"))
            shrinks = stage(weight.join(grown, "cell").where(F.col("grown") <= GROWTH * F.col("elements")).select("cell"), "shrinks")
            parted = shrinks.count()
            dealt = weight.join(small(shrinks, parted), "cell", "left_anti")
        if how_many + busy - parted:
            # blocks of half a task, by what they hold and by the work of a pair of them
            known = small(dealt, how_many + busy)
            parts = F.greatest(F.ceil(2 * F.col("elements") / max_elements), F.ceil(2 * F.sqrt(F.col("elements") * F.col("members") / max_work))) + 1
            done.append(_deal(sets.join(known, "cell"), parts))
            sets = sets.join(known, "cell", "left_anti")
        if not parted:
            return _union([*done, sets]), _union(links) if links else None
        done.append(sets.join(small(shrinks, parted), "cell", "left_anti"))
        big = sets.join(small(shrinks, parted), "cell")
        rows = stage(big.select(*SET_COLUMNS).mapInArrow(_voronoi(held, LEVEL_BIT + level), "kind int, a long, node long, cell long, n long, shingles binary, copies long, mask long"), "regions")
        links.append(rows.where("kind = 0").select("a", F.col("node").alias("b")))
        sets = rows.where("kind = 1").select(*SET_COLUMNS)
    raise AssertionError("not reached")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def jaccard_components(docs: DataFrame, max_elements: int = MAX_ELEMENTS, max_work: int = MAX_WORK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document of (doc_id, text), without counting links.

    Null and empty texts, and texts without words, have no shingles and are alone. Repeated rows give a row
    each and count as copies. A null doc_id gives a null component and never stands for one. Other columns are ignored.
    """
    return _joined(docs, max_elements, max_work, False).drop("n_links")


def jaccard_links(docs: DataFrame, max_elements: int = MAX_ELEMENTS, max_work: int = MAX_WORK) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): as jaccard_components, with the number of other rows each row links with.

    Copies link with each other, whatever their ids. A text without shingles has no link.
    """
    return _joined(docs, max_elements, max_work, True)


def linked_rows(docs: DataFrame, max_elements: int = MAX_ELEMENTS, max_work: int = MAX_WORK) -> DataFrame:
    """(doc_id, text_hash, label) of the rows of (doc_id, text) that are linked with another row; equal labels mean one group.

    Rows without id are left out. Texts without shingles are linked with nothing but repeats of their row. Repeated rows give
    a row each. Other columns are ignored.
    """
    sizes, known = _found(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), max_elements, max_work, False)
    named = sizes.where("doc_id IS NOT NULL")
    linked = named.join(known, "node").select("doc_id", "text_hash", F.coalesce("label", "node").alias("label"))
    return linked.union(named.where("n = 0").select("doc_id", "text_hash", F.xxhash64("doc_id", "text_hash")))


def _found(docs: DataFrame, max_elements: int, max_work: int, count: bool) -> tuple[DataFrame, DataFrame]:
    """Size and node of every row, and what is known of a node besides the set: only of nodes with copies or links."""
    spark = docs.sparkSession
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    kinds = ", ".join(f"{c} long" for c in [*docs.columns[:-1], "n", "node"])
    sizes = stage(docs.mapInArrow(_sizes, kinds), "sizes")
    levels = spark.sparkContext.broadcast(shingle_levels(docs))
    cells = stage(candidate_cells(docs, levels), "cells")
    copies = stage(sizes.where("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("copies")), "copies")
    counted = F.lit(0).cast("long").alias("links")
    if cells.isEmpty():
        found = cells.select("node", "label", counted)
    else:
        sets = stage(cell_sets(docs, cells.join(copies, "node")), "sets")
        sets, links = _split(sets, max_elements, max_work)
        joined = sets.repartition("cell").sortWithinPartitions("cell").mapInArrow(_join_cells(count), "a long, b long, links long")
        joined = stage(joined, "joined")
        edges = joined.select("a", "b")
        found = connected_components(edges.union(links) if links is not None else edges)
        if count:
            found = found.join(joined.groupBy(F.col("b").alias("node")).agg(F.sum("links").alias("links")), "node", "left")
        else:
            found = found.select("node", "label", counted)
    return sizes, stage(copies.where("copies > 1").join(found, "node", "full"), "found")


def _joined(docs: DataFrame, max_elements: int, max_work: int, count: bool) -> DataFrame:
    sizes, known = _found(docs.select("doc_id", "text"), max_elements, max_work, count)
    labelled = sizes.join(known, "node", "left").select(
        "doc_id", "n", F.coalesce("label", "node").alias("label"), (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links")
    )
    named = labelled.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    smallest = stage(named.groupBy("label").agg(F.min("doc_id").alias("smallest"), F.count(F.lit(1)).alias("members")).where("members > 1"), "smallest")
    return labelled.join(smallest, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("smallest", "doc_id")).alias("component_id"),
        "n_links",
    )
