"""Pairs of near fingerprints through vantage-point trees.

A fingerprint of 64 bits is cut into blocks, and each block has a tree of its own. Level j of a tree has one vantage point, and its
branches are the Hamming distances from it, within the block; a leaf is a list of distances, and it is the shard in which
fingerprints meet. If two fingerprints differ in at most ``radius`` bits of the block, the triangle inequality bounds how far their
distances from every vantage point lie apart, and flipping t bits changes each of them by t, t - 2, ..., or -t. All other branches are
pruned. So a fingerprint lives in one leaf and queries those that its ball overlaps, each pair from one side only. Of m blocks, two
fingerprints with at most m * (radius + 1) - 1 differing bits agree to within ``radius`` in one: up to there the search is exact.

In a leaf, pairs are compared block by block and only a minimum spanning forest of them is kept, so a group of n near fingerprints
leaves with n - 1 links and the forest of all leaves connects what all pairs would.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.texts import write_once

#: A leaf should hold about so many fingerprints; one with more than LEAF_MOST is split into chunks, each compared with every query.
LEAF_GOAL, LEAF_MOST = 400, 16_384
ROWS, COLUMNS = 512, 8192
RANK_ROWS = 128
HOME, QUERY = 1, 0


@dataclass(frozen=True)
class Forest:
    """The trees of all blocks: masks, vantage points and the changes of distances that a leaf query may meet."""

    blocks: int
    radius: int
    depth: int

    def masks(self) -> list[int]:
        edges = [round(64 * i / self.blocks) for i in range(self.blocks + 1)]
        return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]

    def vantage_points(self) -> np.ndarray:
        return np.random.default_rng(64).integers(0, 1 << 64, (self.blocks, self.depth), np.uint64, endpoint=False)

    def changes(self) -> list[tuple[int, ...]]:
        """Distance changes of one side: the first that isn't 0 is positive."""
        out = {s for t in range(self.radius + 1) for s in product(range(-t, t + 1, 2), repeat=self.depth)}
        return sorted(s for s in out if s > (0,) * self.depth)

    def leaves(self, fps: np.ndarray, word: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(positions in ``fps``, leaf, role) of the home leaf and of the leaves to query, block by block of the fingerprint's ``word``."""
        every = np.arange(len(fps))
        powers = np.int64(128) ** np.arange(self.depth, dtype=np.int64)
        for i, (mask, points) in enumerate(zip(self.masks(), self.vantage_points())):
            far = np.bitwise_count((fps[:, None] ^ points[None, :]) & np.uint64(mask)).astype(np.int64)
            width = mask.bit_count()
            tag = np.int64(word * self.blocks + i) << 56
            yield every, tag + far @ powers, HOME
            for change in self.changes():
                moved = far + np.array(change)
                fits = ((moved >= 0) & (moved <= width)).all(axis=1)
                yield every[fits], tag + moved[fits] @ powers, QUERY

    @classmethod
    def for_size(cls, n: int, blocks: int, radius: int) -> "Forest":
        """As deep as the number of fingerprints asks for. Distances from a vantage point are about binomial."""
        width = 64 // blocks
        odds = np.array([float(x) for x in np.poly1d([0.5, 0.5]) ** width])
        share = float((odds * odds).sum())
        depth = 1
        while n * share ** depth > LEAF_GOAL and depth < 8:
            depth += 1
        return cls(blocks, radius, depth)


def spanning_forest(n: int, i: np.ndarray, j: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Positions of the edges of a minimum spanning forest over nodes 0 .. n - 1, by distance ``d``."""
    label = np.arange(n)

    def root(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = int(label[x])
        return x

    kept = []
    for step in np.unique(d):
        left = np.flatnonzero(d == step)
        while len(left):
            while not np.array_equal(label, label[label]):
                label = label[label]
            a, b = label[i[left]], label[j[left]]
            apart = a != b
            left, a, b = left[apart], a[apart], b[apart]
            if not len(left):
                break
            # One edge for each pair of trees is enough to look at.
            _, first = np.unique(np.minimum(a, b) * np.int64(n) + np.maximum(a, b), return_index=True)
            for e in left[first]:
                x, y = root(int(i[e])), root(int(j[e]))
                if x != y:
                    label[max(x, y)] = min(x, y)
                    kept.append(e)
    return np.array(kept, np.int64)


class Leaf:
    """Links found in one leaf, between ids. Homes come first; queries may come in any number of parts."""

    def __init__(self, within: int, width: int):
        self.within = within
        self.known = np.zeros(0, np.int64)  # ids that have links
        self.ids, self.words = np.zeros(0, np.int64), np.zeros((0, width), np.uint64)
        self.edges = np.zeros((3, 0), np.int64)  # positions in known, distance

    def _know(self, ids: np.ndarray) -> None:
        old, self.known = self.known, np.union1d(self.known, ids)
        if self.edges.size:
            self.edges[:2] = np.searchsorted(self.known, old)[self.edges[:2]]

    def add(self, ids: np.ndarray, words: np.ndarray, homes: bool) -> None:
        if homes:
            self.ids, self.words = np.concatenate([self.ids, ids]), np.concatenate([self.words, words])
        for lo in range(0, len(ids), ROWS):
            for start in range(0, len(self.ids), COLUMNS):
                own, other = words[lo:lo + ROWS], self.words[start:start + COLUMNS]
                d = np.bitwise_count(own[:, None, 0] ^ other[None, :, 0])
                for w in range(1, own.shape[1]):
                    d += np.bitwise_count(own[:, None, w] ^ other[None, :, w])
                i, j = np.nonzero(d <= self.within)
                a, b, near = ids[lo + i], self.ids[start + j], d[i, j].astype(np.int64)
                keep = a != b
                if keep.any():
                    a, b = a[keep], b[keep]
                    self._know(np.unique(np.concatenate([a, b])))
                    found = np.stack([np.searchsorted(self.known, a), np.searchsorted(self.known, b), near[keep]])
                    edges = np.concatenate([self.edges, found], axis=1)
                    self.edges = edges[:, spanning_forest(len(self.known), *edges)]

    def links(self) -> list[pa.Array]:
        return [pa.array(self.known[self.edges[0]]), pa.array(self.known[self.edges[1]]), pa.array(self.edges[2].astype(np.int32))]


def _dealt(items: DataFrame, blocks: int, radius: int, n: int, trees: int) -> DataFrame:
    """leaf, chunk, role and the columns of ``items``: every item at home and where it queries, sorted, homes first."""
    words = [c for c in items.columns if c != "id"]
    forest = Forest.for_size(n, blocks, radius)
    kinds = "".join(f", {w} long" for w in words)

    def place(batches):
        for batch in batches:
            ids, *held = (batch.column(i).to_numpy() for i in range(1 + len(words)))
            for word in range(trees):
                for at, leaf, role in forest.leaves(held[word].view(np.uint64), word):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(leaf), pa.array(np.full(len(at), role, np.int8)), pa.array(ids[at]), *[pa.array(w[at]) for w in held]],
                        names=["leaf", "role", "id", *words])

    rows = items.select("id", *words).mapInArrow(place, "leaf long, role tinyint, id long" + kinds)
    # Only crowded leaves are listed; the list is usually empty, and its size is known once it is written.
    crowded = write_once(rows.filter(F.col("role") == HOME).groupBy("leaf").count().filter(F.col("count") > LEAF_MOST)
                         .select("leaf", F.ceil(F.col("count") / LEAF_MOST).cast("int").alias("chunks")), "crowded")
    rows = rows.join(crowded, "leaf", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    # A home is compared inside its chunk and queries the chunks after it; a query goes to all chunks.
    chunks = F.sequence(F.lit(0), F.col("chunks") - 1)
    rows = rows.withColumn("chunk", F.explode(F.when(F.col("role") == HOME, F.filter(chunks, lambda c: c >= own)).otherwise(chunks)))
    role = F.when((F.col("role") == HOME) & (F.col("chunk") == own), HOME).otherwise(QUERY).cast("tinyint").alias("role")
    return rows.select("leaf", "chunk", role, "id", *words).repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk", F.col("role").desc())


def near_links(items: DataFrame, within: int, blocks: int, radius: int, n: int, trees: int = 1) -> DataFrame:
    """a, b, distance: links between the ids of items that differ in at most ``within`` bits.

    ``items`` has the columns id (long, unique), fp (long) and any number of further fingerprint words (long); each of the first
    ``trees`` words has trees of its own, and the distance counts all words. The links connect those items that all such pairs would connect, through nearest ones first.
    Pairs that differ in more than ``blocks * (radius + 1) - 1`` bits of each of these words may be missed. ``n`` is the number of items, which are
    evaluated more than once.
    """
    words = [c for c in items.columns if c != "id"]

    def search(batches):
        current, leaf = None, Leaf(within, len(words))
        done = lambda: pa.RecordBatch.from_arrays(leaf.links(), names=["a", "b", "distance"])
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            ids = batch.column(3).to_numpy()
            held = np.stack([batch.column(4 + i).to_numpy().view(np.uint64) for i in range(len(words))], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(ids)]):
                if lo == hi:
                    continue
                key = (keys[lo][0], keys[lo][1])
                if key != current:
                    if leaf.edges.size:
                        yield done()
                    current, leaf = key, Leaf(within, len(words))
                leaf.add(ids[lo:hi], held[lo:hi], keys[lo][2] == HOME)
        if leaf.edges.size:
            yield done()

    return _dealt(items, blocks, radius, n, trees).mapInArrow(search, "a long, b long, distance int")


def open_pairs(items: DataFrame, within: int, blocks: int, radius: int, n: int, lo: int, hi: int, trees: int = 1) -> DataFrame:
    """a, b: pairs that :func:`near_links` would compare, of two parts, from places ``lo`` to ``hi`` of what is near to each item.

    ``items`` has a further column part (long, the last). What is near to an item in a leaf is listed by distance, then id, whatever the
    parts, so that windows from 0 on cover all pairs. A row without b says that an item has others of another part from ``hi`` on.
    """
    def ranked(ids, held, home_ids, homes):
        for at in range(0, len(ids), RANK_ROWS):
            own, own_ids = held[at:at + RANK_ROWS], ids[at:at + RANK_ROWS]
            d = sum(np.bitwise_count(own[:, None, w] ^ homes[None, :, w]).astype(np.int16) for w in range(own.shape[1] - 1))
            i, j = np.nonzero((d <= within) & (own_ids[:, None] != home_ids[None, :]))
            order = np.lexsort((home_ids[j], d[i, j], i))
            i, j = i[order], j[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            apart = own[i, -1] != homes[j, -1]
            now = apart & (rank >= lo) & (rank < hi)
            later = np.unique(i[apart & (rank >= hi)])
            if now.any() or len(later):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([own_ids[i[now]], own_ids[later]])),
                    pa.concat_arrays([pa.array(home_ids[j[now]]), pa.nulls(len(later), pa.int64())])], names=["a", "b"])

    def search(batches):
        current, complete, home_ids, homes = None, False, [], []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            ids = batch.column(3).to_numpy()
            held = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in range(4, batch.num_columns)], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(ids)]):
                if start == end:
                    continue
                key, role = (keys[start][0], keys[start][1]), keys[start][2]
                if current is not None and not complete and (key != current or role == QUERY):
                    home_ids, homes = (np.concatenate(c) if c else None for c in (home_ids, homes))
                    complete = True
                    if homes is not None:
                        yield from ranked(home_ids, homes, home_ids, homes)
                if key != current:
                    current, complete, home_ids, homes = key, False, [], []
                if role == HOME:
                    home_ids.append(ids[start:end])
                    homes.append(held[start:end])
                elif complete and homes is not None:
                    yield from ranked(ids[start:end], held[start:end], home_ids, homes)
                else:
                    # A leaf that no item calls its home.
                    complete, homes = True, None
        if current is not None and not complete:
            home_ids, homes = np.concatenate(home_ids), np.concatenate(homes)
            yield from ranked(home_ids, homes, home_ids, homes)

    return _dealt(items, blocks, radius, n, trees).mapInArrow(search, "a long, b long")
