"""Gradient boosted trees on second-order gains, grown level by level or best leaf first, with patience on average precision.

* Values become bin numbers once (cut points from combinable counts, bin 0 for missing values); the rows lie in blocks of bytes, written
  to the shared folder. Margins are part of the blocks' state, one generation per round, written out every CHUNK rounds.
* A pass over the blocks adds up gradients, hessians and rows per (leaf, feature, bin). They are whole numbers in units of 2^-30 of the
  largest weight, so sums don't depend on their order, and a model not on cores, retries or the order of rows in a sum. Histograms are
  summed by feature before they reach the driver, where their size follows leaves, features and bins alone.
* Of two new leaves only the one with fewer rows is counted, the other is what its parent has besides. The leaf with the largest gain is
  split first. A pass counts for all leaves that may still come up, so a tree takes about as many passes as it has levels, and yet is the
  tree that one split at a time would give. Growing level by level is the same without a limit of leaves.
* Up to PARTITION_ROWS rows one task, which has nobody to wait for, grows the trees of a whole chunk in one job and keeps the rows of every
  leaf. With more rows every level of a tree is a job over all cores, which reads of each block only what the tree is grown on: bin numbers,
  gradients and hessians of the rows drawn, laid down once a tree. The sums are the same, and so is the model.
* Every CHUNK rounds the average precision of every prefix of the ensemble is computed on the validation rows, exactly and for all these
  rounds at once, from distinct margins counted per task. When the best prefix is ``patience`` rounds old the training ends, and the model
  is cut to it.
"""

from __future__ import annotations

import heapq
import json
import math
import operator
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.running import range_cuts
from riskloom.session import cut_lineage

BLOCK_ROWS = 1 << 16
#: Rows that one task grows trees on; with more, the jobs for every level take less time on a few cores.
PARTITION_ROWS = 4_000_000
#: Bytes of state in a task, which holds a block at a time if it isn't the only one.
TASK_BYTES = 1 << 30
#: Rows that one task turns into bin numbers.
BINNED_ROWS = 500_000
#: Trees between two states in memory where every level is a job.
LAID = 6
#: Rounds between two written states and two looks at the validation rows.
CHUNK = 25
#: Feature groups whose histograms are summed apart.
GROUPS = 8
#: Bytes of histograms that are summed on the driver without a shuffle.
SUMMED_BYTES = 1 << 24
#: Rows whose sums stay exact in a double.
SHARD_ROWS = 1 << 22
#: Cells of a table that several columns are counted in together, where a leaf has at least COUNTED times as many rows.
CELLS, COUNTED = 1 << 13, 4
#: Validation rows of one round that are ranked together.
RANKED_ROWS = 1 << 20
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class TreeConfig:
    """Boosting settings. The numbers are fixed values."""

    rounds: int = 500
    depth: int = 6
    step: float = 0.05
    leaves: int = 0  # at most so many leaves, the best first; 0: level by level, as many as the depth allows
    subsample: float = 0.8
    columns: float = 0.8
    min_rows: int = 1
    min_hessian: float = 10.0
    l2: float = 1.0
    bins: int = 64
    patience: int = 50
    seed: int = 42


# The leaf-wise profile: all rows and columns, few rows to a leaf, no shrinking of leaf values but the step.
LEAFWISE = TreeConfig(leaves=63, subsample=1.0, columns=1.0, min_rows=20, min_hessian=1e-3, l2=0.0)


@dataclass
class Tree:
    """Nodes by number, the root first. A leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)  # values up to this bin go left
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[int] = field(default_factory=list)  # rows it was grown on

    def add(self, cover: int) -> int:
        for column, value in zip((self.feature, self.bin, self.missing_left, self.left, self.right, self.value, self.gain, self.cover),
                                 (-1, 0, False, -1, -1, 0.0, 0.0, cover)):
            column.append(value)
        return len(self.feature) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature, np.int32), np.array(self.bin, np.int32), np.array(self.missing_left, bool),
                np.array(self.left, np.int32), np.array(self.right, np.int32))

    def leaves(self) -> int:
        return sum(f < 0 for f in self.feature)


def descend(bins: np.ndarray, arrays: tuple[np.ndarray, ...]) -> np.ndarray:
    """The leaf of every row of bin numbers."""
    feature, at_most, missing_left, left, right = arrays
    node = np.zeros(len(bins), np.int32)
    rows = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, int)
    while len(rows):
        own = node[rows]
        value = bins[rows, feature[own]]
        node[rows] = own = np.where(np.where(value == 0, missing_left[own], value <= at_most[own]), left[own], right[own])
        rows = rows[feature[own] >= 0]
    return node


#: Rows of one block: their numbers, bin numbers, labels, weights, which rows are held out, margins after the rounds so far, and the margins
#: of the rows held out after each round of this chunk. A plain tuple, as these travel once a pass.
Block = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]


def gradients(y: np.ndarray, weight: np.ndarray, margin: np.ndarray, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the weighted log loss, in whole numbers."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint(weight * (p - y) * unit), np.rint(weight * p * (1 - p) * unit)


def drawn(number: np.ndarray, held: np.ndarray, cfg: TreeConfig, round_: int) -> np.ndarray:
    """Rows that this round's tree is grown on: a share of the numbers, whatever block a row is in."""
    if cfg.subsample >= 1:
        return ~held
    mixed = number.astype(np.uint64) + np.uint64((cfg.seed * 1_000_003 + round_) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return ~held & (mixed < np.uint64(cfg.subsample * 2**64))


def _sides(column: np.ndarray, rows: np.ndarray, at_most: int, missing_left: bool) -> tuple[np.ndarray, np.ndarray]:
    """The rows that go left, and those that go right."""
    value = column.take(rows)
    left = value <= at_most
    if not missing_left:
        left &= value > 0
    return rows[left], rows[~left]


def after(block: Block, arrays: tuple[np.ndarray, ...], value: np.ndarray) -> Block:
    """The block after one more tree."""
    number, bins, y, weight, held, margin, history = block
    feature, at_most, missing_left, left, right = (a.tolist() for a in arrays)
    margin, own = margin.copy(), {0: np.arange(len(y))}
    for node in range(len(feature)):  # behind its parent
        rows = own.pop(node)
        if feature[node] < 0:
            margin[rows] += value[node]
        else:
            own[left[node]], own[right[node]] = _sides(bins[:, feature[node]], rows, at_most[node], missing_left[node])
    return number, bins, y, weight, held, margin, (*history, margin[held])


def after_all(block: Block, trees: Iterable[tuple[tuple[np.ndarray, ...], np.ndarray]]) -> Block:
    for arrays, value in trees:
        block = after(block, arrays, value)
    return block


def bin_numbers(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """0 for a missing value, else one more than the number of cut points up to the value."""
    out = np.zeros(x.shape, np.uint16 if max(map(len, cuts), default=0) > 253 else np.uint8)
    for j, points in enumerate(cuts):
        out[:, j] = np.where(np.isnan(x[:, j]), 0, np.searchsorted(points, x[:, j], side="right") + 1)
    return out


def bin_cuts(rows: DataFrame, width: int, n: int, bins: int) -> list[np.ndarray]:
    """Cut points per position of the array ``x``, for at most ``bins`` bins of similar row counts."""
    names = [f"c{i}" for i in range(width)]
    wide = rows.select(*[F.get("x", F.lit(i)).alias(c) for i, c in enumerate(names)])
    found = range_cuts(wide, names, max(1, n // max(1, bins - 2)))
    out = []
    for c in names:
        points = np.array(found[c], float)
        if len(points) > bins - 2:
            points = points[np.linspace(0, len(points) - 1, bins - 2).round().astype(int)]
        out.append(np.unique(points))
    return out


def _blocks(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Rows (row, x, y, w, held) as blocks of bin numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def block():
            number, bins, y, w, held = (np.concatenate(c) for c in zip(*parts))
            return pa.RecordBatch.from_pydict({
                "n": pa.array([len(y)]), "wide": pa.array([bins.dtype == np.uint16]),
                **{k: pa.array([v.tobytes()], pa.binary()) for k, v in (("number", number), ("bins", bins), ("y", y), ("w", w), ("held", held))}})

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(cuts))
            number, y, w, held = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4))
            parts.append((number, bin_numbers(x, cuts), y.astype(float), w.astype(float), held.astype(bool)))
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield block()
                parts, size = [], 0
        if parts:
            yield block()

    return rows.select("row", "x", "y", "w", "held").mapInArrow(run, "n long, wide boolean, number binary, bins binary, y binary, w binary, held binary")


def _state(blocks: DataFrame, width: int, base: float) -> RDD:
    def load(r) -> Block:
        bins = np.frombuffer(r["bins"], np.uint16 if r["wide"] else np.uint8).reshape(r["n"], width)
        y, w = (np.frombuffer(r[c], float) for c in ("y", "w"))
        return np.frombuffer(r["number"], np.int64), bins, y, w, np.frombuffer(r["held"], bool), np.full(r["n"], base), ()

    return blocks.rdd.map(load)


@dataclass(frozen=True)
class _Round:
    """What a round's passes need to know."""

    cfg: TreeConfig
    number: int
    unit: float
    columns: np.ndarray
    sizes: tuple[int, ...]  # bins of each column

    @property
    def n_bins(self) -> int:
        return max(self.sizes)

    @classmethod
    def of(cls, cfg: TreeConfig, number: int, unit: float, sizes: Sequence[int]) -> "_Round":
        take = max(1, math.ceil(cfg.columns * len(sizes)))
        return cls(cfg, number, unit, np.sort(np.random.default_rng([cfg.seed, number]).choice(len(sizes), take, replace=False)), tuple(sizes))

    def tree(self, count: Callable[[tuple[np.ndarray, ...], list[int]], np.ndarray], grown: list | None = None) -> Tree:
        return grow(lambda tree, nodes: dict(zip(nodes, count(tree.arrays(), nodes))), self.cfg, self.unit, self.columns, grown)


def _over_cluster(state: RDD, rounds: list[_Round]) -> tuple[RDD, RDD, list[Tree]]:
    """The state after some rounds, what of it is kept in memory, and their trees; a job for each level."""
    trees, old, new = [], None, []
    state = state.persist(StorageLevel.MEMORY_AND_DISK)

    for r in rounds:
        # What the levels read, once for the whole tree.
        drawn_rows = state.map(lambda b, r=r, new=tuple(new): _Drawn.of(after_all(b, new), r)).persist(StorageLevel.MEMORY_AND_DISK)

        def count(arrays: tuple[np.ndarray, ...], nodes: list[int]) -> np.ndarray:
            shape = len(nodes), len(r.columns), r.n_bins, 3
            small = math.prod(shape) * 8 * state.getNumPartitions() <= SUMMED_BYTES
            groups = [g for g in np.array_split(np.arange(len(r.columns)), GROUPS) if len(g)]
            known = np.arange(r.n_bins) < np.array(r.sizes)[r.columns][:, None]  # bins that the columns have

            def run(blocks: Iterator[_Drawn]):
                total = np.zeros(shape, np.int64)
                for b in blocks:
                    b.add_to(total, r, arrays, nodes)
                if small:
                    yield total[:, known]
                else:
                    for i, group in enumerate(groups):
                        yield i, total[:, group]

            if small:
                out = np.zeros(shape, np.int64)
                out[:, known] = sum(drawn_rows.mapPartitions(run).collect())
                return out
            found = dict(drawn_rows.mapPartitions(run).reduceByKey(operator.add, len(groups)).collect())
            return np.concatenate([found[i] for i in range(len(groups))], axis=1)

        tree = r.tree(count)
        drawn_rows.unpersist()
        if old:  # the present state was computed by the first pass
            old.unpersist()
            old = None
        trees.append(tree)
        new.append((tree.arrays(), np.array(tree.value)))
        # Blocks are many times the margins, so they are laid down after a few trees only; until then these are walked again.
        if len(new) == LAID or r is rounds[-1]:
            old, state, new = state, state.map(lambda b, new=tuple(new): after_all(b, new)).persist(StorageLevel.MEMORY_AND_DISK), []
    return state, state, trees


@dataclass
class _Drawn:
    """What a tree is grown on in one block: bin numbers by column of the round, numbers of the cells of columns that are counted together,
    gradients and hessians."""

    columns: np.ndarray
    keys: list[np.ndarray | None]
    g: np.ndarray
    h: np.ndarray

    @staticmethod
    def together(r: _Round) -> list[list[int]]:
        """Places of columns that are counted together."""
        return packed([r.sizes[f] for f in r.columns])

    @classmethod
    def of(cls, block: Block, r: _Round) -> "_Drawn":
        number, bins, y, weight, held, margin, _ = block
        rows = np.flatnonzero(drawn(number, held, r.cfg, r.number))
        columns = bins.T[r.columns].take(rows, axis=1)
        keys: list[np.ndarray | None] = []
        for members in cls.together(r):
            key = columns[members[0]].astype(np.uint16) if len(members) > 1 else None
            for j in members[1:]:
                key = key * np.uint16(r.sizes[r.columns[j]]) + columns[j]
            keys.append(key)
        # Units are at most 2^30 of the largest weight.
        g, h = (v.astype(np.int32) for v in gradients(y.take(rows), weight.take(rows), margin.take(rows), r.unit))
        return cls(columns, keys, g, h)

    def add_to(self, total: np.ndarray, r: _Round, arrays: tuple[np.ndarray, ...], nodes: list[int]) -> None:
        """Add [leaf, column, bin, (gradient, hessian, rows)] of some leaves."""
        feature, at_most, missing_left, left, right = (a.tolist() for a in arrays)
        place = {int(f): j for j, f in enumerate(r.columns)}
        parent = {side[i]: i for i, f in enumerate(feature) if f >= 0 for side in (left, right)}
        wanted = {n: i for i, n in enumerate(nodes)}
        above: set[int] = set()
        for n in nodes:
            while n in parent and parent[n] not in above:
                n = parent[n]
                above.add(n)
        own: dict[int, np.ndarray] = {0: np.arange(len(self.g))}
        found = []
        for node in range(len(feature)):
            rows = own.pop(node, None)
            if rows is None:
                continue
            if node in wanted:
                found.append((wanted[node], rows))
            if node in above:
                j = place[feature[node]]
                own[left[node]], own[right[node]] = _sides(self.columns[j], rows, at_most[node], missing_left[node])
        few = []
        for i, rows in found:
            values = self.g.take(rows), self.h.take(rows), None
            alone = []
            for members, key in zip(self.together(r), self.keys):
                shape = tuple(r.sizes[r.columns[j]] for j in members)
                if key is None or len(rows) < COUNTED * math.prod(shape):
                    alone += members
                    continue
                cells = key.take(rows).astype(np.intp)
                for k, v in enumerate(values):
                    table = np.bincount(cells, v, math.prod(shape)).reshape(shape)
                    for a, j in enumerate(members):
                        total[i, j, :shape[a], k] += table.sum(axis=tuple(b for b in range(len(shape)) if b != a)).astype(np.int64)
            if alone:
                few.append((i, rows, tuple(alone)))
        # Leaves of few rows are counted together, column by column.
        for alone in {f[2] for f in few}:
            parts = [(i, rows) for i, rows, a in few if a == alone]
            rows = np.concatenate([rows for _, rows in parts])
            leaf = np.repeat(np.arange(len(parts)) * r.n_bins, [len(rows) for _, rows in parts])
            at, values = [i for i, _ in parts], (self.g.take(rows), self.h.take(rows), None)
            for j in alone:
                cells = leaf + self.columns[j].take(rows)
                for k, v in enumerate(values):
                    total[at, j, :, k] += np.bincount(cells, v, len(parts) * r.n_bins).reshape(len(parts), r.n_bins).astype(np.int64)


class _Shard:
    """Blocks of one task, with the rows of every leaf of the tree that is grown."""

    def __init__(self, blocks: list[Block], sizes: Sequence[int], unit: float):
        self.blocks, self.unit, self.sizes = blocks, unit, sizes
        self.number, bins, self.y, self.weight, self.held, self.margin = (
            c[0] if len(c) == 1 else np.concatenate(c) for c in list(zip(*blocks))[:6])
        self.margin = self.margin.copy()
        self.columns = np.ascontiguousarray(bins.T)
        self.history: list[np.ndarray] = []
        self.together = []
        for members in packed(sizes):
            key = np.zeros(len(self.y), np.uint16) if len(members) > 1 else None
            for f in members if len(members) > 1 else ():
                key = key * np.uint16(sizes[f]) + self.columns[f]
            self.together.append((members, tuple(sizes[f] for f in members), key))

    def begin(self, r: _Round) -> None:
        """The root of a new tree."""
        self.g, self.h = gradients(self.y, self.weight, self.margin, self.unit)
        own = drawn(self.number, self.held, r.cfg, r.number)
        self.rows = {0: (np.flatnonzero(own), np.flatnonzero(~own))}

    def split(self, node: int, arrays: tuple[np.ndarray, ...]) -> None:
        feature, at_most, missing_left, left, right = arrays
        goes_left = np.zeros(max(self.sizes) + 1, bool)
        goes_left[1:at_most[node] + 1] = True
        goes_left[0] = missing_left[node]
        column, sides = self.columns[feature[node]], ([], [])
        for rows in self.rows.pop(node):
            side = goes_left.take(column.take(rows))
            sides[0].append(rows[side])
            sides[1].append(rows[~side])
        self.rows[int(left[node])], self.rows[int(right[node])] = map(tuple, sides)

    def histograms(self, r: _Round, arrays: tuple[np.ndarray, ...], nodes: list[int]) -> np.ndarray:
        """[leaf, column, bin, (gradient, hessian, rows)] of some leaves, in whole numbers."""
        inner = np.flatnonzero(arrays[0] >= 0).tolist()
        parent = {int(arrays[side][i]): i for i in inner for side in (3, 4)}
        total = np.zeros((len(nodes), len(r.columns), r.n_bins, 3), np.int64)
        place = {f: j for j, f in enumerate(r.columns.tolist())}
        for i, node in enumerate(nodes):
            way = [node]
            while way[-1] not in self.rows:
                way.append(parent[way[-1]])
            for above in way[:0:-1]:
                self.split(above, arrays)
            rows = self.rows[node][0]
            values = self.g.take(rows), self.h.take(rows), None
            for members, shape, key in self.together:
                wanted = [f for f in members if f in place]
                cells = math.prod(shape)
                if len(wanted) > 1 and len(rows) >= COUNTED * cells:
                    own = key.take(rows).astype(np.intp)
                    for k, v in enumerate(values):
                        table = np.bincount(own, v, cells).reshape(shape)
                        for f in wanted:
                            at = members.index(f)
                            total[i, place[f], :shape[at], k] = table.sum(axis=tuple(a for a in range(len(shape)) if a != at))
                else:
                    for f in wanted:
                        own = self.columns[f].take(rows).astype(np.intp)
                        for k, v in enumerate(values):
                            total[i, place[f], :, k] = np.bincount(own, v, r.n_bins)
        return total

    def end(self, tree: Tree, grown: Tree, number: dict[int, int]) -> None:
        """Margins after a tree, of which more was grown than stayed."""
        arrays, value = grown.arrays(), {}
        for node in range(len(grown.feature)):
            if node in number and tree.feature[number[node]] < 0:
                value[node] = tree.value[number[node]]
            elif node in number and node in self.rows:
                self.split(node, arrays)
            if node in self.rows:
                for rows in self.rows[node]:
                    self.margin[rows] += value[node]
            if node in value and grown.feature[node] >= 0:
                value[grown.left[node]] = value[grown.right[node]] = value[node]
        self.history.append(self.margin[self.held])

    def after(self) -> Iterator[Block]:
        """The blocks with their margins after all rounds."""
        at = before = 0
        for number, bins, y, weight, held, _, _ in self.blocks:
            end, upto = at + len(y), before + int(held.sum())
            yield number, bins, y, weight, held, self.margin[at:end], tuple(m[before:upto] for m in self.history)
            at, before = end, upto


def packed(sizes: Sequence[int]) -> list[list[int]]:
    """Columns that are counted together: as many as fit a table of CELLS cells, by the sizes of their bins."""
    out: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
        fits = next((g for g in out if math.prod(sizes[o] for o in g) * sizes[f] <= CELLS), None)
        if fits is None:
            out.append([f])
        else:
            fits.append(f)
    return out


def _shards(blocks: Iterable[Block], sizes: Sequence[int], unit: float) -> list[_Shard]:
    out, part, n = [], [], 0
    for b in blocks:
        if part and n + len(b[2]) > SHARD_ROWS:
            out.append(_Shard(part, sizes, unit))
            part, n = [], 0
        part.append(b)
        n += len(b[2])
    return [*out, _Shard(part, sizes, unit)] if part else out


def _in_one_task(state: RDD, rounds: list[_Round]) -> tuple[RDD, RDD, list[Tree]]:
    """The same for one partition: one job for all rounds."""
    def run(blocks: Iterator[Block]):
        shards = _shards(blocks, rounds[0].sizes, rounds[0].unit)
        for r in rounds:
            for s in shards:
                s.begin(r)
            grown: list = []
            tree = r.tree(lambda arrays, nodes: sum(s.histograms(r, arrays, nodes) for s in shards), grown)
            for s in shards:
                s.end(tree, *grown)
            yield True, vars(tree)
        for s in shards:
            for b in s.after():
                yield False, b

    told = state.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK)
    trees = [Tree(**t) for t in told.filter(lambda t: t[0]).values().collect()]
    return told.filter(lambda t: not t[0]).values(), told, trees


def _dealt(state: RDD, parts: int) -> RDD:
    """As many blocks in each of some partitions, give or take one."""
    return state.zipWithIndex().map(lambda b: (b[1], b[0])).partitionBy(parts, lambda i: i).values()


@dataclass(frozen=True)
class _Split:
    gain: float
    column: int  # place among the tree's columns
    bin: int
    missing_left: bool
    left: np.ndarray  # gradient, hessian, rows
    right: np.ndarray


def best_split(histogram: np.ndarray, cfg: TreeConfig, unit: float) -> _Split | None:
    """The split with the largest gain; of equal ones the first column, then the lowest bin."""
    total = histogram[0].sum(axis=0)
    upto = np.cumsum(histogram[:, 1:], axis=1)
    # Missing values go right or left; behind the last bin they alone go right.
    left = np.stack([upto, upto + histogram[:, :1]], axis=2)
    right = total - left
    (gl, hl, nl), (gr, hr, nr) = (np.moveaxis(side, -1, 0) for side in (left, right))
    score = lambda g, h: (g / unit) ** 2 / np.maximum(h / unit + cfg.l2, 1e-12)
    fits = (nl >= max(1, cfg.min_rows)) & (nr >= max(1, cfg.min_rows)) & (hl >= cfg.min_hessian * unit) & (hr >= cfg.min_hessian * unit)
    if not fits.any():
        return None
    gain = np.where(fits, score(gl, hl) + score(gr, hr) - score(total[0], total[1]), -math.inf)
    column, at, side = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[column, at, side] <= LEAST_GAIN:
        return None
    own = left[column, at, side], right[column, at, side]
    missing = histogram[column, 0, 2]
    # Where no row was without a value, later ones follow the larger side.
    return _Split(float(gain[column, at, side]), int(column), int(at) + 1, bool(side) if missing else bool(own[0][2] >= own[1][2]), *own)


def grow(count: Callable[[Tree, list[int]], dict[int, np.ndarray]], cfg: TreeConfig, unit: float, columns: np.ndarray,
         grown: list | None = None) -> Tree:
    """One tree. ``count`` is asked for several leaves at once; the tree is that of splitting the best leaf, one at a time.

    ``grown`` gets all that was looked at, as a tree, and the numbers in the result of what stayed of it.
    """
    tree = Tree()
    tree.add(0)
    most = cfg.leaves or 1 << cfg.depth
    histograms = count(tree, [0])
    sums = {0: histograms[0][0].sum(axis=0)}
    depth, children = {0: 0}, {}
    split = {0: best_split(histograms[0], cfg, unit) if cfg.depth else None}

    def chosen() -> tuple[list[int], list[int]]:
        """Nodes that are split in order, as far as known, and the leaves to be looked at before it can go on."""
        queue, done = [(-split[0].gain, 0)] if split[0] else [], []
        while queue and len(done) + 1 < most:
            _, node = heapq.heappop(queue)
            if node not in children:
                # Each split takes one leaf from the limit, so no more of the waiting ones can come up. Those that wait below a leaf not yet
                # split come up too, unless the limit is met before.
                waiting = [n for _, n in sorted((-s.gain, n) for n, s in split.items() if s and n not in children and n != node)]
                return done, [node, *waiting[:most - len(done) - 2]]
            done.append(node)
            for c in children[node]:
                if split[c]:
                    heapq.heappush(queue, (-split[c].gain, c))
        return done, []

    while True:
        done, needed = chosen()
        if not needed:
            break
        wanted = []
        for node in needed:
            s = split[node]
            pair = children[node] = tree.add(0), tree.add(0)
            tree.feature[node], tree.bin[node], tree.missing_left[node] = int(columns[s.column]), s.bin, s.missing_left
            tree.left[node], tree.right[node] = pair
            for c, own in zip(pair, (s.left, s.right)):
                sums[c], depth[c], split[c] = own, depth[node] + 1, None
            if depth[node] + 1 < cfg.depth:
                wanted.append(pair[0] if s.left[2] <= s.right[2] else pair[1])
        counted = count(tree, wanted) if wanted else {}
        for node in needed:
            parent = histograms.pop(node)
            small = next((c for c in children[node] if c in counted), None)
            if small is not None:
                other = sum(children[node]) - small
                histograms[small], histograms[other] = counted[small], parent - counted[small]
                for c in children[node]:
                    split[c] = best_split(histograms[c], cfg, unit)
    # Only what was chosen stays; the rest was looked at for nothing.
    out, number, order = Tree(), {}, [0]
    keep = set(done)
    for node in order:
        number[node] = out.add(int(sums[node][2]))
        order += children[node] if node in keep else ()
    for node in order:
        i, s = number[node], split[node]
        if node in keep:
            out.feature[i], out.bin[i], out.missing_left[i], out.gain[i] = tree.feature[node], s.bin, s.missing_left, s.gain
            out.left[i], out.right[i] = (number[c] for c in children[node])
        else:
            g, h = sums[node][0] / unit, sums[node][1] / unit
            out.value[i] = -cfg.step * g / max(h + cfg.l2, 1e-12)
    if grown is not None:
        grown += [tree, number]
    return out


def _counted(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct scores, the largest first, with their positives and negatives."""
    order = np.argsort(-score)
    score = score[order]
    new = np.flatnonzero(np.concatenate([[True], score[1:] != score[:-1]])) if len(score) else np.zeros(0, np.intp)
    return score[new], *(np.add.reduceat(c[order], new) if len(new) else c for c in (pos, neg))


def _prefix_precision(state: RDD, first: int, n_held: int) -> list[float]:
    """Average precision of the ``n_held`` validation rows after each round of the chunk that begins with round ``first``."""
    ranges = -(-n_held // RANKED_ROWS)

    def rounds(blocks: Iterator[Block]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        kept = [(b[6], b[2][b[4]].astype(np.int64)) for b in blocks]
        y = np.concatenate([k[1] for k in kept]) if kept else np.zeros(0, np.int64)
        for i in range(len(kept[0][0]) if kept else 0):
            yield i, np.concatenate([k[0][i] for k in kept]), y

    cuts: dict[int, np.ndarray] = {}
    if ranges > 1:
        # Regular samples of every task's margins; only the balance of the ranges depends on them.
        def sample(blocks: Iterator[Block]):
            for i, score, _ in rounds(blocks):
                if len(score):
                    yield i, np.quantile(score, np.linspace(0, 1, 8 * ranges + 1), method="nearest")

        found: dict[int, list] = {}
        for i, points in state.mapPartitions(sample).collect():
            found.setdefault(i, []).append(points)
        for i, points in found.items():
            cuts[i] = np.unique(np.quantile(np.concatenate(points), np.arange(1, ranges) / ranges, method="nearest"))

    def parts(blocks: Iterator[Block]):
        for i, score, y in rounds(blocks):
            score, pos, neg = _counted(score, y, 1 - y)
            # Scores fall, and so do the ranges.
            ends = np.concatenate([[0], np.searchsorted(-score, -cuts.get(i, np.zeros(0))[::-1], side="left"), [len(score)]])
            for k, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
                if lo < hi:
                    yield (i, k), (score[lo:hi], pos[lo:hi], neg[lo:hi])

    def merged(tables: Iterable[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
        _, pos, neg = _counted(*(np.concatenate(c) for c in zip(*tables)))
        return np.cumsum(pos), np.cumsum(neg)

    tables = state.mapPartitions(parts).groupByKey(max(state.getNumPartitions(), CHUNK * (ranges > 1))).mapValues(merged)
    tables = tables.persist(StorageLevel.MEMORY_AND_DISK) if ranges > 1 else tables
    before: dict[tuple[int, int], tuple[int, int]] = {}
    if ranges > 1:
        run: dict[int, tuple[int, int]] = {}
        for (i, k), (p, n) in sorted(tables.mapValues(lambda t: (int(t[0][-1]), int(t[1][-1]))).collect()):
            before[i, k] = run.get(i, (0, 0))
            run[i] = before[i, k][0] + p, before[i, k][1] + n

    def part(t) -> tuple[int, tuple[float, int]]:
        (i, k), (pos, neg) = t
        p, n = before.get((i, k), (0, 0))
        return i, (float((np.diff(pos, prepend=0) * ((p + pos) / (p + pos + n + neg))).sum()), int(pos[-1]))

    sums: dict[int, list] = {}
    for i, own in tables.map(part).collect():  # a number for each round and range
        sums.setdefault(i, []).append(own)
    if ranges > 1:
        tables.unpersist()
    out = []
    for i in sorted(sums):
        hits = sum(p for _, p in sums[i])
        # Rounded, so that the ranges, which differ between runs, prefer no round by the last digits.
        out.append(round(math.fsum(a for a, _ in sums[i]) / hits, 13) if hits else math.nan)
    return out


def fit(rows: DataFrame, features_col: str, label: str, cfg: TreeConfig = TreeConfig(), weight: str | None = None,
        validation: str | None = None) -> "BoostedTrees":
    """Train on a vector column. Rows marked by ``validation`` (null: not marked) are only scored, to stop and to cut the ensemble.

    Missing values are NaN in the vector. A null weight counts as 1, a null label leaves the row out. Without rows, or with one class
    only, the model has no trees and answers the share of positives. Partitions must hold the same rows in the same order whenever they
    are computed, or be written, for the model to be the same each time; the caller deals them.
    """
    spark = rows.sparkSession
    plain = rows.where(F.col(label).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), vector_to_array(features_col).alias("x"), F.col(label).cast("double").alias("y"),
        F.coalesce(F.col(weight).cast("double"), F.lit(1.0)).alias("w") if weight else F.lit(1.0).alias("w"),
        F.coalesce(F.col(validation).cast("boolean"), F.lit(False)).alias("held") if validation else F.lit(False).alias("held"),
    )
    plain = cut_lineage(plain, "rows")
    own = F.when(~F.col("held"), F.col("w"))
    about = plain.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width"), F.max("w").alias("heaviest"), F.sum(own).alias("total"),
        F.sum(own * F.col("y")).alias("positive"), F.count_if("held").alias("n_held"),
    ).first()
    width, total, positive = about["width"] or 0, about["total"] or 0.0, about["positive"] or 0.0
    share = positive / total if total else 0.5
    if not 0 < share < 1 or not width:
        return BoostedTrees.of(features_col, width, [], [np.zeros(0)] * width, math.log((share + 1e-9) / (1 - share + 1e-9)), 0, [])
    base = math.log(share / (1 - share))
    cuts = bin_cuts(plain, width, about["n"], cfg.bins)
    sizes = [len(points) + 2 for points in cuts]
    # All sums of whole numbers stay below 2^62, those of a block below 2^53.
    unit = 2.0 ** min(30, 61 - math.ceil(math.log2(about["n"] + 1))) / max(about["heaviest"], 1e-12)
    blocks = cut_lineage(_blocks(plain.coalesce(-(-about["n"] // BINNED_ROWS)), cuts), "blocks")
    state = _state(blocks, width, base)
    size = about["n"] * (3 * width + 96)
    if about["n"] <= PARTITION_ROWS and size <= TASK_BYTES:
        state, grower = state.coalesce(1), _in_one_task
    else:
        cores = spark.sparkContext.defaultParallelism
        # Columns one after the other; as many tasks as cores, or a multiple.
        state = _dealt(state, cores * -(-size // (cores * TASK_BYTES))).map(lambda b: (b[0], np.asfortranarray(b[1]), *b[2:]))
        grower = _over_cluster
    trees: list[Tree] = []
    scores: list[float] = []
    in_memory: list[RDD] = []
    while len(trees) < cfg.rounds:
        numbers = range(len(trees), min(len(trees) + CHUNK, cfg.rounds))
        rounds = [_Round.of(cfg, r, unit, sizes) for r in numbers]
        state, kept, grown = grower(state, rounds)
        trees += grown
        for earlier in in_memory:
            earlier.unpersist()
        in_memory = [kept]
        state.checkpoint()
        if about["n_held"]:
            scores += _prefix_precision(state, len(scores), about["n_held"])
            if len(scores) == len(trees) and len(trees) - 1 - _best(scores) >= cfg.patience:
                break
        state = state.map(lambda b: (*b[:-1], ()))
    for last in in_memory:
        last.unpersist()
    best = _best(scores) + 1 if scores else len(trees)
    return BoostedTrees.of(features_col, width, trees[:best], cuts, base, len(trees), scores)


def _best(scores: list[float]) -> int:
    """The first round with the largest score."""
    return int(np.argmax(np.nan_to_num(np.array(scores), nan=-1.0)))


class BoostedTrees(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted ensemble: adds ``probability`` (vector of two) and ``prediction``. Saved with its settings as one line of JSON."""

    trees = Param(Params._dummy(), "trees", "the trees, as JSON", TypeConverters.toString)
    width = Param(Params._dummy(), "width", "features", TypeConverters.toInt)
    base = Param(Params._dummy(), "base", "margin without any tree", TypeConverters.toFloat)
    roundsRun = Param(Params._dummy(), "roundsRun", "rounds trained, of which the best prefix was kept", TypeConverters.toInt)
    precisions = Param(Params._dummy(), "precisions", "average precision of the validation rows after each round", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()
        self._unpacked = None

    @classmethod
    def of(cls, features_col: str, width: int, trees: list[Tree], cuts: Sequence[np.ndarray], base: float, rounds_run: int, scores: list[float]) -> "BoostedTrees":
        packed = []
        for t in trees:
            # A value goes left if it isn't above the number just below the cut point, that is, if it is below the cut point.
            ends = [np.append(np.nextafter(points, -math.inf), math.inf) for points in cuts]
            thresholds = [float(ends[f][b - 1]) if f >= 0 else 0.0 for f, b in zip(t.feature, t.bin)]
            packed.append({"feature": t.feature, "threshold": thresholds, "missing_left": [int(m) for m in t.missing_left], "left": t.left,
                           "right": t.right, "value": t.value, "gain": t.gain, "cover": t.cover})
        out = cls()
        out._set(featuresCol=features_col, trees=json.dumps(packed), width=width, base=float(base), roundsRun=rounds_run,
                 precisions=[float(s) if not math.isnan(s) else -1.0 for s in scores])
        return out

    @property
    def numFeatures(self) -> int:
        return self.getOrDefault("width")

    @property
    def getNumTrees(self) -> int:
        return len(self.unpacked())

    def unpacked(self) -> list[dict[str, np.ndarray]]:
        """The trees as arrays by node."""
        if self._unpacked is None:
            kinds = {"feature": np.int32, "threshold": float, "missing_left": bool, "left": np.int32, "right": np.int32, "value": float, "gain": float, "cover": float}
            self._unpacked = [{k: np.array(t[k], kind) for k, kind in kinds.items()} for t in json.loads(self.getOrDefault("trees"))]
        return self._unpacked

    def nodes(self) -> pd.DataFrame:
        """(tree, node, left, right, feature, threshold, missing_left, prediction, gain, cover), a row for every node."""
        tables = [pd.DataFrame({"tree": i, "node": np.arange(len(t["feature"])), "left": t["left"], "right": t["right"], "feature": t["feature"],
                                "threshold": t["threshold"], "missing_left": t["missing_left"], "prediction": t["value"], "gain": t["gain"], "cover": t["cover"]})
                  for i, t in enumerate(self.unpacked())]
        names = ["tree", "node", "left", "right", "feature", "threshold", "missing_left", "prediction", "gain", "cover"]
        return pd.concat(tables, ignore_index=True) if tables else pd.DataFrame(columns=names)

    @property
    def featureImportances(self) -> DenseVector:
        """Gain of each feature's splits, as shares of all gain."""
        total = np.zeros(self.numFeatures)
        for t in self.unpacked():
            inner = t["feature"] >= 0
            np.add.at(total, t["feature"][inner], t["gain"][inner])
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of rows of features."""
        out = np.full(len(x), self.getOrDefault("base"))
        for t in self.unpacked():
            out += t["value"][leaf_of(t, x)]
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, base = self.unpacked(), self.getOrDefault("base")

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_numpy()).astype(float) if len(x) else np.zeros((0, 1))
            out = np.full(len(rows), base)
            for t in trees:
                out += t["value"][leaf_of(t, rows)]
            return pd.Series(out)

        p = 1.0 / (1.0 + F.exp(-F.col("__margin")))
        scored = dataset.withColumn("__margin", margin(vector_to_array(self.getFeaturesCol())))
        scored = scored.withColumn("probability", array_to_vector(F.array(1.0 - p, p)))
        return scored.withColumn("prediction", (F.col("__margin") > 0).cast("double")).drop("__margin")


def leaf_of(t: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The leaf of every row of features."""
    node = np.zeros(len(x), np.int32)
    rows = np.arange(len(x)) if t["feature"][0] >= 0 else np.zeros(0, int)
    while len(rows):
        own = node[rows]
        value = x[rows, t["feature"][own]]
        goes_left = np.where(np.isnan(value), t["missing_left"][own], value <= t["threshold"][own])
        node[rows] = own = np.where(goes_left, t["left"][own], t["right"][own])
        rows = rows[t["feature"][own] >= 0]
    return node
