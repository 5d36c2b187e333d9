"""Boosted trees grown best leaf first, for numbers and for classes.

Readings become small integers (bins between quantile edges) once. A round sums gradients by (tree, leaf, column, bin) in
tasks; the sums of a leaf meet in one task, which chooses its split, and the driver sees one short row for each leaf. Trees
grow by splitting the leaf that gains most. One pass over the rows serves every leaf that can be next, so a tree of 31 leaves
takes about as many passes as it has levels. All classes' trees of a round grow side by side from one gradient table.

Gradients are summed as integers, so the same rows give the same trees in any order and partitioning. Scores are kept
beside the rows and written to the shared folder every few rounds, which cuts the lineage and survives lost executors.
Up to LOCAL_ROWS rows one task holds them and grows all rounds by the same sums, as jobs would take longer than the work.
A model is a table of nodes (`operators/trees.py`). Rows without a target are left out; a missing reading goes right.
"""

import heapq
import math
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F

from frostline.operators.quantiles import quantiles
from frostline.operators.trees import Forest, Input
from frostline.workspace import fresh_path, remove

#: Bits that a sum of gradients may have, those behind the point that one gradient has at most, and those of first scores.
_SUM_BITS, _POINT_BITS, _MEAN_BITS = 62, 40, 24
_DRAWS = 1_000_000
#: Rows for which a task is worth starting.
_TASK_ROWS = 50_000
#: Rows that a task holds at most.
_MOST_ROWS = 1_000_000
#: Leaves whose sums meet in one task.
_TASK_LEAVES = 32
#: Rows up to which one task grows all rounds.
LOCAL_ROWS = 300_000

#: Gradients and hessians of rows, from their scores, targets and weights; one column for each tree of a round.
Gradients = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Boosting:
    """Settings of a fit."""
    rounds: int = 700
    learning_rate: float = 0.03
    leaves: int = 31
    min_rows: int = 20
    min_hessian: float = 1e-3
    subsample: float = 0.8
    columns: float = 0.9
    bins: int = 63
    shrink: float = 0.0  # added to the hessian of a leaf
    seed: int = 42
    kept_rounds: int = 25  # rounds between two written states

    def copy(self, **changes) -> "Boosting":
        return replace(self, **changes)


@dataclass
class Node:
    """A leaf, or a split once it has children; sums over its rows, as tables of one column and bin."""
    gradient: np.ndarray | None = None
    hessian: np.ndarray | None = None
    rows: np.ndarray | None = None
    split: tuple[float, int, int] | None = None  # gain, column, last bin on the left
    left: int = -1
    right: int = -1


@dataclass
class Tree:
    """A growing tree. Splits are tried ahead of their turn; `accepted` are those that best-first growth makes."""
    nodes: list[Node] = field(default_factory=lambda: [Node()])
    accepted: list[int] = field(default_factory=list)

    def advance(self, leaves: int) -> list[int]:
        """Repeat best-first growth as far as sums are known; the nodes whose children it needs next."""
        self.accepted, needed = [], []
        queue = [(-self.nodes[0].split[0], 0)] if self.nodes[0].split else []
        while queue and len(self.accepted) + len(needed) < leaves - 1:
            _, at = heapq.heappop(queue)
            node = self.nodes[at]
            if node.left < 0:
                needed.append(at)
                continue
            if not needed:  # what comes after an unknown gain is no more than a guess
                self.accepted.append(at)
            for child in (node.left, node.right):
                if self.nodes[child].split:
                    heapq.heappush(queue, (-self.nodes[child].split[0], child))
        return needed

    def depth(self) -> int:
        level, found = [0], -1
        while level:
            found, level = found + 1, [c for n in level if self.nodes[n].left >= 0 for c in (self.nodes[n].left, self.nodes[n].right)]
        return found

    def kept(self) -> "Tree":
        """The accepted splits alone, nodes numbered anew from the root."""
        out, place = [], {0: 0}
        for old in self._accepted_order():
            node = self.nodes[old]
            out.append(replace(node, left=-1, right=-1))
            if old in self.accepted:
                for child in (node.left, node.right):
                    place[child] = len(place)
        for old, new in place.items():
            if old in self.accepted:
                out[new].left, out[new].right = place[self.nodes[old].left], place[self.nodes[old].right]
        return Tree(out, [place[n] for n in self.accepted])

    def _accepted_order(self) -> Iterator[int]:
        queue, at = [0], 0
        while at < len(queue):
            yield queue[at]
            if queue[at] in self.accepted:
                queue += [self.nodes[queue[at]].left, self.nodes[queue[at]].right]
            at += 1


def best_split(sums: np.ndarray, widths: list[int], allowed: list[int], settings: Boosting, unit: float) -> tuple[float, int, int] | None:
    """The split of most gain among the allowed columns, whose gradients, hessians and rows by bin are given; ties go to the
    first column and bin."""
    gradient, hessian, rows = (float(x[0].sum()) for x in sums)
    gradient, hessian = gradient / unit, hessian / unit
    whole = gradient * gradient / (hessian + settings.shrink) if hessian + settings.shrink > 0 else 0.0
    cuts = np.array([widths[c] - 1 for c in allowed])
    g, h, n = (np.cumsum(x[:len(allowed), :max(cuts.max(), 0)], axis=1) for x in sums)
    g, h = g / unit, h / unit
    fits = (n >= settings.min_rows) & (rows - n >= settings.min_rows) & (h >= settings.min_hessian) & (hessian - h >= settings.min_hessian)
    fits &= np.arange(n.shape[1]) < cuts[:, None]
    if not fits.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / (h + settings.shrink) + (gradient - g) ** 2 / (hessian - h + settings.shrink) - whole
    gain = np.where(fits, gain, -np.inf)
    i, top = divmod(int(np.argmax(gain)), gain.shape[1])
    return (float(gain[i, top]), allowed[i], top) if gain[i, top] > 1e-12 else None


def fit_edges(df: DataFrame, inputs: list[Input], feature_set: str, bins: int) -> list[list[float]]:
    """For each input the values that a split may have, in order."""
    numbers = Forest(inputs, *[np.zeros(1)] * 7, feature_set=feature_set).numbers()
    names = [f"x{i}" for i, n in enumerate(inputs) if n.category is None]
    found = df.select(*[numbers[int(n[1:])].alias(n) for n in names])
    marks = {r["feature"]: r for r in quantiles(found, names, [i / bins for i in range(1, bins)]).collect()} if names else {}
    edges = []
    for i, n in enumerate(inputs):
        row = marks.get(f"x{i}")
        # The last edge has nothing above it when it is the largest value; such a split has no rows on the right.
        edges.append([0.5] if n.category is not None else sorted({row[f"q{j}"] for j in range(bins - 1)}) if row else [])
    return edges


BLOCKS = "n bigint, largest double, bins binary, y binary, w binary, s binary, draw binary"


def bin_type(widths: list[int]) -> type:
    """The smallest integers that hold the bins of these columns."""
    return np.uint8 if max(widths, default=1) <= 256 else np.int32


def _binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def binned(df: DataFrame, inputs: list[Input], feature_set: str, edges: list[list[float]], base: tuple[float, ...], target: Column,
           weight: Column, draw: Column) -> DataFrame:
    """Blocks of rows: their number, the largest weighted target, and as bytes how many edges lie below each input, targets,
    weights, first scores and draws. A block is one row, so that passes don't take rows apart outside Python."""
    numbers = Forest(inputs, *[np.zeros(1)] * 7, feature_set=feature_set).numbers()
    rows = df.select(*[n.alias(f"x{i}") for i, n in enumerate(numbers)], target.alias("y"), weight.alias("w"), draw.alias("draw"))
    kind = bin_type([len(e) + 1 for e in edges])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                columns = [batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in range(len(edges))]
                # NaN, missing too, is above all
                bins = np.column_stack([np.searchsorted(e, x).astype(kind) for e, x in zip(edges, columns)])
                y, w = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in "yw")
                draws = batch.column("draw").to_numpy(zero_copy_only=False).astype(np.int64)
                large = np.nan_to_num(w * np.maximum(1.0, np.abs(y)), nan=0.0).max()
                packed = [pa.array([_binary(x)], pa.binary()) for x in (bins, y, w, np.tile(np.array(base), (n, 1)), draws)]
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([large]), *packed], [c.split()[0] for c in BLOCKS.split(", ")])

    return rows.mapInArrow(made, BLOCKS)


def spread(blocks: DataFrame, n: int, task_rows: int = _TASK_ROWS) -> DataFrame:
    """Blocks over as many tasks as are worth starting."""
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    return blocks.repartition(max(1, min(-(-n // task_rows), 4 * cores), -(-n // _MOST_ROWS)))


def _levels(tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Column, last bin on the left and children of each node, a leaf being its own; and the depth."""
    inner = [n.left >= 0 for n in tree.nodes]
    column = np.array([n.split[1] if i else 0 for n, i in zip(tree.nodes, inner)])
    cut = np.array([n.split[2] if i else 0 for n, i in zip(tree.nodes, inner)])
    child = np.array([(n.left, n.right) if i else (at, at) for at, (n, i) in enumerate(zip(tree.nodes, inner))])
    return column, cut, child, tree.depth()


def _reached(bins: np.ndarray, levels: tuple) -> np.ndarray:
    """The node that each row has reached."""
    column, cut, child, depth = levels
    node, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        node = child[node, (bins[row, column[node]] > cut[node]).astype(np.int64)]
    return node


def unpacked(batch: pa.RecordBatch, kind: type) -> Iterator[tuple[np.ndarray, ...]]:
    """bins, y, w, s and draw of each block."""
    n = batch.column("n").to_numpy()
    for i in range(batch.num_rows):
        held = {c: batch.column(c)[i].as_buffer() for c in ("bins", "y", "w", "s", "draw")}
        bins, y, w, s, draw = (np.frombuffer(held[c], t) for c, t in (("bins", kind), ("y", float), ("w", float), ("s", float), ("draw", np.int64)))
        yield bins.reshape(n[i], -1), y, w, s.reshape(n[i], -1), draw


def _summed_by(spot: np.ndarray, halves: list[np.ndarray] | int, rows: np.ndarray) -> np.ndarray:
    """Sums of integers by spot: two halves, each exact as floating numbers; or the same integer in each of so many rows."""
    if isinstance(halves, int):
        return rows * halves
    high, low = (np.bincount(spot, half, len(rows)).astype(np.int64) for half in halves)
    return (high << 24) + low


def _halves(values: np.ndarray) -> list[np.ndarray] | int:
    """Integers as the bits above and below 24, or as one integer where all are the same."""
    if (values == values[0]).all():
        return int(values[0])
    return [(values >> 24).astype(np.float64), (values & 0xFFFFFF).astype(np.float64)]


def _slots(trees: list[Tree], wanted: list[list[int]]) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """The wanted nodes (tree, node) in their order, and for each tree's nodes their place in it or -1."""
    names = [(k, n) for k, nodes in enumerate(wanted) for n in nodes]
    slots = [np.full(len(t.nodes), -1) for t in trees]
    for at, (k, n) in enumerate(names):
        slots[k][n] = at
    return names, slots


def _add(total: np.ndarray, bins: np.ndarray, g: np.ndarray, h: np.ndarray, levels: list[tuple], slots: list[np.ndarray],
         allowed: list[list[int]], width: int, unit: float) -> None:
    """Add gradients, hessians and numbers of rows to `total` by (allowed column, slot and bin)."""
    for k, (level, slot) in enumerate(zip(levels, slots)):
        place = slot[_reached(bins, level)]
        mine = np.flatnonzero(place >= 0)
        if not len(mine):
            continue
        begin, own = place[mine] * width, bins[mine]
        parts = [_halves(np.rint(v[mine, k] * unit).astype(np.int64)) for v in (g, h)]
        for i, c in enumerate(allowed[k]):
            spot = begin + own[:, c]
            n = np.bincount(spot, minlength=total.shape[2])
            total[2, i] += n
            for into, halves in zip(total, parts):
                into[i] += _summed_by(spot, halves, n)


def _splits(rows: DataFrame, trees: list[Tree], wanted: list[list[int]], widths: list[int], allowed: list[list[int]], gradients: Gradients,
            settings: Boosting, unit: float) -> dict[tuple[int, int], Row]:
    """Gradients, hessians and rows of the wanted nodes of each tree over the rows drawn, and their best split (column -1: none)."""
    levels, width, kind = [_levels(t) for t in trees], max(widths), bin_type(widths)
    names, slots = _slots(trees, wanted)
    tried, limit = max(map(len, allowed)), round(_DRAWS * settings.subsample)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, tried, len(names) * width), np.int64)
        for bins, y, w, s, draw in (block for batch in batches for block in unpacked(batch, kind)):
            kept = draw % _DRAWS < limit
            _add(total, bins[kept], *gradients(s[kept], y[kept], w[kept]), levels, slots, allowed, width, unit)
        total = total.reshape(3, tried, len(names), width)
        held = np.flatnonzero(total[2, 0].any(axis=1))
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array([_binary(total[:, :, i]) for i in held], pa.binary())], ["slot", "sums"])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, packed in zip(batch.column("slot").to_pylist(), batch.column("sums").to_pylist()):
                met[slot] = met.get(slot, 0) + np.frombuffer(packed, np.int64).reshape(3, tried, width)
        made = []
        for slot, total in met.items():
            best = best_split(total, widths, allowed[names[slot][0]], settings, unit)
            made.append((slot, *(int(x[0].sum()) for x in total), *(best or (0.0, -1, -1))))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*made)], ["slot", "g", "h", "n", "gain", "col", "cut"])

    met = rows.mapInArrow(sums, "slot bigint, sums binary").repartition(-(-len(names) // _TASK_LEAVES), "slot")
    found = met.mapInArrow(chosen, "slot bigint, g bigint, h bigint, n bigint, gain double, col bigint, cut bigint").collect()  # one row a node
    return {names[r["slot"]]: r for r in found}


def _step(bins: np.ndarray, s: np.ndarray, draw: np.ndarray, levels: list[tuple], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Scores with the leaves of a round's trees, and the next draw."""
    s = s + np.column_stack([v[_reached(bins, level)] for level, v in zip(levels, values)]).reshape(s.shape)
    draw = draw * np.uint64(6364136223846793005) + np.uint64(1442695040888963407)
    return s, (draw ^ (draw >> np.uint64(29))) >> np.uint64(1)


def _moved(rows: DataFrame, rounds: list[tuple[list[Tree], list[np.ndarray]]], kind: type) -> DataFrame:
    """The rows with the leaves of these rounds' trees added to their scores, and the next draw, in one step."""
    steps, names = [([_levels(t) for t in trees], values) for trees, values in rounds], rows.columns

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, draws = [], []
            for bins, _, _, s, draw in unpacked(batch, kind):
                draw = draw.astype(np.uint64)
                for levels, values in steps:
                    s, draw = _step(bins, s, draw, levels, values)
                scores.append(_binary(s))
                draws.append(_binary(draw.astype(np.int64)))
            new = {"s": pa.array(scores, pa.binary()), "draw": pa.array(draws, pa.binary())}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in names], names)

    return rows.mapInArrow(made, rows.schema)


def grow(find: Callable[[list[Tree], list[list[int]]], Mapping], n: int, settings: Boosting) -> list[Tree]:
    """The `n` trees of one round; `find` gives sums and the best split of wanted nodes of each tree."""
    trees = [Tree() for _ in range(n)]
    todo: list[list[int]] = [[0] for _ in trees]
    while any(todo):
        found = find(trees, todo)
        needed = []
        for k, tree in enumerate(trees):
            for at in todo[k]:
                node, sums = tree.nodes[at], found.get((k, at))  # none of no rows
                node.gradient, node.hessian, node.rows = (np.array([[sums[c] if sums else 0]]) for c in "ghn")
                node.split = (sums["gain"], sums["col"], sums["cut"]) if sums and sums["col"] >= 0 else None
            needed.append(tree.advance(settings.leaves))
        todo = []
        for tree, parents in zip(trees, needed):
            part = []
            for parent in parents:
                node = tree.nodes[parent]
                node.left, node.right = len(tree.nodes), len(tree.nodes) + 1
                tree.nodes += [Node(), Node()]
                part += [node.left, node.right]
            todo.append(part)
    return [tree.kept() for tree in trees]


def leaf_values(tree: Tree, settings: Boosting, unit: float) -> np.ndarray:
    """What each node adds to the score as a leaf, before the learning rate."""
    out = []
    for n in tree.nodes:
        g, h = n.gradient[0].sum() / unit, n.hessian[0].sum() / unit
        out.append(float(-g / (h + settings.shrink)) if h + settings.shrink > 0 else 0.0)
    return np.array(out)


def _rounds(state: "_State", gradients: Gradients, widths: list[int], allowed: list[list[list[int]]], settings: Boosting,
            unit: float) -> list[list[Tree]]:
    """The trees of all rounds; `allowed` has the columns of each round's trees."""
    every: list[list[Tree]] = []
    for columns in allowed:
        grown = grow(lambda trees, wanted: _splits(state.rows, trees, wanted, widths, columns, gradients, settings, unit), len(columns), settings)  # noqa: B023
        if all(len(t.nodes) == 1 for t in grown):
            break
        every.append(grown)
        state.update(grown, [leaf_values(t, settings, unit) * settings.learning_rate for t in grown])
    return every


_PACKED = "round bigint, tree bigint, nodes binary, gains binary, accepted binary"


def _packed(tree: Tree) -> list[bytes]:
    nodes = [(*(int(x[0, 0]) for x in (n.gradient, n.hessian, n.rows)), *(n.split[1:] if n.split else (-1, -1)), n.left, n.right) for n in tree.nodes]
    return [_binary(np.array(x, t)) for x, t in ((nodes, np.int64), ([n.split[0] if n.split else 0.0 for n in tree.nodes], float), (tree.accepted, np.int64))]


def _tree(row: Row) -> Tree:
    nodes = np.frombuffer(row["nodes"], np.int64).reshape(-1, 7).tolist()
    made = [Node(*(np.array([[x]]) for x in (g, h, n)), (gain, column, cut) if column >= 0 else None, left, right)
            for (g, h, n, column, cut, left, right), gain in zip(nodes, np.frombuffer(row["gains"]).tolist())]
    return Tree(made, np.frombuffer(row["accepted"], np.int64).tolist())


class _Sums:
    """What `grow` asks for, over rows that one task holds: sums of a smaller child from its rows, of the other from the rest."""

    def __init__(self, places: np.ndarray, kept: np.ndarray, g: np.ndarray, h: np.ndarray, widths: list[int], allowed: list[list[int]],
                 settings: Boosting, unit: float):
        self.places, self.kept, self.widths, self.allowed, self.settings, self.unit = places, kept, widths, allowed, settings, unit
        self.parts = [[_halves(np.rint(v[:, k] * unit).astype(np.int64)) if len(kept) else 0 for v in (g, h)] for k in range(len(allowed))]
        self.open: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}  # rows among the kept, and sums, of nodes without children

    def _sums(self, k: int, rows: np.ndarray) -> np.ndarray:
        parts = [x if isinstance(x, int) else [half.take(rows) for half in x] for x in self.parts[k]]
        total, own = np.zeros((3, len(self.allowed[k]), max(self.widths)), np.int64), self.kept.take(rows)
        for i, c in enumerate(self.allowed[k]):
            spot = self.places[c].take(own)
            total[2, i] = n = np.bincount(spot, minlength=total.shape[2])
            for into, halves in zip(total, parts):
                into[i] = _summed_by(spot, halves, n)
        return total

    def _children(self, k: int, parent: int, tree: Tree) -> None:
        node = tree.nodes[parent]
        rows, total = self.open.pop((k, parent))
        right = self.places[node.split[1]].take(self.kept.take(rows)) > node.split[2]
        sides = [(node.left, rows[~right]), (node.right, rows[right])]
        (small, few), (large, many) = sorted(sides, key=lambda side: len(side[1]))
        sums = self._sums(k, few)
        self.open[k, small], self.open[k, large] = (few, sums), (many, total - sums)

    def __call__(self, trees: list[Tree], wanted: list[list[int]]) -> dict[tuple[int, int], dict]:
        out = {}
        for k, (tree, nodes) in enumerate(zip(trees, wanted)):
            if nodes == [0]:
                rows = np.arange(len(self.kept))
                self.open[k, 0] = rows, self._sums(k, rows)
            for parent in [at for at, n in enumerate(tree.nodes) if n.left in nodes]:
                self._children(k, parent, tree)
            for node in nodes:
                total = self.open[k, node][1]
                best = best_split(total, self.widths, self.allowed[k], self.settings, self.unit) or (0.0, -1, -1)
                out[k, node] = dict(zip(("g", "h", "n", "gain", "col", "cut"), (*(int(x[0].sum()) for x in total), *best)))
        return out


def _rounds_here(rows: DataFrame, gradients: Gradients, widths: list[int], allowed: list[list[list[int]]], settings: Boosting,
                 unit: float) -> list[list[Tree]]:
    """The same, grown in one task that holds the rows."""
    kind, limit = bin_type(widths), round(_DRAWS * settings.subsample)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, y, w, s, draw = (np.concatenate(x) for x in zip(*(block for batch in batches for block in unpacked(batch, kind))))
        draw, places = draw.astype(np.uint64), np.ascontiguousarray(bins.T).astype(np.intp)
        for number, columns in enumerate(allowed):
            kept = np.flatnonzero(draw % np.uint64(_DRAWS) < limit)
            found = _Sums(places, kept, *gradients(s[kept], y[kept], w[kept]), widths, columns, settings, unit)
            trees = grow(found, len(columns), settings)
            if all(len(t.nodes) == 1 for t in trees):
                break
            values = [leaf_values(t, settings, unit) * settings.learning_rate for t in trees]
            s, draw = _step(bins, s, draw, [_levels(t) for t in trees], values)
            held = zip(*((number, k, *_packed(t)) for k, t in enumerate(trees)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["round", "tree", "nodes", "gains", "accepted"])

    every: list[list[Tree]] = []
    for row in sorted(rows.mapInArrow(made, _PACKED).collect(), key=lambda r: (r["round"], r["tree"])):  # one row a tree
        if row["tree"] == 0:
            every.append([])
        every[-1].append(_tree(row))
    return every


def _forest(inputs: list[Input], edges: list[list[float]], trees: list[tuple[int, Tree, np.ndarray]], settings: Boosting,
            base: tuple[float, ...], link: str, feature_set: str) -> Forest:
    first = np.cumsum([0, *(len(t.nodes) for _, t, _ in trees)])
    nodes = [(n, at + begin, begin) for (_, t, _), begin in zip(trees, first) for at, n in enumerate(t.nodes)]
    inner = np.array([n.left >= 0 for n, _, _ in nodes], bool)
    value = np.zeros((len(nodes), len(base)))
    for (k, tree, values), begin in zip(trees, first):
        value[begin:begin + len(tree.nodes), k] = values
    return Forest(
        inputs, first, np.array([n.split[1] if n.left >= 0 else -1 for n, _, _ in nodes], np.int64),
        np.array([edges[n.split[1]][n.split[2]] if n.left >= 0 else 0.0 for n, _, _ in nodes]),
        np.array([n.left + begin if n.left >= 0 else at for n, at, begin in nodes], np.int64),
        np.array([n.right + begin if n.left >= 0 else at for n, at, begin in nodes], np.int64),
        np.where(inner[:, None], 0.0, value), np.full(len(trees), settings.learning_rate), base, link, feature_set)


class _State:
    """Rows with their scores, kept in memory between rounds and written every few.

    What is kept comes from the written rows in one step, with all trees since, so plans stay as short as they are.
    """

    def __init__(self, rows: DataFrame, every: int, kind: type):
        self.spark, self.every, self.kind, self.path, self.round, self.n = rows.sparkSession, every, kind, None, 0, None
        self.held: list[DataFrame] = []  # the last two; the older one goes when the newer one has been read
        self.since: list[tuple[list[Tree], list[np.ndarray]]] = []  # rounds since the last write
        self._write(rows.repartition(4 * self.spark.sparkContext.defaultParallelism))
        self.n, self.largest = self.rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("largest")).first()
        self._forget(0)
        self.held = [self._read().persist()]  # once more, now that the number of rows tells how many tasks are worth starting

    @property
    def rows(self) -> DataFrame:
        return self.held[-1]

    def _write(self, rows: DataFrame) -> None:
        old, self.path = self.path, fresh_path(self.spark, "boosting")
        rows.write.parquet(self.path)
        self._forget(0)
        if old:
            remove(self.spark, old)
        self.schema, self.since = rows.schema, []
        self.held = [self._read().persist()]

    def _read(self) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows.coalesce(-(-self.n // _TASK_ROWS)) if self.n else rows

    def together(self) -> DataFrame:
        """The written rows in one task."""
        return self.spark.read.schema(self.schema).parquet(self.path).coalesce(1)

    def _forget(self, kept: int) -> None:
        while len(self.held) > kept:
            self.held.pop(0).unpersist()

    def update(self, trees: list[Tree], values: list[np.ndarray]) -> None:
        self.round += 1
        last = _moved(self.rows, [(trees, values)], self.kind)
        self.since.append((trees, values))
        if self.round % self.every == 0:
            self._write(last)
        else:
            self._forget(1)
            self.held.append(_moved(self._read(), self.since, self.kind).persist())

    def close(self) -> None:
        self._forget(0)
        remove(self.spark, self.path)


def _boosted(df: DataFrame, inputs: list[Input], feature_set: str, settings: Boosting, base: tuple[float, ...], link: str,
             gradients: Gradients, target: Column, weight: Column) -> tuple[Forest, list[list[Tree]]]:
    """The model, and the trees of each round."""
    edges = fit_edges(df, inputs, feature_set, settings.bins)
    widths = [len(e) + 1 for e in edges]
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(settings.seed), *[F.col(f"`{c}`") for c in df.columns]), 1)
    held = binned(df, inputs, feature_set, edges, base, target, weight, draw)
    state, rng = _State(held, settings.kept_rounds, bin_type(widths)), np.random.default_rng(settings.seed)
    every, trees = [], []
    try:
        if state.n:
            # A gradient is no larger than twice the largest target, or than the largest weight.
            unit = 2.0 ** min(_POINT_BITS, math.floor(_SUM_BITS - math.log2(4.0 * state.n * max(state.largest, 1.0))))
            kept = max(1, round(settings.columns * len(inputs)))
            allowed = [[sorted(rng.choice(len(inputs), kept, replace=False).tolist()) for _ in base] for _ in range(settings.rounds)]
            if state.n <= LOCAL_ROWS:
                every = _rounds_here(state.together(), gradients, widths, allowed, settings, unit)
            else:
                every = _rounds(state, gradients, widths, allowed, settings, unit)
            trees = [(k, t, leaf_values(t, settings, unit)) for grown in every for k, t in enumerate(grown)]
    finally:
        state.close()
    return _forest(inputs, edges, trees, settings, base, link, feature_set), every


def _residuals(scores: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return scores - y[:, None], np.ones_like(scores)


def _shares(scores: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power = np.exp(scores - scores.max(axis=1, keepdims=True, initial=-np.inf))
    share = power / power.sum(axis=1, keepdims=True)
    return w[:, None] * (share - (y[:, None] == np.arange(scores.shape[1]))), w[:, None] * share * (1.0 - share)


def _summed(value: Column) -> Column:
    """The sum of numbers cut to a number of bits behind the point: exact, so that it doesn't depend on the order."""
    return F.sum(F.rint(value * F.lit(2.0 ** _MEAN_BITS)).cast("decimal(38,0)"))


def boosted_numbers(df: DataFrame, inputs: list[Input], target: str, settings: Boosting, feature_set: str = "") -> tuple[Forest, list[list[Tree]]]:
    """Squared error: a score starts at the mean and follows the residuals."""
    df = df.where(F.col(target).isNotNull() & ~F.isnan(target))
    n, total = df.agg(F.count("*"), _summed(F.col(target))).first()
    mean = float(total) / 2.0 ** _MEAN_BITS / n if n else 0.0
    return _boosted(df, inputs, feature_set, settings, (mean,), "identity", _residuals, F.col(target).cast("double"), F.lit(1.0))


def boosted_classes(df: DataFrame, inputs: list[Input], label: str, classes: int, settings: Boosting, weight: str | None = None,
                    feature_set: str = "") -> tuple[Forest, list[list[Tree]]]:
    """Softmax: in each round one tree for each class, grown from the gradients of all classes' shares."""
    df = df.where(F.col(label).isNotNull())
    heavy = F.col(weight).cast("double") if weight else F.lit(1.0)
    counts = {int(r["k"]): float(r["w"]) for r in df.groupBy(F.col(label).cast("int").alias("k")).agg(_summed(heavy).alias("w")).collect()}  # one row a class
    total = sum(counts.values())
    base = tuple(math.log(max(counts.get(k, 0.0), 1e-12 * total) / total) if total else 0.0 for k in range(classes))
    return _boosted(df, inputs, feature_set, settings, base, "softmax", _shares, F.col(label).cast("double"), heavy)
