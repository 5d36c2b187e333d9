"""Growing many trees over binned readings: split by sums where a node has many rows, by its own rows where it has few.

Readings become bins once. While a node has more than LOCAL_ROWS rows, each task sums weights by (node, column, bin, class)
for many trees side by side, the sums of a node meet in one task, which chooses its split, and the driver sees one row for
each node. The rows of a smaller node, as packed bytes, go to one task that grows everything below it. So passes over the
table follow the rows' logarithm and not the depth, what a task holds is bounded, and sums of cells never reach the driver.
Of grown parts it gets the cuts and leaves, packed: paths follow from the order of the nodes.

A node's number tells its path from the root (1; children 2k and 2k+1). Draws depend on seed, tree and that number, weights
are summed as integers: trees are the same wherever their nodes are split.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from frostline.operators.boosting import bin_type, unpacked

#: Rows up to which what lies below a node is grown in one task, and cells (column, bin, class) that a task sums together.
LOCAL_ROWS, CELLS = 50_000, 6_000_000
#: Pairs of a row and a tree that are sent to their nodes' tasks together, and rows for which a task is worth starting.
PAIRS, TASK_ROWS = 150_000_000, 20_000
#: Rows that a task works on at once, while it sums and while it sends rows to their nodes (in pieces that are not too small).
SUM_ROWS, SENT_ROWS = 30_000, 400_000
#: Bits that a sum of weights may have, as floating numbers add integers exactly.
SUM_BITS = 52


@dataclass(frozen=True)
class Growth:
    """How trees grow. `classes` is 0 for numbers, whose squared error falls, else Gini's impurity does."""
    widths: tuple[int, ...]  # bins of each column
    edges: tuple[tuple[float, ...], ...]
    classes: int
    depth: int
    min_rows: int
    min_split: int
    tried: int  # columns that a node looks at
    bootstrap: bool
    random_cuts: bool  # one cut drawn for each column with different values, else the best of all cuts
    unit: float  # integers in one unit of weight
    seed: int
    gains: bool = False  # what small nodes tell: the gains of their splits, else the rows and weights of their leaves

    @property
    def kinds(self) -> int:
        return max(self.classes, 1)

    @property
    def looked(self) -> int:
        """Columns that are summed for a node: random cuts look further when a column has one value only."""
        return len(self.widths) if self.random_cuts else self.tried


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A hash of 64 bits of numbers that are broadcast against each other."""
    with np.errstate(over="ignore"):
        found = np.uint64(0x9E3779B97F4A7C15)
        for part in parts:
            found = (found ^ np.asarray(part).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x94D049BB133111EB)
            found = (found ^ (found >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
            found = found ^ (found >> np.uint64(32))
    return found


def drawn(*parts: np.ndarray | int) -> np.ndarray:
    """Numbers from 0 to 1 of that hash."""
    return (mixed(*parts) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 13)]))
# How often a row is drawn, by the first 16 bits of its hash; 255 where the next bits decide.
_FIRST, _NEXT = (np.searchsorted(_POISSON, (np.arange(1 << 16) + i) / (1 << 16), "right") for i in (0, 1))
_TIMES = np.where(_FIRST == _NEXT, _FIRST, 255).astype(np.uint8)


def copies(draw: np.ndarray, tree: int, growth: Growth) -> np.ndarray:
    """How often each row is in the bootstrap sample of a tree."""
    if not growth.bootstrap:
        return np.ones(len(draw), np.int64)
    found = mixed(growth.seed, 1, tree, draw.astype(np.int64))
    times = _TIMES.take((found >> np.uint64(48)).astype(np.int64))
    unsure = np.flatnonzero(times == 255)
    times[unsure] = np.searchsorted(_POISSON, (found[unsure] >> np.uint64(11)).astype(np.float64) * 2.0 ** -53, "right")
    return times.astype(np.int64)


def looked_at(trees: np.ndarray, nodes: np.ndarray, growth: Growth) -> np.ndarray:
    """The columns of each node in the order in which it tries them; those that are summed."""
    wide = len(growth.widths)
    order = np.argsort(drawn(growth.seed, 2, trees[:, None], nodes[:, None], np.arange(wide)), axis=1, kind="stable")
    return order[:, :growth.looked]


def summed(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, times: np.ndarray, slot: np.ndarray, columns: np.ndarray,
           growth: Growth, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights by (slot, column, bin, kind) and rows by (slot, column, bin), of rows (those at `at` in `bins`) in slots with
    these columns."""
    width, kinds, (slots, looked) = max(growth.widths), growth.kinds, columns.shape
    weights, rows = np.zeros((looked, slots * width * kinds)), np.zeros((looked, slots * width))
    if len(slot):
        heavy, many, cells = weight * times, times.astype(np.float64), bins.ravel()
        place = (np.arange(len(bins)) if at is None else at) * bins.shape[1]
        even = weight[0] if growth.classes and weight[0] > 0 and (weight == weight[0]).all() else 0.0
        begin = slot.astype(np.int64) * width
        for j in range(looked):
            spot = begin + cells.take(place + np.ascontiguousarray(columns[:, j]).take(slot))
            weights[j] = np.bincount(spot * kinds + label if kinds > 1 else spot, heavy, weights.shape[1])
            if even:  # whole numbers of the same weight
                rows[j] = weights[j].reshape(-1, kinds).sum(axis=1) / even
            else:
                rows[j] = np.bincount(spot, many, rows.shape[1]) if growth.bootstrap else np.bincount(spot, minlength=rows.shape[1])
    return weights.reshape(looked, slots, width, kinds).swapaxes(0, 1), rows.reshape(looked, slots, width).swapaxes(0, 1)


def by_slot(slot: np.ndarray, slots: int) -> np.ndarray:
    """The rows' places in the order of their slots."""
    return np.argsort(slot.astype(np.uint16) if slots <= 1 << 16 else slot, kind="stable")


def _quality(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """What impurity leaves over: for classes sum(w²)/sum(w), for a number's sum s and n rows s²/n."""
    under = weights.sum(axis=-1) if weights.shape[-1] > 1 else rows
    return np.where(under > 0, (weights * weights).sum(axis=-1) / np.where(under > 0, under, 1.0), 0.0)


def random_splits(weights: np.ndarray, rows: np.ndarray, columns: np.ndarray, uniform: np.ndarray, growth: Growth) -> tuple[np.ndarray, ...]:
    """For each slot the place of its column among `columns` (-1: none), the last bin on the left and the gain, of drawn cuts.

    A column's cut is drawn between the first edge that has rows below it and the last that has rows above. Columns with
    one value aren't counted as tried; when no tried cut leaves enough rows, the next one that does is taken.
    """
    slots, looked, width = rows.shape
    there = rows > 0
    low, high = there.argmax(axis=2), width - 1 - there[:, :, ::-1].argmax(axis=2)
    differ = (low < high) & there.any(axis=2)
    cut = low.copy()
    for c in range(len(growth.widths)):
        at = np.nonzero((columns == c) & differ)
        if len(at[0]):
            marks = np.asarray(growth.edges[c])
            first, last = marks[low[at]], marks[high[at] - 1]
            found = np.searchsorted(marks, first + (last - first) * uniform[at], "right") - 1
            cut[at] = np.clip(found, low[at], high[at] - 1)
    slot, place = np.ogrid[:slots, :looked]
    left_rows = rows.cumsum(axis=2)[slot, place, cut]
    left = weights.cumsum(axis=2)[slot, place, cut]
    whole, all_rows = weights.sum(axis=2), rows.sum(axis=2)
    gain = _quality(left, left_rows) + _quality(whole - left, all_rows - left_rows) - _quality(whole, all_rows)
    fits = differ & (np.minimum(left_rows, all_rows - left_rows) >= growth.min_rows)
    tried = differ.cumsum(axis=1) <= growth.tried
    found_before = (fits.cumsum(axis=1) - fits) > 0
    gain = np.where(fits & (tried | ~found_before), gain, -np.inf)
    best = gain.argmax(axis=1)
    top = gain[np.arange(slots), best]
    return np.where(top > -np.inf, best, -1), cut[np.arange(slots), best], top


def best_splits(weights: np.ndarray, rows: np.ndarray, columns: np.ndarray, growth: Growth) -> tuple[np.ndarray, ...]:
    """The same with the best of all cuts; a cut that gains nothing is none."""
    slots, looked, width = rows.shape
    if width < 2:
        return np.full(slots, -1), np.zeros(slots, np.int64), np.full(slots, -np.inf)
    left_rows, left = rows.cumsum(axis=2), weights.cumsum(axis=2)
    whole, all_rows = left[:, :, -1:], left_rows[:, :, -1:]
    left_rows, left = left_rows[:, :, :-1], left[:, :, :-1]
    own = _quality(whole, all_rows)
    gain = _quality(left, left_rows) + _quality(whole - left, all_rows - left_rows) - own
    fits = np.minimum(left_rows, all_rows - left_rows) >= growth.min_rows
    gain = np.where(fits & (gain > 1e-12 * np.abs(own)), gain, -np.inf).reshape(slots, -1)
    best = gain.argmax(axis=1)
    top = gain[np.arange(slots), best]
    return np.where(top > -np.inf, best // (width - 1), -1), best % (width - 1), top


def chosen(weights: np.ndarray, rows: np.ndarray, trees: np.ndarray, nodes: np.ndarray, depth: np.ndarray, columns: np.ndarray,
           growth: Growth) -> dict[str, np.ndarray]:
    """What becomes of each slot's node: its column (-1 for a leaf), cut and gain, weights and rows, and rows of both sides."""
    if growth.random_cuts:
        uniform = drawn(growth.seed, 3, trees[:, None], nodes[:, None], columns)
        place, cut, gain = random_splits(weights, rows, columns, uniform, growth)
    else:
        place, cut, gain = best_splits(weights, rows, columns, growth)
    at = np.arange(len(nodes))
    held, n = weights[:, 0].sum(axis=1), rows[:, 0].sum(axis=1)
    inner = (place >= 0) & (n >= max(growth.min_split, 2 * growth.min_rows)) & (depth < growth.depth)
    if growth.classes:
        inner &= (held > 0).sum(axis=1) > 1
    place, cut = np.where(inner, place, 0), np.where(inner, cut, 0)
    left_rows, left = rows.cumsum(axis=2)[at, place, cut], weights.cumsum(axis=2)[at, place, cut]
    return {"column": np.where(inner, columns[at, place], -1), "cut": cut, "gain": np.where(inner, gain, 0.0) / growth.unit,
            "n": n, "held": held, "n_left": left_rows, "left": left}


def finished(n: np.ndarray, held: np.ndarray, depth: np.ndarray, growth: Growth) -> np.ndarray:
    """Whether nodes with these rows and weights are leaves for sure."""
    done = (n < max(growth.min_split, 2 * growth.min_rows)) | (depth >= growth.depth)
    return done | ((held > 0).sum(axis=1) <= 1) if growth.classes else done


def grown_here(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, times: np.ndarray, tree: int, root: int, growth: Growth) -> list[tuple]:
    """Every node from `root` downwards over its rows: number, column, cut, gain, rows and weights."""
    out, node = [], np.array([root], np.int64)
    slot, depth = np.zeros(len(bins), np.int64), int(root).bit_length() - 1
    per_slot = growth.looked * max(growth.widths) * (growth.kinds + 1)
    while len(node):
        following, moved = [], np.full(len(bins), -1, np.int64)
        step, order = max(1, CELLS // per_slot), by_slot(slot, len(node))
        first = np.searchsorted(slot[order], np.arange(len(node) + 1))
        for a in range(0, len(node), step):
            part = node[a:a + step]
            mine = order[first[a]:first[a + len(part)]]
            own = slot[mine] - a
            columns = looked_at(np.full(len(part), tree), part, growth)
            sums = summed(bins, label[mine], weight[mine], times[mine], own, columns, growth, mine)
            made = chosen(*sums, np.full(len(part), tree), part, np.full(len(part), depth), columns, growth)
            out.append((part, made["column"], made["cut"], made["gain"], made["n"], made["held"]))
            inner = np.flatnonzero(made["column"] >= 0)
            sides = [(made["n_left"], made["left"]), (made["n"] - made["n_left"], made["held"] - made["left"])]
            child = np.full((len(part), 2), -1, np.int64)
            for side, (n, held) in enumerate(sides):
                leaf = finished(n[inner], held[inner], np.full(len(inner), depth + 1), growth)
                done, going = inner[leaf], inner[~leaf]
                out.append((2 * part[done] + side, np.full(len(done), -1), np.zeros(len(done), np.int64), np.zeros(len(done)), n[done], held[done]))
                child[going, side] = sum(map(len, following)) + np.arange(len(going))
                following.append(2 * part[going] + side)
            right = bins[mine, np.maximum(made["column"], 0)[own]] > made["cut"][own]
            moved[mine] = child[own, right.astype(np.int64)]
        kept = moved >= 0
        bins, label, weight, times, slot = bins[kept], label[kept], weight[kept], times[kept], moved[kept]
        node, depth = np.concatenate(following) if following else np.zeros(0, np.int64), depth + 1
    return [np.concatenate(x) for x in zip(*out)]


class Walk:
    """Where rows stand in a tree that has been split so far."""

    def __init__(self, split: dict[int, tuple[int, int]], wanted: dict[int, int]):
        on_path = {n >> i for n in wanted for i in range(1, n.bit_length())}
        split = {n: split[n] for n in on_path}
        number = np.array(sorted({1, *(2 * n for n in split), *(2 * n + 1 for n in split)}), np.int64)
        at = {int(n): i for i, n in enumerate(number)}
        nothing = np.iinfo(np.int32).max  # no bin lies above it
        self.column = np.array([split[n][0] if n in split else 0 for n in at], np.int32)
        self.cut = np.array([split[n][1] if n in split else nothing for n in at], np.int32)
        self.left = np.array([at[2 * n] if n in split else i for n, i in at.items()], np.int32)  # the right one is the next
        self.slot = np.array([wanted.get(n, -1) for n in at], np.int32)
        self.begin, self.end = min(wanted.values()), max(wanted.values()) + 1  # a tree's slots lie together
        self.depth = max((n.bit_length() for n in split), default=0)

    def slots(self, bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The wanted slot that each of these rows has reached, or -1."""
        node, cells, place = np.zeros(len(rows), np.int32), bins.ravel(), rows * bins.shape[1]
        for _ in range(self.depth):
            node = self.left.take(node) + (cells.take(place + self.column.take(node)) > self.cut.take(node))
        return self.slot.take(node)

    def reached(self, bins: np.ndarray, draw: np.ndarray, tree: int, growth: Growth) -> tuple[np.ndarray, ...]:
        """Rows of the tree's sample in wanted slots, the slots, and how often the rows are in the sample."""
        times = copies(draw, tree, growth)
        rows = np.flatnonzero(times)
        slot = self.slots(bins, rows)
        there = np.flatnonzero(slot >= 0)
        rows = rows[there]
        return rows, slot[there], times[rows]


def _rows_of(batches: Iterator[pa.RecordBatch], growth: Growth, together: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bins, label, integer weight and draw of the rows, at least so many at once."""
    held: list[tuple[np.ndarray, ...]] = []

    def joined() -> tuple[np.ndarray, ...]:
        bins, y, w, draw = (np.concatenate(x) for x in zip(*held))
        if growth.classes:
            return bins, y.astype(np.int64), np.rint(w * growth.unit), draw
        return bins, np.zeros(len(bins), np.int64), np.rint(y * growth.unit), draw

    many = 0
    for batch in batches:
        for bins, y, w, _, draw in unpacked(batch, bin_type(growth.widths)):
            held.append((bins, y, w, draw))
            many += len(bins)
            if many >= together:
                yield joined()
                held, many = [], 0
    if held:
        yield joined()


def _bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


_MADE = "slot bigint, col bigint, cut bigint, gain double, n double, n_left double, held binary, held_left binary"
_GROWN = "slot bigint, col binary, cut binary, gain binary, n binary, held binary"
_INNER, _LEAVES = (("cut", np.int16), ("gain", np.float64)), (("n", np.float64), ("held", np.float64))


def _packed(made: tuple[np.ndarray, ...], growth: Growth) -> list[bytes]:
    """A grown part: columns of its nodes by their numbers, cuts and gains of those that are split, rows and weights of leaves."""
    node, column, cut, gain, n, held = made
    order = np.argsort(node)
    inner, leaves = order[column[order] >= 0], order[column[order] < 0]
    if growth.gains:
        leaves = leaves[:0]
    else:
        gain, n = np.zeros(0), n if not growth.classes else np.zeros(len(n))
    gain = gain[inner] if growth.gains else gain
    parts = [column[order].astype(np.int16), cut[inner].astype(np.int16), gain, n[leaves], held[leaves]]
    return [zlib.compress(_bytes(x), 1) for x in parts]


def _part(root: int, row: dict, growth: Growth) -> tuple[np.ndarray, ...]:
    """Numbers, columns, cuts, gains, rows and weights of the nodes of a grown part (0 where it doesn't say)."""
    column = np.frombuffer(zlib.decompress(row["col"]), np.int16)
    numbers, level, begin = [], np.array([root], np.int64), 0
    while len(level):
        numbers.append(level)
        inner = level[column[begin:begin + len(level)] >= 0]
        begin += len(level)
        level = np.column_stack([2 * inner, 2 * inner + 1]).ravel()
    cut, gain, n, held = (np.frombuffer(zlib.decompress(row[c]), t) for c, t in (*_INNER, *_LEAVES))
    whole = [np.zeros(len(column), np.int16), np.zeros(len(column)), np.zeros(len(column)), np.zeros((len(column), growth.kinds))]
    for into, values, there in zip(whole, (cut, gain, n, held.reshape(-1, growth.kinds)), (column >= 0, column >= 0, column < 0, column < 0)):
        if len(values):
            into[there] = values
    return np.concatenate(numbers), column, *whole


def _split_wide(rows: DataFrame, names: list[tuple[int, int]], walks: dict[int, Walk], growth: Growth, tasks: int) -> list:
    """The split of each named node (tree, number), chosen from the sums of all tasks."""
    tree, node = np.array([k for k, _ in names]), np.array([n for _, n in names], np.int64)
    depth = np.array([n.bit_length() - 1 for _, n in names])
    width, kinds, looked = max(growth.widths), growth.kinds, growth.looked
    columns = looked_at(tree, node, growth)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, many = np.zeros((len(names), looked, width, kinds)), np.zeros((len(names), looked, width))
        for bins, label, weight, draw in _rows_of(batches, growth, SUM_ROWS):
            for k, walk in walks.items():
                mine, slot, times = walk.reached(bins, draw, k, growth)
                if len(mine):
                    begin, end = walk.begin, walk.end
                    found = summed(bins, label[mine], weight[mine], times, slot - begin, columns[begin:end], growth, mine)
                    weights[begin:end] += found[0]
                    many[begin:end] += found[1]
        held = np.flatnonzero(many[:, 0].any(axis=1))
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array([_bytes(weights[i]) for i in held], pa.binary()),
                                              pa.array([_bytes(many[i]) for i in held], pa.binary())], ["slot", "weights", "rows"])

    def splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for slot, *packed in zip(*(batch.column(c).to_pylist() for c in ("slot", "weights", "rows"))):
                numbers = [np.frombuffer(p, np.float64) for p in packed]
                met[slot] = [a + b for a, b in zip(met[slot], numbers)] if slot in met else numbers
        if met:
            slot = np.array(sorted(met))
            weights = np.stack([met[s][0] for s in slot]).reshape(-1, looked, width, kinds)
            many = np.stack([met[s][1] for s in slot]).reshape(-1, looked, width)
            made = chosen(weights, many, tree[slot], node[slot], depth[slot], columns[slot], growth)
            held, left = (pa.array([_bytes(x) for x in made[c]], pa.binary()) for c in ("held", "left"))
            plain = [pa.array(made[c].astype(t)) for c, t in (("column", np.int64), ("cut", np.int64), ("gain", float), ("n", float), ("n_left", float))]
            yield pa.RecordBatch.from_arrays([pa.array(slot), *plain, held, left], ["slot", "col", "cut", "gain", "n", "n_left", "held", "held_left"])

    met = rows.mapInArrow(sums, "slot bigint, weights binary, rows binary").repartition(min(tasks, len(names)), "slot")
    return met.mapInArrow(splits, _MADE).collect()  # one row for each node


def _grow_small(rows: DataFrame, names: list[tuple[int, int]], walks: dict[int, Walk], growth: Growth, tasks: int) -> list:
    """All nodes below each named node, from its rows."""
    wide = len(growth.widths)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, label, weight, draw in _rows_of(batches, growth, SENT_ROWS):
            for k, walk in walks.items():
                mine, slot, times = walk.reached(bins, draw, k, growth)
                if not len(mine):
                    continue
                order = by_slot(slot - walk.begin, walk.end - walk.begin)
                mine, slot = mine[order], slot[order].astype(np.int64)
                held, first = np.unique(slot, return_index=True)
                ends = [*first[1:], len(mine)]
                sent = [bins[mine], label[mine].astype(np.int32), weight[mine], times[order].astype(np.uint8)]
                cells = [[_bytes(x[a:b]) for a, b in zip(first, ends)] for x in sent]
                yield pa.RecordBatch.from_arrays([pa.array(held), *(pa.array(c, pa.binary()) for c in cells)], ["slot", "bins", "label", "weight", "times"])

    def below(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[], [], [], []]
        for batch in batches:
            for name, into in zip(("bins", "label", "weight", "times"), parts):
                into += batch.column(name).to_pylist()
        kinds = (bin_type(growth.widths), np.int32, np.float64, np.uint8)
        bins, label, weight, times = (np.frombuffer(b"".join(p), t) for p, t in zip(parts, kinds))
        slot = key[0].as_py()
        made = grown_here(bins.reshape(-1, wide), label.astype(np.int64), weight, times.astype(np.int64), *names[slot], growth)
        yield pa.RecordBatch.from_arrays([pa.array([slot]), *(pa.array([v], pa.binary()) for v in _packed(made, growth))],
                                         ["slot", "col", "cut", "gain", "n", "held"])

    met = rows.mapInArrow(packed, "slot bigint, bins binary, label binary, weight binary, times binary")
    return met.repartition(min(tasks, len(names)), "slot").groupBy("slot").applyInArrow(below, _GROWN).collect()


@dataclass
class Grown:
    """The nodes of one tree, parents before their children: numbers of paths, columns (-1: leaf), cuts, gains, rows, weights."""
    node: np.ndarray
    column: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    n: np.ndarray
    held: np.ndarray

    def children(self) -> tuple[np.ndarray, np.ndarray]:
        own = np.arange(len(self.node))
        inner = self.column >= 0
        return tuple(np.where(inner, np.searchsorted(self.node, 2 * self.node + side), own) for side in (0, 1))


def _walks(splits: list[dict], numbers: range, names: list[tuple[int, int]]) -> dict[int, Walk]:
    wanted: dict[int, dict[int, int]] = {}
    for slot, (k, n) in enumerate(names):
        wanted.setdefault(k, {})[n] = slot
    return {k: Walk(splits[k - numbers.start], w) for k, w in wanted.items()}


def _turns(nodes: list[tuple[int, int, float]], most: int) -> Iterator[list[tuple[int, int]]]:
    """The nodes (tree, number, rows) in turns of so many at most, and of about PAIRS rows."""
    names, held = [], 0.0
    for k, n, many in nodes:
        if names and (len(names) >= most or held + many > PAIRS):
            yield names
            names, held = [], 0.0
        names.append((k, n))
        held += many
    if names:
        yield names


def grow_trees(rows: DataFrame, n_rows: int, numbers: range, growth: Growth, turn: int, tasks: int) -> list[Grown]:
    """The trees of these numbers over blocks of rows. Wide nodes of all trees share passes, bounded by cells; the rows of
    small nodes are sent in turns, bounded by rows and nodes."""
    splits: list[dict[int, tuple[int, int]]] = [{} for _ in numbers]
    parts: list[list[tuple]] = [[] for _ in numbers]
    level, small = [(k, 1, n_rows) for k in numbers], []
    per_slot = growth.looked * max(growth.widths) * (growth.kinds + 1)
    step = max(1, min(turn, CELLS // per_slot))
    while level:
        small += [(k, n, rows_there) for k, n, rows_there in level if rows_there <= LOCAL_ROWS]
        large, level = sorted((k, n) for k, n, rows_there in level if rows_there > LOCAL_ROWS), []
        for a in range(0, len(large), step):
            names = large[a:a + step]
            for r in _split_wide(rows, names, _walks(splits, numbers, names), growth, tasks):
                k, n = names[r["slot"]]
                held, left = (np.frombuffer(r[c], np.float64) for c in ("held", "held_left"))
                parts[k - numbers.start].append(tuple(np.array([x]) for x in (n, r["col"], r["cut"], r["gain"], r["n"])) + (held[None],))
                if r["col"] < 0:
                    continue
                splits[k - numbers.start][n] = (r["col"], r["cut"])
                for side, (many, own) in enumerate(((r["n_left"], left), (r["n"] - r["n_left"], held - left))):
                    child = 2 * n + side
                    if finished(np.array([many]), own[None], np.array([child.bit_length() - 1]), growth)[0]:
                        parts[k - numbers.start].append(tuple(np.array([x]) for x in (child, -1, 0, 0.0, many)) + (own[None],))
                    else:
                        level.append((k, child, many))
    for names in _turns(sorted(small), turn):
        for r in _grow_small(rows, names, _walks(splits, numbers, names), growth, tasks):
            k, n = names[r["slot"]]
            parts[k - numbers.start].append(_part(n, r, growth))
    trees = []
    for part in parts:
        found = [np.concatenate(x) for x in zip(*part)]
        order = np.argsort(found[0], kind="stable")
        trees.append(Grown(*(x[order] for x in found)))
    return trees


def weight_unit(n_rows: int, largest: float) -> float:
    """The most bits behind the point with which all weights add up exactly, no more than 20."""
    whole = max(n_rows, 1) * max(largest, 1e-300) * 2.0  # bootstrap samples have a few rows more
    return 2.0 ** min(20, int(np.floor(SUM_BITS - np.log2(whole))))
