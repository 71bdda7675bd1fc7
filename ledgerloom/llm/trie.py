"""Binary trie self-joins under a Hamming budget, and how their keys are dealt out to tasks.

Inside a task, pairs of trie nodes are traversed together; each level adds a
differing bit when the two nodes take different branches, and a pair is dropped
as soon as its bits exceed the budget.

Tasks come from the pigeonhole: a key is cut into budget + 1 blocks, and two keys
within the budget agree in one block at least. A key goes to one group for each
block, named by the block's number and value; a group is a trie of the remaining
bits. A group of more than ``MOST`` bytes is dealt into sub-blocks, every pair of which
is a task, so no group is bound to one task and none is cut.

Keys travel as packed arrays, a row for each bucket of tasks and bundle of keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL = 48  # node pairs with at most so many leaf pairs are compared directly
CUT = 1 << 17  # leaf pairs of a node pair, and node pairs of a step, at most
MOST = 64 << 20  # bytes of a group's keys that one task takes
CHUNK = 1 << 18  # keys that a task traverses at a time; a larger group is taken alone
BUNDLE = 12 << 20  # bytes packed at a time, about
PER_TASK = 128 << 20  # bytes of a partition, about

NodePairs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def trie_links(keys: np.ndarray, nodes: NodePairs, depth: int, bits: int, budget: int, settled: Callable | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of keys within the budget, in blocks, from node pairs (lo_a, hi_a, lo_b, hi_b) at ``depth``.

    A node is a range of keys that are sorted and agree in the bits above depth.
    A pair of a node with itself gives i < j; other pairs have nodes apart.
    settled(lo_a, hi_a, lo_b, hi_b) tells node pairs that need no more work. The
    traversal is depth-first over blocks of node pairs, so memory stays bounded;
    equal keys are halved, with no bit spent, until they are few.
    """
    ones: dict[int, np.ndarray] = {}

    def middle(lo, hi, depth):
        if depth == bits:
            return (lo + hi) >> 1
        if depth not in ones:
            ones[depth] = np.concatenate(([0], np.cumsum((keys >> np.uint64(bits - 1 - depth)) & np.uint64(1), dtype=np.int64)))
        c = ones[depth]
        return hi - (c[hi] - c[lo])

    stack = [(depth, *nodes, np.zeros(len(nodes[0]), np.int8))]
    while stack:
        depth, la, ha, lb, hb, err = stack.pop()
        if settled is not None and len(la):
            go = ~settled(la, ha, lb, hb)
            la, ha, lb, hb, err = la[go], ha[go], lb[go], hb[go], err[go]
        size = (ha - la) * (hb - lb)
        small = size <= (CUT if depth == bits else SMALL)
        if small.any():
            for i, j in _leaf_pairs(la[small], hb[small] - lb[small], lb[small], size[small]):
                hit = (np.bitwise_count(keys[i] ^ keys[j]) <= budget) & (i < j)
                if hit.any():
                    yield i[hit], j[hit]
            big = ~small
            la, ha, lb, hb, err = la[big], ha[big], lb[big], hb[big], err[big]
        if not len(la):
            continue
        ma, mb = middle(la, ha, depth), middle(lb, hb, depth)
        apart, step = la != lb, int(depth < bits)
        parts = ((la, ma, lb, mb, err), (ma, ha, mb, hb, err), (la, ma, mb, hb, err + step), tuple(x[apart] for x in (ma, ha, lb, mb, err + step)))
        nxt = [np.concatenate([p[k] for p in parts]) for k in range(5)]
        live = (nxt[1] > nxt[0]) & (nxt[3] > nxt[2]) & (nxt[4] <= budget)
        nxt = [x[live] for x in nxt]
        for at in range(0, len(nxt[0]), CUT):
            stack.append((depth + step, *(x[at : at + CUT] for x in nxt)))


def _leaf_pairs(a: np.ndarray, width: np.ndarray, b: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (i, j) of node pairs that begin at a and b, in blocks of about 2 * CUT."""
    ends = np.concatenate(([0], np.cumsum(size)))
    s = 0
    while s < len(size):
        e = max(s + 1, int(np.searchsorted(ends, ends[s] + 2 * CUT, side="right")) - 1)
        each = size[s:e]
        k = np.arange(ends[e] - ends[s]) - np.repeat(ends[s:e] - ends[s], each)
        w = np.repeat(width[s:e], each)
        yield np.repeat(a[s:e], each) + k // w, np.repeat(b[s:e], each) + k % w
        s = e


def join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least-index labels after linking i with j."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label = label[label]


def run_ends(x: np.ndarray) -> np.ndarray:
    """For every position the end of its run of equal values."""
    ends = np.flatnonzero(np.append(x[1:] != x[:-1], True)) + 1
    return np.repeat(ends, np.diff(ends, prepend=0))


def same_run(label: np.ndarray) -> Callable:
    """A ``settled``: both nodes lie within one label."""
    run = run_ends(label)
    return lambda la, ha, lb, hb: (run[la] >= ha) & (run[lb] >= hb) & (label[la] == label[lb])


def spanning_links(keys: np.ndarray, nodes: NodePairs, depth: int, bits: int, budgets: tuple[int, ...], near: Callable | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) within the budgets, smaller ones first, that connect what all such links connect.

    near(i, j) tells the distances of links and which of them count; of those in
    hand the closest are taken first. Under len(keys) links are kept.
    """
    label, kept = np.arange(len(keys)), []
    state = {"settled": same_run(label)}
    for budget in budgets:
        for i, j in trie_links(keys, nodes, depth, bits, budget, lambda *x: state["settled"](*x)):
            open_ = label[i] != label[j]
            if near is not None and open_.any():
                i, j = i[open_], j[open_]
                distance, counts = near(i, j)
                order = np.argsort(distance[counts], kind="stable")
                i, j = i[counts][order], j[counts][order]
            else:
                i, j = i[open_], j[open_]
            grown = False
            while len(i):  # each label takes its first link, until all in hand lie within labels
                ends = np.stack([label[i], label[j]], axis=1).ravel()
                first = np.unique(np.unique(ends, return_index=True)[1] // 2)
                kept.append((i[first], j[first]))
                label, grown = join_labels(label, i[first], j[first]), True
                open_ = label[i] != label[j]
                i, j = i[open_], j[open_]
            if grown:
                state["settled"] = same_run(label)
    return tuple(np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (np.empty(0, np.int64), np.empty(0, np.int64))


# --- distribution -----------------------------------------------------------


@dataclass(frozen=True)
class Keys:
    """The shape of a join: ``bands`` keys of ``bits`` bits a row, a link if one band differs in at most ``budget`` bits."""

    bits: int
    budget: int
    bands: int = 1

    @property
    def blocks(self) -> int:
        return self.budget + 1

    @property
    def width(self) -> int:
        return self.bits // self.blocks

    def groups(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(slot, turned keys, groups): for each band and block the keys with that block on top and the numbers of their groups."""
        mask = np.uint64((1 << self.bits) - 1)
        for band in range(self.bands):
            for block in range(self.blocks):
                k, up = keys[:, band], block * self.width
                if up:
                    k = ((k << np.uint64(up)) & mask) | (k >> np.uint64(self.bits - up))
                slot = band * self.blocks + block
                yield slot, k, (k >> np.uint64(self.bits - self.width)).astype(np.int64) + (slot << self.width)

    def first_slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For linked rows of keys the first slot (band and block) whose group both are in."""
        apart = a ^ b
        near = np.bitwise_count(apart) <= self.budget
        band = near.argmax(axis=1)
        own = apart[np.arange(len(a)), band]
        same = [(own >> np.uint64(self.bits - (k + 1) * self.width)) & np.uint64((1 << self.width) - 1) == 0 for k in range(self.blocks)]
        return (band * self.blocks + np.stack(same, axis=1).argmax(axis=1)).astype(np.int32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def large_groups(nodes: DataFrame, shape: Keys, unpack: Callable, classes: list[int], most: int) -> dict[int, dict[int, int]]:
    """{group: {class: keys}} of groups with over ``most`` keys; a class is the place of a root in ``classes``, else -1.

    Groups are counted by partition first; only large ones reach the driver, at
    most all keys divided by ``most``.
    """
    known = np.array(classes, np.int64)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        n = shape.bands * shape.blocks << shape.width
        for batch in rows:
            got = unpack(batch)
            of = class_of(got.get("root"), known, len(got["node"]))
            for _, _, g in shape.groups(got["keys"]):
                for c in np.unique(of):
                    total[int(c)] = total.get(int(c), np.zeros(n, np.int32)) + np.bincount(g[of == c], minlength=n).astype(np.int32)
        for c, x in total.items():
            at = np.flatnonzero(x)
            for a in range(0, len(at), 1 << 16):
                part = at[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(part), c, np.int32)), pa.array(x[part].astype(np.int64))], names=["g", "c", "n"])

    counts = nodes.mapInArrow(count, "g long, c int, n long").groupBy("g", "c").agg(F.sum("n").alias("n"))
    large = counts.groupBy("g").agg(F.sum("n").alias("n"), F.collect_list(F.struct("c", "n")).alias("of")).filter(F.col("n") > most)
    return {r["g"]: {x["c"]: x["n"] for x in r["of"]} for r in large.collect()}


def class_of(root: np.ndarray | None, known: np.ndarray, n: int) -> np.ndarray:
    if root is None or not len(known):
        return np.full(n, -1)
    at = np.minimum(np.searchsorted(known, root), len(known) - 1)
    return np.where(known[at] == root, at, -1)


def deal(large: dict[int, dict[int, int]], shape: Keys, most: int, complete: bool) -> dict[int, tuple[dict[int, tuple[int, int]], list[list[int]]]]:
    """{group: ({class: (first sub-block, sub-blocks)}, tags of each sub-block)} of large groups.

    Every pair of sub-blocks is a task with two sides, but for pairs within one
    class of a known root, which hold no link between roots. Without
    ``complete`` a sub-block only meets itself. A tag is 2 * task + side; tasks
    below bands * blocks are those of groups that are not large.
    """
    out, task = {}, shape.bands * shape.blocks
    for g, of in sorted(large.items()):
        first, owner = {}, []
        for c, n in sorted(of.items()):
            parts = -(-n // max(1, most // 2))
            first[c] = (len(owner), parts)
            owner += [c] * parts
        tags: list[list[int]] = [[] for _ in owner]
        for x, cx in enumerate(owner):
            for y in range(x, len(owner) if complete else x + 1):
                if cx == owner[y] >= 0:
                    continue
                tags[x].append(2 * task)
                if y > x:
                    tags[y].append(2 * task + 1)
                task += 1
        out[g] = (first, tags)
    return out


def trie_join(nodes: DataFrame, shape: Keys, unpack: Callable, work: Callable, out: str, columns: dict[str, str], n: int, roots: list[int] | None = None, complete: bool = True, most: int | None = None) -> DataFrame:
    """Runs ``work`` over the tries of all groups.

    unpack(batch) gives ``node``, ``keys`` (rows by bands) and the arrays named in
    ``columns`` (name to dtype; by band or by row; ``slot`` is the key's own). work(shape, arrays, nodes,
    depth) yields record batches of schema ``out``; arrays hold ``key`` and the
    columns of some tries, nodes are their node pairs. n: about how many nodes.
    """
    names, kinds = ["key", *columns], {"key": "u8", **columns}
    wide = 4 + sum(np.dtype(k).itemsize for k in kinds.values())
    spark, most = nodes.sparkSession, most or MOST // wide
    known = sorted(roots or [])
    large = large_groups(nodes, shape, unpack, known, most)
    dealt = deal(large, shape, most, complete)
    shared = spark.sparkContext.broadcast((np.array(sorted(dealt), np.int64), dealt))  # large groups only
    copies = shape.bands * shape.blocks
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")), n * copies * wide // PER_TASK)
    buckets = 4 * parts

    def route(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, table = shared.value
        held: list[dict] = []
        for batch in rows:
            if not batch.num_rows:
                continue
            got = unpack(batch)
            of = class_of(got.get("root"), np.array(known, np.int64), len(got["node"]))
            for slot, key, g in shape.groups(got["keys"]):
                row = {"key": key, **{c: np.full(len(g), slot, np.int32) if c == "slot" else got[c][:, slot // shape.blocks] if got[c].ndim == 2 else got[c] for c in columns}}
                at = np.minimum(np.searchsorted(hot, g), max(len(hot) - 1, 0))
                is_hot = hot[at] == g if len(hot) else np.zeros(len(g), bool)
                cold = ~is_hot
                held.append({c: v[cold] for c, v in row.items()} | {"tag": np.full(int(cold.sum()), 2 * slot, np.uint32), "bucket": mixed(g[cold]) % np.uint64(buckets)})
                for x in np.unique(g[is_hot]):
                    first, tags = table[int(x)]
                    pick = np.flatnonzero(g == x)
                    part = np.zeros(len(pick), np.int64)
                    for c, (start, many) in first.items():
                        mine = of[pick] == c
                        part[mine] = start + (mixed(got["node"][pick][mine] + 1) % np.uint64(many)).astype(np.int64)
                    for s in np.unique(part):
                        mine = pick[part == s]
                        for tag in tags[s]:
                            held.append({c: v[mine] for c, v in row.items()} | {"tag": np.full(len(mine), tag, np.uint32), "bucket": mixed(np.full(len(mine), tag >> 1)) % np.uint64(buckets)})
                if sum(len(h["tag"]) for h in held) * wide > BUNDLE:
                    yield _packed(held, names)
                    held = []
        if held:
            yield _packed(held, names)

    def join(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list] = {c: [] for c in ("tag", *names)}
        for batch in rows:
            for c in got:
                got[c] += batch.column(c).to_pylist()
        x = {c: np.frombuffer(b"".join(v), kinds.get(c, "u4")) for c, v in got.items()}
        got.clear()
        if not len(x["tag"]):
            return
        order = np.lexsort((*[x[c] for c in ("root",) if c in x], x["key"], x["tag"]))
        x = {c: v[order] for c, v in x.items()}
        task, side = x["tag"] >> 1, x["tag"] & 1
        top = x["key"] >> np.uint64(shape.bits - shape.width)
        starts = np.flatnonzero(np.concatenate(([True], (task[1:] != task[:-1]) | (top[1:] != top[:-1]))))  # of groups; both sides of a task hold one value
        ends = np.append(starts[1:], len(task))
        a = 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(ends, starts[a] + CHUNK, side="right")))
            lo, hi = int(starts[a]), int(ends[b - 1])
            s, e = starts[a:b] - lo, ends[a:b] - lo
            sides = np.concatenate(([0], np.cumsum(side[lo:hi], dtype=np.int64)))
            m = e - (sides[e] - sides[s])  # where the second side begins
            two = m < e
            nodes = (s, m, np.where(two, m, s), np.where(two, e, m))
            yield from work(shape, {c: v[lo:hi] for c, v in x.items() if c != "tag"}, nodes, shape.width)
            a = b

    fields = ", ".join(["bucket int", "tag binary", *[f"{c} binary" for c in names]])
    return nodes.mapInArrow(route, fields).repartition(parts, "bucket").mapInArrow(join, out)


def _packed(held: list[dict], names: list[str]) -> pa.RecordBatch:
    """A row for each bucket."""
    x = {c: np.concatenate([h[c] for h in held]) for c in ("bucket", "tag", *names)}
    order = np.argsort(x["bucket"], kind="stable")
    bucket = x["bucket"][order]
    cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)])) if len(bucket) else np.array([0])
    columns = [pa.array(bucket[cuts[:-1]].astype(np.int32))]
    for c in ("tag", *names):
        v = np.ascontiguousarray(x[c][order])
        columns.append(pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * v.itemsize).astype(np.int32)), pa.py_buffer(v)]))
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "tag", *names])
