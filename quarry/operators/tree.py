"""Exact classification trees: every threshold between two values is tried, and depth has no limit.

A node is split where the Gini impurity of its two parts is least; of equal splits the one with the smallest feature,
then the smallest threshold, is taken. A node becomes a leaf when its rows are of one class or agree in every feature.

Large nodes are split level by level over the cluster, in two passes over blocks of rows whose bins were found once. The
first counts the classes of every (node, feature, bin), where a feature's bins lie between some of its quantiles. That
rates the ends of the bins exactly, and bounds what a threshold inside a bin could reach: the rating is convex in the
counts of the left part, so it is largest at a corner of what the bin allows. The second pass sorts the values of those
bins only that can hold the best threshold, in ranges that a task each holds, and rates each of them; bins of a single
value are left out. Where the bins lie never shows in the tree.
Once a node has few enough rows it is finished in one task, all nodes of a depth at once, with its attribute lists sorted
once and divided stably at each level. Both rate splits by the same numbers, so where the work is done does not show
either. A tree too large to hold scores rows part by part: each goes to the task that has the nodes on its way.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.svm import SLICE
from quarry.session import cut_lineage, ship_package, stored

LOCAL_CELLS = 8_000_000      # rows times features that one task finishes alone
BLOCK_CELLS = 1 << 17        # of a block of rows, at most
VALUE_ROWS = 1 << 18         # rows of bins whose values one task counts, about
VALUE_BYTES = 32 << 20       # of such rows that a task gathers before it sends them
PART_ROWS = 1 << 20          # rows that one task scores by a part of a tree that is not held
BINS = 1024                  # of a feature, at most
BIN_CELLS = 1 << 16          # bins of all features, unless these get fewer than 16
COUNTED = 16                 # values of a feature that a task counts by node, at most
CORNER_CLASSES = 8           # with more, every bin is counted by its values
STORE_LEVELS = 8             # levels after which the rows' nodes are written
HELD_NODES = 1_000_000       # nodes that scoring holds in a task; a larger tree is walked by joins
NODES = ("id long, depth int, n long, counts array<long>, impurity double, prediction int, feature int, "
         "threshold double, gain double, left long, right long")
_ARROW = pa.schema([("id", pa.int64()), ("depth", pa.int32()), ("n", pa.int64()), ("counts", pa.list_(pa.int64())),
                    ("impurity", pa.float64()), ("prediction", pa.int32()), ("feature", pa.int32()),
                    ("threshold", pa.float64()), ("gain", pa.float64()), ("left", pa.int64()), ("right", pa.int64())])


def rate(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What is to be as large as possible: sum of squared class counts by rows, of both parts. Classes are the last
    axis."""
    right = total - left
    n, m = left.sum(-1), right.sum(-1)
    return (left * left).sum(-1) / np.maximum(n, 1) + (right * right).sum(-1) / np.maximum(m, 1)


def middle(a, b):
    """The threshold between two values; rows up to it go left."""
    mid = a + (b - a) / 2
    return np.where((mid >= b) | ~np.isfinite(mid), a, mid)


def _node(id_: int, depth: int, counts: np.ndarray, split=None) -> dict:
    n = int(counts.sum())
    square = float((counts.astype(float) ** 2).sum()) / n / n
    out = {"id": id_, "depth": depth, "n": n, "counts": counts.tolist(), "impurity": 1.0 - square,
           "prediction": int(counts.argmax()), "feature": None, "threshold": None, "gain": None, "left": None, "right": None}
    if split:
        score, feature, threshold, left, right = split
        out.update(feature=int(feature), threshold=float(threshold), gain=float(score) / n - square, left=left, right=right)
    return out


def grow(x: np.ndarray, y: np.ndarray, classes: int, root: int, depth: int) -> list[dict]:
    """The whole tree of the rows ``x`` (rows, features) with classes ``y``; nodes are ``root``, ``root + 1``, .."""
    return grown(np.asarray(x).T, y, classes, root, depth).to_pylist()


def grown(xt: Sequence[np.ndarray], y: np.ndarray, classes: int, root: int, depth: int) -> pa.Table:
    """The same of rows by feature, as a table. All nodes of a depth are split together, so a node costs no call of its
    own. A feature with few values is counted by node and value. Of any other the rows are kept in its order, node by node,
    and divided stably."""
    y = y.astype(np.int32)
    coded = [np.unique(v, return_inverse=True) for v in xt]
    values, codes = [v for v, _ in coded], np.array([c for _, c in coded], np.int32).reshape(len(coded), len(y))
    del coded
    order = {f: np.argsort(codes[f], kind="stable").astype(np.int32) for f, v in enumerate(values) if len(v) > COUNTED}
    rows, at = np.arange(len(y), dtype=np.int32), np.zeros(len(y), np.int32)     # rows in question and their nodes
    ids, total, out, made = np.array([root]), np.bincount(y, minlength=classes)[None], [], 1
    if np.count_nonzero(total) < 2:
        return _leaves(ids, depth, total)
    side = np.empty(len(y), np.int8)
    while len(ids):
        k, n, whole = np.arange(len(ids)), total.sum(1), total.astype(float)
        begin = np.cumsum(n) - n
        best, feature = np.full(len(ids), -1.0), np.full(len(ids), -1)
        cut, after, low = np.zeros(len(ids), int), np.zeros(len(ids), int), np.zeros_like(total)
        for f, v in enumerate(values):
            if f in order:
                held = order[f]
                code, of, own = codes[f][held], y[held], np.repeat(k, n)
                left = []
                for c in range(classes - 1):
                    sums = np.cumsum(of == c, dtype=float)
                    left.append(sums - np.repeat(np.append(0.0, sums)[begin], n))
                m = np.arange(1.0, len(held) + 1) - np.repeat(begin.astype(float), n)
                left.append(m - sum(left))
                rest = np.repeat(n.astype(float), n) - m
                square, other = (sum(a * a for a in side_) for side_ in (
                    left, [np.repeat(whole[:, c], n) - a for c, a in enumerate(left)]))
                score = square / m + other / np.maximum(rest, 1)
                score[:-1][code[1:] == code[:-1]] = -1.0
                score[begin + n - 1] = -1.0
                most = np.maximum.reduceat(score, begin)
                better = most > best
                if better.any():
                    hit = np.flatnonzero(score == np.where(better, most, np.inf)[own])
                    hit = hit[np.diff(own[hit], prepend=-1) > 0]                 # the smallest threshold
                    i = own[hit]
                    best[i], feature[i], cut[i], after[i] = most[i], f, code[hit], code[hit + 1]
                    low[i] = np.stack([a[hit] for a in left], 1)
            elif len(v) > 1:
                size = len(v)
                found = np.bincount((at * size + codes[f][rows]) * classes + y[rows], minlength=len(ids) * size * classes)
                found = found.reshape(len(ids), size, classes)
                has, left = found.any(2), found.cumsum(1)
                ok = has & (left.sum(2) < n[:, None])
                score = np.where(ok, rate(left.astype(float), whole[:, None]), -1.0)
                j = score.argmax(1)
                i = np.flatnonzero(score[k, j] > best)
                j = j[i]
                best[i], feature[i], cut[i], low[i] = score[i, j], f, j, left[i, j]
                after[i] = (has[i] & (np.arange(size) > j[:, None])).argmax(1)
        inner = feature >= 0
        i = np.flatnonzero(inner)
        threshold = np.zeros(len(ids))
        for f in np.unique(feature[i]):
            mine = feature == f
            threshold[mine] = middle(values[f][cut[mine]], values[f][after[mine]])
        kid = root + made + 2 * (np.cumsum(inner) - 1)
        out.append(_split(ids, depth, total, inner, best, feature, threshold, kid))
        made += 2 * len(i)
        # children of several classes are next; rows of all others are done
        kids = np.stack([low, total - low], 1)
        goes = inner[:, None] & (np.count_nonzero(kids, axis=2) > 1)
        depth += 1
        pure = inner[:, None] & ~goes
        if pure.any():
            out.append(_leaves(np.stack([kid, kid + 1], 1)[pure], depth, kids[pure]))
        number = (np.cumsum(goes.reshape(-1)) - 1).reshape(goes.shape)
        right = (codes[np.maximum(feature, 0)[at], rows] > cut[at]).astype(np.int8)
        keep = goes[at, right]
        side[rows] = np.where(keep, right, 2)
        rows, at = rows[keep], number[at, right][keep].astype(np.int32)
        ids, total = np.stack([kid, kid + 1], 1)[goes], kids[goes]
        to_right = np.repeat(np.nonzero(goes)[1] > 0, total.sum(1))
        for f, held in order.items():
            to, new = side[held], np.empty(len(rows), np.int32)
            new[~to_right], new[to_right] = held[to == 0], held[to == 1]
            order[f] = new
    return pa.concat_tables(out).combine_chunks()


def _split(ids, depth: int, total, inner, best, feature, threshold, kid) -> pa.Table:
    """Nodes as a table, those of ``inner`` with their splits."""
    n = total.sum(1)
    square = (total.astype(float) ** 2).sum(1) / n / n
    gone = ~inner
    return pa.table([
        pa.array(ids, pa.int64()), pa.array(np.full(len(ids), depth), pa.int32()), pa.array(n, pa.int64()),
        pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * total.shape[1], pa.int32()),
                                 pa.array(total.reshape(-1), pa.int64())),
        pa.array(1.0 - square), pa.array(total.argmax(1), pa.int32()), pa.array(feature, pa.int32(), mask=gone),
        pa.array(threshold, pa.float64(), mask=gone), pa.array(best / n - square, mask=gone),
        pa.array(kid, pa.int64(), mask=gone), pa.array(kid + 1, pa.int64(), mask=gone)], schema=_ARROW)


def _leaves(ids, depth: int, total) -> pa.Table:
    none = np.zeros(len(ids), int)
    return _split(ids, depth, total, none > 0, none + 0.0, none, none + 0.0, none)


class Steps:
    """Splits ``(node, feature, threshold, left, right)`` by node."""

    def __init__(self, moves: Sequence[tuple]):
        moves = sorted(moves)
        self.node, self.feature, self.left, self.right = (np.array([m[i] for m in moves], np.int64) for i in (0, 1, 3, 4))
        self.threshold = np.array([m[2] for m in moves])

    def walk(self, node: np.ndarray, xt: np.ndarray) -> np.ndarray:
        """The nodes in which rows that are in ``node`` end; ``xt`` has a row for each feature."""
        node, rows = node.copy(), np.arange(len(node))
        while len(rows) and len(self.node):
            at = np.searchsorted(self.node, node[rows]).clip(max=len(self.node) - 1)
            inner = self.node[at] == node[rows]
            rows, at = rows[inner], at[inner]
            node[rows] = np.where(xt[self.feature[at], rows] <= self.threshold[at], self.left[at], self.right[at])
        return node


def _matrix(x: pa.ListArray) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


class Block:
    """Some rows of one node: values and bins by feature, and classes."""

    def __init__(self, width: int, node: int, x: pa.Scalar, bin_: pa.Scalar, y: pa.Scalar):
        self.node, self.y = node, np.frombuffer(y.as_buffer(), np.int32)
        self.x = np.frombuffer(x.as_buffer()).reshape(width, len(self.y))
        self.bin = np.frombuffer(bin_.as_buffer(), np.uint16).reshape(width, len(self.y))


def _held_in(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Block]:
    for b in batches:
        for row in zip(b.column("node").to_pylist(), *[b.column(c) for c in ("x", "bin", "y")]):
            yield Block(width, *row)


def _block(node: int, x: np.ndarray, bin_: np.ndarray, y: np.ndarray, odd: bytes | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"node": pa.array([node], pa.int64()), "odd": pa.array([odd], pa.binary()), **{
        k: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for k, v in (("x", x), ("bin", bin_), ("y", y))}})


BLOCKS = "node long, odd binary, x binary, bin binary, y binary"


def _blocks(rows: DataFrame, width: int, borders: list[np.ndarray]) -> DataFrame:
    """``rows`` in blocks of node 0, written row by row (readers of columns would hold many blocks). ``odd`` has a bit for every feature and bin: whether the block has a value
    there that does not end the bin."""
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast(borders)
    size = max(1, min(1 << 16, BLOCK_CELLS // max(1, width)))

    def pack(batches):
        borders = held.value
        bins = max((len(b) for b in borders), default=0) + 1

        def put(some):
            t = pa.Table.from_batches(some)
            x = np.ascontiguousarray(_matrix(t.column("x").combine_chunks()).T)
            bin_, odd = np.zeros(x.shape, np.uint16), np.zeros((width, bins), bool)
            for f, q in enumerate(borders):
                bin_[f] = np.searchsorted(q, x[f])
                odd[f, bin_[f][np.append(q, np.nan)[bin_[f]] != x[f]]] = True
            return _block(0, x, bin_, t.column("y").to_numpy(), np.packbits(odd).tobytes())

        some, n = [], 0
        for b in batches:
            for lo in range(0, b.num_rows, size):
                part = b.slice(lo, size)
                if n and n + part.num_rows > size:
                    yield put(some)
                    some, n = [], 0
                some, n = [*some, part], n + part.num_rows
        if n:
            yield put(some)

    return cut_lineage(rows.select("x", "y").mapInArrow(pack, BLOCKS))


def _borders(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Some quantiles of every feature, ascending; a bin ends with each."""
    bins = max(16, min(BINS, BIN_CELLS // max(1, width)))
    marks = [i / bins for i in range(1, bins)]
    found = rows.select(F.posexplode("x").alias("feature", "value")).groupBy("feature").agg(
        F.percentile_approx("value", marks, 4 * bins).alias("q")).collect()
    return [np.unique(q) for _, q in sorted((r["feature"], r["q"]) for r in found)]


def _odd(blocks: DataFrame, width: int, bins: int) -> np.ndarray:
    """Whether a feature's bin has several values, or one that does not end it."""
    def either(batches):
        found = None
        for b in batches:
            for body in b.column("odd"):
                bits = np.frombuffer(body.as_buffer(), np.uint8)
                found = bits if found is None else found | bits
        if found is not None:
            yield pa.RecordBatch.from_pydict({"odd": pa.array([found.tobytes()], pa.binary())})

    parts = [np.frombuffer(r["odd"], np.uint8) for r in blocks.select("odd").mapInArrow(either, "odd binary").collect()]
    return np.unpackbits(np.bitwise_or.reduce(parts), count=width * bins).reshape(width, bins).astype(bool)


def _best_splits(blocks: DataFrame, steps: Steps, nodes: list[int], classes: int, borders: list[np.ndarray],
                 odd: np.ndarray) -> dict:
    """For every one of ``nodes``, to which ``steps`` lead the rows of ``blocks``: its class counts, and the best split
    if it has one (``score, feature, threshold, low``, the last being the class counts of the left part)."""
    spark, width = blocks.sparkSession, len(borders)
    nodes = np.array(sorted(nodes), np.int64)
    bins = odd.shape[1]
    shape = (len(nodes), width, bins, classes)
    held = spark.sparkContext.broadcast((steps, nodes))

    def placed(batches):
        """Blocks, and the number of the node for those of their rows that are in question."""
        steps, nodes = held.value
        for b in _held_in(batches, width):
            node = steps.walk(np.full(len(b.y), b.node), b.x)
            at = np.searchsorted(nodes, node).clip(max=len(nodes) - 1)
            here = np.flatnonzero(nodes[at] == node)
            if len(here):
                yield b, at[here], here

    def count(batches):
        total = None
        for b, at, here in placed(batches):
            if total is None:
                total = np.zeros((width, shape[0] * bins * classes), np.int64)
            cell, y = at * bins, b.y[here]
            for f in range(width):
                total[f] += np.bincount((cell + b.bin[f, here]) * classes + y, minlength=total.shape[1])
        if total is not None:
            total = total.reshape(-1)
            at = range(0, len(total), SLICE)
            yield pa.RecordBatch.from_pydict({"slice": pa.array(range(len(at)), pa.int32()),
                                              "body": pa.array([total[i:i + SLICE].tobytes() for i in at], pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        found = np.sum([np.frombuffer(x.as_buffer(), np.int64) for x in t.column("body")], axis=0)
        return pa.table({"slice": t.column("slice").slice(0, 1), "body": pa.array([found.tobytes()], pa.binary())})

    sums = blocks.mapInArrow(count, "slice int, body binary").groupBy("slice").applyInArrow(add, "slice int, body binary").collect()
    counts = np.concatenate([np.frombuffer(r["body"], np.int64) for r in sorted(sums, key=lambda r: r["slice"])])
    counts = counts.reshape(width, shape[0], bins, classes).transpose(1, 0, 2, 3)
    total = counts[:, 0].sum(1)                                     # (node, class)
    whole = total[:, None, None, :].astype(float)
    after = counts.cumsum(2)
    before = after - counts
    full = counts.sum(-1) > 0
    ends = np.where(full & (after.sum(-1) < total.sum(-1)[:, None, None]), rate(after.astype(float), whole), -1.0)
    least = ends.max((1, 2))[:, None, None]                         # the best split is at least as good
    asked = full & odd                                              # one value cannot be cut
    if classes <= CORNER_CLASSES:
        reach = np.max([rate((before + counts * [c >> k & 1 for k in range(classes)]).astype(float), whole)
                        for c in range(1 << classes)], axis=0)
        asked &= reach >= least - 1e-9 * np.abs(least)
    # the best cut at a bin's end lies between its last value and the first one of the next bin that has rows
    edges = []
    for i in range(len(nodes)):
        f, k = np.unravel_index(ends[i].argmax(), ends[i].shape)
        if ends[i, f, k] >= 0:
            edges.append((i, f, k, k + 1 + int(full[i, f, k + 1:].argmax())))
    # bins to be counted by their values, dealt in ranges of about as many rows
    rows = np.where(asked, counts.sum(-1), 0).reshape(-1, bins)
    before_here = rows.cumsum(1) - rows
    part = before_here // VALUE_ROWS
    first = np.concatenate([[0], np.cumsum(part[:, -1] + 1)[:-1]]) if len(part) else np.zeros(0, int)
    part = (part + first[:, None]).reshape(shape[:3])               # number of the range, by node, feature and bin
    told = spark.sparkContext.broadcast((asked, part, edges, before, total))

    def values(batches):
        asked, part, edges, _, _ = told.value
        found: dict = {}
        size = 0

        def put():
            keys = sorted(found)
            return pa.RecordBatch.from_pydict({
                "part": pa.array(keys, pa.int64()), "last": pa.nulls(len(keys), pa.float64()), "first": pa.nulls(len(keys), pa.float64()),
                **{name: pa.array([np.concatenate([v[j] for v in found[k]]).tobytes() for k in keys], pa.binary())
                   for j, name in enumerate(("list", "bin", "value", "y"))}})

        for b, at, here in placed(batches):
            y = b.y[here].astype(np.uint16)
            for f in np.flatnonzero(asked.any((0, 2))):
                bin_ = b.bin[f, here]
                take = np.flatnonzero(asked[at, f, bin_])
                to = part[at[take], f, bin_[take]]
                order = np.argsort(to, kind="stable")
                take, to = take[order], to[order]
                cuts = np.flatnonzero(np.diff(to, prepend=-1))
                for lo, hi in zip(cuts, np.append(cuts[1:], len(to))):
                    rows = take[lo:hi]
                    found.setdefault(int(to[lo]), []).append(
                        (np.array([at[rows[0]] * width + f]), bin_[rows], b.x[f, here[rows]], y[rows]))
                size += 12 * len(take)
            for i, f, k, k2 in edges:
                bin_ = np.where(at == i, b.bin[f, here], bins)
                last, first = b.x[f, here[bin_ == k]], b.x[f, here[bin_ == k2]]
                if len(last) + len(first):
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([-1 - i], pa.int64()), "last": pa.array([last.max() if len(last) else None], pa.float64()),
                        "first": pa.array([first.min() if len(first) else None], pa.float64()),
                        **{c: pa.nulls(1, pa.binary()) for c in ("list", "bin", "value", "y")}})
            if size > VALUE_BYTES:
                yield put()
                found, size = {}, 0
        if found:
            yield put()

    kind = pa.schema([("part", pa.int64()), ("list", pa.int64()), ("score", pa.float64()), ("threshold", pa.float64()),
                      ("low", pa.list_(pa.int64())), ("last", pa.float64()), ("first", pa.float64())])

    def best(t: pa.Table) -> pa.Table:
        _, _, _, before, total = told.value
        out = {"part": t.column("part")[0].as_py()}
        if out["part"] < 0:
            out |= {"last": pa.compute.max(t.column("last")).as_py(), "first": pa.compute.min(t.column("first")).as_py()}
            return pa.Table.from_pylist([out], kind)
        list_ = np.frombuffer(t.column("list")[0].as_buffer(), np.int64)[0]
        i, f = divmod(int(list_), width)
        bin_, value, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), d) for c, d in (
            ("bin", np.uint16), ("value", np.float64), ("y", np.uint16)))
        order = np.argsort(value, kind="stable")
        bin_, value, y = bin_[order], value[order], y[order]
        # a cut between two values of one bin; a bin's rows stand together
        at = np.flatnonzero((value[1:] > value[:-1]) & (bin_[1:] == bin_[:-1]))
        if not len(at):
            return pa.Table.from_pylist([out | {"list": list_, "score": -1.0}], kind)
        start = np.searchsorted(bin_, bin_[at])
        low = np.empty((len(at), classes), np.int64)
        for c in range(classes):
            sums = np.append(0, np.cumsum(y == c))
            low[:, c] = sums[at + 1] - sums[start] + before[i, f, bin_[at], c]
        score = rate(low.astype(float), total[i].astype(float))
        j = int(score.argmax())
        return pa.Table.from_pylist([out | {"list": list_, "score": score[j], "low": low[j].tolist(), "threshold": float(
            middle(value[at[j]], value[at[j] + 1]))}], kind)

    found = blocks.mapInArrow(
        values, "part long, last double, first double, list binary, bin binary, value binary, y binary").groupBy("part").applyInArrow(
        best, "part long, list long, score double, threshold double, low array<long>, last double, first double").collect()
    held.destroy()
    told.destroy()
    out = {int(n): {"total": total[i], "score": -1.0} for i, n in enumerate(nodes)}

    def offer(i: int, score: float, f: int, threshold: float, low: Sequence):
        r = out[int(nodes[i])]
        if score >= 0 and (r["score"] < 0 or (score, -f, -threshold) > (r["score"], -r["feature"], -r["threshold"])):
            r.update(score=score, feature=f, threshold=threshold, low=np.array(low))

    between = {-1 - r["part"]: r for r in found if r["part"] < 0}
    for i, f, k, _ in edges:
        offer(i, float(ends[i, f, k]), int(f), float(middle(between[i]["last"], between[i]["first"])), after[i, f, k])
    for r in found:
        if r["part"] >= 0:
            offer(r["list"] // width, r["score"], r["list"] % width, r["threshold"], r["low"])
    return out


@dataclass
class Tree:
    """A fitted tree: ``nodes`` (``NODES``) with the root at id 0; rows with ``feature <= threshold`` go left. ``moves``
    are the splits above the parts that were finished in a task each; a part's nodes agree in ``id >> 32``."""
    nodes: DataFrame
    features: str
    held: int = HELD_NODES
    moves: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``: the class of most rows in the leaf, of equal ones the smallest. A null vector
        has a null prediction."""
        if self.nodes.count() > self.held:
            return self._walk(df)
        t = self.nodes.orderBy("id").toPandas()
        ids = t["id"].to_numpy()
        leaf = t["feature"].isna().to_numpy()
        child = [np.where(leaf, np.arange(len(t)), np.searchsorted(ids, t[c].fillna(-1).to_numpy())) for c in ("left", "right")]
        held = df.sparkSession.sparkContext.broadcast((
            t["feature"].fillna(0).to_numpy(np.int64), t["threshold"].fillna(0).to_numpy(float), *child, leaf,
            t["prediction"].to_numpy(float)))

        @F.arrow_udf("double")
        def walk(vector: pa.Array) -> pa.Array:
            feature, threshold, left, right, leaf, prediction = held.value
            good = pa.compute.is_valid(vector).to_numpy(zero_copy_only=False)
            x = vector.drop_null()
            out = np.full(len(vector), np.nan)
            if len(x):
                values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
                at = np.zeros(len(x), np.int64)
                while not leaf[at].all():
                    at = np.where(values[np.arange(len(x)), feature[at]] <= threshold[at], left[at], right[at])
                out[good] = prediction[at]
            return pa.array(out, mask=~good)

        return df.withColumn("prediction", walk(vector_to_array(self.features)))

    def _walk(self, df: DataFrame) -> DataFrame:
        """The same for a tree too large to hold: rows go to the part that their way leads to, and meet its nodes there."""
        spark = df.sparkSession
        rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "walk")
        steps = spark.sparkContext.broadcast(Steps(self.moves))

        @F.arrow_udf("long")
        def part(x: pa.Array) -> pa.Array:
            return pa.array(steps.value.walk(np.zeros(len(x), np.int64), _matrix(x).T))

        x = rows.where(F.col(self.features).isNotNull()).select("_row", vector_to_array(self.features).alias("x"))
        x = stored(x.select("_row", "x", part("x").alias("part")), "walk")
        # a part that many rows go to is met in several tasks
        shares = stored(x.groupBy("part").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("shares")), "shares")
        x = x.join(shares, "part").select("_row", "x", "part", F.pmod(F.xxhash64("_row"), "shares").cast("int").alias("share"))
        nodes = self.nodes.withColumn("part", F.shiftright("id", 32)).join(shares, "part").select(
            "part", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "id", "feature", "threshold", "left", "right",
            "prediction")

        def walk(key, x, nodes):
            nodes = nodes.sort_by("id")
            ids, prediction = nodes.column("id").to_numpy(), nodes.column("prediction").to_numpy()
            feature = nodes.column("feature").fill_null(-1).to_numpy()
            left, right = (np.searchsorted(ids, nodes.column(c).fill_null(0).to_numpy()) for c in ("left", "right"))
            threshold = nodes.column("threshold").fill_null(0).to_numpy()
            xt = _matrix(x.column("x").combine_chunks()).T
            at = np.zeros(x.num_rows, np.int64)
            rows = np.flatnonzero(feature[at] >= 0)
            while len(rows):
                here = at[rows]
                at[rows] = np.where(xt[feature[here], rows] <= threshold[here], left[here], right[here])
                rows = rows[feature[at[rows]] >= 0]
            return pa.table({"_row": x.column("_row"), "prediction": prediction[at].astype(float)})

        found = x.groupBy("part", "share").cogroup(nodes.groupBy("part", "share")).applyInArrow(walk, "_row long, prediction double")
        return rows.join(found, "_row", "left").drop("_row")


def fit(train: DataFrame, features: str = "features", label: str = "label", local_cells: int = LOCAL_CELLS) -> Tree:
    """Grow a tree on rows with a vector ``features`` and a class number ``label`` (0, 1, ..) until every leaf is pure
    or its rows agree in all features. Rows with a null in either take no part; values must not be NaN. An empty table
    gives a tree without nodes, and cannot score."""
    spark = train.sparkSession
    ship_package(spark)
    rows = stored(train.where(F.col(features).isNotNull() & F.col(label).isNotNull()).select(
        vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y")), "rows")
    seen = rows.agg(F.count("*").alias("n"), F.max("y").alias("y"), F.max(F.size("x")).alias("width")).first()
    if not seen["n"]:
        return Tree(spark.createDataFrame([], NODES), features)
    classes, width, few = seen["y"] + 1, seen["width"], max(1, local_cells // max(1, seen["width"]))
    if not width:                    # vectors without features
        counts = np.zeros(classes, np.int64)
        for r in rows.groupBy("y").count().collect():
            counts[r["y"]] = r["count"]
        return Tree(stored(spark.createDataFrame([tuple(_node(0, 0, counts)[f.name] for f in _ARROW)], NODES), "nodes"), features)
    top: list[dict] = []             # nodes split over the cluster: fewer than rows / few a level
    small: dict = {0: 0} if seen["n"] <= few else {}     # depths of nodes that tasks finish
    large: dict = {} if small else {0: 0}
    number = 1                       # a node's id is its number here times 2^32; nodes inside add to that
    borders = _borders(rows, width) if large else []
    blocks = _blocks(rows, width, borders)
    odd = _odd(blocks, width, max(len(b) for b in borders) + 1) if large else None
    every: list[tuple] = []
    moves: list[tuple] = []          # since the rows' blocks were written
    base, levels, done, waiting = list(large), 0, blocks if small else None, set()
    while large:
        splits = _best_splits(blocks.where(F.col("node").isin(base)), Steps(moves), list(large), classes, borders, odd)
        next_large: dict = {}
        for node, depth in large.items():
            r = splits[node]
            total = r["total"]
            if r["score"] < 0 or np.count_nonzero(total) == 1:       # all rows agree
                top.append(_node(node << 32, depth, total))
                continue
            low = r["low"]
            kids = []
            for counts in (low, total - low):
                kid, number = number, number + 1
                kids.append(kid)
                if np.count_nonzero(counts) == 1:
                    top.append(_node(kid << 32, depth + 1, counts))
                elif counts.sum() <= few:
                    small[kid] = depth + 1
                    waiting.add(kid)
                else:
                    next_large[kid] = depth + 1
            moves.append((node, r["feature"], r["threshold"], *kids))
            top.append(_node(node << 32, depth, total, (r["score"], r["feature"], r["threshold"], kids[0] << 32, kids[1] << 32)))
        large, levels = next_large, levels + 1
        if moves and (levels % STORE_LEVELS == 0 or not large):
            blocks = _settled(blocks.where(F.col("node").isin(base)), Steps(moves), width, waiting | set(large))
            mine = blocks.where(F.col("node").isin(sorted(waiting)))
            done = mine if done is None else done.union(mine)
            every, moves, base, waiting = every + moves, [], list(large), set()

    def finish(key, t):
        node = key[0].as_py()
        y = np.frombuffer(b"".join(t.column("y").to_pylist()), np.int32)
        n = [x.as_buffer().size // 8 // width for x in t.column("x")]
        xt = [np.concatenate([np.frombuffer(x.as_buffer(), np.float64, m, 8 * m * f) for m, x in zip(n, t.column("x"))])
              for f in range(width)]
        return grown(xt, y, classes, node << 32, small[node])

    nodes = spark.createDataFrame([tuple(n[f.name] for f in _ARROW) for n in top], NODES)
    if small:
        nodes = nodes.union(done.select("node", "x", "y").groupBy("node").applyInArrow(finish, NODES))
    return Tree(stored(nodes, "nodes"), features, moves=every)


def _settled(blocks: DataFrame, steps: Steps, width: int, keep: set) -> DataFrame:
    """The rows in blocks of the nodes of ``keep`` that ``steps`` lead them to, written; other rows are done."""
    held = blocks.sparkSession.sparkContext.broadcast((steps, np.array(sorted(keep), np.int64)))

    def move(batches):
        steps, keep = held.value
        for b in _held_in(batches, width):
            node = steps.walk(np.full(len(b.y), b.node), b.x)
            for k in np.intersect1d(node, keep):
                rows = np.flatnonzero(node == k)
                yield _block(int(k), b.x[:, rows], b.bin[:, rows], b.y[rows])

    return cut_lineage(blocks.mapInArrow(move, BLOCKS))
