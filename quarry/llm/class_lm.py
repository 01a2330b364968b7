"""Scoring by a Brown class-based bigram model.

Words are assigned to classes by exchange: a word moves to the class that raises the likelihood of the class bigrams
most. The ``HEAD`` most frequent words are exchanged one after the other until nothing moves, which gives the classes
their shape. Then every word that training holds twice or more is exchanged in distributed rounds: its neighbours'
classes are counted over the corpus, sparsely, and all words are compared with the same table of class bigrams and move
at once (the way of Uszkoreit and Brants, 2008). What is rarer, seen or not, moves with the words of the same last two
bytes; there are at most 65,792 such endings at any size. So the units that move grow with the corpus.

A text's probability is the product, over its words and its end, of the class transition (interpolated with the class
unigram, Witten and Bell) and the word's emission by its class (absolute discounting; what the discount saves is the
probability of the class's unseen words as one event).

All counts are exact and come from all training documents. Texts are read and split into words once: they are held in
chunks as codes of the chunk's distinct words. The vocabulary is dealt in slices by a hash of the word, never broadcast:
a chunk tells a slice what its words do, in one packed message, and is answered in the same order. A word costs an entry
for each chunk that has it, not for each occurrence, so frequent words are no hot keys.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, cut_lineage_by, rows_of, shuffle_partitions, tidy, unzip, zip_
from quarry.session import stored

HEAD = 1024                  # words that are exchanged one after the other, the most frequent ones
CLASSES = 64                 # at most 250
ROUNDS = 20                  # over the head
SWEEPS = 2                   # distributed rounds over all words
OFTEN = 1000                 # training tokens from which a word's gain is taken in full, not to first order
CHUNK = 8 << 20
PIECE = 1 << 20              # bytes of text, or words, that are worked on at once within a chunk
SLICE = 32 << 20             # bytes of text for each slice of the vocabulary
TABLE = 64                   # the head's bigram table travels in so many pieces
PART = 12                    # endings in 2^PART share a message
BASE = 0.1                   # added to counts by the base score
NONE = 255                   # no class yet

_CODED = "chunk long, docs binary, codes binary, slices binary, cuts binary, endings binary, words binary"
_COUNTS = "chunk long, slice long, rank binary, c binary, words binary"
_SAID = "chunk long, slice long, rank binary, entries binary, col binary, n binary"
_CLASSES = "chunk long, slice long, of binary"


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every unit, from counts of unit pairs. Unit 0 (the end) is class 0 and stays there; the others start in
    turn, most frequent first, in classes 1 .. ``classes``. Ties go to the smallest class."""
    n = len(bigrams)
    total = bigrams.sum(0) + bigrams.sum(1)
    order = 1 + np.argsort(-total[1:], kind="stable")
    of = np.zeros(n, np.int64)
    of[order] = 1 + np.arange(n - 1) % classes
    k = classes + 1
    member = np.zeros((n, k))
    member[np.arange(n), of] = 1
    after, before = bigrams @ member, bigrams.T @ member      # [u, class of the next], [u, class of the one before]
    table = member.T @ after
    for _ in range(rounds):
        moved = 0
        for u in order:
            if not total[u]:
                continue
            old, own = of[u], bigrams[u, u]
            out, into = after[u].copy(), before[u].copy()
            out[old] -= own                                    # pairs with others only
            into[old] -= own
            table[old] -= out
            table[:, old] -= into
            table[old, old] -= own
            # gain of adding u to each class: its row and its column change, and where they cross
            row = (_h(table + out) - _h(table)).sum(1) - (_h(np.diag(table) + out) - _h(np.diag(table)))
            col = (_h(table + into[:, None]) - _h(table)).sum(0) - (_h(np.diag(table) + into) - _h(np.diag(table)))
            cross = _h(np.diag(table) + out + into + own) - _h(np.diag(table))
            rows, cols = table.sum(1), table.sum(0)
            gain = row + col + cross - (_h(rows + out.sum() + own) - _h(rows)) - (_h(cols + into.sum() + own) - _h(cols))
            # the sums of other classes' rows and columns change as well
            gain -= (_h(cols + out) - _h(cols)).sum() - (_h(cols + out) - _h(cols))
            gain -= (_h(rows + into) - _h(rows)).sum() - (_h(rows + into) - _h(rows))
            gain += (_h(rows + out.sum() + own) - _h(rows + out.sum() + own + into)
                     + _h(cols + into.sum() + own) - _h(cols + into.sum() + own + out))
            gain[0] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9 * abs(gain[old]):
                new = old
            table[new] += out
            table[:, new] += into
            table[new, new] += own
            if new != old:
                moved += 1
                of[u] = new
                after[:, old] -= bigrams[:, u]
                after[:, new] += bigrams[:, u]
                before[:, old] -= bigrams[u]
                before[:, new] += bigrams[u]
        if not moved:
            break
    return of


def packed(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def table(**columns) -> pa.Table:
    return pa.table({k: v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v) for k, v in columns.items()})


def split(texts: pa.ChunkedArray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """All words as numbers in the list of distinct ones (empty ones, too), that list, and how many each text has. What
    the words take while they are split is bounded by ``PIECE`` bytes of text and the longest text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    at, names, count, lo = [], [], [], 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE, side="right")))
        raw = pa.array([t.translate(LOWER) for t in texts.slice(lo, hi - lo).to_pylist()], pa.large_binary())
        lists = pc.ascii_split_whitespace(raw.view(pa.large_string()))
        some = lists.flatten().dictionary_encode()
        at.append(some.indices.to_numpy())
        names.append(some.dictionary.view(pa.large_binary()))
        count.append(pc.list_value_length(lists).to_numpy())
        lo = hi
    whole = pa.concat_arrays(names).dictionary_encode()
    number, start = whole.indices.to_numpy(), np.cumsum([0, *map(len, names)])
    return (np.concatenate([number[i:][a] for i, a in zip(start, at)]), whole.dictionary.to_pylist(),
            np.concatenate(count).astype(np.int64))


def coded(rows: pa.Table, number: int, slices: int) -> dict:
    """A chunk: its documents (without texts), the codes of their words and ends (0), and its distinct words, whose codes
    go by slice: those of ``slices[i]`` begin at ``cuts[i]``."""
    at, words, count = split(rows.column("text"))
    good = np.array([w != b"" for w in words], bool)
    of = np.array([zlib.crc32(w) % slices if w else -1 for w in words], np.int64)
    order = np.argsort(of, kind="stable")[int((~good).sum()):]
    code = np.zeros(len(words), np.int32)
    code[order] = 1 + np.arange(len(order))
    at = code[at]                                            # 0 for what is no word
    edge = np.append(0, np.cumsum(at > 0, dtype=np.int32))[np.append(0, np.cumsum(count))]
    length = np.diff(edge).astype(np.int64) + 1
    codes, word = np.zeros(int(length.sum()), np.int32), np.ones(int(length.sum()), bool)
    word[np.cumsum(length) - 1] = False                      # an end stands behind every document
    codes[word] = at[at > 0]
    held = rows.column("held").to_numpy(zero_copy_only=False).astype(bool)
    n = np.bincount(codes[np.repeat(~held, length)], minlength=len(order) + 1)[1:]
    words = [words[i] for i in order]
    of = of[order]
    cut = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else of
    return {"chunk": number, "docs": packed(table(id=rows.column("id"), held=held, length=length)), "codes": zip_(codes),
            "slices": zip_(of[cut]), "cuts": zip_(1 + cut.astype(np.int64)),
            "endings": zip_(np.array([ending(w) for w in words], np.int32)),
            "words": packed(table(word=pa.array(words, pa.binary()), n=n))}


def ending(word: bytes) -> int:
    """The last two bytes as a number; one byte alone is smaller than 256."""
    return word[-1] if len(word) == 1 else 256 + word[-2] * 256 + word[-1]


ENDINGS = 256 + 65536


class Chunk:
    """A chunk with what it was answered: of every word its rank in its slice, training tokens and class."""

    def __init__(self, row: dict, counts: pa.Table, classes: pa.Table | None):
        self.docs = rows_of(pa.scalar(row["docs"], pa.binary()))
        self.codes = unzip(row["codes"], np.int32)
        self.endings = unzip(row["endings"], np.int32)
        self.slices, self.cuts = unzip(row["slices"], np.int64), np.append(unzip(row["cuts"], np.int64), len(self.endings) + 1)
        told = {s: (r, c) for s, r, c in zip(*[counts.column(x).to_pylist() for x in ("slice", "rank", "c")])}
        self.rank = np.concatenate([unzip(told[s][0], np.int32) for s in self.slices.tolist()] or [np.zeros(0, np.int32)])
        self.c = np.concatenate([unzip(told[s][1], np.int64) for s in self.slices.tolist()] or [np.zeros(0, np.int64)])
        self.own = self.c > 1                                # units of their own
        self.of = np.full(len(self.c), NONE, np.uint8)
        if classes is not None:
            named = dict(zip(classes.column("slice").to_pylist(), classes.column("of").to_pylist()))
            for s, a, b in zip(self.slices.tolist(), self.cuts, self.cuts[1:]):
                if s in named:
                    mine = np.flatnonzero(self.own[a - 1:b - 1]) + a - 1
                    self.of[mine] = np.frombuffer(named[s], np.uint8)

    def classes(self, endings: np.ndarray | None, head: dict | None = None) -> np.ndarray:
        """The class of every code; ``NONE`` if it has none yet."""
        of = self.of.copy()
        if head is not None:
            of[:] = NONE
            at = self.head(head["key"]) - 1
            of[at >= 0] = head["of"][at[at >= 0]]
        if endings is not None:
            of[~self.own] = endings[self.endings[~self.own]]
        return np.append(np.uint8(0), of)

    def head(self, key: np.ndarray) -> np.ndarray:
        """Place of every word among the most frequent ones, from 1; 0 for others. ``key``: ascending."""
        mine = np.repeat(self.slices, np.diff(self.cuts)) << 32 | self.rank
        at = np.minimum(np.searchsorted(key, mine), max(0, len(key) - 1))
        return np.where(key[at] == mine, at + 1, 0) if len(key) else np.zeros(len(mine), np.int64)

    def training(self) -> np.ndarray:
        """Codes of all training documents."""
        held = self.docs.column("held").to_numpy(zero_copy_only=False)
        return self.codes[np.repeat(~held, self.docs.column("length").to_numpy())]


def pairs_of(units: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring units and their counts; a document follows an end, and ends with one."""
    at, n = np.unique(np.append(0, units[:-1]).astype(np.int64) * size + units, return_counts=True)
    return at, n


def added(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if len(found) == 1:
        return found[0]
    key, n = map(np.concatenate, zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
    return key[first], np.add.reduceat(n[order], first) if len(key) else n


def contexts(t: Chunk, of: np.ndarray, width: int) -> Iterator[dict]:
    """For every slice what the chunk's words do: for each word of its own how often a class follows it (``col`` below
    ``width``) or stands before it. Endings speak for all rare words, in messages to the slices below 0."""
    code = t.training()
    near = np.concatenate([of[:1], of[code], of[:1]])        # an end stands before and behind
    unit_of = np.append(np.int64(-1), np.where(t.own, np.arange(len(t.own)), len(t.own) + t.endings)) * (2 * width)
    found = []
    for lo in range(0, len(code), PIECE):                    # that many words at a time
        here = code[lo:lo + PIECE]
        before, after = near[lo:lo + len(here)], near[lo + 2:lo + 2 + len(here)]
        unit, some, other = unit_of[here], (here > 0) & (after != NONE), (here > 0) & (before != NONE)
        found.append(np.unique(np.concatenate([unit[some] + after[some], unit[other] + width + before[other]]),
                               return_counts=True))
    key, n = added(found)
    unit, col = key // (2 * width), (key % (2 * width)).astype(np.uint8 if 2 * width <= 256 else np.uint16)
    for s, a, b in zip(t.slices.tolist(), t.cuts - 1, t.cuts[1:] - 1):
        mine = np.flatnonzero(t.own[a:b]) + a
        if len(mine):
            lo, hi = np.searchsorted(unit, [a, b])
            each = np.bincount(np.searchsorted(mine, unit[lo:hi]), minlength=len(mine))
            yield {"slice": s, "rank": zip_(t.rank[mine]), "entries": zip_(each.astype(np.uint16)),
                   "col": zip_(col[lo:hi].astype(np.uint16)), "n": zip_(n[lo:hi].astype(np.uint32))}
    lo = np.searchsorted(unit, len(t.own))
    end = unit[lo:] - len(t.own)
    for p in np.unique(end >> PART).tolist():
        a, b = lo + np.searchsorted(end, [p << PART, (p + 1) << PART])
        which, each = np.unique(unit[a:b], return_counts=True)
        yield {"slice": -1 - p, "rank": zip_((which - len(t.own) - (p << PART)).astype(np.int32)),
               "entries": zip_(each.astype(np.uint16)), "col": zip_(col[a:b].astype(np.uint16)), "n": zip_(n[a:b].astype(np.uint32))}


def best_classes(m: np.ndarray, old: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The class of each unit that raises the likelihood of the class bigrams ``pairs`` most. ``m``: how often each class
    follows the unit, then how often each stands before it. To first order the gain is that of the unit's own bigrams
    under the smoothed class model; units with ``OFTEN`` tokens or more are taken out of the table first, and their gain
    is that of the whole table. Ties go to the smallest class."""
    width = len(pairs)
    after, before = m[:, :width].astype(float), m[:, width:].astype(float)
    step = transitions(pairs) * np.log(10)
    size = np.log(np.maximum(pairs.sum(0), 1.0))
    n = np.maximum(after.sum(1), before.sum(1))
    gain = after @ step.T + before @ step - n[:, None] * size
    gain[:, 0] = -np.inf                                     # the end's class
    of = gain.argmax(1).astype(np.uint8)
    for i in np.flatnonzero(n >= OFTEN):
        t, out, into = pairs.copy(), after[i], before[i]
        if old[i] != NONE:
            t[old[i]] = np.maximum(t[old[i]] - out, 0)
            t[:, old[i]] = np.maximum(t[:, old[i]] - into, 0)
        row, col = t.sum(1), t.sum(0)
        whole = ((_h(t + out) - _h(t)).sum(1) + (_h(t + into[:, None]) - _h(t)).sum(0)
                 - (_h(row + n[i]) - _h(row)) - (_h(col + n[i]) - _h(col)))
        whole[0] = -np.inf
        of[i] = whole.argmax()
    return of


@dataclass(frozen=True)
class Model:
    """Everything that scoring needs but the words' own counts and classes; its size does not depend on the corpus."""
    endings: np.ndarray       # class of every ending
    step: np.ndarray          # log10 P(class | class before)
    count: np.ndarray         # tokens of each class
    unseen: np.ndarray        # log10 P(an unseen word | class)
    discount: np.ndarray
    ends: int                 # training documents
    tokens: int               # of the training documents
    words: int                # distinct ones, with the end

    def emission(self, c: np.ndarray, k: np.ndarray) -> np.ndarray:
        known = np.log10(np.maximum(c - self.discount[k], 1e-300) / np.maximum(self.count[k], 1))
        return np.where(c > 0, known, self.unseen[k])

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + BASE) / (self.tokens + BASE * (self.words + 1)))


def transitions(pairs: np.ndarray) -> np.ndarray:
    """log10 P(class | class before) from counts of class pairs."""
    k = len(pairs)
    single = (pairs.sum(0) + 1) / (pairs.sum() + k)
    kinds = np.maximum((pairs > 0).sum(1), 1)[:, None]
    return np.log10((pairs + kinds * single) / (pairs.sum(1)[:, None] + kinds))


def held_out(id: str) -> Column:
    """Documents that nothing is learnt from: crc32 of the id as text, modulo 10, is 0; also those without an id."""
    return F.crc32(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")).cast("binary")) % 10 == 0


class Job:
    """Clusters the words of ``src`` (``id``, ``held``, binary ``text``) and fits the model."""

    def __init__(self, src: DataFrame, classes: int, head: int, sweeps: int, chunk_bytes: int):
        self.spark, self.width = src.sparkSession, classes + 1
        if not 0 < classes < NONE - 1:
            raise ValueError("classes must be 1 to 253")
        total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        slices = max(shuffle_partitions(self.spark), -(-total // SLICE))

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            held: list[pa.RecordBatch] = []
            size = 0

            def put() -> pa.RecordBatch:
                row = coded(pa.Table.from_batches(held), number, slices)
                return pa.RecordBatch.from_pydict({k: pa.array([v], pa.int64() if k == "chunk" else pa.binary())
                                                   for k, v in row.items()})

            for b in batches:
                ends = np.cumsum(pc.binary_length(b.column("text")).to_numpy().astype(np.int64) + 16)
                at = 0
                while at < b.num_rows:
                    before = int(ends[at - 1]) if at else 0
                    n = max(1, int(np.searchsorted(ends, before + chunk_bytes - size, side="right")) - at)
                    held.append(b.slice(at, n))
                    at += n
                    size += int(ends[at - 1]) - before
                    if size >= chunk_bytes or at < b.num_rows:
                        yield put()
                        number, held, size = number + 1, [], 0
            if held:
                yield put()

        self.chunks = cut_lineage_by(src.mapInArrow(tidy(gather), _CODED), shuffle_partitions(self.spark), "chunk")
        self._count()
        self._cluster(head)
        for _ in range(sweeps):
            self._sweep()
        self.pairs = self._class_pairs()

    def _each(self, run, schema: str, classes: bool = True) -> DataFrame:
        """``run(chunk)`` yields rows for each chunk, which knows the classes found last."""
        told = self.counts
        if classes and self.named is not None:
            told = told.unionByName(self.named.withColumnRenamed("of", "rank").withColumn("c", F.lit(None).cast("binary")))
        width, names = self.width, [x.split()[0] for x in schema.split(", ")]

        def over(key, left: pa.Table, right: pa.Table) -> pa.Table:
            known = pc.is_valid(right.column("c"))
            of = right.filter(pc.invert(known)).select(["slice", "rank"]).rename_columns(["slice", "of"])
            rows = []
            for row in left.to_pylist():
                rows.extend({"chunk": row["chunk"], **r} for r in run(Chunk(row, right.filter(known), of if classes else None)))
            kinds = [pa.int64() if x in ("chunk", "slice", "piece") else pa.binary() for x in names]
            return pa.table([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

        assert width
        return self.chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(tidy(over), schema)

    def _count(self) -> None:
        """Training tokens of every word, the vocabulary, and the model's totals."""
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for row in b.to_pylist():
                    words = rows_of(pa.scalar(row["words"], pa.binary()))
                    slices, cuts = unzip(row["slices"], np.int64), unzip(row["cuts"], np.int64) - 1
                    for s, lo, hi in zip(slices.tolist(), cuts, np.append(cuts[1:], len(words))):
                        yield pa.RecordBatch.from_pydict({
                            "chunk": pa.array([row["chunk"]], pa.int64()), "slice": pa.array([s], pa.int64()),
                            "words": pa.array([packed(words.slice(lo, hi - lo).combine_chunks())], pa.binary())})

        def add(t: pa.Table) -> pa.Table:
            t = t.sort_by("chunk")
            parts = [rows_of(x) for x in t.column("words")]
            whole = pa.concat_tables(parts).combine_chunks()
            at = whole.column("word").combine_chunks().dictionary_encode()
            rank = at.indices.to_numpy().astype(np.int32)
            c = np.bincount(rank, weights=whole.column("n").to_numpy()).astype(np.int64)
            ends = np.cumsum([len(p) for p in parts])
            out = [(i, z, zip_(rank[b - len(p):b]), zip_(c[rank[b - len(p):b]]), None)
                   for i, z, p, b in zip(t.column("chunk").to_pylist(), t.column("slice").to_pylist(), parts, ends)]
            out.append((-1, t.column("slice")[0].as_py(), None, zip_(c), packed(table(word=at.dictionary))))
            return pa.table([pa.array(x, k) for x, k in zip(zip(*out), [pa.int64()] * 2 + [pa.binary()] * 3)],
                            ["chunk", "slice", "rank", "c", "words"])

        asked = self.chunks.select("chunk", "slices", "cuts", "words").mapInArrow(
            tidy(ask), "chunk long, slice long, words binary")
        found = stored(asked.groupBy("slice").applyInArrow(tidy(add), _COUNTS), "counts")
        self.counts = found.where("chunk >= 0").select("chunk", "slice", "rank", "c")
        self.vocabulary = found.where("chunk < 0").select("slice", "c", "words")
        self.named = self.of_words = None
        self.endings = None

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for raw, words in zip(b.column("c").to_pylist(), b.column("words")):
                    c = unzip(raw, np.int64)
                    names = rows_of(words).column("word").to_pylist()
                    end, n = np.unique([ending(names[i]) for i in np.flatnonzero(c == 1)], return_counts=True)
                    yield pa.RecordBatch.from_pydict({
                        "ending": pa.array(np.append(end, -1).astype(np.int32)),
                        "n": pa.array(np.append(n, c.sum()).astype(np.int64)),
                        "v": pa.array(np.append(n, (c > 0).sum()).astype(np.int64))})

        # a row for each ending at most, and one for all words
        each = self.vocabulary.mapInArrow(tidy(sums), "ending int, n long, v long").groupBy("ending").agg(
            F.sum("n").alias("n"), F.sum("v").alias("v")).toPandas()
        self.single = np.zeros(ENDINGS, np.int64)
        some = each[each["ending"] >= 0]
        self.single[some["ending"].to_numpy()] = some["n"].to_numpy()
        words = each[each["ending"] < 0]
        self.tokens, self.words = (int(words[x].sum()) for x in ("n", "v"))

        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                held = [rows_of(x).column("held").to_numpy(zero_copy_only=False) for x in b.column("docs")]
                yield pa.RecordBatch.from_pydict({"n": pa.array([int(sum((~h).sum() for h in held))], pa.int64())})

        self.ends = int(self.chunks.select("docs").mapInArrow(tidy(ends), "n long").agg(F.sum("n")).first()[0] or 0)

    def _cluster(self, head: int) -> None:
        """The most frequent words, exchanged one after the other."""
        def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for z, raw in zip(b.column("slice").to_pylist(), b.column("c").to_pylist()):
                    c = unzip(raw, np.int64)
                    at = np.argsort(-c, kind="stable")[:head]
                    at = at[c[at] > 1]
                    yield pa.RecordBatch.from_pydict({"key": pa.array(at | z << 32, pa.int64()), "c": pa.array(c[at], pa.int64())})

        first = self.vocabulary.select("slice", "c").mapInArrow(tidy(top), "key long, c long")
        key = np.sort(np.array([r["key"] for r in first.orderBy(F.desc("c"), "key").limit(head).collect()], np.int64))
        size, classes = len(key) + 2, self.width - 1         # the end, the words, all others
        rest = size - 1

        def count(t: Chunk) -> Iterator[dict]:
            unit = np.append(np.int64(0), t.head(key))
            unit[1:][unit[1:] == 0] = rest
            at, n = pairs_of(unit[t.training()], size) if len(t.training()) else (np.zeros(0, np.int64),) * 2
            edge = np.searchsorted(at, np.linspace(0, size * size, TABLE + 1).astype(np.int64))
            for i, (a, b) in enumerate(zip(edge, edge[1:])):
                if b > a:
                    yield {"piece": i, "at": zip_(at[a:b].astype(np.int32)), "n": zip_(n[a:b])}

        def add(t: pa.Table) -> pa.Table:
            at = np.concatenate([unzip(x, np.int32) for x in t.column("at").to_pylist()])
            n = np.concatenate([unzip(x, np.int64) for x in t.column("n").to_pylist()])
            at, where = np.unique(at, return_inverse=True)
            n = np.bincount(where, weights=n).astype(np.int64)
            return pa.table({"piece": t.column("piece").slice(0, 1), "at": pa.array([zip_(at)], pa.binary()),
                             "n": pa.array([zip_(n)], pa.binary())})

        def cluster(t: pa.Table) -> pa.Table:
            pairs = np.zeros(size * size)
            for at, n in zip(t.column("at").to_pylist(), t.column("n").to_pylist()):
                pairs[unzip(at, np.int32)] = unzip(n, np.int64)
            pairs = pairs.reshape(size, size)[:-1, :-1]
            of = exchange(pairs, classes)
            member = np.zeros((size - 1, classes + 1))
            member[np.arange(size - 1), of] = 1
            return pa.table({"of": pa.array([of.tobytes()], pa.binary()),
                             "pairs": pa.array([(member.T @ pairs @ member).tobytes()], pa.binary())})

        piece = "piece long, at binary, n binary"
        part = self._each(count, "chunk long, " + piece, classes=False).withColumn("g", F.xxhash64("chunk") % 16).drop("chunk")
        part = part.groupBy("piece", "g").applyInArrow(tidy(add), piece).groupBy("piece").applyInArrow(tidy(add), piece)
        # one task: the table's size is fixed by the number of words in it
        found = part.groupBy().applyInArrow(cluster, "of binary, pairs binary").collect()
        of = np.frombuffer(found[0]["of"], np.int64)[1:] if found else 1 + np.arange(len(key)) % classes
        self.head = {"key": key, "of": of.astype(np.uint8)}
        self.pairs = np.frombuffer(found[0]["pairs"]).reshape(self.width, self.width) if found else np.zeros((self.width,) * 2)

    def _now(self) -> tuple:
        """What a chunk needs to name the class of every word: those of endings, and of the head before the first sweep."""
        return self.spark.sparkContext.broadcast((self.endings, self.head if self.named is None else None))

    def _class_pairs(self) -> np.ndarray:
        """Counts of neighbouring classes in all training documents."""
        now, width = self._now(), self.width

        def count(t: Chunk) -> Iterator[dict]:
            code = t.training()
            if len(code):
                of = t.classes(*now.value)[code].astype(np.int64)
                of[of == NONE] = width
                at, n = pairs_of(of, width + 1)
                yield {"at": zip_(at), "n": zip_(n)}

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width + 1) ** 2, np.int64)
            for b in batches:
                for at, n in zip(b.column("at").to_pylist(), b.column("n").to_pylist()):
                    total[unzip(at, np.int64)] += unzip(n, np.int64)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"at": pa.array(some, pa.int64()), "n": pa.array(total[some], pa.int64())})

        found = self._each(count, "chunk long, at binary, n binary").mapInArrow(tidy(add), "at long, n long").groupBy(
            "at").agg(F.sum("n").alias("n")).toPandas()
        out = np.zeros((width + 1) ** 2)
        out[found["at"].to_numpy()] = found["n"].to_numpy()
        return out.reshape(width + 1, width + 1)[:width, :width]

    def _sweep(self) -> None:
        """Every word with two training tokens or more, and every ending, moves to its best class."""
        if self.named is not None:
            self.pairs = self._class_pairs()
        now, width, pairs = self._now(), self.width, self.pairs

        def say(t: Chunk) -> Iterator[dict]:
            of = t.classes(*now.value)
            mine = [np.zeros(0, np.uint8)]
            for r in contexts(t, of, width):
                if r["slice"] >= 0:          # the class it has goes with each word
                    i = int(np.searchsorted(t.slices, r["slice"]))
                    a, b = t.cuts[i] - 1, t.cuts[i + 1] - 1
                    mine = of[1:][a:b][t.own[a:b]]
                else:
                    mine = np.zeros(0, np.uint8)
                yield {**r, "old": zip_(mine)}

        def move(t: pa.Table) -> pa.Table:
            t = t.sort_by("chunk")
            z = t.column("slice")[0].as_py()
            rank = [unzip(x, np.int32) for x in t.column("rank").to_pylist()]
            each = [unzip(x, np.uint16) for x in t.column("entries").to_pylist()]
            at = np.concatenate([np.repeat(r, e) for r, e in zip(rank, each)]).astype(np.int64)
            col = np.concatenate([unzip(x, np.uint16) for x in t.column("col").to_pylist()]).astype(np.int64)
            n = np.concatenate([unzip(x, np.uint32) for x in t.column("n").to_pylist()])
            size = 1 + max((int(r.max()) for r in rank if len(r)), default=-1) if z >= 0 else 1 << PART
            old = np.full(size, NONE, np.uint8)
            for r, o in zip(rank, [unzip(x, np.uint8) for x in t.column("old").to_pylist()]):
                if len(o):
                    old[r] = o
            order = np.argsort(at, kind="stable")
            at, col, n = at[order], col[order], n[order]
            of = np.zeros(size, np.uint8)
            for lo in range(0, size, 10_000):
                hi = min(size, lo + 10_000)
                a, b = np.searchsorted(at, [lo, hi])
                m = np.bincount((at[a:b] - lo) * (2 * width) + col[a:b], weights=n[a:b], minlength=(hi - lo) * 2 * width)
                of[lo:hi] = best_classes(m.reshape(-1, 2 * width), old[lo:hi], pairs)
            out = [(i, z, of[r].tobytes()) for i, r in zip(t.column("chunk").to_pylist(), rank)] if z >= 0 else []
            out.append((-1, z, of.tobytes()))
            return pa.table([pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))],
                            ["chunk", "slice", "of"])

        said = self._each(say, _SAID + ", old binary")
        found = stored(said.groupBy("slice").applyInArrow(tidy(move), _CLASSES), "classes")
        self.named = found.where("chunk >= 0")
        self.of_words = found.where("chunk < 0 and slice >= 0").select("slice", "of")
        endings = np.ones(ENDINGS + (1 << PART), np.uint8)
        for r in found.where("slice < 0").select("slice", "of").collect():       # 17 rows at most
            p = -1 - r["slice"]
            endings[p << PART:(p + 1) << PART] = np.frombuffer(r["of"], np.uint8)
        self.endings = endings[:ENDINGS]

    def word_classes(self) -> DataFrame:
        """``word`` (binary), ``c`` (training tokens), ``class`` of every word that is a unit of its own."""
        def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for raw, words, of in zip(b.column("c").to_pylist(), b.column("words"), b.column("of").to_pylist()):
                    c = unzip(raw, np.int64)
                    k = np.frombuffer(of, np.uint8)
                    at = np.flatnonzero(c > 1)
                    yield pa.RecordBatch.from_arrays([
                        rows_of(words).column("word").combine_chunks().cast(pa.binary()).take(pa.array(at)),
                        pa.array(c[at]), pa.array(k[at].astype(np.int32))], names=["word", "c", "class"])

        return self.vocabulary.join(self.of_words, "slice").mapInArrow(tidy(spell), "word binary, c long, class int")

    def model(self) -> Model:
        width = self.width

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((3, width), np.int64)
            for b in batches:
                k, c = b.column("class").to_numpy(), b.column("c").to_numpy()
                for i, w in enumerate((c, np.ones(len(c)), c == 2)):
                    out[i] += np.bincount(k, weights=w, minlength=width).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), *[pa.array(x) for x in out]], names=["k", "n", "v", "two"])

        each = np.zeros((3, width))
        for r in (self.word_classes().mapInArrow(tidy(sums), "k long, n long, v long, two long").groupBy("k").agg(
                *[F.sum(x).alias(x) for x in ("n", "v", "two")]).collect()):
            each[:, r["k"]] = r["n"], r["v"], r["two"]
        one = np.bincount(self.endings, weights=self.single, minlength=width)
        n, v, two = each[0] + one, each[1] + one, each[2]
        n[0], v[0] = self.ends, int(self.ends > 0)
        discount = np.clip(np.where(one + two > 0, one / np.maximum(one + 2 * two, 1), 0.5), 0.1, 0.9)
        discount[0] = 0                                      # the end's class has no other word
        with np.errstate(divide="ignore"):
            unseen = np.where(n > 0, np.log10(discount * v / np.maximum(n, 1)), 0.0)
        return Model(self.endings, transitions(self.pairs), n, unseen, discount, self.ends, self.tokens + self.ends,
                     self.words + int(self.ends > 0))


def _source(df: DataFrame, held: Column, id: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{id}`").alias("id"), F.coalesce(held, F.lit(True)).alias("held"),
                     F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("text"))


def score_texts(df: DataFrame, held: Column, id: str = "doc_id", text: str = "text", classes: int = CLASSES,
                head: int = HEAD, sweeps: int = SWEEPS, chunk_bytes: int = CHUNK, job: Job | None = None) -> DataFrame:
    """One row per row of ``df``: ``id``, ``held_out`` (the value of ``held``; a null counts as true), ``n_tokens``
    (words and the end), ``n_known`` (that occur in training), ``train_tokens``, ``base_score`` and ``score`` (log10
    probabilities of the text by the unigram base and by the class model), ``perplexity`` (of the class model).

    A null or empty text is the end alone. Repeated rows count each time. Without training documents nothing is known
    and the model is uniform over classes. Texts are read whole, of any length. An empty table gives an empty result.
    Other columns are not read.
    """
    src = _source(df, held, id, text)
    kind = src.schema["id"].dataType.simpleString()
    job = job or Job(src, classes, head, max(1, sweeps), chunk_bytes)
    held_model = df.sparkSession.sparkContext.broadcast(job.model())
    told = job.counts.unionByName(job.named.withColumnRenamed("of", "rank").withColumn("c", F.lit(None).cast("binary")))

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        m, known = held_model.value, pc.is_valid(right.column("c"))
        of = right.filter(pc.invert(known)).select(["slice", "rank"]).rename_columns(["slice", "of"])
        out = []
        for row in left.to_pylist():
            t = Chunk(row, right.filter(known), of)
            k = t.classes(m.endings).astype(np.int64)
            c = np.append(m.ends, t.c)
            emit, base, seen = m.emission(c, k), m.base(c), (c > 0).astype(np.int64)
            length = t.docs.column("length").to_numpy()
            start = np.cumsum(length) - length
            near = k[t.codes]
            step = m.step[np.append(0, near[:-1]), near]     # after an end, and at the start, the end's class
            out.append(pa.table({
                "id": t.docs.column("id"), "held_out": t.docs.column("held"), "n_tokens": pa.array(length.astype(np.int64)),
                "n_known": pa.array(np.add.reduceat(seen[t.codes], start)),
                "train_tokens": pa.array(np.full(len(length), m.tokens)),
                "base_score": pa.array(np.add.reduceat(base[t.codes], start)),
                "score": pa.array(np.add.reduceat(step + emit[t.codes], start))}))
        return pa.concat_tables(out)

    done = job.chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        tidy(score), f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
               "score double")
    return done.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
