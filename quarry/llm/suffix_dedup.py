"""Exact removal of repeated byte strings by prefix-free parsing.

Every document is parsed into phrases at triggers: a place is a trigger when its rolling hash over ``TRIGGER`` bytes is
the least among those of some string of ``width`` bytes around it (of equal ones the last). That test reads nothing
outside the string, so equal strings have the same trigger at the same place wherever they occur, no phrase is longer
than a string, and every string of ``width`` bytes belongs to exactly one trigger: the one that is its own least. The
strings of one trigger start in a run of neighbouring places; the run's bytes are the phrase with its right context.

The dictionary (triggers, then phrases) and the parse (which document has which phrase where) are ordered apart, and
the order of the corpus' strings is put together from the two in three steps, each of which leaves less to do:

1. triggers: those that occur in one document only can begin no repeat; nearly all of a text ends here;
2. phrases: equal phrases of one trigger are one dictionary entry, owned by the smallest document; any other document
   that has it repeats all its strings. Copies, near copies and shared passages end here, whatever their number;
3. suffixes: only where a trigger has several phrases, the phrases' suffixes (cut to ``width`` bytes) of the owners
   are brought into one order, and equal ones go to the smallest document. A string holds its trigger and at least half
   of what it may have on one side, so only phrases that agree in the trigger with half a context can share one: step 2
   tells for either side whether there is another such phrase, and only strings of that side are compared.

Order here is that of 64-bit fingerprints (more for anything that decides a removal: 128 for a phrase, 96 for a suffix), not of letters: equal
strings stand together, which is all that repeats need, and no byte of text is shuffled for it. An answer is a bit for
each key: that a smaller document elsewhere has it, too.

Texts are held in chunks of about ``CHUNK`` bytes, compressed, dealt once over the cluster and checkpointed. In each
step a chunk sends every fingerprint once, however often it holds it, so a string that a third of all documents share
costs a row per chunk, not per document. Answers come back to the chunk by a cogroup that does not move the texts. Once
step 1 is answered, the runs that are still alive are kept beside the chunk; the steps behind it need no parse.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.llm.common import cut_lineage, rows_of, text_chunks, tidy, unzip, zip_
from quarry.session import stored

WIDTH = 50
TRIGGER = 20                 # bytes of a trigger; less when the strings are shorter
CHUNK = 2 << 20
SEGMENT = 1 << 18            # places worked on at once, whatever the length of a text
KEYS_A_BUCKET = 500_000
GROW = 1 << 30               # bytes of text from which chunks and buckets grow, with the root of the corpus' size
MOST = 8                     # times their size here, at most
MANY = 64                    # phrases of one trigger that a chunk sends; beyond, it goes on to the suffixes at once
LAST = np.iinfo(np.int64).max  # stands for a null id: no id is larger
MARK = np.uint64(0)          # instead of a phrase: the trigger has others
_PLACE = np.uint64((1 << 31) - 1)

_SENT = "bucket long, chunk long, a binary, b binary, left binary, right binary, doc binary, base long"
_ANSWER = "chunk long, step int, bucket long, left binary, right binary, less binary"
_SENT_ARROW = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("a", pa.binary()), ("b", pa.binary()),
                         ("left", pa.binary()), ("right", pa.binary()), ("doc", pa.binary()), ("base", pa.int64())])
_ANSWER_ARROW = pa.schema([("chunk", pa.int64()), ("step", pa.int32()), ("bucket", pa.int64()),
                           ("left", pa.binary()), ("right", pa.binary()), ("less", pa.binary())])


class Rolling:
    """Fingerprints of substrings, modulo 2**64, from prefix sums of byte values times powers of an odd base."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.value = rng.integers(0, 1 << 64, 256, np.uint64)
        base = int(rng.integers(0, 1 << 62)) * 4 + 3
        self.inverse = pow(base, -1, 1 << 64)
        self.base = base
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        out[1:] = np.uint64(base)
        return np.multiply.accumulate(out)

    def sums(self, x: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(x):
            self.up, self.down = self._powers(self.base, len(x) + 1), self._powers(self.inverse, len(x) + 1)
        out = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(self.value[x] * self.up[:len(x)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, start: np.ndarray | slice, n: int) -> np.ndarray:
        if isinstance(start, slice):
            return mix((sums[n:] - sums[:-n]) * self.down[:len(sums) - n])
        return mix((sums[start + n] - sums[start]) * self.down[start])


def mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


_ROLLING: list[Rolling] = []


def rolling() -> list[Rolling]:
    if not _ROLLING:
        _ROLLING.extend(Rolling(seed) for seed in (1, 2, 3))
    return _ROLLING


def parse(x: np.ndarray, begin: np.ndarray, width: int, trigger: int):
    """The runs of a chunk's bytes ``x``; texts begin at ``begin`` (with the end as last entry). For each piece of the
    bytes: ``(first, piece, offset, start, end, place)``; ``first`` is the piece's own place in ``x``, the others are
    relative to it: a run has the strings that start at ``start .. end``, and their trigger is at ``place``."""
    span = width - trigger + 1
    for lo in range(0, max(0, len(x) - width + 1), SEGMENT):
        piece = x[lo:lo + SEGMENT + width - 1]
        n = len(piece) - width + 1
        roll = rolling()[0]
        h = roll.at(roll.sums(piece), slice(None), trigger)
        # the least hash, of equal ones the last place: 33 bits of hash, 31 of place
        key = (h & ~_PLACE) | (_PLACE - np.arange(len(h), dtype=np.uint64))
        size, least = 1, key
        while size * 2 <= span:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < span:
            least = np.minimum(least[:n], least[span - size:span - size + n])
        place = (_PLACE - (least[:n] & _PLACE)).astype(np.int64)
        # strings must not cross texts
        text = np.searchsorted(begin, np.arange(lo, lo + n), side="right")
        ok = begin[np.minimum(text, len(begin) - 1)] >= np.arange(lo, lo + n) + width
        edge = np.ones(n, bool)
        edge[1:] = (place[1:] != place[:-1]) | (ok[1:] != ok[:-1]) | (text[1:] != text[:-1])
        start = np.flatnonzero(edge)
        end = np.append(start[1:], n) - 1
        good = ok[start]
        start, end = start[good], end[good]
        yield lo, piece, text[start] - 1, start, end, place[start], h[place[start]]


class Texts:
    """A chunk's texts as one run of bytes."""

    def __init__(self, table: pa.Table, width: int):
        self.table, self.width = table, width
        text = table.column("text").combine_chunks().cast(pa.large_binary()).fill_null(b"")
        if isinstance(text, pa.ChunkedArray):
            text = text.chunk(0) if text.num_chunks else pa.array([], pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = text.buffers()[2]
        self.x = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
        self.begin = offsets - offsets[0]
        self.ids = table.column("id").fill_null(LAST).to_numpy().astype(np.int64)

    def runs(self, trigger: int) -> Runs:
        """All runs, by parsing the texts."""
        got = {k: [] for k in Runs.KINDS}
        one = rolling()[1]
        for lo, piece, doc, start, end, place, h in parse(self.x, self.begin, self.width, trigger):
            s = one.sums(piece)
            head, tail = one.at(s, start, self.width), one.at(s, end, self.width)
            got["owner"].append(self.ids[doc])
            got["start"].append(start + lo)
            got["end"].append(end + lo)
            got["place"].append(place + lo)
            got["trigger"].append(h)
            got["phrase"].append(mix(head * np.uint64(0xD6E8FEB86659FD93) + tail + (end - start).astype(np.uint64)))
        return Runs(*[np.concatenate(got[k]) if got[k] else np.zeros(0, t) for k, t in Runs.KINDS.items()])

    def prints(self, roll: Rolling, place: np.ndarray, n: int) -> np.ndarray:
        """The fingerprints of the ``n`` bytes at each of the places, which ascend."""
        out = np.zeros(len(place), np.uint64)
        for lo in range(0, len(self.x), SEGMENT):
            a, b = np.searchsorted(place, [lo, lo + SEGMENT])
            if b > a:
                out[a:b] = roll.at(roll.sums(self.x[lo:lo + SEGMENT + n - 1]), place[a:b] - lo, n)
        return out

    def halves(self, runs: Runs, trigger: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each run the fingerprints (32 bits, never 0) of the trigger with half a context to its left, and to its
        right; 0 where no string of the run reaches so far."""
        half = (self.width - trigger) // 2
        out = []
        for has, place, n in ((runs.place - half >= runs.start, runs.place - half, trigger + half),
                              (runs.place - half < runs.end, runs.place, self.width - half + 1)):
            x = np.zeros(len(has), np.uint32)
            x[has] = (self.prints(rolling()[1], place[has], n) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
            out.append(x)
        return out[0], out[1]

    def suffixes(self, start: np.ndarray, end: np.ndarray):
        """Every string that begins at ``start .. end`` of a run: fingerprints (64 and 32 bits), its run and its place."""
        length = end - start + 1
        run = np.repeat(np.arange(len(start)), length)
        ends = np.cumsum(length)
        place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - length, length) + start[run]
        a = self.prints(rolling()[1], place, self.width)
        b = (self.prints(rolling()[2], place, self.width) >> np.uint64(32)).astype(np.uint32)
        return a, b, run, place


@dataclass
class Runs:
    """Runs of strings that share a trigger, in the order of their places: the document's id, the places of the first
    and the last string and of the trigger, and the fingerprints of the trigger and of the phrase."""
    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray
    place: np.ndarray
    trigger: np.ndarray
    phrase: np.ndarray

    KINDS: ClassVar = {"owner": np.int64, "start": np.int64, "end": np.int64, "place": np.int64, "trigger": np.uint64,
                       "phrase": np.uint64}

    def take(self, at: np.ndarray) -> Runs:
        return Runs(*[getattr(self, k)[at] for k in self.KINDS])

    # each step: the distinct fingerprints in order, the smallest id of each, and where each run has its own
    def triggers(self):
        return distinct(self.trigger, None, self.owner)

    def phrases(self):
        a, b, doc, at = distinct(self.trigger, self.phrase, self.owner)
        first = np.ones(len(a), bool)
        first[1:] = a[1:] != a[:-1]
        number = np.cumsum(first) - 1
        many = (np.bincount(number) > MANY)[number] if len(a) else np.zeros(0, bool)
        return a, b, doc, at, many

    def live(self, told: Told) -> Runs:
        """Runs whose trigger occurs in several documents."""
        a, _, least, at = self.triggers()
        flag, _, _ = told.of(1, *buckets(a, told.bits))
        most = np.full(len(a), np.iinfo(np.int64).min)
        np.maximum.at(most, at, self.owner)
        return self.take(np.flatnonzero((flag | (most > least))[at]))


@dataclass
class Live:
    """Live runs, without their fingerprints: what stays beside the chunk from step 2 on."""
    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray
    place: np.ndarray
    at: np.ndarray            # which of the chunk's phrases a run has
    index: np.ndarray         # which of them each sent entry is; -1 for marks
    bucket: np.ndarray        # of the sent entries, with how many went to each
    count: np.ndarray

    @staticmethod
    def of(runs: Runs, at: np.ndarray, index: np.ndarray, sent: list[tuple]) -> Live:
        return Live(runs.owner, runs.start, runs.end, runs.place, at, index, np.array([r[0] for r in sent], np.int64),
                    np.array([len(r[2]) // 8 for r in sent], np.int64))

    def pack(self) -> tuple[bytes, bytes, bytes]:
        places = np.concatenate([np.diff(self.start, prepend=0), self.end - self.start, self.place - self.start])
        places = places.astype(np.int32)
        same = (self.index == np.arange(len(self.index))).all()
        which = np.concatenate([self.at, [] if same else self.index]).astype(np.int32)
        parts = [zip_(places), zip_(which), zip_(self.bucket), zip_(self.count)]
        return (np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts), zip_(np.diff(self.owner, prepend=0)), b"")

    @staticmethod
    def unpack(raw: bytes, owners: bytes, _: bytes) -> Live:
        ends = np.cumsum(np.frombuffer(raw[:32], np.int64)) + 32
        parts = [raw[a:b] for a, b in zip([32, *ends], ends)]
        places, which = unzip(parts[0], np.int32).astype(np.int64), unzip(parts[1], np.int32)
        bucket, count = unzip(parts[2], np.int64), unzip(parts[3], np.int64)
        n = len(places) // 3
        start = np.cumsum(places[:n])
        index = which[n:] if len(which) > n else np.arange(int(count.sum()))
        return Live(np.cumsum(unzip(owners, np.int64)), start, start + places[n:2 * n], start + places[2 * n:], which[:n],
                    index, bucket, count)

    def open(self, told: Told, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the runs, those known to be repeats, and those of which strings must be compared one by one, with the
        first and the last such string. Phrases that were not sent are open on both sides."""
        n = int(self.at.max()) + 1 if len(self.at) else 0
        least = np.full(n, LAST)
        np.minimum.at(least, self.at, self.owner)
        real = self.index >= 0
        left, right, less = np.ones(n, bool), np.ones(n, bool), np.zeros(n, bool)
        for mine, told_ in zip((left, right, less), told.of(2, self.bucket, self.count)):
            mine[self.index[real]] = told_[real]
        repeat = less[self.at] | (least[self.at] < self.owner)
        # strings up to the split have half a context at the left of the trigger, those behind it at the right
        split = self.place - half
        lo = np.where(left[self.at], self.start, np.maximum(self.start, split + 1))
        hi = np.where(right[self.at], self.end, np.minimum(self.end, split))
        open_ = np.flatnonzero(~repeat & (left | right)[self.at] & (lo <= hi))
        return np.flatnonzero(repeat), open_, lo[open_], hi[open_]


def distinct(a: np.ndarray, b: np.ndarray | None, doc: np.ndarray):
    """Distinct keys in order, the smallest id of each, and the key's number of every entry."""
    order = np.argsort(a, kind="stable") if b is None else np.lexsort((b, a))
    ka = a[order]
    first = np.ones(len(ka), bool)
    first[1:] = ka[1:] != ka[:-1]
    if b is not None:
        kb = b[order]
        first[1:] |= kb[1:] != kb[:-1]
    at = np.empty(len(ka), np.int64)
    at[order] = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    least = np.minimum.reduceat(doc[order], starts) if len(starts) else doc[:0]
    return ka[first], (kb[first] if b is not None else None), least, at


def bucket_of(a: np.ndarray, bits: int) -> np.ndarray:
    return (a >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(a), np.int64)


def buckets(a: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of ordered keys, and how many go to each."""
    bucket = bucket_of(a, bits)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    return bucket[cuts], np.diff(np.append(cuts, len(a)))


def send(chunk: int, bits: int, a: np.ndarray, b: np.ndarray | None = None, doc: np.ndarray | None = None,
         left: np.ndarray | None = None, right: np.ndarray | None = None) -> Iterator[tuple]:
    """The keys of a chunk (ordered by ``a``) cut by bucket. Triggers, sent alone, go as the 32 bits behind those that
    name the bucket: that two of them meet by chance is as rare at any size, and only keeps a run for the next step."""
    number, count = buckets(a, bits)
    ends = np.cumsum(count)
    bucket = np.repeat(number, count)
    for lo, hi in zip(ends - count, ends):
        if doc is None:
            yield int(bucket[lo]), chunk, (a[lo:hi] >> np.uint64(32 - bits)).astype(np.uint32).tobytes(), *[b""] * 4, 0
            continue
        base = int(doc[lo:hi].min())
        sides = [b"" if x is None else x[lo:hi].tobytes() for x in (left, right)]
        yield int(bucket[lo]), chunk, a[lo:hi].tobytes(), b[lo:hi].tobytes(), *sides, narrow(doc[lo:hi] - base), base


def narrow(x: np.ndarray) -> bytes:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64).tobytes()


def wide(raw: bytes, n: int, base: int) -> np.ndarray:
    return np.frombuffer(raw, {2: np.uint16, 4: np.uint32, 8: np.uint64}[len(raw) // n]).astype(np.int64) + base


def rows_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def alike(group: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Where another entry of the same group has the same ``x``, which is not 0."""
    order = np.lexsort((x, group))
    group, x = group[order], x[order]
    same = (group[1:] == group[:-1]) & (x[1:] == x[:-1]) & (x[1:] != 0)
    out = np.zeros(len(x), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def _answer(step: int) -> Callable[[pa.Table], pa.Table]:
    """For one bucket, as bits: which keys occur in several chunks (step 1); where a smaller document has the key (steps 2
    and 3), and which phrases agree with another one of their trigger on the left, and on the right (step 2)."""

    def run(t: pa.Table) -> pa.Table:
        chunk, bucket = t.column("chunk").to_pylist(), t.column("bucket").to_pylist()

        def numbers(c: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(t.column(c).to_pylist()), kind)

        kind = np.uint32 if step == 1 else np.uint64
        a = numbers("a", kind)
        n = [len(r) // kind().itemsize for r in t.column("a").to_pylist()]
        none = np.zeros(len(a), bool)
        if step == 1:
            order = np.argsort(a, kind="stable")
            same = a[order][1:] == a[order][:-1]
            left, right, less = none.copy(), None, None
            left[order[1:]] = same
            left[order[:-1]] |= same
        else:
            b = numbers("b", np.uint64 if step == 2 else np.uint32)
            doc = np.concatenate([wide(r, m, base) for r, m, base in
                                  zip(t.column("doc").to_pylist(), n, t.column("base").to_pylist())])
            ka, kb, least, at = distinct(a, b, doc)
            less = least[at] < doc
            left = right = None
            if step == 2:
                group = np.cumsum(np.append(False, ka[1:] != ka[:-1]))
                marked = np.zeros(len(ka), bool)
                marked[group[kb == MARK]] = True
                rep = np.empty(len(ka), np.int64)
                rep[at] = np.arange(len(at))
                left, right = ((alike(group, numbers(c, np.uint32)[rep]) | marked[group])[at] for c in ("left", "right"))
        ends = np.cumsum(n)
        return pa.Table.from_batches([rows_batch(
            [(c, step, k, *[b"" if x is None else np.packbits(x[hi - m:hi]).tobytes() for x in (left, right, less)])
             for c, k, hi, m in zip(chunk, bucket, ends, n)], _ANSWER_ARROW)])

    return run


class Told:
    """What a chunk was answered."""

    def __init__(self, bits: int, answers: pa.Table):
        self.bits, self.runs = bits, None
        self.by = {(s, k): told for s, k, *told in zip(*[answers.column(x).to_pylist() for x in (
            "step", "bucket", "left", "right", "less")])}
        kept = self.by.pop((0, -1), None)
        if kept:
            self.runs = Live.unpack(*kept)

    def of(self, step: int, bucket: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bits of what went to the buckets, in the order in which it was sent."""
        out = tuple(np.zeros(int(count.sum()), bool) for _ in range(3))
        ends = np.cumsum(count)
        for k, lo, hi in zip(bucket.tolist(), (ends - count).tolist(), ends.tolist()):
            for bits, raw in zip(out, self.by.get((step, k), ())):
                if raw:
                    bits[lo:hi] = np.unpackbits(np.frombuffer(raw, np.uint8), count=hi - lo).astype(bool)
        return out


def covered(t: Texts, told: Told, half: int) -> np.ndarray:
    """Bytes of a chunk that lie in a string which a smaller document has too, as marks."""
    mark = np.zeros(len(t.x) + 1, np.int32)
    if told.runs is None:
        return mark[:-1] > 0
    r, w = told.runs, t.width
    repeat, open_, first, last = r.open(told, half)
    np.add.at(mark, r.start[repeat], 1)
    np.add.at(mark, r.end[repeat] + w, -1)
    a, b, run, place = t.suffixes(first, last)
    owner = r.owner[open_][run]
    ka, _, least, at = distinct(a, b, owner)
    _, _, less = told.of(3, *buckets(ka, told.bits))
    hit = place[less[at] | (least[at] < owner)]
    np.add.at(mark, hit, 1)
    np.add.at(mark, hit + w, -1)
    return np.cumsum(mark[:-1], dtype=np.int32, out=mark[:-1]) > 0


def keep_few(a, b, doc, many, left, right):
    """What step 2 sends: all phrases of a trigger with few of them; else a mark that says it has others as well."""
    first = np.ones(len(a), bool)
    first[1:] = a[1:] != a[:-1]
    mark, few = np.flatnonzero(many & first), np.flatnonzero(~many)
    at = np.concatenate([few, mark])
    real = np.arange(len(at)) < len(few)
    order = np.argsort(a[at], kind="stable")
    at, real = at[order], real[order]
    return (a[at], np.where(real, b[at], MARK), doc[at], np.where(real, left[at], 0).astype(np.uint32),
            np.where(real, right[at], 0).astype(np.uint32), np.where(real, at, -1))


def remove_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (),
                   width: int = WIDTH, chunk_bytes: int = CHUNK, characters: bool = False) -> DataFrame:
    """One row per row of ``df``: ``id`` (long), ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``spans`` (``[start, end, ...]`` in bytes), ``kept`` (the remaining bytes), then the columns named in ``carry``.
    With ``characters``, what a cut leaves of a UTF-8 character is not in ``kept``.

    A byte is removed when it is covered by a string of ``width`` bytes that also starts in a document with a
    smaller id; strings are judged on the input. A null text is empty; texts shorter than ``width`` lose nothing;
    texts of any length are handled whole. Rows with the same id never remove anything from each other; a null id
    counts as larger than any other and equal to other nulls. An empty table gives an empty result. Only ``id``,
    ``text`` and ``carry`` are read, and the results are named in that order, so other columns cannot clash;
    carried columns must have other names than the results.
    """
    if width < 2:
        raise ValueError("width must be at least 2")
    trigger = max(1, min(TRIGGER, width - 1))
    half = (width - trigger) // 2
    src = df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"),
                    *[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(carry)])
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # with the corpus grow chunks and buckets, up to what a task can hold, so that messages do not shrink to nothing
    more = max(1.0, math.sqrt(total / GROW))
    chunks = text_chunks(src, int(chunk_bytes * min(more, MOST)))
    keys = int(total * 2 / (width - trigger + 2)) + 1
    bits = max(0, int(keys // (KEYS_A_BUCKET * min(more, MOST))).bit_length())

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column("chunk").to_pylist(), batch.column("body")):
                a = Texts(rows_of(body), width).runs(trigger).triggers()[0]
                yield rows_batch(list(send(number, bits, a)), _SENT_ARROW)

    def second(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for number, body in zip(left.column("chunk").to_pylist(), left.column("body")):
            texts = Texts(rows_of(body), width)
            live = texts.runs(trigger).live(Told(bits, right))
            if len(live.owner):
                a, b, doc, at, many = live.phrases()
                one = np.empty(len(a), np.int64)         # a run of each phrase
                one[at] = np.arange(len(at))
                sides = [x[one] for x in texts.halves(live, trigger)]
                a, b, doc, *sides, index = keep_few(a, b, doc, many, *sides)
                sent = list(send(number, bits, a, b, doc, *sides))
                kept, owners, none = Live.of(live, at, index, sent).pack()
                out.append((-1, number, b"", none, kept, owners, none, 0))
                out.extend(sent)
        return pa.Table.from_batches([rows_batch(out, _SENT_ARROW)])

    def third(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out, told = [], Told(bits, right)
        for number, body in zip(left.column("chunk").to_pylist(), left.column("body")):
            _, open_, lo, hi = told.runs.open(told, half) if told.runs else [()] * 4
            if len(open_):
                a, b, run, _ = Texts(rows_of(body), width).suffixes(lo, hi)
                out.extend(send(number, bits, *distinct(a, b, told.runs.owner[open_][run])[:3]))
        return pa.Table.from_batches([rows_batch(out, _SENT_ARROW)])

    def answers(sent: DataFrame, step: int) -> DataFrame:
        return cut_lineage(sent.groupBy("bucket").applyInArrow(tidy(_answer(step)), _ANSWER))

    def ask(known: DataFrame, run) -> DataFrame:
        return chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(tidy(run), _SENT)

    kind = src.schema
    schema = T.StructType([kind["id"], *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
                           T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType()),
                           *[kind[f"x{i}"] for i in range(len(carry))]])
    arrow = to_arrow_schema(schema)

    def finish(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out, told = [], Told(bits, right)
        for body in left.column("body"):
            c = Texts(rows_of(body), width)
            gone = covered(c, told, half)
            spans, kept = [], []
            for lo, hi in zip(c.begin[:-1], c.begin[1:]):
                g = gone[lo:hi]
                edge = np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0))
                spans.append(edge.astype(np.int64))
                kept.append(c.x[lo:hi][~g].tobytes())
            removed = [int((s[1::2] - s[::2]).sum()) for s in spans]
            if characters:
                kept = [k.decode("utf-8", "ignore").encode() if n else k for k, n in zip(kept, removed)]
            out.append(pa.Table.from_arrays(
                [c.table.column("id"), pa.array(np.diff(c.begin), pa.int64()), pa.array(removed, pa.int64()),
                 pa.array([len(s) // 2 for s in spans], pa.int64()), pa.array(spans, arrow.field("spans").type),
                 pa.array(kept, pa.binary()), *[c.table.column(f"x{i}") for i in range(len(carry))]],
                names=arrow.names).cast(arrow))
        return pa.concat_tables(out) if out else arrow.empty_table()

    # the live runs stay beside their chunk: the texts are parsed twice, not in every step
    live = stored(ask(answers(chunks.mapInArrow(tidy(first), _SENT), 1), second), "live")
    known = live.where("bucket < 0").select(
        "chunk", F.lit(0).alias("step"), "bucket", "left", "right", F.col("doc").alias("less"))
    known = known.union(answers(live.where("bucket >= 0"), 2))
    known = known.union(answers(ask(known, third), 3))
    done = chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(tidy(finish), schema)
    return done.select("id", "n_bytes", "n_removed", "n_spans", "spans", "kept",
                       *[F.col(f"x{i}").alias(c) for i, c in enumerate(carry)])
