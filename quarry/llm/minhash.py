"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A document is the multiset of its shingles of five consecutive words, weighted by term frequency times inverse document
frequency. Improved consistent weighted sampling (Ioffe, 2010) draws ``BANDS * ROWS`` shingles from it such that two
documents draw alike with a probability equal to their weighted Jaccard similarity. Documents that agree in all rows of
a band meet in a bucket, and pairs that meet are verified by their exact weighted Jaccard similarity.

Document frequencies are exact: every chunk of texts sends each of its distinct shingles once, with the number of its
texts that hold it, to the slice that the shingle falls into, and gets the sums back. A slice holds a bounded part of
the shingles, and no task holds them all. Draws take their random numbers from a fixed table by a hash of shingle and
draw.

Groups of any size: documents with the same weighted shingles are one class from the start. What a class shares with
any other class bounds its similarity to each of them, so a text with too much of its own leaves its buckets, and a pair
whose bound is too low is never made. In a bucket all classes are first verified against the one that has least of its
own (an original rather than one of its edited copies), which joins a large group in linear work. Then the pairs of a
bucket that are still possible and still in different groups, and only these, are verified too: pairs within a group
could not change it. So no meeting pair is left out that could be a link, no bucket is capped, and no group's pairs are
written out.

Copies make what they share look common: the larger a group, the less its common shingles weigh beside the few that an
edit made, and edited copies fall below the limit. With ``copies_once`` a group of near copies counts as one text. Texts
whose plain similarity (by counts of shingles) to the one of their bucket with least of its own reaches the limit are its
group; of the texts that hold a shingle, as many
as the group has besides one are taken for its copies and left out of the document frequency; a pair of a group whose plain
similarity and whose similarity by these frequencies both reach the limit is linked, too. What makes texts of other
content alike (a passage that many texts hold) stays as light as it was. Such pairs come from the same buckets: of
similarity ``s`` by the ordinary weights, a pair meets with probability ``1 - (1 - s**ROWS)**BANDS``.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import components, cut_lineage, rows_of, shuffle_partitions, text_chunks, tidy
from quarry.llm.decontaminate import _SPACE
from quarry.llm.suffix_dedup import Rolling, mix
from quarry.session import scratch_path

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
CHUNK_BYTES = 4 << 20        # texts that are counted and signed together
SLICE_BYTES = 32 << 20       # bytes of text whose shingles are a slice, about
DRAW_BITS = 16
SEGMENT = 1 << 18
_ROUND = 1e-5                # bounds are kept clear of rounding
_WORD = np.array([b != 0x20 for b in _SPACE])
_BYTE = np.frombuffer(_SPACE, np.uint8)


def _rolling() -> Rolling:
    if not _HELD:
        _HELD.append(Rolling(11))
    return _HELD[0]


_HELD: list[Rolling] = []


def word_hashes(texts: pa.Array, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Hash of every word of a batch of texts in order, and how many words each text has; then, for each number of
    bytes in ``prefixes``, the hash of the word's beginning (0 for words that are not longer). Words are lower-cased
    (A-Z) runs of ASCII letters, digits and non-ASCII characters."""
    text = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    x = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    roll, hashes, starts, lo = _rolling(), [], [], 0
    parts: list[list[np.ndarray]] = [[] for _ in prefixes]
    while lo < len(x):
        hi = min(len(x), lo + SEGMENT)
        while hi < len(x) and _WORD[x[hi]] and _WORD[x[hi - 1]]:  # up to the end of a word
            more = np.flatnonzero(~_WORD[x[hi:hi + SEGMENT]])
            hi = hi + int(more[0]) if len(more) else min(len(x), hi + SEGMENT)
        piece = x[lo:hi]
        word = _WORD[piece]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        # the end of a text ends a word
        cut = offsets[np.searchsorted(offsets, lo, side="right"):np.searchsorted(offsets, hi, side="left")] - lo
        first[cut] |= word[cut]
        last[cut - 1] |= word[cut - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        sums = roll.sums(_BYTE[piece])
        hashes.append(mix((sums[e] - sums[s]) * roll.down[s] + (e - s).astype(np.uint64)))
        starts.append(s + lo)
        for n, out in zip(prefixes, parts):
            out.append(np.where(e - s > n, mix((sums[np.minimum(e, s + n)] - sums[s]) * roll.down[s] +
                                               np.uint64(n << 40)), np.uint64(0)))
        lo = hi
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return (h, np.diff(np.searchsorted(at, offsets)),
            *[np.concatenate(p) if p else np.zeros(0, np.uint64) for p in parts])


def shingles(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, shingle, count)``: distinct shingles of every text, ordered. A text with fewer than ``n`` words, but
    not none, has one shingle of all its words."""
    h, words = word_hashes(texts)
    begin = np.concatenate([[0], np.cumsum(words)])
    doc = np.repeat(np.arange(len(words)), words)
    total = np.zeros(len(h), np.uint64)
    room = np.repeat(begin[1:], words) - np.arange(len(h))          # words from here to the end of the text
    for k in range(n):
        part = np.zeros(len(h), np.uint64)
        part[:max(0, len(h) - k)] = h[k:]
        part[room <= k] = 0
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(k + 1))
    full = (room >= n) | ((words[doc] < n) & (np.arange(len(h)) == begin[doc]))
    doc, total = doc[full], total[full]
    order = np.lexsort((total, doc))
    doc, total = doc[order], total[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (total[1:] != total[:-1])
    at = np.flatnonzero(first)
    return doc[at], total[at], np.diff(np.append(at, len(doc)))


def packed(x: np.ndarray) -> bytes:
    """Numbers, compressed byte place by byte place; the high places of small ones cost nothing."""
    if not len(x):
        return b""
    places = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return pa.compress(places.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, dtype: type) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype)
    size = np.dtype(dtype).itemsize
    places = np.frombuffer(pa.decompress(data, n * size, codec="zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(places.T).reshape(-1).view(dtype)


def chunk_shingles(text: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``shingles`` of every 256 texts."""
    return [shingles(text.slice(lo, 256)) for lo in range(0, len(text), 256)]


class Sampler:
    """Consistent weighted samples; all random numbers are fixed by the seed."""

    def __init__(self, draws: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = 1 << DRAW_BITS
        self.r = rng.gamma(2, 1, n).astype(np.float32)
        self.one_r = (1 / self.r).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, n)).astype(np.float32)
        self.beta = rng.random(n, np.float32)
        self.odd = rng.integers(0, 1 << 63, draws, np.uint64) * np.uint64(2) + np.uint64(1)

    def draw(self, begin: np.ndarray, h: np.ndarray, log_weight: np.ndarray) -> np.ndarray:
        """One row per text (texts begin at ``begin`` and are not empty), one column per draw: a fingerprint of the
        drawn shingle and level."""
        out = np.empty((len(begin), len(self.odd)), np.uint64)
        number = np.arange(len(h), dtype=np.int64)
        for k, odd in enumerate(self.odd):
            at = ((h * odd) >> np.uint64(64 - DRAW_BITS)).astype(np.int32)
            beta, r = self.beta[at], self.r[at]
            level = np.floor(log_weight * self.one_r[at] + beta)
            value = self.log_c[at] - r * (level - beta + np.float32(1))
            bits = value.view(np.int32)
            bits = bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))     # integers in the order of the floats
            least = np.minimum.reduceat((bits.astype(np.int64) << 32) | number, begin)
            won = least & 0xFFFFFFFF
            out[:, k] = mix(h[won] * odd + level[won].astype(np.int64).astype(np.uint64))
        return out


def weights(count: np.ndarray, df: np.ndarray, n: int) -> np.ndarray:
    """Term frequency times inverse document frequency, of shingles in ``df`` of ``n`` texts."""
    return count * (np.log((1 + n) / (1 + df.astype(float))) + 1)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two ``(ordered distinct shingles, weights)``; 0 when either is empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    either = float(a[1].sum() + b[1].sum()) - both
    return both / either if either > 0 else 0.0


def document_frequencies(chunks: DataFrame) -> DataFrame:
    """``(chunk, slice, n, n_rows, df)`` for all chunks and slices: in how many of all ``n_rows`` texts the ``n``
    distinct shingles of the chunk that fall into the slice are, in their order, ``packed``."""
    n_bytes = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    slices = max(shuffle_partitions(chunks.sparkSession), -(-n_bytes // SLICE_BYTES))
    # slices are ranges of hashes, so that the differences of ordered hashes are small
    limits = np.array([-(-(k << 64) // slices) for k in range(1, slices)], np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, body in zip(b.column("chunk").to_pylist(), b.column("body")):
                text = rows_of(body).column("text").combine_chunks()
                h, held = np.unique(np.concatenate([h for _, h, _ in chunk_shingles(text)]), return_counts=True)
                cuts = np.concatenate([[0], np.searchsorted(h, limits), [len(h)]])
                gap = np.diff(h, prepend=np.uint64(0))
                held = held.astype(np.uint32)
                out = {"slice": range(slices), "chunk": [chunk] * slices, "n": np.diff(cuts),
                       "n_rows": [len(text)] * slices, "first": h[np.minimum(cuts[:-1], len(h) - 1)].view(np.int64)
                       if len(h) else [0] * slices,
                       "gap": [packed(gap[lo + 1:hi]) for lo, hi in zip(cuts, cuts[1:])],
                       "held": [packed(held[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]}
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array(v, pa.binary() if k in ("gap", "held") else pa.int64()) for k, v in out.items()})

    def add(t: pa.Table) -> pa.Table:
        sizes = t.column("n").to_pylist()
        h, held = np.empty(sum(sizes), np.uint64), np.empty(sum(sizes), np.uint32)
        cuts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        for lo, n, first, gap, c in zip(cuts, sizes, *[t.column(k).to_pylist() for k in ("first", "gap", "held")]):
            if n:
                h[lo] = np.int64(first).view(np.uint64)
                h[lo + 1:lo + n] = unpacked(gap, n - 1, np.uint64)
                np.cumsum(h[lo:lo + n], out=h[lo:lo + n])
                held[lo:lo + n] = unpacked(c, n, np.uint32)
        order = np.argsort(h, kind="stable")
        h = h[order]
        begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        del h
        if len(begin):
            total = np.add.reduceat(held[order], begin, dtype=np.uint32)
            held[order] = np.repeat(total, np.diff(np.append(begin, len(order))))
        rows = sum(t.column("n_rows").to_pylist())
        return pa.table({"chunk": t.column("chunk"), "slice": t.column("slice"), "n": t.column("n"),
                         "n_rows": pa.array([rows] * len(sizes), pa.int64()),
                         "df": pa.array([packed(held[lo:hi]) for lo, hi in zip(cuts, cuts[1:])], pa.binary())})

    return chunks.mapInArrow(
        tidy(deal), "slice long, chunk long, n long, n_rows long, first long, gap binary, held binary").groupBy(
        "slice").applyInArrow(tidy(add), "chunk long, slice long, n long, n_rows long, df binary")


def chunk_frequencies(found: pa.Table) -> tuple[np.ndarray, int]:
    """Of one chunk's rows of ``document_frequencies``: those of its ordered distinct shingles, and ``n_rows``."""
    found = found.sort_by("slice")
    df = [unpacked(d, n, np.uint32) for d, n in zip(found.column("df").to_pylist(), found.column("n").to_pylist())]
    return np.concatenate(df), found.column("n_rows")[0].as_py()


def shared_weights(texts: DataFrame, n: int) -> DataFrame:
    """``(key, shared, plain)``: weight and number of a text's shingles that also occur in another text of the table, of
    keys that have any. Only shingles of several documents can. They are dealt by their hash, many to a row, so a frequent one is
    no hot key."""
    slices = shuffle_partitions(texts.sparkSession)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                doc, h, count = shingles(part.column("text"))
                df = np.concatenate([unpacked(d, k, np.uint32) for d, k in zip(
                    part.column("df").to_pylist(), np.bincount(doc, minlength=part.num_rows))])
                several = df > 1
                doc, h, count = doc[several], h[several], count[several]
                w = weights(count, df[several], n).astype(np.float32)
                count = count.astype(np.uint8 if count.max(initial=0) < 256 else np.uint32)
                to = (h % np.uint64(slices)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                cuts = np.searchsorted(to[order], np.arange(slices + 1))
                cols = doc[order].astype(np.uint16), h[order], w[order], count[order]
                keys = part.column("key").to_numpy()
                out = {"slice": [], "keys": [], "doc": [], "h": [], "w": [], "count": []}
                for k in np.flatnonzero(np.diff(cuts)):
                    d = cols[0][cuts[k]:cuts[k + 1]]
                    used, at = np.unique(d, return_inverse=True)
                    out["slice"].append(int(k))
                    out["keys"].append(keys[used].tobytes())
                    out["doc"].append(at.astype(np.uint16).tobytes())
                    for name, c in zip(("h", "w", "count"), cols[1:]):
                        out[name].append(c[cuts[k]:cuts[k + 1]].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out["slice"], pa.int32()), *[
                    pa.array(out[k], pa.binary()) for k in ("keys", "doc", "h", "w", "count")]], names=list(out))

    def common(t: pa.Table) -> pa.Table:
        key = np.concatenate([np.frombuffer(k, np.int64)[np.frombuffer(d, np.uint16)] for k, d in
                              zip(t.column("keys").to_pylist(), t.column("doc").to_pylist())])
        h = np.frombuffer(b"".join(t.column("h").to_pylist()), np.uint64)
        w = np.frombuffer(b"".join(t.column("w").to_pylist()), np.float32).astype(float)
        count = np.concatenate([np.frombuffer(c, np.uint8 if len(c) == len(x) // 8 else np.uint32) for c, x in
                                zip(t.column("count").to_pylist(), t.column("h").to_pylist())]).astype(float)
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        shared = np.zeros(len(h), bool)
        shared[order[1:]] = same
        shared[order[:-1]] |= same
        keys, at = np.unique(key, return_inverse=True)
        sums, plain = np.bincount(at, weights=w * shared), np.bincount(at, weights=count * shared)
        to = keys % slices
        order = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[order], np.arange(slices + 1))
        used = np.flatnonzero(np.diff(cuts))
        part = lambda x: pa.array([x[order[cuts[k]:cuts[k + 1]]].tobytes() for k in used], pa.binary())
        return pa.table({"to": pa.array(used, pa.int32()), "keys": part(keys), "shared": part(sums), "plain": part(plain)})

    def add(t: pa.Table) -> pa.Table:
        keys, at = np.unique(np.frombuffer(b"".join(t.column("keys").to_pylist()), np.int64), return_inverse=True)
        return pa.table({"key": keys, **{c: np.bincount(at, weights=np.frombuffer(b"".join(t.column(c).to_pylist())))
                                         for c in ("shared", "plain")}})

    kind = "slice int, keys binary, doc binary, h binary, w binary, count binary"
    return texts.select("key", "text", "df").mapInArrow(tidy(deal), kind).groupBy("slice").applyInArrow(
        tidy(common), "to int, keys binary, shared binary, plain binary").groupBy("to").applyInArrow(
        add, "key long, shared double, plain double")


def document_key(df: DataFrame, id: str = "doc_id", text: str = "text") -> Column:
    """The id; in place of a null one a number of at least 2**62 made from the text."""
    made = F.xxhash64(df[f"`{text}`"]).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(df[f"`{id}`"].cast("long"), made)


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", at_least: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS, copies_once: bool = False) -> DataFrame:
    """One row per row of ``df``: ``id`` (long), ``class_id`` (smallest id with the same weighted shingles),
    ``group_id`` (smallest id of the documents reachable by links of similarity ``at_least`` or more).

    A null, empty or wordless text has no shingles and is alone in its group; repeated texts are one class. Rows that
    share an id are one document and thus one group. A null id is replaced, for the grouping only, by a number above
    2**62 made from the text, and comes out as that number in ``class_id`` and ``group_id``, as null in ``id``. Texts
    are read whole. An empty table gives an empty result. Other columns are not read. ``copies_once``: see above.
    """
    spark = df.sparkSession
    docs = df.select(document_key(df, id, text).alias("key"), F.col(f"`{id}`").cast("long").alias("id"),
                     F.col(f"`{text}`").alias("text"))
    chunks = text_chunks(docs, CHUNK_BYTES)

    def sign(chunk: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        sampler = Sampler(bands * rows)
        table = rows_of(left.column("body")[0])
        df, n = chunk_frequencies(right)
        parts = chunk_shingles(table.column("text").combine_chunks())
        df = df[np.unique(np.concatenate([h for _, h, _ in parts]), return_inverse=True)[1]]
        size, lo = table.num_rows, 0
        one, two = np.zeros((2, size), np.int64)
        keys = np.zeros((size, bands), np.int64)
        total, length, held = np.zeros(size), np.zeros(size), [b""] * size
        full = np.zeros(size, bool)
        for number, (doc, h, count) in enumerate(parts):
            begin = np.flatnonzero(np.diff(doc, prepend=-1))
            has = doc[begin] + number * 256
            if not len(begin):
                continue
            seen = df[lo:lo + len(h)]
            lo += len(h)
            w = weights(count, seen, n)
            drawn = sampler.draw(begin, h, np.log(w).astype(np.float32))
            c = count.astype(np.uint64)
            one[has] = np.add.reduceat(mix(h + c * np.uint64(0xD6E8FEB86659FD93)), begin).view(np.int64)
            two[has] = np.add.reduceat(mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + c), begin).view(np.int64)
            drawn = drawn.reshape(len(has), bands, rows)
            key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x165667B19E3779F9)
            for k in range(rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + drawn[:, :, k])
            keys[has] = key.view(np.int64)
            total[has] = np.add.reduceat(w, begin)
            length[has] = np.add.reduceat(count, begin)
            for at, x, y in zip(has, begin, np.append(begin[1:], len(h))):
                held[at] = packed(seen[x:y])
            full[has] = True
        return pa.table({
            "key": table.column("key"), "id": table.column("id"), "has": pa.array(full), "one": pa.array(one),
            "two": pa.array(two), "bands": pa.array([k if f else [] for k, f in zip(keys, full)], pa.list_(pa.int64())),
            "chunk": pa.array([chunk[0].as_py()] * size, pa.int64()), "at": pa.array(range(size), pa.int32()),
            "n_rows": pa.array([n] * size, pa.int64()), "total": pa.array(total), "length": pa.array(length),
            "df": pa.array(held, pa.binary())})

    signed = cut_lineage(chunks.groupBy("chunk").cogroup(document_frequencies(chunks).groupBy("chunk")).applyInArrow(
        tidy(sign), "key long, id long, has boolean, one long, two long, bands array<long>, chunk long, at int, "
                    "n_rows long, total double, length double, df binary"))
    first = signed.select("n_rows").first()
    n = first["n_rows"] if first else 0
    classes = signed.where("has").groupBy("one", "two").agg(F.min("key").alias("class"), F.first("bands").alias("b"),
                                                           F.count("*").alias("texts"))
    met = cut_lineage(classes.select("class", F.explode("b").alias("bucket")).distinct())
    several = met.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi")
    met = cut_lineage(met.join(several.select("bucket"), "bucket"))
    # the texts of classes that meet others, once
    wanted = signed.where("has").join(met.select(F.col("class").alias("key")).distinct(), "key", "left_semi") \
        .dropDuplicates(["key", "one", "two"]).select("chunk", "at", "key", "total", "length", "df")

    def fetch(chunk: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        text = rows_of(left.column("body")[0]).column("text") if right.num_rows else pa.chunked_array([], pa.string())
        return pa.table({"key": right.column("key"), "text": text.take(right.column("at")),
                         "total": right.column("total"), "length": right.column("length"), "df": right.column("df")})

    path = scratch_path(spark, "meeting")
    kind = "key long, text string, total double, length double, df binary"
    chunks.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(tidy(fetch), kind).write.parquet(path)
    texts = spark.read.schema(kind).parquet(path)
    # what a class shares with any other bounds its similarity to each: ids of several texts are not bounded
    several = F.col("n") > 1
    bound = texts.groupBy("key").agg(F.count("*").alias("n"), F.sum("total").alias("total"), F.sum("length").alias("length")).join(
        shared_weights(texts, n), "key", "left").select(
        F.col("key").alias("class"), "total", "length", several.alias("open"), *[F.when(several, F.col(t)).otherwise(
            F.coalesce(c, F.lit(0.0))).alias(c) for c, t in (("shared", "total"), ("plain", "length"))])
    measures = [("shared", "total"), ("plain", "length")][:1 + copies_once]
    meeting = cut_lineage(met.join(bound, "class").where(reduce(or_, [
        F.col("open"), *[F.col(c) >= F.col(t) * (at_least - _ROUND) for c, t in measures]])))

    def possible(x: str, y: str, c: str, t: str) -> Column:
        both = F.least(f"{x}.{c}", f"{y}.{c}")
        return F.col(f"{x}.open") | F.col(f"{y}.open") | (
            both >= (at_least - _ROUND) * (F.col(f"{x}.{t}") + F.col(f"{y}.{t}") - both))

    def star(c: str, t: str) -> DataFrame:
        """Classes with the one of their bucket that has least of its own."""
        kept = ("shared", "total", "plain", "length", "open")
        best = meeting.groupBy("bucket").agg(F.max(F.struct(
            (F.col(c) / F.col(t)).alias("q"), (-F.col("class")).alias("c"), *kept)).alias("p")).select("bucket", "p.*").select(
            "bucket", (-F.col("c")).alias("class"), *kept)
        return meeting.alias("x").join(best.alias("y"), "bucket").where(F.col("x.class") != F.col("y.class")).where(
            possible("x", "y", c, t)).select(F.greatest("x.class", "y.class").alias("a"), F.least("x.class", "y.class").alias("b"))

    pairs = cut_lineage(reduce(DataFrame.union, [star(*m) for m in measures]).distinct())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict = OrderedDict()

        def vector(text: str, df: bytes):
            if text not in held:
                _, h, count = shingles(pa.array([text], pa.string()))
                df = unpacked(df, len(h), np.uint32)
                held[text] = h, weights(count, df, n), count, df
                if len(held) > 16:
                    held.popitem(last=False)
            held.move_to_end(text)
            return held[text]

        def once(v: tuple, others: int) -> tuple[np.ndarray, np.ndarray]:
            h, _, count, df = v
            return h, weights(count, np.maximum(df.astype(np.int64) - others, 1), n)

        for b in batches:
            ok, alike = [], []
            for x, p, y, q, size in zip(*[b.column(k).to_pylist() for k in ("text_a", "df_a", "text_b", "df_b", "size")]):
                x, y = vector(x, p), vector(y, q)
                near = similarity(x[:2], y[:2]) >= at_least
                plain = copies_once and similarity(x[::2], y[::2]) >= at_least
                if plain and not near and size:
                    near = similarity(once(x, size - 1), once(y, size - 1)) >= at_least
                ok.append(near)
                alike.append(plain)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok, pa.bool_()), pa.array(alike, pa.bool_())],
                                             names=["a", "b", "near", "plain"]).filter(pa.array(np.array(ok + alike).reshape(2, -1).any(0)))

    def linked(candidates: DataFrame) -> DataFrame:
        """Pairs that are near, or alike by their plain similarity; ``size`` is that of the group of both, if they have one."""
        left = candidates.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"),
                                               F.col("df").alias("df_a")), "a")
        both = left.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"),
                                        F.col("df").alias("df_b")), "b")
        return cut_lineage(both.select("a", "b", "text_a", "df_a", "text_b", "df_b", "size").mapInArrow(
            tidy(verify), "a long, b long, near boolean, plain boolean"))

    def apart(group: DataFrame, allowed: Column) -> DataFrame:
        """Pairs of a bucket that are ``allowed``, stand in different parts of ``group`` and were not verified."""
        named = meeting.join(group.select(F.col("node").alias("class"), "component"), "class", "left").withColumn(
            "component", F.coalesce("component", "class"))
        mixed = named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        named = named.join(mixed.select("bucket"), "bucket", "left_semi")
        if copies is not None:
            named = named.join(copies, "class", "left")
        named = cut_lineage(named)
        size = F.when(F.col("x.copies") == F.col("y.copies"), F.col("x.size")) if copies is not None else F.lit(None).cast("long")
        rest = named.alias("x").join(named.alias("y"), "bucket").where(
            "x.class > y.class and x.component <> y.component").where(allowed).select(
            F.col("x.class").alias("a"), F.col("y.class").alias("b"), size.alias("size")).distinct()
        return cut_lineage(rest.join(pairs, ["a", "b"], "left_anti"))

    copies = None
    links = linked(pairs.withColumn("size", F.lit(None).cast("long")))
    may = possible("x", "y", "shared", "total")
    if copies_once:
        alike = links
        group = components(alike.where("plain")).select(F.col("node").alias("class"), F.col("component").alias("copies"))
        sizes = group.join(classes.select("class", "texts"), "class").groupBy("copies").agg(F.sum("texts").alias("size"))
        copies = cut_lineage(group.join(sizes, "copies").select("class", "copies", "size"))
        # alike but not near by the ordinary weights: once more, with the size of their group
        again = alike.where("plain and not near").select("a", "b").join(
            copies.select(F.col("class").alias("a"), "size"), "a").select("a", "b", "size")
        links = alike.union(linked(again))
        may = may | ((F.col("x.copies") == F.col("y.copies")) & possible("x", "y", "plain", "length"))
    links = links.where("near").select("a", "b")
    group = components(links)
    rest = apart(group, may)
    if rest.limit(1).count():
        group = components(links.union(linked(rest).where("near").select("a", "b")))

    # rows -> class -> group; rows of one id are one document
    named = signed.join(classes.select("one", "two", "class"), ["one", "two"], "left").select(
        "id", "key", F.when(F.col("has"), F.col("class")).otherwise(F.col("key")).alias("class_id"))
    out = named.join(group.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    return out.select("id", "key", "class_id", F.coalesce("component", "class_id").alias("group_id"))
