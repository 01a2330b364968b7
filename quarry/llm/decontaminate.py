"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` consecutive words of every benchmark item (an item with fewer words is one
pattern of its own length). The search moves along a document with a block of two words: the shift table says how many
positions cannot hold the end of any pattern, so most words are never looked at; where the shift is 0, the bucket of
that suffix block names the few patterns to compare word by word. Patterns of one length share a search.

The benchmark travels in blocks of a bounded number of bytes: each block is collected, broadcast and searched for in
all documents, and what was found is merged row by row, so the size of a task's tables does not grow with the
benchmark, and documents are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import LOWER, only

WINDOW = 10
BLOCK_BYTES = 8 << 20        # benchmark text that one broadcast holds at most (one longer item: that item)

# words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z: every other byte counts as a space
_SPACE = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in LOWER)

FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                      T.StructField("spans", T.ArrayType(T.IntegerType())),
                      T.StructField("items", T.ArrayType(T.StringType()))])
_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.int32())),
                    ("items", pa.list_(pa.string()))])


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_SPACE).split() if text else []


class WuManber:
    """Patterns of one length over a sequence of words."""

    def __init__(self, patterns: dict[tuple, set[str]]):
        self.m = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.default = m - b + 1
        self.shift: dict = {}
        self.bucket: dict = defaultdict(list)
        for p, items in patterns.items():
            for end in range(b, m + 1):
                key = p[end - b:end]
                self.shift[key] = min(self.shift.get(key, self.default), m - end)
            self.bucket[p[m - b:]].append((p[0], list(p), items))

    def search(self, text: list[bytes]) -> Iterable[tuple[int, set[str]]]:
        """Start and items of every occurrence."""
        m, b, default, shift, bucket = self.m, self.block, self.default, self.shift, self.bucket
        end, n = m, len(text)
        while end <= n:
            key = (text[end - 2], text[end - 1]) if b == 2 else (text[end - 1],)
            far = shift.get(key, default)
            if far:
                end += far
                continue
            at = end - m
            for first, pattern, items in bucket[key]:
                if text[at] == first and text[at:end] == pattern:
                    yield at, items
            end += 1


def searches(items: Iterable[tuple[str, str]], window: int) -> list[WuManber]:
    by: dict[int, dict[tuple, set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            by[n][tuple(w[at:at + n])].add(item)
    return [WuManber(p) for _, p in sorted(by.items())]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def overlaps(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
             item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Column:
    """A column over ``docs`` (struct ``FOUND``): number of words, number of words inside any occurrence of a
    window, the merged runs of such words as ``[start, end, start, end, ...]``, and the ids, sorted as strings, of
    items with a window that occurs.

    A null or empty text has no words and no hits. Items without words match nothing; repeated items and ids count
    once; an item whose id is null is matched and listed as an empty string. An empty benchmark finds nothing. Texts
    are searched whole, of any length. Other columns are neither read nor changed.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    spark = docs.sparkSession
    bench = only(items, item=item_id, text=item_text).select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), "text")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-int(size) // block_bytes) or 1
    found = F.lit(None).cast(FOUND)
    for k in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        found = _search(spark, part, window)(F.col(f"`{text}`"), found)
    return found


def _search(spark, part: DataFrame, window: int):
    held = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in part.collect()])
    ready: list[list[WuManber]] = []

    @F.arrow_udf(FOUND)
    def search(texts: pa.Array, before: pa.Array) -> pa.Array:
        if not ready:
            ready.append(searches(held.value, window))
        out = []
        for text, old in zip(texts, before):
            old = old.as_py() or {"spans": [], "items": []}
            w = words(text.as_py())
            spans, items = list(zip(old["spans"][::2], old["spans"][1::2])), set(old["items"])
            for s in ready[0]:
                for at, names in s.search(w):
                    spans.append((at, at + s.m))
                    items |= names
            spans = merged(spans)
            out.append({"n_words": len(w), "n_hit": sum(b - a for a, b in spans),
                        "spans": [x for span in spans for x in span], "items": sorted(items)})
        return pa.array(out, _FOUND)

    return search
