"""How far the sources of a language drift apart: smoothed shares of common terms, compared pair by pair on run-length
columns.

Every group (a source within a language) and every language is a column over the language's vocabulary: the smoothed
share of each term, in parts of a thousand million, rounded down. The vocabulary is reordered so that terms with equal
counts in the largest sources stand together, and is dealt in ranges of that order to tasks. There each column is
written as runs of equal counts; a pair's boundaries are merged, and the difference of the two shares is multiplied by
the length of each common run. Sums of ranges add up, so no task holds a whole column.

All arithmetic is on integers: shares by long division, sums of at most 2 * 10^9 a vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import only, packed_slices, rows_of, shuffle_partitions, summed, tidy
from quarry.session import stored

SCALE = 1_000_000_000
SMOOTH = 5                   # added to each count
AT_LEAST = 30                # documents of a language that hold a kept term
TOP = 50                     # terms listed of each group
BYTES = 8 << 20              # text counted at a time
HELD = 1_500_000             # counts that a task holds before it adds them up, and sends them if half are left
SLICE = 32 << 20             # bytes of text for each slice of the terms
BLOCK = 50_000               # kept terms in a range
# letters in lower case, bytes of other characters as they are, all else as a space
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def count_terms(langs: list[str], sources: list[str], texts: list[bytes]) -> pa.Table:
    """``lang``, ``source``, ``term``, ``c`` (occurrences) and ``d`` (documents) of a block of documents."""
    groups = sorted(set(zip(langs, sources)))
    number = {g: i for i, g in enumerate(groups)}
    group = np.array([number[g] for g in zip(langs, sources)], np.int64)
    lists = pc.ascii_split_whitespace(pa.array([t.translate(TERMS) for t in texts], pa.large_binary()).cast(pa.large_string()))
    coded = lists.flatten().dictionary_encode()
    size = len(coded.dictionary)
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    at, n = np.unique(doc * size + coded.indices.to_numpy(), return_counts=True)
    key = group[at // max(size, 1)] * size + at % max(size, 1)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    key = key[first]
    found = pa.table({
        "lang": pa.array([g[0] for g in groups], pa.string()).take(pa.array(key // max(size, 1))),
        "source": pa.array([g[1] for g in groups], pa.string()).take(pa.array(key // max(size, 1))),
        "term": coded.dictionary.take(pa.array(key % max(size, 1))).cast(pa.string()),
        "c": pa.array(np.add.reduceat(n, first) if len(first) else n, pa.int64()),
        "d": pa.array(np.diff(np.append(first, len(n))), pa.int64())})
    return found.filter(pc.not_equal(found.column("term"), ""))


def added(tables: list[pa.Table]) -> pa.Table:
    return summed(tables, ["lang", "source", "term"], "c", "d")


def kept_counts(src: DataFrame, at_least: int) -> DataFrame:
    """``lang``, ``source``, ``term``, ``c``, ``all`` (occurrences in the language) of the terms in at least
    ``at_least`` documents of their language. ``src``: ``lang``, ``source``, ``text`` without nulls.

    A task counts its documents and sends its counts in slices of the terms' hash range, each slice as one compressed
    table: a term costs a row for each source and task that has it, not for each document. A slice has all counts of
    its terms, so it can add them up and drop the rare ones, which are most."""
    spark = src.sparkSession
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(shuffle_partitions(spark), -(-total // SLICE))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        docs: list[tuple] = []
        size = 0

        def put() -> Iterator[pa.RecordBatch]:
            t = added(held)
            held.clear()
            of = np.fromiter((zlib.crc32(x) % slices for x in t.column("term").cast(pa.binary()).to_pylist()), np.int64, len(t))
            rows = list(packed_slices(t, of))
            for at in range(0, len(rows), 64):
                part = rows[at:at + 64]
                yield pa.RecordBatch.from_pydict({"slice": pa.array([i for i, _ in part], pa.int64()),
                                                  "body": pa.array([x for _, x in part], pa.binary())})

        for b in batches:
            for row in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(),
                           b.column("text").cast(pa.binary()).to_pylist()):
                docs.append(row)
                size += len(row[2]) + 16
                if size > BYTES:
                    held.append(count_terms(*map(list, zip(*docs))))
                    docs, size = [], 0
                    if sum(map(len, held)) > HELD:
                        held[:] = [added(held)]
                        if len(held[0]) > HELD // 2:
                            yield from put()
        if docs:
            held.append(count_terms(*map(list, zip(*docs))))
        if held:
            yield from put()

    def keep(t: pa.Table) -> pa.Table:
        whole = added([rows_of(x) for x in t.column("body")])
        terms = whole.group_by(["lang", "term"]).aggregate([("d", "sum"), ("c", "sum")])
        terms = terms.filter(pc.greater_equal(terms.column("d_sum"), at_least)).select(["lang", "term", "c_sum"])
        return whole.join(terms, ["lang", "term"], join_type="inner").select(
            ["lang", "source", "term", "c", "c_sum"]).rename_columns(["lang", "source", "term", "c", "all"])

    return src.mapInArrow(tidy(count), "slice long, body binary").groupBy("slice").applyInArrow(
        tidy(keep), "lang string, source string, term string, c long, all long")


def share(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 5) / total), by long division to the base 1000, exact below 9 * 10^15."""
    whole, rest = np.divmod(count.astype(np.int64) + SMOOTH, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def runs(place: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and values of the runs of a column of ``length`` places that holds ``count`` at ``place`` (ascending)
    and 0 elsewhere."""
    value = np.zeros(2 * len(place) + 1, np.int64)
    start = np.zeros(2 * len(place) + 1, np.int64)
    start[1::2], value[1::2] = place, count
    start[2::2] = place + 1
    last = np.append(start[1:] > start[:-1], start[-1] < length)     # of starts at one place the last one holds
    start, value = start[last], value[last]
    new = np.append(True, value[1:] != value[:-1]) if len(start) else last[:0]
    return start[new], value[new]


def difference(a: tuple, b: tuple, length: int) -> int:
    """Sum of abs(p - q) over all places of two columns of runs."""
    start = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], start, side="right") - 1]
    q = b[1][np.searchsorted(b[0], start, side="right") - 1]
    return int((np.abs(p - q) * np.diff(np.append(start, length))).sum())


def audit(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", at_least: int = AT_LEAST,
          top: int = TOP, block: int = BLOCK) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` for every group of a language and a source in
    ``df``. Part ``pair``: ``item`` is each other source of the language, ``value`` the sum over all kept terms of the
    absolute difference of the two groups' shares. Part ``term``: the ``top`` terms whose share in the group exceeds
    that in the language most, with the difference. Ranks count from 1 by value, descending, then item in UTF-8 order.

    Kept terms are those in at least ``at_least`` documents of the language. Null texts, languages and sources read as
    empty ones; a group without terms has pairs, and no terms; a language without kept terms has pairs of value 0; a
    single source has no pairs. Repeated rows count each time. Texts are whole, of any length. An empty table gives an
    empty result. Other columns are not read.
    """
    spark = df.sparkSession
    src = only(df, lang=lang, source=source, text=text)
    src = src.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in src.columns])
    kept = stored(kept_counts(src, at_least), "kept")
    # sizes of groups and languages
    of_lang = kept.groupBy("lang").agg(F.sum("c").alias("lang_n"), F.countDistinct("term").alias("v"))
    groups = (src.select("lang", "source").distinct()
              .join(kept.groupBy("lang", "source").agg(F.sum("c").alias("n")), ["lang", "source"], "left")
              .join(of_lang, "lang", "left").fillna(0, ["n", "lang_n", "v"]))
    by_size = Window.partitionBy("lang").orderBy(F.desc("n"), "source")
    groups = stored(groups.withColumn("place", F.row_number().over(by_size)), "groups")

    # terms: the group's share against the language's
    def p(count: str, n: str):
        return F.expr(f"1 + cast({SCALE} as decimal(20,0)) * cast({count} + {SMOOTH} as decimal(18,0)) "
                      f"div cast({n} + {SMOOTH} * v as decimal(38,0))")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (kept.join(groups, ["lang", "source"]).withColumn("value", p("c", "n") - p("all", "lang_n"))
             .where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
             .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))

    # the vocabulary in an order that brings equal counts together, a range of it for each block
    vectors = (kept.join(groups.select("lang", "source", "place"), ["lang", "source"])
               .groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("place", "c"))).alias("counts")))
    blocks = max(shuffle_partitions(spark), -(-groups.agg(F.max("v").alias("v")).first()["v"] // block)
                 if not groups.isEmpty() else 1)
    # (ranges by the first counts: their bounds are sampled on the driver)
    ranges = stored(vectors.repartitionByRange(blocks, "lang", F.slice("counts", 1, 2), "term")
                    .sortWithinPartitions("lang", "counts", "term").select(
        "lang", "counts", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("order")), "ranges")
    # every group has a column in every block of its language, and one block is empty, for languages without terms
    columns = stored(ranges.select("lang", "block").distinct()
                     .union(groups.select("lang", F.lit(-1).alias("block")).distinct())
                     .join(groups.select("lang", "place", "n", "v"), "lang"), "columns")

    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        lists = left.take(pc.sort_indices(left, [("order", "ascending")])).column("counts").combine_chunks()
        length = len(lists)
        found = lists.flatten()
        place = found.field("place").to_numpy().astype(np.int64)
        c = found.field("c").to_numpy().astype(np.int64)
        at = np.repeat(np.arange(length), pc.list_value_length(lists).to_numpy())
        order = np.lexsort((at, place))
        place, c, at = place[order], c[order], at[order]
        made = {}
        for i, n, v in zip(*[right.column(x).to_pylist() for x in ("place", "n", "v")]):
            lo, hi = np.searchsorted(place, [i, i + 1])
            start, count = runs(at[lo:hi], c[lo:hi], length)
            made[i] = start, share(count, n + SMOOTH * v) if len(count) else count
        which = sorted(made)
        pairs = [(i, k) for x, i in enumerate(which) for k in which[x + 1:]]
        return pa.table({"lang": pa.array([key[0].as_py()] * len(pairs), pa.string()),
                         "a": pa.array([i for i, _ in pairs], pa.int32()), "b": pa.array([k for _, k in pairs], pa.int32()),
                         "value": pa.array([difference(made[i], made[k], length) for i, k in pairs], pa.int64())})

    sums = (ranges.groupBy("lang", "block").cogroup(columns.groupBy("lang", "block"))
            .applyInArrow(tidy(compare), "lang string, a int, b int, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = stored(sums.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                              .alias("p"), "value").select("lang", "p.a", "p.b", "value"), "pairs")
    name = groups.select("lang", "source", F.col("place").alias("a"))
    item = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"))
    pairs = (both.join(name, ["lang", "a"]).join(item, ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(best)))
    return pairs.unionByName(terms)

