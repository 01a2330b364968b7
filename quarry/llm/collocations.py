"""Phrase collocations by Toivonen's way of mining: a sample proposes, whole passes decide.

A sample of the documents proposes phrases (those with a lowered count there). A pass over all documents then counts
exactly every proposed phrase and its negative border: the phrases that were not proposed although all their shorter
parts were. If no phrase of the border is frequent, every frequent phrase has been counted, as the parts of a frequent
phrase are frequent. Else the proposal was too small, and what is missing holds a border phrase that failed: a further
pass counts every phrase that holds one and whose words are all proposed or failed. That closes the search, however poor
the sample was; expanding by one border at a time would take a pass for every length.

Who is proposed is held in one bit map (a key's place is the start of a 64-bit hash of the phrase), whose size has a
fixed bound. A chance hit in it only means that a phrase is counted that need not be, so results are exact at every
load. Proposed phrases are counted as words; the border, which is large and almost all rare, as the starts of hashes,
sorted and packed by slices of the hash range: a slice's messages are added up in one task. Two border phrases that
share a key can only seem frequent together; the next pass counts them as words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import only, packed_slices, rows_of, shuffle_partitions, summed, tidy
from quarry.session import stored

AT_LEAST = 30                # occurrences of a candidate
LONGEST = 4                  # words of a phrase
SAMPLE = 0.25                # share of the documents that proposes
FIRST = 2000                 # phrases returned of each language
BLOCK = 4 << 20              # bytes of text at a time
SLICE = 32 << 20             # bytes of text for each slice
MAP_BITS = 29                # log2 of the bit map's size, at most
MAP_PARTS = 256              # pieces in which it comes to the driver
BREAK = b"."
# letters in lower case, tabs as spaces, what ends a piece as BREAK
PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 46 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
HELD = 1_000_000             # phrases that a task holds before it adds them up, and sends them if half are left
OUT = "slice long, once binary, many binary, times binary, body binary"
_OUT = pa.schema([("slice", pa.int64()), ("once", pa.binary()), ("many", pa.binary()), ("times", pa.binary()),
                  ("body", pa.binary())])
BORDER = 1_000_000           # keys of border phrases that a task holds before it sends them
KEYS = ["lang", "phrase", "m", "key"]
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Words:
    """A block of texts as codes of its distinct words; ``BREAK`` stands behind every piece."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        lists = pc.ascii_split_whitespace(pa.array(
            [t.translate(PLAIN).replace(BREAK, b" . ") + b" ." for t in texts], pa.large_binary()).cast(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        self.words = coded.dictionary
        names = self.words.to_pylist()
        self.code = coded.indices.to_numpy().astype(np.int64)
        stop = {i for i, w in enumerate(names) if w in ("", ".")}
        self.word = ~np.isin(self.code, list(stop))
        self.langs = sorted(set(langs))
        number = {l: i for i, l in enumerate(self.langs)}
        self.lang = np.repeat(np.array([number[l] for l in langs], np.int64),
                              pc.list_value_length(lists).to_numpy().astype(np.int64))
        self.h = hashes([w.encode() for w in names])[self.code]
        start = mix(hashes([l.encode() for l in self.langs]) + _ODD) if self.langs else np.zeros(0, np.uint64)
        self.keys = [mix(self.h + start[self.lang])]

    def __len__(self) -> int:
        return len(self.code)

    def key(self, m: int) -> np.ndarray:
        """Keys of the phrases of ``m`` words that begin at each place."""
        while len(self.keys) < m:
            n = len(self.keys)
            self.keys.append(mix(self.keys[-1][:len(self.h) - n] * _ODD + self.h[n:]))
        return self.keys[m - 1]

    def levels(self, held, longest: int, loose: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
        """For phrases of 1, 2, .. words: at which places one begins whose shorter parts are all held, and which of
        those are held themselves. Up to ``loose`` words, none needs to be held."""
        out, before = [], self.word
        for m in range(1, longest + 1):
            could = before if m == 1 else before[:-1] & before[1:]
            at = np.flatnonzero(could)
            member = np.zeros(len(could), bool)
            if held is not None:
                member[at] = held(self.key(m)[at])
            out.append((could, member))
            before = could if m <= loose else member
        return out

    def totals(self, bits: int) -> pa.Table:
        """The number of words of each language."""
        key = (mix(hashes([x.encode() for x in self.langs])) >> np.uint64(32 - bits)).astype(np.int64)
        return pa.table({"lang": pa.array(self.langs, pa.string()), "phrase": pa.nulls(len(key), pa.string()),
                         "m": pa.array([0] * len(key), pa.int32()), "key": key,
                         "n": np.bincount(self.lang[self.word], minlength=len(key)).astype(np.int64)})

    def phrases(self, m: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """A first place and the count of every distinct phrase of ``m`` words that begins at the chosen places, and
        the phrases. Compares words, not hashes."""
        at = np.flatnonzero(chosen)
        size, same = len(self.words), self.lang[at]
        for i in range(m):
            same = same * size + self.code[at + i]
            if i < m - 1:
                _, same = np.unique(same, return_inverse=True)
        order = np.argsort(same, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(same[order]) > 0)) if len(at) else order
        at, n = at[order[first]], np.diff(np.append(first, len(at)))
        parts = [self.words.take(pa.array(self.code[at + i])) for i in range(m)]
        return at, n, parts[0] if m == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))


class Map:
    """Who is held, as bits; the place of a key is its first ``bits`` bits."""

    def __init__(self, raw: np.ndarray, bits: int):
        self.raw, self.bits = raw, np.uint64(64 - bits)

    def __call__(self, key: np.ndarray) -> np.ndarray:
        place = key >> self.bits
        return (self.raw[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    langs, texts, size = [], [], 0
    for b in batches:
        for lang, t in zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
            if t:
                langs.append(lang)
                texts.append(t)
                size += len(t) + 8
                if size > BLOCK:
                    yield Words(langs, texts)
                    langs, texts, size = [], [], 0
    if texts:
        yield Words(langs, texts)


def _joined(key: np.ndarray, n: np.ndarray, room: int) -> np.ndarray:
    """Keys and counts as one number each, the count in its last ``room`` bits; what does not fit there goes on in
    further numbers."""
    most = (1 << room) - 1
    out = [key << np.uint64(room) | np.minimum(n, most).astype(np.uint64)]
    if len(n) and n.max() > most:
        at = np.flatnonzero(n > most)
        out.append(_joined(key[at], n[at] - most, room))
    return out[0] if len(out) == 1 else np.concatenate(out)


def _counted(parts: list[np.ndarray], room: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts. Empties ``parts``: they are sorted in one place."""
    x = np.concatenate(parts)
    parts.clear()
    x.sort()
    if not len(x):
        return x, np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, x[1:] >> np.uint64(room) != x[:-1] >> np.uint64(room)))
    key = x[first] >> np.uint64(room)
    x &= np.uint64((1 << room) - 1)
    return key, np.add.reduceat(x, first).astype(np.int64)


def _packed(key: np.ndarray, n: np.ndarray) -> Iterator[dict]:
    """Keys of border phrases: for each slice (all but the last 32 bits) the last 32 bits, of those that occur once and
    those that occur more often, with their counts."""
    part = (key >> np.uint64(32)).astype(np.int64)
    low = key.astype(np.uint32)
    edge = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else [0]
    for a, b in zip(edge[:-1], edge[1:]):
        one = n[a:b] == 1
        yield {"slice": int(part[a]), "once": low[a:b][one].tobytes(), "many": low[a:b][~one].tobytes(),
               "times": n[a:b][~one].astype(np.uint32).tobytes()}


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Messages in batches of about a megabyte."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r.values() if isinstance(x, bytes))
        if size > 1 << 20:
            yield pa.RecordBatch.from_pylist(held, _OUT)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _OUT)


class Miner:
    """The passes over one table ``lang, text`` without nulls."""

    def __init__(self, spark: SparkSession, src: DataFrame, at_least: int, longest: int, sample: float):
        self.spark, self.src, self.at_least, self.longest, self.share = spark, src, at_least, longest, sample
        size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.bits = max(4, int(np.ceil(np.log2(max(shuffle_partitions(spark), size / SLICE, 1)))))

    def counted(self, src: DataFrame, wanted, at_least: int, totals: bool = False) -> DataFrame:
        """One pass. ``wanted(block)`` yields ``(m, places to count as words, places to count as keys)``, each or None.
        Frequent phrases with ``lang``, ``phrase``, ``m``, ``key``, ``n``; as ``m`` = -1 the keys of what was counted as
        keys and is frequent; with ``totals``, as ``m`` = 0, the number of words of each language."""
        bits = self.bits

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.Table] = []
            border: list[np.ndarray] = []    # distinct keys and counts of some blocks

            def put_border() -> Iterator[pa.RecordBatch]:
                yield from _batches(_packed(*_counted(border, 32 - bits)))

            def put() -> Iterator[pa.RecordBatch]:
                t = summed(held, KEYS, "n")
                held.clear()
                yield from _batches({"slice": i, "body": x} for i, x in packed_slices(t, t.column("key").to_numpy() >> 32))

            for block in _blocks(batches):
                loose = []
                if totals:
                    held.append(block.totals(bits))
                for m, spelt, keyed in wanted(block):
                    if keyed is not None:
                        loose.append(block.key(m)[np.flatnonzero(keyed)])
                    if spelt is not None:
                        at, n, phrase = block.phrases(m, spelt)
                        key = (block.key(m)[at] >> np.uint64(32 - bits)).astype(np.int64)
                        lang = pa.array(block.langs, pa.string()).take(pa.array(block.lang[at]))
                        held.append(pa.table({"lang": lang, "phrase": phrase.cast(pa.string()),
                                              "m": pa.array(np.full(len(at), m, np.int32)), "key": key, "n": n}))
                if loose:
                    border.append(_joined(*np.unique(np.concatenate(loose) >> np.uint64(32 - bits), return_counts=True),
                                          32 - bits))
                    if sum(map(len, border)) > BORDER:
                        yield from put_border()
                if sum(map(len, held)) > HELD:
                    held[:] = [summed(held, KEYS, "n")]
                    if len(held[0]) > HELD // 2:
                        yield from put()
            if border:
                yield from put_border()
            if held:
                yield from put()

        def add(t: pa.Table) -> pa.Table:
            number = t.column("slice")[0].as_py()
            out = []
            spelt = [rows_of(x) for x in t.column("body") if x.is_valid]
            if spelt:
                sums = summed(spelt, KEYS, "n")
                out.append(sums.filter(pc.or_(pc.greater_equal(sums.column("n"), at_least), pc.equal(sums.column("m"), 0))))
            once, many, times = (np.frombuffer(b"".join(x for x in t.column(c).to_pylist() if x), np.uint32)
                                 for c in ("once", "many", "times"))
            key = np.concatenate([once, many])
            order = np.argsort(key, kind="stable")
            key, n = key[order], np.concatenate([np.ones(len(once), np.int64), times.astype(np.int64)])[order]
            if len(key):
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                n = np.add.reduceat(n, first)
                found = key[first[n >= at_least]].astype(np.int64) | (number << 32)
                out.append(pa.table({"lang": pa.nulls(len(found), pa.string()), "phrase": pa.nulls(len(found), pa.string()),
                                     "m": pa.array([-1] * len(found), pa.int32()), "key": found, "n": n[n >= at_least]}))
            return pa.concat_tables(out)

        done = src.mapInArrow(tidy(scan), OUT).groupBy("slice").applyInArrow(
            tidy(add), "lang string, phrase string, m int, key long, n long")
        return stored(done, "phrases")

    def bits_of(self, keys: DataFrame, log: int) -> np.ndarray:
        """A bit map of 2^``log`` bits with those of ``keys``, made in parts."""
        width, parts = 32 + self.bits, min(log - 3, int(np.log2(MAP_PARTS)))

        def fill(t: pa.Table) -> pa.Table:
            place = np.unique(t.column("place").to_numpy())
            bits = np.zeros(1 << (log - parts), np.uint8)
            bits[place & ((1 << (log - parts)) - 1)] = 1
            return pa.table({"part": t.column("part").slice(0, 1),
                             "body": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

        place = F.shiftright("key", width - log)
        made = (keys.select(place.alias("place")).distinct()
                .withColumn("part", F.shiftright("place", log - parts).cast("int"))
                .groupBy("part").applyInArrow(tidy(fill), "part int, body binary").collect())
        out = np.zeros((1 << parts, 1 << (log - parts - 3)), np.uint8)
        for r in made:
            out[r["part"]] = np.frombuffer(r["body"], np.uint8)
        return out.reshape(-1)

    def propose(self) -> tuple[np.ndarray, int]:
        """The bit map of what a sample finds with a lowered count, and the log2 of its size."""
        longest, low = self.longest, max(1, int(self.at_least * self.share / 2))
        few = self.src.sample(False, self.share, 7) if self.share < 1 else self.src

        def short(block: Words):
            for m, (could, _) in enumerate(block.levels(None, min(2, longest), loose=2), 1):
                yield m, None, could

        keys = self.counted(few, short, low).where("m < 0").select("key")
        log = int(np.clip(np.ceil(np.log2(max(1, 64 * keys.count()))), 12, min(MAP_BITS, 32 + self.bits)))
        raw = self.bits_of(keys, log)
        if longest > 2:
            held = self.spark.sparkContext.broadcast(raw)

            def long(block: Words):
                got = block.levels(Map(held.value, log), 2)
                two = member = got[1][1]
                for m in range(3, longest + 1):
                    member = member[:-1] & two[m - 2:]
                    yield m, None, member

            raw = raw | self.bits_of(self.counted(few, long, low).where("m < 0").select("key"), log)
        return raw, log

    def mine(self) -> tuple[DataFrame, DataFrame, int]:
        """All frequent phrases with their exact counts, the number of words of each language, and the passes made."""
        longest, at_least = self.longest, self.at_least
        raw, log = self.propose()
        held = self.spark.sparkContext.broadcast(raw)

        def first(block: Words):
            for m, (could, member) in enumerate(block.levels(Map(held.value, log), longest), 1):
                yield m, member, could & ~member

        found, passes = self.counted(self.src, first, at_least, totals=True), 1
        words = found.where("m = 0").select("lang", "n")
        failed = found.where("m < 0").select("key")
        if not failed.isEmpty():
            # a frequent phrase that was not counted holds a failed one, and its words are held or failed themselves
            lost = self.bits_of(failed, log)
            more = self.spark.sparkContext.broadcast(lost)

            def rest(block: Words):
                old = block.levels(Map(held.value, log), longest)
                missed = Map(more.value, log)
                word = block.word & (old[0][1] | missed(block.key(1)))
                inside, has = word, np.zeros(len(block) + 1, bool)
                for m in range(1, longest + 1):
                    inside = inside if m == 1 else inside[:-1] & word[m - 1:]
                    at = np.flatnonzero(inside)
                    new = np.zeros(len(inside), bool)
                    new[at] = missed(block.key(m)[at])
                    has = new | (has[:-1] | has[1:]) & inside
                    yield m, has & ~old[m - 1][1], None          # what was proposed has been counted

            found, passes = found.union(self.counted(self.src, rest, at_least)), 2
        return found.where("m > 0").select("lang", "phrase", "m", "n"), words, passes


def mine(df: DataFrame, lang: str = "lang", text: str = "text", at_least: int = AT_LEAST, first: int = FIRST,
         longest: int = LONGEST, sample: float = SAMPLE) -> DataFrame:
    """The ``first`` strongest phrases of each language: ``lang``, ``rank`` (from 1), ``phrase`` (words joined by
    spaces), ``a`` (its occurrences), ``l`` and ``r`` (of its two parts at the weakest cut), ``n`` (of all words) and
    ``score`` = floor(2000000 * a / (l + r)).

    Phrases of 2 to ``longest`` words within pieces (between any of ``.,;:!?`` and line ends) that occur at least
    ``at_least`` times are candidates; one that stands inside a longer candidate with 80 % of its occurrences or more is
    left out. Ranks: score, then ``a``, descending, then the phrase in UTF-8 order. A null language reads as ``und``, a
    null text as empty. Repeated rows count each time. Texts are whole, of any length. An empty table, or one without
    candidates, gives an empty result. ``sample`` (the share of rows that proposes) changes the work, never the result.
    Other columns are not read.
    """
    src = only(df, lang=lang, text=text).where("text is not null").select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    found, words, _ = Miner(df.sparkSession, src, at_least, longest, sample).mine()
    found = stored(found, "frequent")
    many = found.where("m > 1").select("lang", F.col("phrase"), F.col("n").alias("a"), "m", F.split("phrase", " ").alias("w"))

    def part(begin, length):
        return F.array_join(F.slice("w", begin, length), " ")

    cuts = many.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.withColumn("x", part(F.lit(1), F.col("k"))).withColumn("y", part(F.col("k") + 1, F.col("m") - F.col("k")))
    left = found.select("lang", F.col("phrase").alias("x"), F.col("n").alias("l"))
    right = found.select("lang", F.col("phrase").alias("y"), F.col("n").alias("r"))
    score = F.expr("cast(2000000 as decimal(18,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(38,0))")
    weakest = (cuts.join(left, ["lang", "x"]).join(right, ["lang", "y"]).withColumn("score", score.cast("long"))
               .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    # of every shorter phrase the most occurrences of a longer one around it
    inner = (many.where("m > 2").withColumn("z", F.explode(F.sequence(F.lit(2), F.col("m") - 1)))
             .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("z") + 1)))
             .select("lang", part(F.col("i"), F.col("z")).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("most")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (weakest.join(inner, ["lang", "phrase"], "left").where("most is null or 100 * most < 80 * a")
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
            .withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= first)
            .join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
