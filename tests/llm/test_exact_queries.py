"""Operators whose results SQL or a short brute-force program gives exactly."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import math

import numpy as np
import pyarrow as pa
import pytest
from helpers import odd_documents, odd_rows, prose
from oracle import compare, duck
from pyspark.sql import functions as F

from quarry.llm import class_lm, common, decontaminate, embedding_dedup, hnsw, minhash, packing, queries, sharding, \
    suffix_dedup, warc

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, small_dir, name):
    ok, said = compare(queries.QUERIES[name](spark, small_dir), duck(small_dir), queries.SQL[name])
    assert ok, said


# 1 sharding


def test_shards_are_exact_and_gapless(spark):
    df = odd_documents(spark, odd_rows())
    got = sharding.shuffle_to_shards(df, 4, rows_a_cell=3).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(4)]
    assert sum(sizes) == df.count() and max(sizes) - min(sizes) <= 1
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(odd_rows())
    assert got[0].asDict()["chunk"] is None and got[0]["key"] == "k"
    assert sharding.shuffle_to_shards(df.limit(0), 4).count() == 0
    assert sharding.shuffle_to_shards(df.limit(2), 4).count() == 2


def test_sharding_query_against_the_table(spark, small_dir):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = queries.op1_sharding(spark, small_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(rows)
    slots = defaultdict(list)
    for r in got:
        raw = (rows[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_communication_matrix_rows_and_columns_add_up():
    sizes, totals = np.array([5, 7, 0, 9, 11]), np.array([4, 6, 11, 0, 11])
    rows = np.array([sharding.matrix_row(sizes, totals, i, 3) for i in range(5)])
    assert (rows.sum(0) == totals).all() and (rows.sum(1) == sizes).all() and (rows >= 0).all()
    mean = np.mean([sharding.matrix_row(sizes, totals, 3, s) for s in range(2000)], axis=0)
    assert np.allclose(mean, 9 * totals / totals.sum(), atol=0.15)


def test_hypergeometric_beyond_numpy_limits():
    rng = np.random.default_rng(1)
    got = np.array([sharding.hypergeometric(rng, 3 * 10**10, 10**10, 1000) for _ in range(400)])
    assert abs(got.mean() - 750) < 3 and 100 < got.var() < 280
    assert sharding.hypergeometric(rng, 3 * 10**10, 10**10, 4 * 10**10) == 3 * 10**10


# 2 class model


def class_model_rows():
    return odd_rows() + [(400 + i, f"Ab cd\tNew{i} ab ef{i % 7} gh") for i in range(40)] + [(445, "\x0b a\x1cb \xa0 ")]


def lm_tokens(rows):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    held = {d: zlib.crc32(str("" if d is None else d).encode()) % 10 == 0 for d, _ in rows}
    return [(d, held[d], word.findall((t or "").translate(LOW)) + [None]) for d, t in rows]


@pytest.mark.parametrize("chunk", [500, 1 << 24])
def test_class_model_against_a_loop(spark, chunk):
    rows = class_model_rows()
    df = odd_documents(spark, rows)
    job = class_lm.Job(class_lm._source(df, class_lm.held_out("doc_id"), "doc_id", "text"), 4, 10, 2, chunk)
    out = class_lm.score_texts(df, class_lm.held_out("doc_id"), job=job).collect()
    toks = lm_tokens(rows)
    c = Counter(w for _, h, ws in toks if not h for w in ws)
    n, v = sum(c.values()), len(c)
    # classes, as the operator says; everything else is counted here
    own = {bytes(r["word"]).decode(): r["class"] for r in job.word_classes().collect()}
    assert {w for w, k in c.items() if k > 1 and w is not None} == set(own)

    def cls(w):
        return 0 if w is None else own[w] if w in own else int(job.endings[class_lm.ending(w.encode())])

    pairs, size, kinds, ones, twos = np.zeros((5, 5)), Counter(), Counter(), Counter(), Counter()
    for _, h, ws in toks:
        if not h:
            for a, b in zip([None, *ws], ws):
                pairs[cls(a), cls(b)] += 1
    for w, k in c.items():
        size[cls(w)] += k
        kinds[cls(w)] += 1
        ones[cls(w)] += k == 1 and w is not None
        twos[cls(w)] += k == 2 and w is not None
    step = class_lm.transitions(pairs)

    def emission(w):
        k = cls(w)
        d = 0.0 if k == 0 else min(0.9, max(0.1, ones[k] / max(1, ones[k] + 2 * twos[k]))) if ones[k] + twos[k] else 0.5
        return math.log10((c[w] - d) / size[k]) if c[w] else math.log10(d * kinds[k] / size[k])

    want = Counter()
    for d, h, ws in toks:
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        score = sum(step[cls(a), cls(b)] + emission(b) for a, b in zip([None, *ws], ws))
        want[(d, h, len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6), round(score, 6))] += 1
    assert want == Counter((r["id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                            round(r["base_score"], 6), round(r["score"], 6)) for r in out)
    assert all(r["perplexity"] > 1 for r in out)


def test_class_model_is_a_distribution_and_handles_no_training(spark):
    pairs = np.random.default_rng(0).poisson(2, (5, 5))
    assert np.allclose((10 ** class_lm.transitions(pairs)).sum(1), 1)
    counts = {1: [5, 2, 1, 1], 2: [1]}
    n, v = np.array([3., 9, 1]), np.array([1, 4, 1])
    d = np.array([0, 0.5, 0.9])
    with np.errstate(divide="ignore"):
        m = class_lm.Model(np.zeros(2, int), np.zeros((3, 3)), n, np.log10(d * v / n), d, 3, 13, 6)
    for k, cs in counts.items():
        known = 10 ** m.emission(np.array(cs), np.full(len(cs), k))
        unseen = 10 ** m.emission(np.array([0]), np.array([k]))
        assert abs(known.sum() + unseen.sum() - 1) < 1e-9
    df = odd_documents(spark, [(1, "a b"), (2, None)])
    none = class_lm.score_texts(df, F.lit(True), classes=2, head=4).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in none] == [(0, 0, 0.0)] * 2
    assert class_lm.score_texts(df.limit(0), F.lit(False)).count() == 0


def test_classes_follow_what_words_do(spark):
    rng = random.Random(1)
    kinds = [[f"{c}{i}" for i in range(30)] for c in "pqr"]
    rows = [(i, " ".join(rng.choice(kinds[k % 3]) for k in range(rng.randint(6, 12)))) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    job = class_lm.Job(class_lm._source(df, F.lit(False), "doc_id", "text"), 3, 12, 2, 2000)
    of = {bytes(r["word"]).decode(): r["class"] for r in job.word_classes().collect()}
    assert len(of) == 90 and all(len({of[w] for w in words}) == 1 for words in kinds)


def test_gains_of_common_units_are_those_of_the_whole_table(monkeypatch):
    def likelihood(t):
        h = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return h(t) - h(t.sum(0)) - h(t.sum(1))

    monkeypatch.setattr(class_lm, "OFTEN", 0)
    rng = np.random.default_rng(4)
    pairs, m, old = rng.poisson(60, (5, 5)).astype(float), rng.poisson(4, (6, 10)).astype(float), np.full(6, 2, np.uint8)
    for i, k in enumerate(class_lm.best_classes(m, old, pairs)):
        def moved(k, i=i):
            t = pairs.copy()
            n = max(m[i, :5].sum(), m[i, 5:].sum())
            t[2] = np.maximum(t[2] - m[i, :5], 0)
            t[:, 2] = np.maximum(t[:, 2] - m[i, 5:], 0)
            row, col = t.sum(1), t.sum(0)
            h = lambda x: x * np.log(np.maximum(x, 1))
            a, b = t.copy(), t.copy()
            a[k] += m[i, :5]
            b[:, k] += m[i, 5:]
            return (h(a) - h(t)).sum() + (h(b) - h(t)).sum() - h(row[k] + n) + h(row[k]) - h(col[k] + n) + h(col[k])
        assert k == 1 + int(np.argmax([moved(k) for k in range(1, 5)]))


def test_exchange_leaves_no_improving_move():
    def likelihood(t):
        h = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return h(t) - h(t.sum(0)) - h(t.sum(1))

    b = np.random.default_rng(0).poisson(3, (12, 12)).astype(float)

    def of_classes(of):
        m = np.zeros((12, 4))
        m[np.arange(12), of] = 1
        return likelihood(m.T @ b @ m)

    of = class_lm.exchange(b, 3, 50)
    for u in range(1, 12):
        for k in range(1, 4):
            other = of.copy()
            other[u] = k
            assert of_classes(other) <= of_classes(of) + 1e-9


def test_a_chunk_is_the_same_in_pieces(monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(0, 40)) + rng.choice(["", " ", "  \t", "É Ü"]) for _ in range(200)] + [""]
    rows = pa.table({"id": pa.array(range(201)), "held": pa.array([i % 5 == 0 for i in range(201)]),
                     "text": pa.chunked_array([pa.array([t.encode() for t in x], pa.binary()) for x in (texts[:90], texts[90:])])})
    got = []
    for piece in (1 << 20, 300, 1):
        monkeypatch.setattr(class_lm, "PIECE", piece)
        row = class_lm.coded(rows, 1, 5)
        n = len(class_lm.rows_of(pa.scalar(row["words"], pa.binary())))
        cuts = np.append(class_lm.unzip(row["cuts"], np.int64), n + 1)
        counts = pa.table({"slice": class_lm.unzip(row["slices"], np.int64),
                           "rank": [class_lm.zip_(np.arange(b - a, dtype=np.int32)) for a, b in zip(cuts, cuts[1:])],
                           "c": [class_lm.zip_(1 + np.arange(a, b) % 3) for a, b in zip(cuts, cuts[1:])]})
        chunk = class_lm.Chunk(row, counts, None)
        got.append((row, list(class_lm.contexts(chunk, np.append(np.uint8(0), (1 + np.arange(n) % 7).astype(np.uint8)), 8))))
    assert got[0] == got[1] == got[2] and len(got[0][1]) > 5


# 3 repeats


def brute_repeats(rows, width):
    seen = {}
    raw = [(d, (t or "").encode()) for d, t in rows]
    big = 1 << 62
    for d, b in raw:
        for i in range(len(b) - width + 1):
            s = b[i:i + width]
            seen[s] = min(seen.get(s, big), big if d is None else d)
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] < (big if d is None else d):
                gone[i:i + width] = b"\1" * width
        spans = re.findall(b"\1+", bytes(gone))
        out.append((d, len(b), sum(gone), len(spans), bytes(x for x, g in zip(b, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("width,chunk,seed", [(50, 2 << 20, 1), (50, 700, 2), (12, 300, 3), (5, 100, 4)])
def test_repeats_against_a_loop(spark, width, chunk, seed):
    rng = random.Random(seed)
    rows = odd_rows(seed)
    if width < 50:  # a small alphabet: strings meet by chance everywhere
        rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 90)))) for i in range(60)]
        rng.shuffle(rows)
    got = suffix_dedup.remove_repeats(odd_documents(spark, rows), carry=("shard", "slot"), width=width,
                                      chunk_bytes=chunk)
    assert got.columns == ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "shard", "slot"]
    assert Counter((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got.collect()) == \
        brute_repeats(rows, width)


def test_repeats_of_an_empty_table_and_many_contexts(spark, monkeypatch):
    assert suffix_dedup.remove_repeats(odd_documents(spark, [(1, "x")]).limit(0)).count() == 0
    rng = random.Random(5)
    line = "one line that a great many of these documents have in them somewhere"
    rows = [(i, prose(rng, 5) + line + prose(rng, 5)) for i in range(90)]   # over MANY phrases of one trigger
    got = suffix_dedup.remove_repeats(odd_documents(spark, rows)).collect()
    assert Counter((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == \
        brute_repeats(rows, 50)


def test_only_sides_on_which_phrases_agree_are_compared():
    # phrases 1 and 2 of trigger 7 agree on the left, 1 and 3 on neither side; trigger 8 has one phrase, in two documents;
    # trigger 9 has more phrases than its chunk sent
    rows = [r for chunk, a, b, left, right, doc in [
        (1, [7, 7, 8, 9], [1, 2, 5, 6], [3, 3, 1, 1], [5, 6, 1, 0], [10, 11, 12, 13]), (2, [7, 8, 9], [3, 5, 0], [4, 1, 0], [0, 1, 0], [5, 4, 20])]
        for r in suffix_dedup.send(chunk, 0, *(np.array(x, np.uint64) for x in (a, b)), np.array(doc),
                                   *(np.array(x, np.uint32) for x in (left, right)))]
    sent = pa.Table.from_batches([suffix_dedup.rows_batch(rows, suffix_dedup._SENT_ARROW)])
    got = {r["chunk"]: [np.unpackbits(np.frombuffer(r[c], np.uint8), count=n).tolist() for c in ("left", "right", "less")]
           for r, n in zip(suffix_dedup._answer(2)(sent).to_pylist(), (4, 3))}
    assert got[1] == [[1, 1, 0, 1], [0, 0, 0, 1], [0, 0, 1, 0]]
    assert got[2][0][:2] == [0, 0] and got[2][1][:2] == [0, 0] and got[2][2] == [0, 0, 0]


# 4 near-duplicates


def brute_groups(rows, at_least=0.8):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    bags = []
    for _, t in rows:
        w = word.findall((t or "").translate(LOW))
        bags.append(Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else
                    Counter([tuple(w)] if w else []))
    df = Counter(x for b in bags for x in b)
    idf = {x: math.log((1 + len(rows)) / (1 + n)) + 1 for x, n in df.items()}
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = sum(min(bags[i][x], bags[j][x]) * idf[x] for x in bags[i] if x in bags[j])
            either = sum(n * idf[x] for x, n in (bags[i] | bags[j]).items())
            if either and both / either >= at_least:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def test_groups_against_all_pairs(spark):
    rng = random.Random(3)
    rows = [(d, t) for d, t in odd_rows() if d is not None]
    rows = list({d: (d, t) for d, t in rows}.values())
    first = prose(rng, 90).split()
    for i in range(60):  # a crowd of edited copies, many of which are only near a few others
        w = list(first)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(w)))
    got = {r["id"]: r["group_id"] for r in minhash.near_duplicates(odd_documents(spark, rows)).collect()}
    groups = defaultdict(list)
    for (d, _), g in zip(rows, brute_groups(rows)):
        groups[g].append(d)
    want = {d: min(ds) for ds in groups.values() for d in ds}
    assert got == want


def test_edited_copies_of_a_large_group_are_found(spark):
    # 150 copies of one text, each with an edit of its own in the last 20 words: every two of them, and the original, are
    # 0.85 alike or more, but what they share weighs little, as 150 texts hold it
    rng = random.Random(6)
    first = prose(rng, 150).split()
    rows = [(0, " ".join(first))]
    for i in range(1, 151):
        w = list(first)
        for k in rng.sample(range(135, 150), 3):
            w[k] = f"edit{i}x{k}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, prose(rng, 60)) for i in range(2000)]
    docs = odd_documents(spark, rows)
    got = {r["id"]: r["group_id"] for r in minhash.near_duplicates(docs, copies_once=True).collect()}
    assert all(got[i] == 0 for i in range(151)) and all(got[1000 + i] == 1000 + i for i in range(2000))
    assert sum(r["group_id"] == 0 for r in minhash.near_duplicates(docs).collect()) < 75     # by the ordinary weights


def test_a_passage_of_many_texts_does_not_make_copies(spark):
    passage = " ".join(f"w{i}" for i in range(104))
    rows = [(i, f"{passage} own{i} of{i} it{i}") for i in range(2)]
    rows += [(10 + i, passage + "".join(f" x{i}y{k}" for k in range(300))) for i in range(1000)]
    rows += [(5000, prose(random.Random(1), 80))] * 2 + [(5001, None), (5002, "")]
    rows += [(6000 + i, " ".join(f"z{i}q{k}" for k in range(400))) for i in range(600)]
    got = minhash.near_duplicates(odd_documents(spark, rows), copies_once=True)
    assert got.count() == len(rows) and got.where("id <> group_id").count() == 0


def test_groups_of_odd_rows(spark):
    rows = odd_rows()
    out = minhash.near_duplicates(odd_documents(spark, rows)).collect()
    assert Counter(r["id"] for r in out) == Counter(d for d, _ in rows)
    by = {r["id"]: r["group_id"] for r in out if r["id"] is not None}
    assert all(by[100 + i] == i for i in range(3)) and all(by[d] == d for d in (300, 301, 302, 303, 304))
    assert sorted(r["group_id"] for r in out if r["id"] is None)[0] == 4   # the copy of document 4
    assert minhash.near_duplicates(odd_documents(spark, rows).limit(0)).count() == 0


def test_groups_beside_millions_of_other_shingles(spark):
    # two texts share 100 shingles of 1,002 documents and have 3 of their own: 0.78 alike, however many other shingles
    # there are (with counters that shingles share, those of their own would weigh less: 0.81)
    passage = " ".join(f"w{i}" for i in range(104))
    rows = [(i, f"{passage} own{i} of{i} it{i}") for i in range(2)]
    rows += [(10 + i, passage + "".join(f" x{i}y{k}" for k in range(300))) for i in range(1000)]
    other = spark.range(2000, 3000, 1, 8).selectExpr(
        "id as doc_id", "concat_ws(' ', transform(sequence(1, 8000), k -> concat('z', id, 'q', k))) as text")
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(other)
    got = minhash.near_duplicates(docs)
    assert got.count() == 2002 and got.where("id <> group_id").count() == 0


def test_document_frequencies_of_small_chunks(spark):
    texts = [t or "" for _, t in odd_rows()]
    want = Counter(int(h) for t in texts for h in minhash.shingles(minhash.pa.array([t]))[1])
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    chunks = minhash.text_chunks(docs, 500)
    rows = {r["chunk"]: r["body"] for r in chunks.collect()}
    found = defaultdict(list)
    for r in minhash.document_frequencies(chunks).collect():
        found[r["chunk"]].append(r.asDict())
    assert len(rows) > 4 and set(rows) == set(found)
    for chunk, body in rows.items():
        text = minhash.rows_of(minhash.pa.scalar(bytes(body))).column("text").combine_chunks()
        h = np.unique(minhash.shingles(text)[1])
        df, n = minhash.chunk_frequencies(minhash.pa.Table.from_pylist(found[chunk]))
        assert n == len(texts) and [want[int(x)] for x in h] == df.tolist()


# 5 packing


def test_pieces_hold_every_id_once_within_all_limits(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tok = Tokenizer.from_file(path)              # the contract's call: a special token's string is that token
    assert tok.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    rows = odd_rows() + [(503, "a <|endoftext|> b"), (500, "a  b   c \n\n d <|endoftext|> e  f  "), (501, "\t x \r\n y"), (502, " ")]
    limits = packing.Limits(64, 3, 40)
    df = odd_documents(spark, rows).withColumn("prompt", F.when(F.col("doc_id") % 2 == 0, F.lit("Say this: ")))
    got = packing.pack_examples(df, path, prompt="prompt", limits=limits, block=7).collect()
    docs = defaultdict(list)
    for r in got:
        docs[r["id"]].append(r)
    want = Counter()
    for d, t in rows:
        head = tok.encode("Say this: ", add_special_tokens=False).ids if d is not None and d % 2 == 0 else []
        want[(d, tuple(head + tok.encode(t or "", add_special_tokens=False).ids + [0]))] += 1
    ids = Counter(i for (d, seq), n in want.items() for i in [d] * n * len(seq))
    assert Counter(r["id"] for r in got for _ in range(r["length"])) == ids
    for (d, seq), n in want.items():
        if n == 1 and d not in (None, 5):
            pieces = sorted(docs[d], key=lambda r: r["start"])
            assert sum((list(np.frombuffer(r["ids"], "<u4")) for r in pieces), []) == list(seq)
            assert [r["start"] for r in pieces] == list(np.cumsum([0] + [r["length"] for r in pieces])[:-1])
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append(r)
    for s in seqs.values():
        s.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in s] == list(np.cumsum([0] + [r["length"] for r in s])[:-1])
        assert sum(r["length"] for r in s) <= 64 and len(s) <= 3 and sum(r["loss"] for r in s) <= 40
    assert packing.pack_examples(df.limit(0), path).count() == 0


def test_packing_wastes_little(spark, small_dir):
    got = queries.op5_packing(spark, small_dir).agg(F.sum("length").alias("n"), F.countDistinct("sequence_id").alias("s"))
    r = got.first()
    assert r["n"] / (1024 * r["s"]) > 0.97


def test_an_encoder_goes_when_the_worker_gets_other_work():
    path = queries.tokenizer_path()
    first = packing.encoder(path)
    common.let_go(packing.__name__)
    assert packing.encoder(path) is first
    common.tidy(lambda table: table)(None)                # a task of this module
    assert not common.kept(packing.__name__)
    assert packing.encoder(path).encode(["to be"]) == first.encode(["to be"])


# 6 archives


def test_archives_round_trip(spark, tmp_path):
    rows = [(3, "http://WWW.a.example:80/x?y#z", "same"), (1, "http://b.example/", "same"), (2, None, None),
            (4, "", ""), (None, "ftp://u@c.example", "same"), (5, "http://a.example/x?y", "é\r\n\r\nWARC/1.1\r\n"),
            (6, "line\nend", "x" * 100_000), (7, "http://a.example/x?y", "other"), (7, "http://a.example/x?y", "other")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "page_id long, url string, html string, type string")
    path = str(tmp_path / "w")
    warc.write_archives(df, path, records=2)
    index = warc.build_index(spark, path, lines=2)
    found = warc.lookup(spark, index, df, id="page_id").collect()

    def digest(t):
        return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()

    firsts = {"same": 1, "": 2}
    want = Counter((i, len((h or "").encode()), digest(h), "revisit" if firsts.get(h or "", i) != i else "response",
                    firsts[h or ""] if firsts.get(h or "", i) != i else None) for i, _, h in rows)
    assert Counter((r["id"], r["payload_bytes"], r["digest"], r["type"], r["refers_to"]) for r in found) == want
    by_url = warc.lookup(spark, index, df.where("page_id = 3"))
    assert sorted(r["id"] for r in by_url.collect()) == [3, 5, 7, 7]      # one key
    got = warc.read_records(spark, by_url.where("id = 5")).first()
    assert got["record"].startswith(b"WARC/1.1\r\n") and got["record"].endswith(rows[5][2].encode())
    nothing = str(tmp_path / "n")
    warc.write_archives(df.limit(0), nothing)
    assert warc.lookup(spark, warc.build_index(spark, nothing), df).count() == 0


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/a?b#c") == "com,example)/a?b"
    assert warc.url_key(None) == "" and warc.url_key("https://x.y") == "y,x)/"


# 7 decontamination


def test_overlaps_against_a_loop(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.choice((3, 9, 10, 14, 30)))) for i in range(25)] + [
        (50, None), (51, ""), (52, "ab"), (None, "zz yy xx"), (3, "repeated id with a few words of its own")]
    docs = odd_rows() + [(600, items[0][1]), (601, "start " + items[4][1].upper() + " end, ab."),
                         (602, "zz yy xx zz yy xx"), (603, " ".join(items[7][1].split()[-10:]))]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, items string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    pats = []
    for i, t in items:
        w = word.findall((t or "").translate(LOW))
        n = min(10, len(w))
        pats += [("" if i is None else str(i), w[k:k + n]) for k in range(len(w) - n + 1 if n else 0)]
    want = []
    for d, t in docs:
        w = word.findall((t or "").translate(LOW))
        hit, found = set(), set()
        for i, p in pats:
            for k in range(len(w) - len(p) + 1):
                if w[k:k + len(p)] == p:
                    hit.update(range(k, k + len(p)))
                    found.add(i)
        want.append((d, len(w), len(hit), tuple(sorted(found))))
    df = odd_documents(spark, docs)
    for size in (1 << 20, 200):   # one block, many blocks
        f = decontaminate.overlaps(df, bench, block_bytes=size)
        got = df.select("doc_id", f.alias("f")).collect()
        assert Counter((r["doc_id"], r["f"]["n_words"], r["f"]["n_hit"], tuple(r["f"]["items"])) for r in got) == \
            Counter(want)
    none = df.select(decontaminate.overlaps(df, bench.limit(0)).alias("f")).where("f.n_hit > 0").count()
    assert none == 0


# 8 embeddings


def test_graph_finds_crowds_and_loners():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(1500, 16)), rng.normal(size=16) + 0.05 * rng.normal(size=(400, 16))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    length = np.linalg.norm(x, axis=1)
    uid = np.arange(len(x))
    found, share, _, _ = embedding_dedup.search_block(x, length, uid, hnsw.Graph(x), x, length, uid, 0.95, 0.99)
    true = (x @ x.T) / np.outer(length, length) >= 0.95
    got = sum(len(f) for f in found)
    assert all(true[i, f].all() for i, f in enumerate(found)) and got >= 0.99 * true.sum() and share >= 0.99


def test_audit_counts_no_vector_with_itself():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 24))
    x[1500:1540] = x[:40] + 0.02 * rng.normal(size=(40, 24))          # few true pairs among many vectors
    x /= np.linalg.norm(x, axis=1)[:, None]
    length, uid = np.linalg.norm(x, axis=1), np.arange(len(x))
    graph = hnsw.Graph(x)
    found, share, seen, _ = embedding_dedup.search_block(x, length, uid, graph, x, length, uid, 0.95, 0.99)
    assert 64 <= seen <= 80
    assert sum(len(f) for f in found) == 3080 and share >= 0.99
    graph.links = [np.full_like(k, -1) for k in graph.links]           # nothing can be reached
    graph.back, graph.back_at = graph.back[:0], np.zeros(len(x) + 1, int)
    found, share, seen, beam = embedding_dedup.search_block(x, length, uid, graph, x, length, uid, 0.95, 0.99)
    assert share < 0.99 and beam == len(x) and sum(len(f) for f in found) == 3080


def test_links_of_odd_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (3, [1.0, 0.0], 0), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], None),
            (6, None, 0), (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [1.0, None], 0), (10, [inf, 1.0], 0),
            (11, [1.0], 0), (12, [], 0), (None, [1.0, 0.0], 0), (13, [0.0, 1.0], 0)]
    df = spark.createDataFrame([(*r, 3, 4) for r in rows],
                               "vec_id long, embedding array<double>, label int, uid int, shard int")
    out = embedding_dedup.link_embeddings(df, shard=2, block=2, audits=str(tmp_path / "audits"))
    assert spark.read.parquet(str(tmp_path / "audits")).where("recall < 0.99").count() == 0
    got = {r["id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out.collect()}
    assert got.pop(None) == (0, None, True)
    assert {k: got.pop(k) for k in (1, 2, 3)} == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False)}
    assert got == {k: (0, k, True) for k in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13)}
    assert embedding_dedup.link_embeddings(df.limit(0)).count() == 0
