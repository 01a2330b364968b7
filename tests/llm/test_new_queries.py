"""Pieces, divergence and collocations against the library and against short brute-force programs."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import odd_documents, odd_rows, prose

from quarry.llm import collocations, divergence, pieces, queries

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
MARKED = ["", " ", "  ", " a", "a ", "a  b   c", "▁", "a▁b ▁▁c", "x\n\n  y\t", "é ﬁ １ \x00 漢字", "<s> </s> <0x41> <unk>",
          "a" * 3000, " " * 50 + "x", "漢" * 400, "　 x ​"]


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_model_path())


# 11 pieces


def test_pieces_equal_the_library(spark):
    sp = library()
    rows = odd_rows() + [(600 + i, t) for i, t in enumerate(MARKED)]
    df = odd_documents(spark, rows)
    done = pieces.round_trip(df, queries.piece_model_path())
    assert done.columns == ["id", "ids", "decoded"]
    want = Counter((d, tuple(sp.encode(t or "")), sp.decode(sp.encode(t or ""))) for d, t in rows)
    assert Counter((r["id"], tuple(r["ids"]), r["decoded"]) for r in done.collect()) == want
    apart = pieces.decode(pieces.encode(df, queries.piece_model_path()), queries.piece_model_path())
    assert Counter((r["id"], r["text"]) for r in apart.collect()) == Counter((d, x) for d, _, x in want.elements())
    assert pieces.round_trip(df.limit(0), queries.piece_model_path()).count() == 0


def test_pieces_of_any_ids_and_small_tables():
    sp, rng = library(), random.Random(3)
    p = pieces.Pieces(queries.piece_model_path(), entries=20)     # generations change all the time
    parts = ["a", "b", " ", "  ", "▁", "é", "\n", "the", "<s>", "漢", "\x00"]
    for _ in range(60):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(20)]
        got = p.encode([t.encode() for t in texts])
        assert got.to_pylist() == sp.encode(texts) and p.decode(got) == [sp.decode(x) for x in sp.encode(texts)]
        ids = [[rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(300) for _ in range(rng.randint(0, 9))]
               for _ in range(20)]
        assert p.decode(pa.array(ids, pa.list_(pa.int32()))) == [sp.decode(x) for x in ids]
    assert len(p.ids.young) <= 20 + 20 * 15
    with pytest.raises(ValueError):
        p.decode(pa.array([[32000]], pa.list_(pa.int32())))


def test_pieces_query_digests(spark, small_dir):
    sp = library()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    for r in queries.op11_pieces(spark, small_dir).collect():
        ids = sp.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


# 12 divergence


def brute_audit(rows, at_least, top):
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOW)))
             for lang, source, t in rows]
    docs, counts, whole = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, w in words:
        docs[lang].update(set(w))
        counts[(lang, source)].update(w)
        whole[lang].update(w)
    kept = {lang: sorted(w for w, n in c.items() if n >= at_least) for lang, c in docs.items()}

    def p(c, lang):
        v = kept[lang]
        n = sum(c[w] for w in v)
        return {w: 1 + 1_000_000_000 * (c[w] + 5) // (n + 5 * len(v)) for w in v}

    share = {g: p(c, g[0]) for g, c in counts.items()}
    out = set()
    for g in counts:
        q = p(whole[g[0]], g[0])
        pairs = [(sum(abs(share[g][w] - share[h][w]) for w in share[g]), h[1]) for h in counts if h[0] == g[0] and h != g]
        terms = [(share[g][w] - q[w], w) for w in q if counts[g][w] and share[g][w] > q[w]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            for i, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                out.add((*g, part, item, v, i))
    return out


@pytest.mark.parametrize("at_least,top,block", [(2, 50, 50_000), (3, 4, 7), (10**6, 50, 50_000)])
def test_audit_against_a_loop(spark, monkeypatch, at_least, top, block):
    monkeypatch.setattr(divergence, "BYTES", 2000)
    monkeypatch.setattr(divergence, "HELD", 300)
    rng = random.Random(at_least)
    rows = [(rng.choice(["en", "EN", None, "de"]), rng.choice(["a", "b", "ö", None, "a b"]), t) for _, t in odd_rows()]
    rows += [("fr", "only", "un deux un deux"), ("it", "x", None), ("it", "y", ""), ("en", "none", "123 .;"), ("en", "a", "x" * 70_000)]
    df = spark.createDataFrame([(7, "r", *r, 0.5) for r in rows], "place int, order string, lang string, source string, text string, c double")
    got = divergence.audit(df, at_least=at_least, top=top, block=block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = got.collect()
    assert len(found) == len(set(found)) and set(map(tuple, found)) == brute_audit(rows, at_least, top)
    assert divergence.audit(df.limit(0)).count() == 0


def test_shares_are_exact_beyond_64_bits():
    rng = random.Random(1)
    for _ in range(300):
        total = rng.randrange(1, 9 * 10**15)
        count = rng.randrange(0, total)
        assert divergence.share(np.array([count]), total)[0] == 1 + 1_000_000_000 * (count + 5) // total


def test_runs_are_columns():
    rng = np.random.default_rng(2)
    for n in (1, 2, 9, 40):
        a, b = rng.integers(0, 3, n), rng.integers(0, 3, n)
        ra, rb = (divergence.runs(np.flatnonzero(x), x[x > 0], n) for x in (a, b))
        for x, (start, value) in ((a, ra), (b, rb)):
            assert (np.repeat(value, np.diff(np.append(start, n))) == x).all() and (value[1:] != value[:-1]).all()
        assert divergence.difference(ra, rb, n) == np.abs(a - b).sum()


# 13 collocations


@pytest.mark.parametrize("room", [3, 20])
def test_border_keys_and_counts_in_one_number(room):
    rng = np.random.default_rng(room)
    parts, want = [], {}
    for _ in range(4):
        key, n = np.unique(rng.integers(0, 50, 300).astype(np.uint64) << np.uint64(30), return_counts=True)
        n[::7] += 100                                   # more than 3 bits hold
        for k, c in zip(key.tolist(), n.tolist()):
            want[k] = want.get(k, 0) + c
        parts.append(collocations._joined(key, n, room))
    key, n = collocations._counted(parts, room)
    assert dict(zip(key.tolist(), n.tolist())) == want and (np.diff(key.astype(np.int64)) > 0).all() and not parts
    assert [len(x) for x in collocations._counted([collocations._joined(key[:0], n[:0], room)], room)] == [0, 0]


def brute_phrases(rows, at_least, first, longest=4):
    f, n = defaultdict(Counter), Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (t or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = set()
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= at_least}
        rows_ = []
        for p, a in found.items():
            score, _, l, r = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                       for q, b in found.items()):
                rows_.append((score, a, " ".join(p), l, r))
        rows_.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out.update((lang, i, p, a, l, r, n[lang], s) for i, (s, a, p, l, r) in enumerate(rows_[:first], 1))
    return out


@pytest.mark.parametrize("at_least,sample,seed,block", [(3, 0.25, 1, 8 << 20), (3, 0.02, 2, 500), (8, 1.0, 3, 3000)])
def test_phrases_against_a_loop(spark, monkeypatch, at_least, sample, seed, block):
    monkeypatch.setattr(collocations, "BLOCK", block)
    rng = random.Random(seed)
    line = "The Quick brown fox, jumps over the lazy dog; the quick brown cat\tsits! a b a b a b a b"
    rows = [(rng.choice(["en", None, "de"]), t) for _, t in odd_rows(seed)]
    rows += [(rng.choice(["en", "und"]), " ".join(rng.choice([line, prose(rng, 6), "é ö ü", "aa aa aa aa"]) for _ in range(rng.randint(0, 8))))
             for _ in range(60)]
    rows += [("xx", "..  ,,\n\t ;"), ("en", "a b " * 4000)]
    df = spark.createDataFrame([(7, *r, "k") for r in rows], "n int, lang string, text string, phrase string")
    got = collocations.mine(df, at_least=at_least, first=40, sample=sample)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = got.collect()
    assert len(found) == len(set(found)) and set(map(tuple, found)) == brute_phrases(rows, at_least, 40)
    assert collocations.mine(df.limit(0)).count() == 0


def test_a_poor_sample_is_mended_by_a_further_pass(spark):
    rows = [("en", "one two three four five")] * 40 + [("en", prose(random.Random(i), 30)) for i in range(200)]
    df = spark.createDataFrame(rows, "lang string, text string")
    src = df.select("lang", "text")
    found, words, passes = collocations.Miner(spark, src, 30, 4, 0.0).mine()     # nothing is proposed
    assert passes == 2
    got = {r["phrase"]: r["n"] for r in found.where("m > 1").collect()}
    assert got == {p: 40 for p in ("one two", "two three", "three four", "four five", "one two three", "two three four",
                                   "three four five", "one two three four", "two three four five")}
    assert words.first()["n"] == 40 * 5 + 200 * 30
