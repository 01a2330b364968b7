"""The registered queries of this subpackage: thin projections of the operators' results over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.llm import (class_lm, collocations, decontaminate, divergence, embedding_dedup, minhash, ordinal, packing,
                        pieces, sharding, suffix_dedup, toxicity, warc)
from quarry.llm.common import read
from quarry.session import scratch_path


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_packing(spark, sf_dir):
    """All documents packed into sequences of at most 1024 ids, 128 segments and 1024 loss-bearing ids."""
    pieces = packing.pack_examples(read(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         F.col("total").alias("doc_tokens"), "sequence_id", "offset", "segment", "loss")


def op7_decontamination(spark, sf_dir):
    """Every document against every window of 10 words of the benchmark."""
    docs = read(spark, sf_dir, "documents")
    found = decontaminate.overlaps(docs, read(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", found.alias("f")).select(
        "doc_id", "f.n_words", "f.n_hit", F.size("f.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "f.items"), 256).alias("items_sha256"), (F.col("f.n_hit") > 0).alias("contaminated"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP7_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS m, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS p
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (
  SELECT doc_id, i, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS p
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
occ AS (SELECT doc_id, i, dw.m, item FROM dw JOIN win ON dw.p = win.p AND dw.m = win.m),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""


def op1_sharding(spark, sf_dir):
    """All documents in 16 shards whose numbers of rows differ by at most one (law ``rows``)."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    bytes_ = F.coalesce(F.octet_length("text"), F.lit(0))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return sharding.shuffle_to_shards(docs, 16).select(
        "doc_id", (bytes_ + 1).cast("long").alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_suffix_dedup(spark, sf_dir):
    """Every document without the bytes of its 50-byte strings that start in an earlier document too."""
    done = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
w AS (SELECT doc_id, i, substr(hx, 2 * i + 1, 100) AS s
      FROM (SELECT doc_id, hx, unnest(range(0, len(hx) // 2 - 49)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
hit AS (SELECT DISTINCT doc_id, i FROM w JOIN f USING (s) WHERE m < doc_id),
run AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g
        FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END
              AS new FROM hit)),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY doc_id, g),
gap AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
          string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
        FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, len(hx) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(hx, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""


def op6_warc(spark, sf_dir):
    """All pages written as WARC records, read back and indexed, each looked up by its URL and id."""
    pages = read(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path)
    found = warc.lookup(spark, warc.build_index(spark, path), pages, id="page_id")
    return found.select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                        F.col("type").alias("record_type"), "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(encode(coalesce(html, ''))) AS x FROM pages),
f AS (SELECT x, min(page_id) AS first FROM p GROUP BY x)
SELECT page_id, octet_length(encode(h)) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(p.x, 10 * (i // 8) + 1, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (x)"""


def op4_near_dedup(spark, sf_dir):
    """Near-duplicate groups of all documents, copies counted once; the smallest doc_id of a group is kept."""
    found = minhash.near_duplicates(read(spark, sf_dir, "documents"), copies_once=True)
    return found.select(F.col("id").alias("doc_id"), "class_id", "group_id",
                        (F.col("key") == F.col("group_id")).alias("kept"))


def _graded(spark, sf_dir):
    """The ratings as grades: 0 poor, 1 good but toxic, 2 good."""
    labels = read(spark, sf_dir, "labels")
    good = F.col("quality") == 1
    return labels.select("doc_id", F.when(~good, 0).when(good & (F.col("toxic") == 1), 1).when(good, 2).alias("grade"))


def op9_quality(spark, sf_dir):
    """Expected grade of every document and its probability of grade 1 or more, by which it is selected."""
    found = ordinal.rate(read(spark, sf_dir, "documents"), _graded(spark, sf_dir), grades=3)
    return found.withColumnRenamed("id", "doc_id")


def toxic_categories():
    """The chain: toxic and poor, toxic in a text that is good otherwise, then toxic of any kind. The two ratings of
    ``labels`` tell these apart; an unknown quality leaves the first two unknown, so such labels are not used."""
    toxic, poor = F.col("toxic") == 1, F.col("quality") == 0
    return {"toxic_poor": toxic & poor, "toxic_good": toxic & ~poor, "toxic": toxic}


TOXIC_AT = 0.3               # a missed toxic document costs more than a lost clean one


def toxic_probabilities(docs, spark, sf_dir, source=None):
    """The chain's probabilities over ``docs``, learnt from all given documents that have labels."""
    source = read(spark, sf_dir, "documents") if source is None else source
    model_input = source.select("doc_id", "text")
    return toxicity.chain_probabilities(model_input, read(spark, sf_dir, "labels"), toxic_categories())


def op10_toxicity(spark, sf_dir):
    """Probabilities of toxicity, by kind and of any kind, of every document."""
    docs = read(spark, sf_dir, "documents")
    p = toxic_probabilities(docs, spark, sf_dir)
    return docs.select("doc_id", p.alias("p")).select(
        "doc_id", *[F.col("p")[i].alias(f"p_{n}") for i, n in enumerate(toxic_categories())]).withColumn(
        "toxic", F.col("p_toxic") >= TOXIC_AT)


def op2_class_lm(spark, sf_dir):
    """Log10 probability of every document by the class model and by the unigram base."""
    docs = read(spark, sf_dir, "documents")
    return class_lm.score_texts(docs, class_lm.held_out("doc_id")).withColumnRenamed("id", "doc_id")


def op8_embedding_dedup(spark, sf_dir):
    """Links of cosine 0.98 or more between all embeddings of the same label, and their components."""
    return embedding_dedup.link_embeddings(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


OP8_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL
  AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN comp ON comp.a = vec_id LEFT JOIN deg ON deg.a = vec_id"""


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_pieces(spark, sf_dir):
    """Ids of every document by the piece model, and what they decode to."""
    done = pieces.round_trip(read(spark, sf_dir, "documents"), piece_model_path())
    return done.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_divergence(spark, sf_dir):
    """Every source of every language against the others, and the terms that mark it."""
    return divergence.audit(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT i, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (n + 5 * v) AS p
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) JOIN n USING (lang, source) LEFT JOIN c USING (lang, source, term)),
ln AS (SELECT lang, sum(c) AS n FROM c GROUP BY lang),
lc AS (SELECT lang, term, sum(c) AS c FROM c GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (lc.c + 5)) // (ln.n + 5 * v) AS q
  FROM lc JOIN ln USING (lang) JOIN v USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM k
WHERE part = 'pair' OR rank <= 50"""


def op13_collocations(spark, sf_dir):
    """The strongest phrases of every language."""
    return collocations.mine(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?
-
]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM d),
f AS (SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
  GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
cut AS (SELECT lang, m, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS x,
    array_to_string(list_slice(w, k + 1, m), ' ') AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
sc AS (SELECT cut.*, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score FROM cut
  JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sub AS (SELECT lang, array_to_string(list_slice(w, i, i + z - 1), ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, m - z + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS z) WHERE z < m) GROUP BY ALL),
o AS (SELECT low.lang, low.phrase, a, l, r, n, score, row_number() OVER (
    PARTITION BY low.lang ORDER BY score DESC, a DESC, encode(low.phrase)) AS rank
  FROM low JOIN n USING (lang) LEFT JOIN sub ON sub.lang = low.lang AND sub.phrase = low.phrase
  WHERE most IS NULL OR 100 * most < 80 * a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 2000"""



QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_class_lm": op2_class_lm,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_near_dedup": op4_near_dedup,
    "op5_packing": op5_packing,
    "op6_warc": op6_warc,
    "op7_decontamination": op7_decontamination,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_pieces": op11_pieces,
    "op12_divergence": op12_divergence,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {
    "op3_suffix_dedup": OP3_SQL,
    "op6_warc": OP6_SQL,
    "op7_decontamination": OP7_SQL,
    "op8_embedding_dedup": OP8_SQL,
    "op12_divergence": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
