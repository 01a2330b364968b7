"""Text queries over ``documents`` (1,000 docs at sf0.01, four languages, up to 20,000
words), ``pages`` and ``part``; every query reads whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import text as T
from quarry.operators import sampling as X
from quarry.plans.sample_jobs import md5_rank, quota_sql
from quarry.plans.tables import table, text_table
from quarry.session import cut_lineage

MAX_FEATURES = 5000     # the reference's vocabulary size (uni- and bigrams)
TOP_TERMS = 50
CLASS_TOP = 20


def r6(c):
    return F.round(c, 6)


def _docs(spark, sf_dir):
    return text_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")


def _clean_docs(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", "lang", tx.clean_tokens("text").alias("tokens"))


def q_clean_text(spark, sf_dir):
    d = _clean_docs(spark, sf_dir)
    return d.select("doc_id", F.array_join("tokens", " ").alias("clean"), F.size("tokens").alias("n_tokens"))


def q_strip_links(spark, sf_dir):
    pages = text_table(spark, sf_dir, "pages")
    raw = F.concat(F.lit("see "), F.col("url"), F.lit(" or www.example.com/p?id=1 and @team_"),
                   F.col("page_id").cast("string"), F.lit(" now"))
    return pages.select("page_id", tx.strip_mentions(tx.strip_links(raw)).alias("stripped"))


def q_bigrams(spark, sf_dir):
    d = _clean_docs(spark, sf_dir).select("doc_id", "tokens", tx.bigrams("tokens").alias("bi"))
    return d.select("doc_id", F.size("tokens").alias("n_tokens"), F.size("bi").alias("n_bigrams"),
                    F.array_join("bi", "|").alias("bigrams"))


def _tfidf(spark, sf_dir):
    d = _clean_docs(spark, sf_dir)
    return T.tfidf(d, "doc_id", tx.with_bigrams("tokens"), MAX_FEATURES)


def q_vocabulary_top(spark, sf_dir):
    d = _clean_docs(spark, sf_dir)
    tf = T.term_counts(d, "doc_id", tx.with_bigrams("tokens"))
    return T.vocabulary(tf, "doc_id", TOP_TERMS)


def q_tfidf_long(spark, sf_dir):
    w = _tfidf(spark, sf_dir)
    return w.select("doc_id", "term", "tf", "df", r6("idf").alias("idf"), r6("weight").alias("weight"))


def q_tfidf_train_only(spark, sf_dir):
    """T14 as the sentiment jobs use it: vocabulary and idf of the training part, weights of the test part."""
    split = X.stratified_split(_clean_docs(spark, sf_dir), "lang", ["doc_id"], 0.2, 42)
    split = cut_lineage(split.select("doc_id", "split", tx.with_bigrams("tokens").alias("grams")))
    w = T.tfidf(split.where("split = 'test'"), "doc_id", F.col("grams"), MAX_FEATURES,
                fit_on=split.where("split = 'train'"))
    return w.select("doc_id", "term", "tf", "df", r6("idf").alias("idf"), r6("weight").alias("weight"))


def q_word_tokens(spark, sf_dir):
    """Word tokens by the default pattern (2+ characters) and by the one of the fused job (1+), in order."""
    d = _docs(spark, sf_dir)
    two, one = tx.word_tokens("text"), tx.word_tokens("text", tx.TOKEN_1PLUS)
    return d.select("doc_id", F.array_join(two, " ").alias("two_plus"), F.size(one).alias("n_one_plus"))


def q_tfidf_shape(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    n_docs = docs.count()
    w = _tfidf(spark, sf_dir)
    return w.agg(F.lit(n_docs).cast("bigint").alias("docs"), F.countDistinct("term").alias("terms"))


def q_class_terms_top(spark, sf_dir):
    return T.class_terms(_docs(spark, sf_dir), "lang", "text", CLASS_TOP).select(
        "lang", F.col("rank").cast("int").alias("rank"), "term", "count")


def q_concat_text(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.expr("CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_type END").alias("t2"),
        F.expr("CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name END").alias("evo"))
    filled = part.na.fill({"t2": "", "evo": ""})
    return filled.select("p_partkey", tx.concat_space("t2", "evo").alias("text_doc"))


def q_stemmed_terms(spark, sf_dir):
    d = _clean_docs(spark, sf_dir)
    toks = d.select(F.explode("tokens").alias("token"))
    return T.stem_vocabulary(toks, "token")


QUERIES = {
    "clean_text": q_clean_text,
    "strip_links": q_strip_links,
    "bigrams": q_bigrams,
    "vocabulary_top": q_vocabulary_top,
    "tfidf_long": q_tfidf_long,
    "tfidf_train_only": q_tfidf_train_only,
    "word_tokens": q_word_tokens,
    "tfidf_shape": q_tfidf_shape,
    "class_terms_top": q_class_terms_top,
    "concat_text": q_concat_text,
    "stemmed_terms": q_stemmed_terms,
}


# ---------------------------------------------------------------------------------------------------------
# DuckDB oracle SQL (RE2 patterns spelled with the same explicit classes)

_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(tx.ENGLISH_STOP_WORDS))) + "]"

CLEAN_CTE = f"""clean AS (
    SELECT doc_id, lang, list_filter(
        list_filter(regexp_split_to_array(lower(
            regexp_replace(regexp_replace(regexp_replace(text, '@[\\p{{L}}\\p{{N}}_]+', '', 'g'),
                                          'http[^\\s\\p{{Z}}]+|www[^\\s\\p{{Z}}]+', '', 'g'),
                           '[^a-zA-Z\\s\\p{{Z}}]', '', 'g')), '[\\s\\p{{Z}}]+'), lambda x: x <> ''),
        lambda x: length(x) >= 3 AND NOT list_contains({_STOP}, x)) AS tokens
    FROM documents)"""

GRAMS_CTE = """grams AS (
    SELECT doc_id, tokens || list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]) AS g
    FROM clean),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(g) AS term FROM grams) GROUP BY ALL),
    vocab_all AS (SELECT term, sum(tf) AS corpus_tf, count(*) AS df FROM tf GROUP BY term)"""

TFIDF_CTE = f"""vocab AS (SELECT * FROM vocab_all ORDER BY corpus_tf DESC, term LIMIT {MAX_FEATURES}),
    w AS (SELECT t.doc_id, t.term, t.tf, v.df,
                 ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + v.df)) + 1.0 AS idf FROM tf t JOIN vocab v USING (term)),
    wn AS (SELECT *, tf * idf AS x FROM w)"""

SQL = {
    "clean_text": f"""WITH {CLEAN_CTE}
    SELECT doc_id, array_to_string(tokens, ' ') AS clean, CAST(len(tokens) AS INTEGER) AS n_tokens FROM clean""",
    "strip_links": """
    SELECT page_id, regexp_replace(regexp_replace(
        'see ' || url || ' or www.example.com/p?id=1 and @team_' || CAST(page_id AS VARCHAR) || ' now',
        'http[^\\s\\p{Z}]+|www[^\\s\\p{Z}]+', '', 'g'), '@[\\p{L}\\p{N}_]+', '', 'g') AS stripped FROM pages""",
    "bigrams": f"""WITH {CLEAN_CTE},
    b AS (SELECT doc_id, tokens, list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]) AS bi
          FROM clean)
    SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, CAST(len(bi) AS INTEGER) AS n_bigrams,
           array_to_string(bi, '|') AS bigrams FROM b""",
    "vocabulary_top": f"""WITH {CLEAN_CTE}, {GRAMS_CTE}
    SELECT term, CAST(corpus_tf AS BIGINT) AS corpus_tf, df FROM vocab_all ORDER BY corpus_tf DESC, term LIMIT {TOP_TERMS}""",
    "tfidf_long": f"""WITH {CLEAN_CTE}, {GRAMS_CTE}, {TFIDF_CTE}
    SELECT doc_id, term, tf, df, round(idf, 6) AS idf,
           round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS weight FROM wn""",
    "word_tokens": """SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'), ' ') AS two_plus,
      CAST(len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS INTEGER) AS n_one_plus FROM documents""",
    "tfidf_train_only": f"""WITH {CLEAN_CTE}, {quota_sql('clean', 'lang')},
    r AS (SELECT doc_id, lang, {md5_rank('doc_id', 'lang')} AS rk FROM clean),
    part AS (SELECT r.doc_id, r.rk <= q.quota AS test FROM r JOIN quota q ON r.lang = q.lang),
    grams AS (SELECT doc_id, test,
        tokens || list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]) AS g
        FROM clean JOIN part USING (doc_id)),
    tf AS (SELECT doc_id, test, term, count(*) AS tf FROM (SELECT doc_id, test, unnest(g) AS term FROM grams) GROUP BY ALL),
    vocab AS (SELECT term, sum(tf) AS corpus_tf, count(*) AS df FROM tf WHERE NOT test GROUP BY term
              ORDER BY corpus_tf DESC, term LIMIT {MAX_FEATURES}),
    w AS (SELECT t.doc_id, t.term, t.tf, v.df,
            ln((1.0 + (SELECT count(*) FROM part WHERE NOT test)) / (1.0 + v.df)) + 1.0 AS idf
          FROM tf t JOIN vocab v USING (term) WHERE t.test),
    wn AS (SELECT *, tf * idf AS x FROM w)
    SELECT doc_id, term, tf, df, round(idf, 6) AS idf,
           round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS weight FROM wn""",
    "tfidf_shape": f"""WITH {CLEAN_CTE}, {GRAMS_CTE}, {TFIDF_CTE}
    SELECT (SELECT count(*) FROM documents) AS docs, count(DISTINCT term) AS terms FROM wn""",
    "class_terms_top": f"""WITH words AS (
        SELECT lang, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_][\\p{{L}}\\p{{N}}_'']+')) AS term
        FROM documents WHERE lang IS NOT NULL),
    counts AS (SELECT lang, term, count(*) AS count FROM words WHERE NOT list_contains({_STOP}, term) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY count DESC, term) AS rank FROM counts)
    SELECT lang, CAST(rank AS INTEGER) AS rank, term, count FROM ranked WHERE rank <= {CLASS_TOP}""",
    "concat_text": """
    SELECT p_partkey, coalesce(CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_type END, '') || ' ' ||
                      coalesce(CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name END, '') AS text_doc FROM part""",
}
