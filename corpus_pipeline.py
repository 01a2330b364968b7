"""From raw documents to packed training sequences, one operator after the other.

``STAGES`` names the stages in order. Each takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes
as Parquet and reads again as the next stage's ``docs``; all but the last return the columns of ``documents``. A stage
works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, minhash, packing, suffix_dedup
from quarry.llm.common import prepare, read
from quarry.llm.queries import TOXIC_AT, tokenizer_path, toxic_probabilities
from quarry.session import scratch_path

ORACLE_SQL = None  # classifiers, weighted samples and subword ids are not SQL


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier chain finds toxic. It learns from the labels of these documents. A null
    or empty text is scored like any other; repeated rows fare alike; without usable labels, or documents, all stay."""
    p = toxic_probabilities(docs, spark, sf_dir, source=docs)
    return docs.where(F.element_at(p, -1) < TOXIC_AT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id. Of rows that share an id, one. Null
    and empty texts are alone in their groups and stay; a null id counts as larger than any other."""
    prepare(spark)
    found = minhash.near_duplicates(docs, copies_once=True)
    rows = found.groupBy("key", "group_id").agg(F.count("*").alias("n"))
    # what does not simply stay, written so that its size is known: the texts are shuffled only if it is large
    path = scratch_path(spark, "decided")
    rows.where("key <> group_id or n > 1").select("key", (F.col("key") == F.col("group_id")).alias("one")) \
        .coalesce(64).write.parquet(path)
    decided = spark.read.schema("key long, one boolean").parquet(path)
    # the row as one column, so that no name of its own can clash
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), minhash.document_key(docs).alias("key"))
    stay = keyed.join(decided, "key", "left_anti")
    again = keyed.join(decided.where("one"), "key", "left_semi").dropDuplicates(["key"])
    return stay.union(again).select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings of earlier documents; characters that a cut runs through go whole, and
    documents of which nothing is left go, too."""
    prepare(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    safe = {c: f"__{i}" for i, c in enumerate(others)}   # whatever they are called, they cannot clash
    done = suffix_dedup.remove_repeats(docs.select("doc_id", "text", *[docs[f"`{c}`"].alias(n) for c, n in safe.items()]),
                                       carry=tuple(safe.values()), characters=True)
    cut = F.col("n_removed") > 0
    out = done.withColumn("__text", F.col("kept").cast("string")).where(~cut | (F.col("__text") != ""))

    def column(c: str):
        if c == "doc_id":
            return F.col("id")
        if c == "text":
            return F.col("__text")
        if c == "n_chars":
            return F.when(cut, F.length("__text").cast("long")).otherwise(F.col(safe[c]))
        return F.col(safe[c])

    return out.select(*[column(c).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item. Null and empty texts hold none and stay, as do all
    documents if the benchmark is empty; repeated rows fare alike."""
    found = decontaminate.overlaps(docs, read(spark, sf_dir, "benchmark"))
    return docs.where(found["n_hit"] == 0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in sequences of at most 1024, one row per piece. A null or empty text is the closing id alone;
    rows that share an id, or have none, are packed one by one."""
    prepare(spark)
    return packing.pack_examples(docs, tokenizer_path()).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        F.col("total").alias("doc_tokens"), "sequence_id", "offset", "ids")


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("suffix_dedup", cut_repeats),
          ("decontamination", drop_contaminated), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
