"""A training corpus from ``documents``: language, quality, near copies, personal data, packing.

Each stage takes the documents its predecessor kept, and all but the last return the columns of documents, whatever further columns
there are and whatever their names. ``run`` writes each stage's rows to the shared folder and reads them back for the next.
An empty table passes all stages empty; texts of any length are taken whole.
"""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm import language_id, ngram_join, packing, pii, quality_model, storage

#: Documents whose language is surer than this stay; so do those of every quality score from this on.
MIN_LANGUAGE, MIN_QUALITY = 0.5, 0.3


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, null texts, and those of no clear language go. Repeated rows share their fate."""
    storage.small_batches(spark)
    name = storage.free_name(docs, "_language")
    found = language_id.identify(docs, language_id.fit(docs, F.lit(True)), name)
    return found.where((F.col(name)["lang_pred"] != "und") & (F.col(name)["score"] >= MIN_LANGUAGE)).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality go. The classifier learns from the labels of the documents that are left; without any, all stay."""
    storage.small_batches(spark)
    model = quality_model.fit(docs, storage.table(spark, sf_dir, "labels"), F.lit(True))
    name = storage.free_name(docs, "_quality")
    return quality_model.score_quality(docs, model, name).where(F.col(name) >= MIN_QUALITY).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five words, similarity 0.8) the document with the least id stays, once.

    Rows that share a doc_id but not the text are documents of their own, and so are those without one: they come after all others,
    by doc_id and text. A null or empty text has no copies; repeated rows are copies.
    """
    storage.small_batches(spark)
    id_, text, sid, key = F.col("doc_id").cast("long"), F.col("text").cast("string"), storage.free_name(docs, "_sid"), storage.free_name(docs, "_key")
    docs = docs.withColumn(sid, id_).withColumn(key, F.xxhash64(text))
    shared = docs.groupBy(sid).agg(F.count("*").alias("n")).where(f"n > 1 OR {sid} IS NULL").select(F.col(sid).alias("shared"))
    shared = storage.stored(shared, "shared-ids")
    odd = not shared.isEmpty()
    if odd:
        apart = F.col(sid).eqNullSafe(F.col("shared"))
        odd_rows = docs.join(shared, apart, "left_semi")
        top = (docs.agg(F.max(sid)).first()[0] or 0) + 1
        order = [F.col(sid).asc_nulls_last(), F.col(key)]
        places = storage.numbered(odd_rows.select(sid, key).distinct(), order, "place").select(F.col(sid).alias("_id"), F.col(key).alias("_text"), (F.col("place") + top).alias("_place"))
        places = storage.stored(places, "shared-places")
        same = F.col(sid).eqNullSafe(F.col("_id")) & F.col(key).eqNullSafe(F.col("_text"))
        odd_rows = odd_rows.join(places, same).withColumn(sid, F.col("_place")).drop("_id", "_text", "_place")
        docs = storage.stored(docs.join(shared, apart, "left_anti").unionByName(odd_rows), "near-copies-rows")
    found = ngram_join.ngram_components(docs.select(F.col(sid).alias("doc_id"), text.alias("text")), n=5, threshold=Fraction(4, 5))
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(sid)).distinct()
    docs = docs.join(kept, sid, "left_semi")
    if odd:  # Spark limits the copies of a row in each task before they meet
        docs = docs.withColumn(key, F.row_number().over(Window.partitionBy(sid).orderBy(sid))).where(F.col(key) == 1)
    return docs.drop(sid, key)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind; ``n_chars`` follows. All documents stay."""
    storage.small_batches(spark)
    name = storage.free_name(docs, "_redacted")
    found = pii.without_spans(docs, pii.fit(docs), name)
    changed, text = F.col(name)["spans"] > 0, F.col(name)["text"]
    size = F.length(text).cast(docs.schema["n_chars"].dataType)
    found = found.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return found.withColumn("text", F.when(changed, text).otherwise(F.col("text"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, with their ids. A null or empty text is an end token."""
    storage.small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("languages", languages), ("quality", quality), ("near_copies", near_copies), ("personal_data", personal_data), ("packed", packed)]

#: The stages learn models and use a tokenizer, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = storage.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = storage.stored(stage(spark, rows, sf_dir), name)
    return rows
