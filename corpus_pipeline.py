"""From raw documents to clean, encoded ones: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and
returns a DataFrame that is written as Parquet and reread as the next one's
``docs``.  All but the last return the columns of ``documents``; further
columns of the input are kept as they are (the last stage's own replace them).

1. ``language``: documents without an identified language go (no letter, or
   no language that covers half of the letters).
2. ``near_duplicates``: of every class that links of Jaccard similarity 0.8 on
   word 5-grams connect, one row stays: that of the least doc_id, among rows of
   that id that of the least SHA-256 of the text, among rows with the same id and
   text that of the least hash of all columns.  Classes are told apart by rows,
   not by ids: texts that share an id and are no copies all stay.  Texts without
   words are in no class and stay.
3. ``decontaminate``: documents with a passage of a benchmark item go.
4. ``secrets``: findings are replaced by ``[SECRET]`` in the text, and n_chars
   is set again where the text changed; no document goes.
5. ``encode``: the SentencePiece ids and score of each text are added.

Null texts go in the first stage; later stages pass them on unchanged.  Documents
without id are in no class of the second stage and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.llm import decontaminate, language_id, ngram_join, secrets, sentencepiece_codec
from yoyflow.llm.common import table
from yoyflow.operators.joins import hashed_join
from yoyflow.session import cut_lineage, drop_path, new_stage

LEAST_LANGUAGE_SHARE = 0.5


def packed(docs: DataFrame) -> DataFrame:
    """The text and, whatever the names of its columns, the rest of the row as ``_doc``: each text is sent once."""
    return docs.select("text", F.struct(*(c for c in docs.columns if c != "text")).alias("_doc"))


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col("text") if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows outside the held-out third."""
    model = language_id.fit(docs.where(language_id.training_rows()))
    found = language_id.predict(packed(docs), model, keep=["_doc", "text"])
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE)
    return unpacked(found.where(known), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = F.sha2(F.col("text").cast("binary"), 256)
    classes = ngram_join.jaccard_join(docs.select("doc_id", "text", key.alias("_key")), keep=["_key"])
    classes = cut_lineage(classes.where("doc_id is not null").select("doc_id", "_key", "class_no"))
    alike = classes.where("class_no is not null").groupBy("class_no", "doc_id", "_key").agg(F.count("*").alias("_rows"))
    first = alike.groupBy("class_no").agg(F.min(F.struct("doc_id", "_key", "_rows")).alias("_first")).select("_first.*")
    # rows without words, all of them: by the same key, as equal texts agree on having words
    wordless = classes.where("class_no is null").groupBy("doc_id", "_key").agg(F.lit(1).cast("long").alias("_rows"))
    stay = cut_lineage(first.unionByName(wordless).select(F.col("doc_id").alias("_id"), F.col("_key").alias("_text_key"), "_rows"))
    rows = docs.where("doc_id is not null").select(F.struct("*").alias("_doc"), F.col("doc_id").alias("_id"), F.coalesce(key, F.lit("")).alias("_text_key"))
    kept = hashed_join(rows, stay.withColumn("_text_key", F.coalesce("_text_key", F.lit(""))), ["_id", "_text_key"], how="inner")
    once = kept.where("_rows > 1").groupBy("_id", "_text_key").agg(F.min_by("_doc", F.xxhash64("_doc")).alias("_doc"))
    return kept.where("_rows = 1").select("_doc.*").unionByName(once.select("_doc.*")).unionByName(docs.where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.search(packed(docs), table(spark, sf_dir, "benchmark"), keep=["_doc", "text"])
    return unpacked(found.where(~decontaminate.contaminated()), docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(packed(docs), secrets.fit(docs), changed="_changed")
    n_chars = F.when(F.col("_changed"), F.length("text").cast("long")).otherwise(F.col("_doc")["n_chars"])
    return unpacked(clean.withColumn("_doc", F.col("_doc").withField("n_chars", n_chars)), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sentencepiece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("secrets", without_secrets),
    ("encode", encoded),
]

# Language, links and pieces are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = new_stage(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # the stage after it is complete
            drop_path(spark, before)
        before = path
    return docs
