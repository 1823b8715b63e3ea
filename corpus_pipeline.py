"""From raw documents to packed sequences: five stages, each written as Parquet and read by the next.

Language ID drops what has no language, the n-gram Jaccard join keeps one document of each group,
decontamination drops documents that hold a benchmark item, the secret scan blanks what it finds, and
packing cuts the rest into sequences. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, queries, secrets
from tidemark.llm.decontam import find_leaks
from tidemark.llm.packing import pack_documents
from tidemark.llm.setjoin import jaccard_components
from tidemark.session import run_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without any letter go, null and empty ones too. Learned from the
    labelled rows that aren't held out. Rows without a label get the predicted one, or stay as they are when no
    row is labelled; other rows stay as they are, repeated ones and ambiguous ones too."""
    model = langid.fit(docs.where(~F.coalesce(queries.held_out(), F.lit(False))))
    lettered = docs.where(F.regexp_like("text", F.lit(langid.LETTER)))  # all others are rejected by prediction
    judged = langid.predict(lettered.withColumns({f"_{c}": F.col(c) for c in docs.columns}), model)
    named = F.when(F.col("lang_pred") != langid.UNKNOWN, F.col("lang_pred"))
    return judged.withColumn("_lang", F.coalesce("_lang", named)).select(*(F.col(f"_{c}").alias(c) for c in docs.columns))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Of rows that share id and
    text the one whose other columns come first (null before all) stays. Different texts that share an id are
    judged apart. Rows with a null id can't be told apart and stay."""
    named = docs.where(F.col("doc_id").isNotNull()).withColumn("_key", F.xxhash64("doc_id", "text"))
    groups = jaccard_components(named, id_col="_key").select(F.col("doc_id").alias("_key"), "component_id")
    ids = named.select("_key", "doc_id").distinct()
    first = groups.join(ids, "_key").groupBy("component_id").agg(F.min(F.struct("doc_id", "_key")).alias("first"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = named.join(first.select("first._key"), "_key", "left_semi").groupBy("_key").agg(F.min(F.struct(*others, "doc_id", "text")).alias("row"))
    return kept.select("row.*").select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Each text is judged by itself, whatever its id, as ids may lack
    or be shared."""
    keyed = docs.withColumn("_key", F.sha2(F.col("text"), 256))
    leaks = find_leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="_key")
    found = leaks.select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(found, "_key", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, what is secret in them replaced by a mark, with n_chars to match."""
    scanned = secrets.scan_secrets(docs.select(*docs.columns), secrets.fit(docs))
    found = F.col("redacted").isNotNull()
    return scanned.withColumns({
        "n_chars": F.when(found, F.char_length("redacted").cast("long")).otherwise(F.col("n_chars")),
        "text": F.when(found, F.col("redacted")).otherwise(F.col("text")),
    }).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as sequences of token ids of power-of-two length."""
    return pack_documents(docs, public_tokenizers.path(queries.TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of all documents of `sf_dir`."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), run_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
