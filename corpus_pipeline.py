"""A corpus pipeline over ``documents``.

Each stage is written as Parquet and read again as the next one's input, and
works on all that its predecessor kept.  All but the last return the columns of
their input.  For near duplicates a document is its id and its text: rows that
repeat an id with other texts are compared as documents of their own, rows
without an id come after all others, and of rows equal in both the least one
by the other columns stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import byte_bpe, common, decontaminate, language_id, minhash_forest, pii


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go."""
    common.small_batches(spark)
    model = language_id.train(docs)
    names = tuple(common.free_name(docs, n) for n in ("lang_found", "lang_score", "lang_rejected"))
    return language_id.identify(common.spread(docs), model, out=names).where(f"NOT {names[2]}").select(*docs.columns)


def document_key() -> Column:
    """A number for an id and a text that orders by id, then by the text's hash;
    rows without an id come last."""
    number = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(2**63)).cast("decimal(20,0)"))
    return (number * F.lit(str(2**60)).cast("decimal(19,0)") + F.shiftrightunsigned(F.xxhash64("text"), 4)).cast("decimal(38,0)")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the document of
    the smallest id stays."""
    common.small_batches(spark)
    key = common.free_name(docs, "document_key")
    keyed = docs.withColumn(key, document_key())
    groups = minhash_forest.near_duplicates(common.spread(keyed.select(key, "text")), key)
    kept = groups.where("kept").select(key).distinct()
    # One row per key: the join has dealt the rows by key already.
    named = keyed.join(kept, key, "left_semi").groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return named.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    common.small_batches(spark)
    names = (common.free_name(docs, "leak"), common.free_name(docs, "leak_items"))
    found = decontaminate.find_leaks(common.spread(docs), common.table(spark, sf_dir, "benchmark"), out=names, short=True)
    return found.where(f"NOT {names[0]}").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; ``n_chars`` follows."""
    before = common.free_name(docs, "text_before")
    out = pii.redact(docs.withColumn(before, F.col("text")))
    if "n_chars" in docs.columns:
        same = F.col("text").eqNullSafe(F.col(before))
        out = out.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether they decode to it; one stage."""
    common.small_batches(spark)
    vocab = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.round_trip(common.spread(docs.select("doc_id", "text", "lang", "source")), vocab, public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decodes")


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("benchmark leaks", benchmark_leaks),
    ("personal data", personal_data),
    ("token ids", token_ids),
]

#: SQL can't express the learned and hashed stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
