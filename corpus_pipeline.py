"""From raw documents to packed token sequences: language, near copies, personal data, mix, packing.

Every stage takes all that the one before it kept. Rows with a null id stay in
each filtering stage as far as its operator says nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm.common import table, written
from logweir.llm.language_id import UNKNOWN, identify, learn_language_model
from logweir.llm.mixing import mix, word_count
from logweir.llm.near_dup import near_duplicates
from logweir.llm.packing import default_tokenizer, pack
from logweir.llm.pii import replace_pii

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text with less than this share of its words in one language is in none.
LEAST_SCORE = 0.3
# Bytes of rows that a task hands to Python at once. Both sides hold a batch, and more than once while it grows or is read.
BATCH_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands rows to Python in batches of ``BATCH_BYTES``, whatever it did before."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language go; the others get the language found as ``lang``."""
    small_batches(spark)
    named = identify(docs.select(*COLUMNS), learn_language_model(docs))
    kept = named.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the one with the smallest id."""
    small_batches(spark)
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    docs = docs.select(*COLUMNS)
    once = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(docs.where("doc_id is null"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates in place of personal data; ``n_chars`` counts anew."""
    small_batches(spark)
    clean = replace_pii(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    sized = docs.select(*COLUMNS).withColumn("size", word_count()).withColumn("sources", F.array("source"))
    mixed, _ = mix(sized)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mixed.where("copies > 0").withColumn("copy", again).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack(docs, default_tokenizer())


STAGES = [
    ("language ID", language),
    ("near copies", near_copies),
    ("personal data", personal_data),
    ("mixture", mixture),
    ("packing", packed),
]

# Models, signatures and tokenizers cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
