"""Each operator over its whole table, with the settings meant for production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm import part_codes, periodic_runs, winnowing
from logweir.llm.common import table, written
from logweir.llm.kneser_ney import classify
from logweir.llm.language_id import held_out, identify, learn_language_model
from logweir.llm.main_text import extract
from logweir.llm.mixing import mix, word_count
from logweir.llm.near_dup import near_duplicates
from logweir.llm.packing import default_tokenizer, pack
from logweir.llm.pii import replace_pii
from logweir.llm.prefix_forest import nearest
from logweir.llm.quality_rules import apply_rules
from logweir.llm.warc_zip import round_trip


def surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return replace_pii(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return apply_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = learn_language_model(docs)
    named = identify(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def warc(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "pages")).drop("url", "payload")


def mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sized = written(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    mixed, targets = mix(sized.withColumn("sources", F.array("source")))
    own = F.broadcast(targets.withColumnRenamed("source", "name"))
    out = mixed.join(own, F.col("source").eqNullSafe(F.col("name")), "left")
    return out.select("doc_id", "size", "source_size", "target", "taken")


def packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), default_tokenizer())


def html(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


def near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    return classify(table(spark, folder, "documents"), labels.where("quality = 1 and toxic = 0"))


def ann(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return part_codes.digest(*part_codes.part_codes(table(spark, folder, "embeddings")))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.digest(winnowing.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


def runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return periodic_runs.digest(periodic_runs.periodic_runs(docs, change=periodic_runs.repeat_end))


QUERIES = {
    "op1_surrogates": surrogates,
    "op2_quality_rules": quality_rules,
    "op3_language_id": language_id,
    "op4_warc": warc,
    "op5_mixing": mixing,
    "op6_packing": packing,
    "op7_html": html,
    "op8_near_dup": near_dup,
    "op9_kneser_ney": kneser_ney,
    "op10_ann": ann,
    "op11_part_codes": vector_codes,
    "op12_decontamination": decontamination,
    "op13_periodic_runs": runs,
}

# Trees, forests, flows, tokenizers, signatures and runs are nothing that SQL can say.
SQL: dict[str, str] = {
    # Records as they come back from the archives; how they are stored is a matter of tests.
    "op4_warc": """
        with payloads as (
            select page_id, coalesce(html, '') as payload, octet_length(encode(coalesce(html, ''))) as n from pages
        ), firsts as (
            select *, case when n >= 100 then min(page_id) over (partition by payload) else page_id end as first from payloads
        )
        select page_id, cast(n as bigint) as payload_bytes, sha256(payload) as payload_digest,
            case when page_id = first then 'response' else 'revisit' end as record_type,
            case when page_id <> first then first end as refers_to
        from firsts""",
    "op11_part_codes": part_codes.SQL,
    "op12_decontamination": winnowing.SQL,
}
