"""The corpus operators as queries over the given tables, with SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covenant.llm import (
    ann,
    brown_lm,
    bwt_dedup,
    chat,
    decontaminate,
    langid,
    licenses,
    merkle,
    near_dup,
    packing,
    spelling,
    sql,
    substring,
    warc,
)
from covenant.llm.common import held_out, table
from covenant.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def vocabulary() -> str:
    """The public byte-level vocabulary installed beside the libraries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query(sql.SUBSTRINGS)
def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query(sql.NEAR_DUPLICATES)
def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(langid.learnable(docs))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)


@query(sql.CONTAMINATION)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query()
def op2_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = brown_lm.train(brown_lm.training_rows(docs))
    return brown_lm.score(docs, model).withColumn("held_out", held_out(F.col("doc_id"), 7, 2))


@query(sql.CHAT)
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = r"\### Assistant: </turn> ok"
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(control).alias("text"),
    )
    windows = chat.read_turns(chat.format_chat(given.union(own)))
    parts = windows.select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            chat.learned_text(windows).alias("learned"),
        ).alias("part"),
        F.size("turns").alias("n"),
        F.char_length("text").alias("chars"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").cast("bigint").alias("n_turns"),
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.sum("chars").cast("bigint").alias("formatted_chars"),
    )
    learned = F.array_join(F.transform("parts", lambda p: p["learned"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("parts", lambda p: p["turns"]), ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query(sql.ARCHIVES)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.read_pages(spark, path)
    return found.select(
        warc.page_of(F.col("id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


@query()
def op4_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bwt_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


@query(sql.MANIFEST)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.verify(table(spark, sf_dir, "documents"), tampered=third)


@query(sql.LICENCES)
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query(sql.VARIANTS)
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(table(spark, sf_dir, "documents"), drop_every=97)
    return found.select("word", "n", "n_near", "form", "form_n", "root")
