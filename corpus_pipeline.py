"""Corpus cleaning as a run of stages, each of which writes its documents for the next one.

Every stage but the last returns the columns of the documents it is given. Rows keep their texts unless words are cut out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covenant.llm import decontaminate, langid, near_dup, packing, substring
from covenant.llm.common import drop_rows, row_key, table
from covenant.llm.queries import vocabulary
from covenant.session import scratch_path, written

#: Language predictions below this are rejected: no learned language fits.
LEAST_SCORE = 0.2


def _apart(docs: DataFrame, *names: str) -> tuple[DataFrame, list]:
    """``docs`` with own columns of these names out of the way, and the columns that bring them back."""
    moved = docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c in names})
    return moved, [F.col(new).alias(old) for new, old in zip(moved.columns, docs.columns, strict=True)]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts, texts without a letter and texts no language fits go.

    The classifier learns from the rows of the given documents that have a language.
    """
    model = langid.train(langid.learnable(docs))
    moved, columns = _apart(docs, "lang_pred", "score")
    found = langid.identify(moved, model)
    known = found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return known.select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Rows are told apart by id and text. Of the texts that share an id one keeps it; the others, and those without an id, go by
    an id made from both, larger than any other. So texts that resemble nothing stay, and of equal rows or texts one does.
    """
    row = row_key("doc_id", "text")
    shared = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("__first"))
    shared = written(shared.where("n > 1").select("doc_id", "__first"), scratch_path(spark, "shared"))
    # Rows with an id of their own stay where they are; only the others are shuffled, to be once each.
    met = docs.join(shared, "doc_id", "left")
    made = F.shiftrightunsigned(row, 2).bitwiseOR(F.lit(1 << 62))
    own = F.col("doc_id").cast("bigint")
    alone = met.where("doc_id IS NOT NULL AND __first IS NULL").withColumn("__name", own)
    others = met.where("doc_id IS NULL OR __first IS NOT NULL").withColumn("__name", F.when(row == F.col("__first"), own).otherwise(made))
    named = alone.union(others.dropDuplicates(["__name"])).select(*docs.columns, "__name")
    found = near_dup.near_duplicates(named.select(F.col("__name").alias("doc_id"), "text"))
    gone = written(found.where("NOT kept").select(F.col("row").alias("__row")).distinct(), scratch_path(spark, "gone"))
    kept = named.withColumnsRenamed({"doc_id": "__own", "__name": "doc_id"})
    return drop_rows(kept, gone).drop("doc_id").withColumnRenamed("__own", "doc_id").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents with smaller ids have; documents with nothing left go."""
    moved, columns = _apart(docs, "kept_text", "n_words", "n_removed", "kept_sha256")
    found = substring.remove_repeats(moved)
    cut = F.col("n_removed") > 0
    left = found.where(~cut | (F.col("n_removed") < F.col("n_words")))
    return left.select(
        *[
            F.when(cut, F.col("kept_text")).otherwise(F.col("text")).alias("text") if c == "text"
            else F.when(cut, F.char_length("kept_text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars"
            else column
            for c, column in zip(docs.columns, columns, strict=True)
        ]
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.find_contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    gone = written(found.where("contaminated").select(row_key("doc_id", "text").alias("__row")), scratch_path(spark, "contaminated"))
    kept = docs.withColumn("__row", row_key("doc_id", "text")).join(gone, "__row", "left_anti")
    return kept.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in training sequences."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Kernels, signatures and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), scratch_path(spark, name))
    return docs
