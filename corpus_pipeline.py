"""A training-data pipeline over ``documents``: five operators, each working on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of ``documents``.

Defined cases are those of the operators: null and empty texts are scored, linked and packed like any other; rows that share a
doc_id are one document and stay or go together; very long texts are taken whole by each stage; an empty table gives no row; columns named like an operator's
results are set aside while it works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm import decontamination, packing, quality_rules_model, simhash, substring_dedup
from pairforge.llm.common import stage, table
from pairforge.llm.language_id import held_out


#: Input columns are set aside under this prefix while an operator works, so that none meets one of its results.
_ASIDE = "_pipeline_input_"


def _apart(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with every column but the needed ones renamed."""
    return docs.withColumnsRenamed({c: _ASIDE + c for c in docs.columns if c not in needed})


def _together(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names."""
    return out.select([F.col(f"`{_ASIDE}{c}`" if _ASIDE + c in out.columns else f"`{c}`").alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the threshold."""
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    work = _apart(docs, "doc_id", "text")
    model = quality_rules_model.fit(work, labels)
    return _together(quality_rules_model.score(work, model).filter(F.col("score") >= quality_rules_model.THRESHOLD), docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return _together(simhash.deduplicate(_apart(docs, "doc_id", "text")), docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a document with a smaller doc_id has too.  A text that loses
    something keeps its other words, joined by one space; one that loses every word goes.  ``n_chars``,
    where the table has it, follows the text."""
    out = substring_dedup.remove_repeats(_apart(docs, "doc_id", "text"))
    lost = F.col("n_removed") > 0
    out = out.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words"))).withColumn("text", F.when(lost, F.col("kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        own = F.col(_ASIDE + "n_chars")
        out = out.withColumn(_ASIDE + "n_chars", F.when(lost, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(own))
    return _together(out, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    out = decontamination.match(_apart(docs, "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return _together(out.filter("n_hit = 0"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document: sequences of power-of-two lengths."""
    import public_tokenizers

    out = packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: SQL can express neither the classifier's fit nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
