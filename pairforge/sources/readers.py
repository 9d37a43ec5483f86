"""Sources: companies, opportunities, reviews, verdict logs, folders of mixed files."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge import dims
from pairforge.functions import text as X
from pairforge.operators.similarity import position
from pairforge.sources.stages import CSV

# --- fixed values: header aliases, after normalisation ------------------------------------------
COMPANY_HEADERS = {
    "company name": "company_name", "company profile": "company_profile", "product/services": "product_services", "product and services": "product_services",
    "products/services": "product_services", "sector": "sector",
}
OPPORTUNITY_HEADERS = {
    "what is the opportunity name?": "opportunity_name", "sector": "sector", "what is the opportunity description?": "description",
    "what are the investment highlights?": "highlights", "what is the value proposition of this opportunity?": "value_proposition",
    "what are the key demand drivers?": "demand_drivers", "who are the key players in this sector or project?": "key_players",
    "what materials are involved or required in the project?": "materials", "market data": "market_data", "cost structure": "cost_structure",
    "government incentives": "incentives", "risks and mitigations": "risks", "investment locations": "locations",
}
STRUCTURED_LISTS = ["required_capabilities", "required_inputs", "adjacent_value_chain_sectors", "precedent_industries", "capability_keywords"]
EMAIL_HEADERS = ["email", "e-mail", "mail", "email address", "work email"]


def header(name: str) -> str:
    """A header without odd spaces, in lower case."""
    return re.sub(r"\s+", " ", re.sub("[​‌‍﻿]", "", name.replace(" ", " "))).strip().lower()


def with_headers(df: DataFrame, aliases: dict[str, str], required: Iterable[str] = ()) -> DataFrame:
    out = df.withColumnsRenamed({c: aliases[header(c)] for c in df.columns if header(c) in aliases})
    if missing := [c for c in required if c not in out.columns]:
        raise KeyError(f"missing columns: {missing}")
    return out


def companies(df: DataFrame, order: list | None = None, dedupe: bool = True) -> DataFrame:
    """company_id, name, profile, products, sector and the derived texts; one row for each entity (the
    one with the longest text stays, the first on ties)."""
    out = with_headers(df, COMPANY_HEADERS, ["company_name", "company_profile", "product_services", "sector"])
    return identified(out, "company", "company_id", order).transform(lambda d: entity_resolution(d) if dedupe else d).withColumns(
        {
            "combined": F.concat_ws(" ", "company_name", "sector", "company_profile", "product_services"),
            "combined_focused": F.concat_ws(" ", "sector", X.focus_company(F.col("company_profile")), X.focus_company(F.col("product_services"))),
            "products_clean": X.preprocess(F.col("product_services")),
        }
    )


def opportunities(df: DataFrame, order: list | None = None) -> DataFrame:
    out = with_headers(df, OPPORTUNITY_HEADERS, ["opportunity_name", "sector", "description"])
    fields = [c for c in OPPORTUNITY_HEADERS.values() if c in out.columns]
    out = identified(out, "opportunity", "opportunity_id", order)
    return out.withColumns({"requirement": F.concat_ws(" ", *fields), "requirement_focused": X.focus_opportunity(F.concat_ws(" ", *fields))})


def is_structured(df: DataFrame) -> bool:
    return any(c in df.columns for c in STRUCTURED_LISTS)


def structured_lists(df: DataFrame) -> DataFrame:
    """The JSON list columns as arrays; a missing column is an empty list."""
    return df.withColumns({c: F.coalesce(F.from_json(F.col(c) if c in df.columns else F.lit("[]"), "array<string>"), F.array().cast("array<string>")) for c in STRUCTURED_LISTS})


def id_column(df: DataFrame, hint: str) -> str | None:
    """The column that holds ids: named like the hint, ``id`` in one of its spellings, or both."""
    return next((c for c in (hint, "id", "ID", "Id", f"{hint}_id", f"{hint}Id") if c in df.columns), None)


def identified(df: DataFrame, hint: str, name: str, order: list | None = None) -> DataFrame:
    """Ids from the table's id column (0 where it holds no number), else positions from 1: in the order
    of ``order``, or as the rows were read."""
    column = id_column(df, hint)
    if column:
        return df.withColumn(name, F.coalesce(F.trim(F.col(column).cast("string")).try_cast("long"), F.lit(0)))
    if name in df.columns:
        return df
    keys = order or ["_read"]
    at = position(df if order else df.withColumn("_read", F.monotonically_increasing_id()), keys, "_at")
    return at.withColumn(name, F.col("_at") + 1).drop("_at", "_read")


def entity_resolution(df: DataFrame, name: str = "company_name", order: str = "company_id", texts: tuple[str, ...] = ("company_profile", "product_services")) -> DataFrame:
    """One row for each canonical name: the richest text, then the least ``order``."""
    size = sum((F.length(F.coalesce(F.col(t), F.lit(""))) for t in texts[1:]), F.length(F.coalesce(F.col(texts[0]), F.lit(""))))
    w = W.partitionBy("_key").orderBy(size.desc(), order)
    return df.withColumn("_key", X.canonical_name(F.col(name))).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_key")


def union_sheets(inputs: Iterable[DataFrame], normalize: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All inputs that normalise, one below the other; an error if none does."""
    good = []
    for df in inputs:
        try:
            good.append(normalize(df))
        except KeyError:
            continue
    if not good:
        raise ValueError("no input has the wanted columns")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), good)


def first_existing(spark: SparkSession, paths: Iterable[str]) -> str | None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            return p
    return None


def human_label(verdict: Column) -> Column:
    v = F.lower(F.trim(verdict))
    return F.when(v.isin(dims.AGREE), 1).when(v.isin(dims.DISAGREE), 0)


def human_reviews(df: DataFrame, seq: str) -> DataFrame:
    """(company, opportunity, label): the last readable verdict of each pair."""
    known = df.withColumn("label", human_label(F.col("verdict"))).filter("label IS NOT NULL")
    return known.groupBy(F.trim("company").alias("company"), F.trim("opportunity").alias("opportunity")).agg(F.max_by("label", seq).alias("label"))


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """The reviews of a CSV file, or of a folder of them in the order of the paths.  Values may hold quotes and line ends."""
    if not first_existing(spark, [path]):
        return human_reviews(spark.createDataFrame([], "company string, opportunity string, verdict string, seq int"), "seq")
    rows = spark.read.options(**CSV, multiLine=True).csv(path)
    return human_reviews(rows.withColumn("_seq", F.struct("_metadata.file_path", F.monotonically_increasing_id())), "_seq")


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    schema = "ts string, company string, opportunity string, decision string, confidence double, agreement string, model string, votes int, rubric string, final_score double, embed_mode string"
    return spark.read.schema(schema).json(path) if first_existing(spark, [path]) else spark.createDataFrame([], schema)


def read_documents(spark: SparkSession, path: str, extract: Callable[[bytes], str] | None = None) -> DataFrame:
    """Files of a folder with their text: category by the file name's prefix, length, lines.  ``extract``
    turns a file's bytes into text (by default UTF-8 text)."""
    read = extract or (lambda b: b.decode("utf-8", "replace"))

    @F.pandas_udf("string")
    def as_text(content: pd.Series) -> pd.Series:
        return content.map(read)

    stem = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        stem.alias("file"), F.when(F.contains(stem, F.lit("_")), F.substring_index(stem, "_", 1)).otherwise("Telecom/ICT").alias("category"), as_text("content").alias("text")
    ).withColumns({"n_chars": F.length("text"), "n_lines": F.size(F.split("text", "\n")) - 1})


def literal_table(spark: SparkSession, rows: list[dict], columns: list[str]) -> DataFrame:
    """Inline records as a table of strings in a fixed order of columns, with the characters of each row."""
    df = spark.createDataFrame([tuple(str(r.get(c, "")) for c in columns) for r in rows], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return df.withColumn("n_chars", sum((F.length(F.col(f"`{c}`")) for c in columns[1:]), F.length(F.col(f"`{columns[0]}`"))))


def merged_names(df: DataFrame, name: str = "company_name", order: str = "company_id", texts: tuple[str, ...] = ("company_profile", "product_services")) -> DataFrame:
    """(kept, merged): the names that entity resolution drops, with the name that stays for each."""
    kept = entity_resolution(df, name, order, texts)
    k = kept.select(X.canonical_name(F.col(name)).alias("_key"), F.col(name).alias("kept"), F.col(order).alias("_kept"))
    return df.withColumn("_key", X.canonical_name(F.col(name))).join(k, "_key").filter(F.col(order) != F.col("_kept")).select("kept", F.col(name).alias("merged"))


def email_column(df: DataFrame) -> str:
    return next((c for c in df.columns if header(c) in EMAIL_HEADERS), "Email")
