"""Stage tables, checkpoints, caches and sinks of the matching engine."""

from __future__ import annotations

import atexit
import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def stage_root(spark: SparkSession) -> str:
    """The shared folder for stage tables.  A temporary one serves a local session that names none; on a
    cluster the setting is needed, since other hosts do not see a local folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        root = tempfile.mkdtemp(prefix="stages-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


_made: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; :func:`remove_stages` removes it."""
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append((spark, path))
    return path


def remove_stages() -> None:
    """Remove the stage tables made so far; results that still read them must have been read."""
    while _made:
        spark, path = _made.pop()
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - that session has ended; others may still be there
            continue


atexit.register(remove_stages)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lineage ends here, and every executor
    can read it."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most rows of a side that is broadcast.
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast only when its counted rows are few; else the planner chooses."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's columns and rows, in any order of the rows."""
    plain = [F.to_json(F.struct(f"`{f.name}`")) if "map" in f.dataType.simpleString() or f.dataType.typeName() == "variant" else F.col(f"`{f.name}`") for f in df.schema.fields]
    row = F.struct(F.xxhash64(F.lit(1), *plain).alias("a"), F.xxhash64(F.lit(2), *plain).alias("b"))
    one = df.select(row.alias("r")).agg(F.count("*"), F.bit_xor("r.a"), F.sum(F.col("r.b").cast("decimal(20,0)"))).first()
    return hashlib.sha256(repr((df.schema.simpleString(), *one)).encode()).hexdigest()


def checkpoint(df: DataFrame, path: str, inputs: list[DataFrame] | None = None, parameters: dict | None = None) -> DataFrame:
    """Resume from ``path`` if the table there was made from the same ``inputs`` with the same ``parameters`` and columns; else write ``df`` there.

    A manifest beside the table (``path`` + ``.manifest``) holds the digests; it is written last, so a table whose writing was cut short is
    made anew.  Inputs are read once to take their digest.  Without ``inputs`` the rows of ``df`` itself are taken, which is always
    right but computes them: name the inputs where ``df`` is dear (model replies)."""
    spark = df.sparkSession
    made_of = {"inputs": [fingerprint(x) for x in ([df] if inputs is None else inputs)], "parameters": parameters or {}, "columns": df.schema.simpleString()}
    wanted = hashlib.sha256(json.dumps(made_of, sort_keys=True, default=str).encode()).hexdigest()
    try:
        if spark.read.schema("digest string").json(f"{path}.manifest").first() == (wanted,):
            return spark.read.schema(df.schema).parquet(path)
    except AnalysisException:
        pass  # there is no manifest
    manifest = spark.createDataFrame([(wanted,)], "digest string").coalesce(1)
    manifest.limit(0).write.mode("overwrite").json(f"{path}.manifest")  # none while the table is written
    df.write.mode("overwrite").parquet(path)
    manifest.write.mode("overwrite").json(f"{path}.manifest")
    return spark.read.schema(df.schema).parquet(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append verdicts; what is there is never rewritten."""
    df.write.mode("append").json(path)


def write_views(views: dict[str, DataFrame], path: str) -> None:
    """One Parquet table for each view; optional views are left out when they are empty, and abstentions
    without a row get one that says so."""
    for name, df in views.items():
        if name in ("Consortium_View", "Verdict_Changes", "Abstentions") and df.isEmpty():
            if name != "Abstentions":
                continue
            texts = [F.lit("none" if f.name == "status" else "-").cast(f.dataType).alias(f.name) if f.dataType.typeName() == "string" else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]
            df = df.sparkSession.range(1).select(*texts)
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def read_views(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    """The views that are there."""
    out = {}
    for name in names:
        try:
            out[name] = spark.read.parquet(f"{path}/{name}")
        except AnalysisException:
            continue
    return out


#: Texts survive a CSV file as they are: quotes doubled, line ends kept inside quotes, no blanks cut.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV, quoteAll=True).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A file of :func:`write_csv`, all columns strings."""
    return spark.read.options(**CSV, multiLine=True).csv(path)


def write_batches(df: DataFrame, path: str, index: str, size: int = 10) -> None:
    """One folder for each ``size`` source entities."""
    df.withColumn("batch", F.floor(F.col(index) / size)).write.mode("overwrite").partitionBy("batch").parquet(path)


def missing_from_cache(items: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Items whose key the cache doesn't hold: only these go to a provider."""
    return items.join(cache.select(key).distinct(), key, "left_anti")


def merged_cache(cache: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The cache with fresh entries, which replace older ones of their key."""
    return cache.join(fresh.select(key), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def cache_key(model: str, text: Column) -> Column:
    """The key under which a provider's answer to a text is kept."""
    return F.md5(F.concat(F.lit(f"{model}::"), text).cast("binary"))


def cached_vectors(items: DataFrame, cache: DataFrame, provide: Callable[[DataFrame], DataFrame], model: str, text: str, batch: int = 96) -> tuple[DataFrame, DataFrame]:
    """(items with ``vector``, the new cache).  Only different texts whose key the cache (key, vector)
    doesn't hold go to ``provide``, which gets (key, text, batch) with ``batch`` texts to a batch and
    returns (key, vector)."""
    from pairforge.operators.similarity import position

    keyed = items.withColumn("_key", cache_key(model, F.col(text)))
    asked = missing_from_cache(keyed.select(F.col("_key").alias("key"), F.col(text).alias("text")).distinct(), cache, "key")
    asked = position(asked, ["key"], "_at").withColumn("batch", F.floor(F.col("_at") / batch)).drop("_at")
    whole = merged_cache(cache, provide(asked), "key")
    return keyed.join(whole.select(F.col("key").alias("_key"), "vector"), "_key", "left").drop("_key"), whole


def view_order(df: DataFrame, *order: Column) -> DataFrame:
    """A sink's rows in their final order (a range-partitioned sort, so files follow each other)."""
    return df.orderBy(*order)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")
