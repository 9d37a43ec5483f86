"""The verdict log as a stream: the last verdict of each pair, kept up to date in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairforge.operators.ranking import latest
from pairforge.sources.readers import first_existing

SCHEMA = "ts string, company string, opportunity string, decision string, confidence double, agreement string, model string, votes int, rubric string, final_score double, embed_mode string"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(SCHEMA).json(path)


#: Parts of the table by a hash of the key; a batch rewrites the parts that it touches.
PARTS = 64


def _newest(table: DataFrame) -> DataFrame:
    """The rows of each part's newest version."""
    versions = table.select("part", "version").distinct().groupBy("part").agg(F.max("version").alias("version"))
    return table.join(F.broadcast(versions), ["part", "version"]).drop("version")  # PARTS rows at most


def keep_latest(log: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("company", "opportunity")) -> StreamingQuery:
    """Every batch is merged into the table below ``path``: the parts that it touches get a new version with
    the batch's number, complete before it is read.  A batch that is run again writes the same versions."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.filter(F.col("company").isNotNull()).withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int"))
        parts = [r.part for r in rows.select("part").distinct().collect()]  # PARTS values at most
        if not parts:
            return
        if number and first_existing(spark, [path]):
            old = spark.read.parquet(path).filter(F.col("part").isin(parts) & (F.col("version") < number))
            rows = _newest(old).unionByName(rows)
        latest(rows, [*keys, "part"], "ts").write.mode("overwrite").partitionBy("part").parquet(f"{path}/version={number}")

    return log.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every part."""
    return _newest(spark.read.parquet(path)).drop("part")
