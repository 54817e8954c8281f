"""What several of the operators need."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanebeacon.plans.shared import shared_folder

# A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read again, which cuts their lineage."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def uniform(*columns: Column | str, seed: int) -> Column:
    """A number in [0, 1) that depends on the values alone, so that reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Lets whole texts go to Python in smaller batches than Spark's own settings would, to bound memory."""
    for key, most in (("maxRecordsPerBatch", 1000), ("maxBytesPerBatch", 8 << 20)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
