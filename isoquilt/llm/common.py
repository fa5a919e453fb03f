"""Small helpers of the operators."""

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast up to this many rows; beyond, the join shuffles.
BROADCAST_ROWS = 100_000

#: What words are made of, and the white space between them, as patterns.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks, as Spark reads it."""
    return "`" + name.replace("`", "``") + "`"


def small_side(small: DataFrame, rows: int) -> DataFrame:
    """``small`` marked for broadcast if its counted ``rows`` allow it."""
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null.

    Counts the single spaces left between words, which needs no array of all words.
    """
    spaced = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))
    gaps = F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit("")))
    return (gaps + (spaced != "").cast("int")).cast("long")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints that nothing refers to any more.

    They go when the driver collects its garbage, which a job of a few long stages may not do for half an hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
