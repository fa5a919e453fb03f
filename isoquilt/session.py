"""Session helpers: lineage cuts in the shared checkpoint folder, dense codes, scans."""

import atexit
import gc
import hashlib
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On one machine (a ``local`` master) a temporary folder stands in where none is named;
    on a cluster that would scatter the parts over the machines, so it is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all of {sc.master} shares")
        folder = tempfile.mkdtemp(prefix="isoquilt-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and drop its lineage.

    Its files go when nothing refers to it any more, whatever the session does with other checkpoints.
    """
    checkpoint_dir(df.sparkSession)
    conf, key = df.sparkSession.sparkContext._jsc.sc().conf(), "spark.cleaner.referenceTracking.cleanCheckpoints"
    before = conf.get(key, "false")
    # read where the checkpoint is made
    conf.set(key, "true")
    try:
        return df.checkpoint(eager=True)
    finally:
        conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints that nothing refers to any more, which else waits for the driver's garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def compute_once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns behind a generator, so that a later filter on them is evaluated on
    the computed value instead of being pushed down as a second copy of the expression."""
    made = F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))
    return df.select("*", F.inline(made))


def stored(spark: SparkSession, key: str, build) -> DataFrame:
    """Write ``build()`` once per application into the shared folder and read it back."""
    name = hashlib.md5(key.encode()).hexdigest()[:12]
    path = f"{checkpoint_dir(spark)}/isoquilt-{spark.sparkContext.applicationId}/{name}"
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scalar(df: DataFrame, column: Column) -> Column:
    """One aggregate over all of ``df`` as a scalar subquery (no one-partition window)."""
    return df.agg(column.alias("_scalar")).select("_scalar").scalar()


def _sorted_slices(df: DataFrame, order: list) -> DataFrame:
    """Range-sort ``df`` and tag each row with its slice and its place in the slice."""
    ident = F.monotonically_increasing_id()
    return cut(
        df.orderBy(*order)
        .withColumn("_slice", F.shiftright(ident, 33))
        .withColumn("_place", ident.bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    )


def ordinal(df: DataFrame, order: list, name: str) -> DataFrame:
    """Global 1-based row number by ``order`` without a one-partition window.

    The rows are range-partitioned and sorted; only one count per partition is
    combined on a single task.
    """
    tagged = _sorted_slices(df, order)
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_slice")
        .agg(F.count("*").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # one row per partition, so the broadcast is bounded by the partition count
    return (
        tagged.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_slice", "_place", "_offset")
    )


def codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """Dictionary ``column -> 1-based code`` in sorted order (factor codes)."""
    return ordinal(df.select(column).distinct(), [column], name)


def running_totals(df: DataFrame, order: list, sums: dict) -> DataFrame:
    """Add inclusive running sums ``{new: source}`` over a global order.

    Two-level scan: totals per range partition first, then sums inside each.
    """
    tagged = _sorted_slices(df, order)
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("_slice").orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    totals = tagged.groupBy("_slice").agg(*[F.sum(src).alias("_t_" + new) for new, src in sums.items()])
    offsets = totals.select(
        "_slice", *[F.coalesce(F.sum("_t_" + new).over(before), F.lit(0)).alias("_o_" + new) for new in sums]
    )
    out = tagged.join(F.broadcast(offsets), "_slice")
    for new, src in sums.items():
        out = out.withColumn(new, F.sum(src).over(inside) + F.col("_o_" + new))
    return out.drop("_slice", "_place", *["_o_" + new for new in sums])
