"""Whole-chain queries and the stream's learnt state."""

import uuid

from pyspark.sql import functions as F

from isoquilt.plans import longread
from isoquilt.plans import testbed as tb
from isoquilt.plans.registry import query
from isoquilt.session import checkpoint_dir
from isoquilt.streaming import adaptive


@query("sp_driver")
def sp_driver(spark, sf):
    return longread.count_molecules(tb.cell_exon(spark, sf))


@query("longread_counts")
def longread_counts(spark, sf):
    return longread.run(tb.alignments(spark, sf), tb.gene_bed(spark, sf), tb.whitelist(spark, sf))["exon_count"]


@query(
    "bm_learnt_priors",
    "",
    """WITH o AS (SELECT value, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS batch FROM events),
    b AS (SELECT batch, count(*) AS c, sum(value) AS s, sum(value * value) AS q FROM o GROUP BY batch),
    r AS (SELECT batch, sum(c) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q FROM b WINDOW w AS (ORDER BY batch))
    SELECT batch, n::bigint AS n, round(s / n, 10) AS mu,
        round(sqrt((q - s * s / n) / (n - 1) * (n + 1) / (n + 0.5::double)) + 10.0::double / n, 6) AS sigma FROM r""",
)
def bm_learnt_priors(spark, sf):
    out = adaptive.learnt_priors(tb.table(spark, sf, "events"), ["ts", "event_id"], "value")
    return out.select("batch", "n", F.round("mu", 10).alias("mu"), F.round("sigma", 6).alias("sigma"))


@query(
    "bm_stream_priors",
    "",
    """WITH o AS (SELECT (user_id % 4)::int AS lane, event_id, value FROM events),
    r AS (SELECT lane, row_number() OVER w AS n, sum(value) OVER w AS s, sum(value * value) OVER w AS q FROM o
          WINDOW w AS (PARTITION BY lane ORDER BY event_id ROWS UNBOUNDED PRECEDING))
    SELECT lane, n::bigint AS n, round(s / n, 8) AS mu,
        round(sqrt((q - s * s / n) / (n - 1) * (n + 1) / (n + 0.5::double)) + 10.0::double / n, 6) AS sigma FROM r WHERE n % 100 = 0""",
)
def bm_stream_priors(spark, sf):
    path = f"{checkpoint_dir(spark)}/isoquilt-{spark.sparkContext.applicationId}/priors-{uuid.uuid4().hex}"
    known = tb.table(spark, sf, "events").schema
    # every user's values belong to one lane, whose state goes on from batch to batch
    values = spark.readStream.schema(known).parquet(f"{sf}/events.parquet*").selectExpr("user_id % 4 AS lane", "event_id AS place", "value")
    adaptive.prior_stream(values, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("lane", "n", F.round("mu", 8).alias("mu"), F.round("sigma", 6).alias("sigma"))
