"""Driver queries that run the one-pass stream operators over the events table with Structured Streaming.

The events file is read as a file stream (``availableNow``), the query runs to the end of the input,
and the result is read back as a batch DataFrame. Sinks, state and stream checkpoints live under the
session's checkpoint folder (the cluster's shared ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import round6
from ..session import ensure_checkpoint_dir
from ..sources.tables import table
from ..streaming import moments as SM
from .fits import AMS_K, AMS_V
from .registry import ORACLE, query


def _events_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    # the table's own path, one file or a folder of part files: as a pattern, since a stream's plain path must be a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf.rstrip('/')}/events.parque[t]")


def _run(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lodestar-streams/{uuid.uuid4().hex}"


@query("exact_moment_stream", ORACLE["exact_moment"])
def q_exact_moment_stream(spark, sf):
    base = _scratch(spark)
    s = _events_stream(spark, sf).select("user_id")
    _run(SM.exact_moments_stream(s, "user_id", f"{base}/out", f"{base}/ck"))
    return spark.read.parquet(f"{base}/out").select("f0", "f1", "f2", "f3")


STREAM_FILES = 10


@query("exact_moment_batches", ORACLE["exact_moment"])
def q_exact_moment_batches(spark, sf):
    """The events as ``STREAM_FILES`` files, one a micro-batch; moments from the changed counts of each."""
    base = _scratch(spark)
    ev = table(spark, sf, "events").select("event_id", "user_id")
    ev.repartition(STREAM_FILES, "event_id").select("user_id").write.parquet(f"{base}/in")
    s = spark.readStream.schema(ev.select("user_id").schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    _run(SM.incremental_moments_stream(s, "user_id", f"{base}/state", f"{base}/ck"))
    return SM.latest_totals(spark, f"{base}/state").select("f0", "f1", "f2", "f3")


@query("ams_moment_stream", ORACLE["ams_moment"])
def q_ams_moment_stream(spark, sf):
    base = _scratch(spark)
    s = _events_stream(spark, sf).select((F.col("event_id") + 1).alias("pos"), F.col("user_id").alias("el"))
    _run(SM.ams_stream(s, "el", "pos", AMS_V, f"{base}/state", f"{base}/ck"))
    st = SM.latest_ams_state(spark, f"{base}/state")
    est = SM.ams_estimate(st, AMS_K)
    n = st.select(F.max("n")).scalar()
    return est.select(
        F.lit(AMS_K).alias("k"), F.lit(AMS_V).alias("v"), n.cast("bigint").alias("n"), "sum_counts",
        round6("estimate").alias("estimate"),
    )
