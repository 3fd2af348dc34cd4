"""Stream moments in one pass with Structured Streaming.

* exact: a streaming count per element (state = one row per distinct element) in complete mode;
  each micro-batch's full count table gives F_0..F_k in ``foreachBatch``.
* exact, incremental: the same state, but a micro-batch hands on only the counts it changed; the
  moments are running totals.
* AMS: v reservoir variables kept as a state table of v rows. Each micro-batch is an ordinary
  DataFrame inside ``foreachBatch``: new reservoir picks (the last position p of the batch with
  h(s, p) * p < 1), then one join of the batch with the v-row state on element counts the
  occurrences at or after each variable's position. The state table (v rows) is written per epoch
  under the query's checkpoint folder, so a restarted query resumes from the last committed epoch.
  Positions must grow from batch to batch (e.g. files ordered by position, one or more per trigger);
  a batch that starts at or below the last position seen stops the query with an error.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.sketches import ams_choice, power_sum

AMS_STATE_SCHEMA = "sample INT, t BIGINT, el BIGINT, c BIGINT, n BIGINT, last BIGINT"


def exact_moments_stream(
    stream: DataFrame, element: str, out_path: str, checkpoint: str, ks=(0, 1, 2, 3), trigger: dict | None = None
) -> StreamingQuery:
    """Start the exact-moment query; every micro-batch overwrites ``out_path`` with (epoch, f0..fk)."""
    counts = stream.groupBy(element).agg(F.count(F.lit(1)).alias("_c"))

    def emit(batch: DataFrame, epoch: int) -> None:
        m = batch.agg(*[power_sum(F.col("_c"), k).alias(f"f{k}") for k in ks])
        m.select(F.lit(epoch).cast("bigint").alias("epoch"), "*").write.mode("overwrite").parquet(out_path)

    w = counts.writeStream.outputMode("complete").foreachBatch(emit).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


# ---------------------------------------------------------------- exact moments, changed elements only

_TOTALS_KEY = "n_batches BIGINT"


def _totals_schema(ks) -> str:
    return ", ".join([_TOTALS_KEY, *[f"f{k} DECIMAL(38,0)" for k in ks]])


def _merged_counts(state: pa.Table | None, new: pa.Table) -> pa.Table:
    """(el, old, add) per element of a bucket: its count before and its rows in this batch."""
    zero = lambda t: pa.array(np.zeros(len(t), dtype=np.int64))
    both = [pa.table({"el": new["el"], "old": zero(new), "add": new["n"]})]
    if state is not None:
        both.insert(0, pa.table({"el": state["el"], "old": state["c"], "add": zero(state)}))
    t = pa.concat_tables(both).group_by("el").aggregate([("old", "sum"), ("add", "sum")])
    return pa.table({"el": t["el"], "old": t["old_sum"], "add": t["add_sum"]})


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def incremental_moments_stream(
    stream: DataFrame, element: str, state_dir: str, checkpoint: str, ks=(0, 1, 2, 3), trigger: dict | None = None, buckets: int = 1024
) -> StreamingQuery:
    """Exact moments with keyed state: the elements' counts live in the state store, and a micro-batch hands on only the elements it
    changed, with their old and new count.

    F_k after a batch is F_k before it plus the sum of new^k - old^k over those (exact, DECIMAL). The totals, one row, are written per epoch to
    ``state_dir/epoch=e``, so a batch that is replayed after a failure starts from the totals before it. Elements are dealt by hash to ``buckets`` keys; a
    key's state is one packed table of its elements and counts, so Python is called once a bucket and batch, and not once an element.
    Rows are counted by element within an Arrow batch before they are dealt, so a hot element sends a few. No batch sees the table of all counts.
    """

    def counted(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch]).group_by(["bucket", "el"]).aggregate([([], "count_all")])
            yield pa.RecordBatch.from_arrays([t[c].combine_chunks() for c in ("bucket", "el", "count_all")], names=["bucket", "el", "n"])

    def changed(key, frames, state):
        new = pa.concat_tables([pa.table({"el": pa.array(f["el"], pa.string(), from_pandas=True), "n": pa.array(f["n"], pa.int64())}) for f in frames])
        t = _merged_counts(_unpacked(state.get[0]) if state.exists else None, new)
        total = pc.add(t["old"], t["add"])
        state.update((_packed(pa.table({"el": t["el"], "c": total})),))
        moved = pc.greater(t["add"], 0)
        yield pd.DataFrame({"old": t["old"].filter(moved).to_numpy(), "new": total.filter(moved).to_numpy()})

    el = F.col(element)  # as text: one type of state for all, and a null stays an element of its own
    dealt = stream.select(F.pmod(F.xxhash64(el), F.lit(buckets)).cast("int").alias("bucket"), el.cast("string").alias("el"))
    counts = dealt.mapInArrow(counted, "bucket int, el string, n bigint").groupBy("bucket").applyInPandasWithState(
        changed, "old BIGINT, new BIGINT", "counts BINARY", "update", GroupStateTimeout.NoTimeout
    )

    def emit(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        # an element counted 0 times adds nothing, also to F_0
        power = lambda c, k: F.when(F.col(c) > 0, F.lit(1)).otherwise(F.lit(0)) if k == 0 else F.col(c)
        moved = [(F.coalesce(power_sum(power("new", k), max(k, 1)), F.lit(0)) - F.coalesce(power_sum(power("old", k), max(k, 1)), F.lit(0))).alias(f"d{k}") for k in ks]
        delta = batch.agg(*moved)
        before = _last_state(spark, state_dir, epoch, _totals_schema(ks))
        if before is None:
            before = spark.range(1).select(F.lit(0).cast("bigint").alias("n_batches"), *[F.lit(0).cast("decimal(38,0)").alias(f"f{k}") for k in ks])
        # two tables of one row each
        after = before.withColumn("_one", F.lit(1)).join(delta.withColumn("_one", F.lit(1)), "_one").select(
            (F.col("n_batches") + 1).alias("n_batches"), *[(F.col(f"f{k}") + F.col(f"d{k}")).cast("decimal(38,0)").alias(f"f{k}") for k in ks]
        )
        after.coalesce(1).write.mode("overwrite").parquet(_state_path(state_dir, epoch))

    w = counts.writeStream.outputMode("update").foreachBatch(emit).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def latest_totals(spark: SparkSession, state_dir: str, ks=(0, 1, 2, 3)) -> DataFrame | None:
    """(n_batches, f0 ..) after the last committed epoch."""
    return _last_state(spark, state_dir, 2**62, _totals_schema(ks))


def _state_path(state_dir: str, epoch: int) -> str:
    return os.path.join(state_dir, f"epoch={epoch:012d}")


def _last_state(spark: SparkSession, state_dir: str, before_epoch: int, schema: str = AMS_STATE_SCHEMA) -> DataFrame | None:
    """The newest committed state strictly before ``before_epoch`` (epochs are replayed idempotently)."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(state_dir)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hp):
        return None
    epochs = []
    for st in fs.listStatus(hp):
        name = st.getPath().getName()
        if name.startswith("epoch=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            e = int(name.split("=", 1)[1])
            if e < before_epoch:
                epochs.append(e)
    if not epochs:
        return None
    return spark.read.schema(schema).parquet(_state_path(state_dir, max(epochs)))


def ams_step(batch: DataFrame, prev: DataFrame | None, element: str, pos: str, v: int) -> DataFrame:
    """One micro-batch of the AMS variables: returns the new v-row state (sample, t, el, c, n)."""
    spark = batch.sparkSession
    ev = batch.select(F.col(pos).cast("bigint").alias("_p"), F.col(element).cast("bigint").alias("_el"))
    samples = spark.range(1, v + 1).select(F.col("id").cast("int").alias("sample"))
    if prev is None:
        prev = samples.select("sample", *[F.lit(None).cast(t).alias(c) for c, t in (("t", "bigint"), ("el", "bigint"), ("c", "bigint"), ("n", "bigint"), ("last", "bigint"))])
    gen = ev.select("_p", "_el", F.explode(F.sequence(F.lit(1), F.lit(v))).alias("sample"))
    picks = gen.where(ams_choice(F.col("sample"), F.col("_p")) * F.col("_p") < 1.0).groupBy("sample").agg(
        F.max(F.struct("_p", "_el")).alias("_x")
    )
    # v rows: the reservoir position and element of every variable after this batch
    st = (
        F.broadcast(prev)
        .join(F.broadcast(picks), "sample", "left")
        .select(
            "sample",
            F.coalesce(F.col("_x._p"), F.col("t")).alias("t"),
            F.coalesce(F.col("_x._el"), F.col("el")).alias("el"),
            F.col("_x").isNotNull().alias("_new"),
            F.coalesce(F.col("c"), F.lit(0)).alias("_c0"),
            F.coalesce(F.col("n"), F.lit(0)).alias("_n0"),
            "last",
        )
    )
    hits = ev.join(F.broadcast(st.select("sample", "t", "el")), ev["_el"] == F.col("el")).where(F.col("_p") >= F.col("t"))
    cnt = hits.groupBy("sample").agg(F.count(F.lit(1)).alias("_k"))
    size = ev.agg(F.count(F.lit(1)).alias("n"), F.min("_p").alias("first"), F.max("_p").alias("last")).first()
    seen = prev.agg(F.max("last")).first()[0]
    if seen is not None and size["first"] is not None and size["first"] <= seen:
        raise ValueError(f"batch starts at position {size['first']}, but {seen} was seen before")
    n_batch = F.lit(size["n"])
    last = F.lit(size["last"]).cast("bigint")
    return (
        st.join(F.broadcast(cnt), "sample", "left")
        .select(
            "sample",
            "t",
            "el",
            (F.when(F.col("_new"), F.lit(0)).otherwise(F.col("_c0")) + F.coalesce(F.col("_k"), F.lit(0))).cast("bigint").alias("c"),
            (F.col("_n0") + n_batch).cast("bigint").alias("n"),
            F.coalesce(last, F.col("last")).alias("last"),
        )
    )


def ams_stream(stream: DataFrame, element: str, pos: str, v: int, state_dir: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the AMS query; the state after epoch e is the parquet folder ``state_dir/epoch=e``."""

    def step(batch: DataFrame, epoch: int) -> None:
        prev = _last_state(batch.sparkSession, state_dir, epoch)
        batch = batch.persist()  # read for its size, its picks and its counts
        try:
            ams_step(batch, prev, element, pos, v).coalesce(1).write.mode("overwrite").parquet(_state_path(state_dir, epoch))
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def ams_estimate(state: DataFrame, k: int) -> DataFrame:
    """Mean over the variables of n * (c^k - (c-1)^k) from a state table."""
    c = F.col("c").cast("double")
    return state.where(F.col("t").isNotNull()).agg(
        F.sum("c").cast("bigint").alias("sum_counts"),
        F.avg(F.col("n") * (F.pow(c, F.lit(float(k))) - F.pow(c - 1, F.lit(float(k))))).alias("estimate"),
    )


def latest_ams_state(spark: SparkSession, state_dir: str) -> DataFrame | None:
    return _last_state(spark, state_dir, 2**62)
