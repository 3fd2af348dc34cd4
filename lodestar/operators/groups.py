"""Skew-safe group helpers: bounded per-group arrays, pairs inside groups split into tiles, exact global row numbers.

Every helper assumes one key may hold a third of all rows: no helper places a whole group's rows,
or a whole group's pairs, into one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import md5_hex_int


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is planned and run in here go when it is done; else they wait for the driver's garbage collection."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def reliable_checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df.checkpoint()`` into the cluster's ``spark.checkpoint.dir`` (a folder of our own only when unset)."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_end(df.sparkSession):
        return df.select("*").checkpoint(eager=eager)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder: as lasting as ``reliable_checkpoint``, for large tables of plain columns.

    A checkpoint is row by row in Java's serialization; this is several times smaller and read by column.
    """
    from ..session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(df.sparkSession)}/lodestar_{uuid.uuid4().hex}"
    with shuffles_end(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_degree(df: DataFrame, keys: Sequence[str], name: str = "_deg") -> DataFrame:
    """Rows per key; partial aggregation before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def chunked_collect(
    df: DataFrame,
    keys: Sequence[str],
    member: str,
    value,
    out: str,
    chunk_rows: int = 10000,
) -> DataFrame:
    """Per key, the sorted list of ``value`` in chunks of about ``chunk_rows`` members.

    A key with d rows gets ceil(d / chunk_rows) chunks; a member goes to chunk
    ``md5(member) mod chunks``. The degrees are written before the join (only a join of two plain
    shuffles is split by AQE when skewed) and the rows are dealt by (key, chunk) before the lists are
    built, so no task holds a hot key's rows. Output: keys, ``chunk``, ``n_in_key``, ``out``.
    """
    deg = reliable_checkpoint(group_degree(df, keys, "n_in_key"))
    x = df.join(deg, list(keys))
    n_chunks = F.greatest(F.lit(1), F.ceil(F.col("n_in_key") / F.lit(float(chunk_rows)))).cast("bigint")
    x = x.withColumn("chunk", F.pmod(md5_hex_int(F.col(member)), n_chunks))
    x = x.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "chunk")
    return x.groupBy(*keys, "chunk", "n_in_key").agg(F.array_sort(F.collect_list(value)).alias(out))


def pairs_in_groups(
    df: DataFrame,
    group: str,
    member: str,
    payload: Sequence[str] = (),
    tile_rows: int = 2048,
    keep_tiles: bool = False,
    reduce: Callable | None = None,
    reduced: str = "",
    asked: DataFrame | None = None,
) -> DataFrame:
    """Every unordered pair of members sharing ``group`` once per shared group, as (group, lo, hi, lo_*, hi_*).

    The pair set is the semantics of the operator (co-rated users, sets sharing an element), so its size
    is the output size. What must not happen is that a hot group's pairs land in one task: a group with d
    members is cut into t = ceil(d / tile_rows) chunks by a hash of the member and its pairs are produced
    in t*(t+1)/2 tiles of at most tile_rows**2 pairs each, one join key per tile. Small groups (t = 1)
    are joined once, unreplicated. The tile join gets about one tile's worth of pairs per task (the
    partition count comes from sum d(d-1)/2 over the degrees), since its output, not its input, is large.
    The degrees are written once (one job when the plan is built) for that count and the join; an expensive ``df`` is best written first
    (``reliable_checkpoint``) so that this job and the join read it once.

    With ``reduce`` a pair comes once, over all its groups: (lo, hi, n_common, the columns ``reduced``), and no pair is shuffled (see ``_reduced_pairs``);
    with ``asked`` (lo, hi), only those of these pairs.
    """
    if reduce is not None:
        return _reduced_pairs(df, group, member, payload, tile_rows, reduce, reduced, asked)
    deg = reliable_checkpoint(group_degree(df, [group]).where("_deg > 1"))  # a group of one has no pair
    x = df.join(deg, group)
    n_chunks = F.greatest(F.lit(1), F.ceil(F.col("_deg") / F.lit(float(tile_rows)))).cast("int")
    x = x.withColumn("_nc", n_chunks).withColumn("_c", F.pmod(F.xxhash64(F.col(member)), F.col("_nc")).cast("int"))
    # the row of chunk c is the left side of tiles (c, j), j >= c, and the right side of tiles (i, c), i <= c
    left = x.select(
        F.col(group),
        F.col(member).alias("_a"),
        *[F.col(p).alias(f"_a_{p}") for p in payload],
        F.col("_c").alias("_ti"),
        F.explode(F.sequence(F.col("_c"), F.col("_nc") - 1)).alias("_tj"),
    )
    right = x.select(
        F.col(group),
        F.col(member).alias("_b"),
        *[F.col(p).alias(f"_b_{p}") for p in payload],
        F.explode(F.sequence(F.lit(0), F.col("_c"))).alias("_ti"),
        F.col("_c").alias("_tj"),
    )
    # The join's inputs are small per tile but its output is up to tile_rows**2 pairs per tile, which
    # adaptive coalescing cannot see: fix the partition count from the pair count instead (explicit
    # repartitions are not coalesced), about one tile's worth of pairs per task.
    total_pairs = deg.agg(F.sum(F.col("_deg") * (F.col("_deg") - 1) / 2)).first()[0] or 0
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_parts = int(max(base, -(-int(total_pairs) // (tile_rows * tile_rows))))
    left = left.repartition(n_parts, group, "_ti", "_tj")
    right = right.repartition(n_parts, group, "_ti", "_tj")
    j = left.join(right, [group, "_ti", "_tj"]).where(
        F.when(F.col("_ti") == F.col("_tj"), F.col("_a") < F.col("_b")).otherwise(F.col("_a") != F.col("_b"))
    )
    a_first = F.col("_a") < F.col("_b")
    cols = [F.col(group), F.least("_a", "_b").alias("lo"), F.greatest("_a", "_b").alias("hi")]
    if keep_tiles:
        cols += [F.col("_ti").alias("tile_i"), F.col("_tj").alias("tile_j")]
    for p in payload:
        cols.append(F.when(a_first, F.col(f"_a_{p}")).otherwise(F.col(f"_b_{p}")).alias(f"lo_{p}"))
        cols.append(F.when(a_first, F.col(f"_b_{p}")).otherwise(F.col(f"_a_{p}")).alias(f"hi_{p}"))
    return j.select(*cols)


def _reduced_pairs(df: DataFrame, group: str, member: str, payload: Sequence[str], tile_rows: int, reduce: Callable, reduced: str, asked: DataFrame | None = None, task_pairs: int = 1 << 20) -> DataFrame:
    """The pairs of ``pairs_in_groups``, reduced over their groups: (lo, hi, n_common, ``reduced``).

    A member is sent the list of the larger members of each of its groups (``member_lists``), some bytes a pair, and all its lists meet in one place: the pairs are
    formed and added up there with numpy and never shuffled as rows. ``reduce(lo_values, hi_values, first)`` gets the payload columns (BIGINT or DOUBLE) of all pairs
    sorted by pair and the first position of each pair. A group of more than ``tile_rows`` members is cut into chunks by a hash, and its lists come from pairs of
    chunks; members are dealt so that a task call forms about ``task_pairs`` pairs.
    """
    from .member_lists import larger_lists, list_rows, place, received

    n_own = len(payload)
    types = dict(df.select(*payload).dtypes) if payload else {}
    deg = written(group_degree(df, [group]).where("_deg > 1"))
    r = deg.agg(F.sum(F.col("_deg") * (F.col("_deg") - 1) / 2)).first()[0]
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = int(max(base, -(-int(r or 0) // task_pairs)))
    out = larger_lists(list_rows(df.join(deg, group), group, member, payload, tile_rows), n_own, parts)

    def add(table, wanted=None):
        if not table.num_rows:
            return pa.table([pa.array([], f.type) for f in own_schema], schema=own_schema)
        mine, size, own, b, values = received(table["_sent"], n_own)
        ids, at = np.unique(mine, return_inverse=True)
        a = np.repeat(at, size)
        others, number = np.unique(b, return_inverse=True)
        key = a * len(others) + number
        order = np.argsort(key, kind="stable") if wanted is None else own_pairs(key, ids, others, wanted)
        order = order[ids[a[order]] < b[order]]  # a member listed twice in a group is no pair with itself
        key = key[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), dtype=bool), key[1:] != key[:-1])))
        n = np.diff(np.append(first, len(key)))
        lo = [np.repeat(v, size)[order] for v in own]
        hi = [v[order] for v in values]
        more = reduce(lo, hi, first) if len(first) else [[] for _ in names_out]
        return pa.table([pa.array(ids[a[order[first]]]), pa.array(b[order[first]]), pa.array(n), *[pa.array(v, t) for v, t in zip(more, out_types, strict=True)]], names=["lo", "hi", "n_common", *names_out])

    def own_pairs(key, ids, others, wanted):
        """The places of the asked pairs' keys, sorted by key."""
        lo, hi = wanted["lo"].to_numpy(), wanted["hi"].to_numpy()
        if not len(lo) or not len(key):
            return np.zeros(0, dtype=np.int64)
        i, j = np.minimum(np.searchsorted(ids, lo), len(ids) - 1), np.minimum(np.searchsorted(others, hi), len(others) - 1)
        known = (ids[i] == lo) & (others[j] == hi)
        at = np.flatnonzero(np.isin(key, i[known] * len(others) + j[known]))
        return at[np.argsort(key[at], kind="stable")]

    def dealt(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["lo"], batch["hi"], pa.array(place(batch["lo"].to_numpy(), parts))], names=["lo", "hi", "_k"])

    fields = [f.split() for f in reduced.split(",") if f.strip()]
    names_out = [f[0] for f in fields]
    out_types = [{"bigint": pa.int64(), "double": pa.float64()}[f[1]] for f in fields]
    own_schema = pa.schema([("lo", pa.int64()), ("hi", pa.int64()), ("n_common", pa.int64()), *zip(names_out, out_types, strict=True)])
    if set(types.values()) - {"bigint", "double"}:
        raise ValueError("payload columns must be BIGINT or DOUBLE")
    schema = ", ".join(["lo bigint", "hi bigint", "n_common bigint", *[f"{n} {t}" for n, t in fields]])
    if asked is None:
        return out.groupBy("_k").applyInArrow(lambda table: add(table), schema)
    asked = asked.select(F.col("lo").cast("bigint"), F.col("hi").cast("bigint")).where("lo IS NOT NULL AND hi IS NOT NULL").mapInArrow(dealt, "lo bigint, hi bigint, _k int")
    return out.groupBy("_k").cogroup(asked.groupBy("_k")).applyInArrow(lambda table, wanted: add(table, wanted), schema)


def global_row_number(df: DataFrame, order_cols: Sequence, name: str = "rn", partitions: int | None = None, write: Callable = reliable_checkpoint) -> DataFrame:
    """Exact 1-based row number over a total order, without a single-partition window.

    Range-partition and sort by the order, stamp partition id and in-partition position, cut lineage
    with a reliable ``checkpoint()`` (so both uses below see the same partitions, and a lost executor
    re-reads instead of re-sampling the range bounds), then add per-partition offsets from a table of
    one row per partition. The order must be total (break ties in ``order_cols``). ``write`` is how the lineage is cut (``written`` for many rows of
    plain columns); an order by an expression is neither shuffled nor written.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (
        df.repartitionByRange(n_parts, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    s = write(s)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    # one row per partition: the size is bounded by the partition count
    out = s.join(F.broadcast(offsets), "_pid").withColumn(
        name, F.col("_off") + F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33) + F.lit(1)
    )
    return out.drop("_pid", "_mid", "_off")
