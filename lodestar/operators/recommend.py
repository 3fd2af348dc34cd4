"""Neighbourhood collaborative filtering: fill in all items for one user, estimate requested (user, item) cells."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from .groups import reliable_checkpoint, written
from .member_lists import blob_batches, flat, gathered, list_rows, received, sends
from .ratings import center_ratings
from .similarity import similarity_to_user


def _neighbour_order(sim: str, user: str, undefined_first: bool):
    # similarities are compared at 9 places so that float noise does not reorder mathematical ties
    order = [F.round(F.col(sim), 9).desc(), F.col(user).asc()]
    if undefined_first:
        # the dense form's NaN sorts above every number and takes a neighbour slot
        order.insert(0, F.col(sim).isNull().desc())
    return order


def rate_all_items(um: DataFrame, target, k: int, drop_undefined: str = "after") -> DataFrame:
    """Every item for one user: the known rating, else the similarity-weighted mean of the ratings of the
    k raters most similar to the user (largest signed similarity; ties by lower user id).

    Weights are divided by sum(similarity), not sum(|similarity|), so an estimate may leave the scale.
    Users with undefined similarity (zero norm) rank first and are dropped after ranking
    (``drop_undefined='after'``, the dense form) or before (``'before'``). No neighbour, or similarities
    summing to 0, gives null. The per-item top-k is ``row_number() <= k``, which Spark plans as a
    partial WindowGroupLimit before the shuffle, so a hot item ships at most k rows per map task.
    Output: (item_id, rating, is_known, n_neighbors).
    """
    sims = similarity_to_user(um, target, undefined="null").select("user_id", "similarity")
    if drop_undefined == "before":
        sims = sims.where(F.col("similarity").isNotNull())
    # written first: the join of a hot user's ratings is split only between two plain shuffles
    raters = um.where(F.col("user_id") != F.lit(target)).join(reliable_checkpoint(sims), "user_id")
    w = Window.partitionBy("item_id").orderBy(*_neighbour_order("similarity", "user_id", drop_undefined == "after"))
    top = raters.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k)
    top = top.where(F.col("similarity").isNotNull())
    est = top.groupBy("item_id").agg(
        safe_div(F.sum(F.col("similarity") * F.col("rating")), F.sum("similarity")).alias("_est"),
        F.count(F.lit(1)).alias("n_neighbors"),
    )
    known = um.where(F.col("user_id") == F.lit(target)).select("item_id", F.col("rating").alias("_known"))
    items = um.select("item_id").distinct()
    return (
        items.join(known, "item_id", "left")
        .join(est, "item_id", "left")
        .select(
            "item_id",
            F.coalesce("_known", "_est").alias("rating"),
            F.col("_known").isNotNull().alias("is_known"),
            F.when(F.col("_known").isNull(), F.coalesce("n_neighbors", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_neighbors"),
        )
    )


ENTRY = ("_kind", "rating", "_sum", "_n", "_norm", "_asks", "_item")


def _rater_lists(lists: DataFrame, users: DataFrame, parts: int, only: tuple[int, int]) -> DataFrame:
    """(_k, _kind, _sent): the raters of each of its items for every asking user, of requested items (_kind 1) with what their similarity needs, and its own sums (_kind 2).

    ``lists`` is that of ``list_rows`` with the columns ENTRY: a rater (_kind 0) or a request (_kind 1) of the item. ``only`` for the users of these places.
    """

    def rows_of(column):
        size, (ids, *values) = flat(column)
        return np.repeat(np.arange(len(size)), size), ids, dict(zip(ENTRY, values, strict=True))

    def units(batch):
        row, ids, v = rows_of(batch["_l"])
        rated = v["_kind"] == 0
        end = np.cumsum(np.bincount(row[rated], minlength=batch.num_rows))
        start = np.concatenate(([0], end[:-1]))
        raters = ids[rated], [v[c][rated] for c in ("rating", "_sum", "_n", "_norm")]
        cut = batch["_own"].is_valid().to_numpy(zero_copy_only=False)
        whole = ~cut[row]
        sides = [(row[whole], ids[whole], {c: x[whole] for c, x in v.items()})]
        if cut.any():
            sides.append(rows_of(batch["_own"]))
        for row, ids, v in sides:
            # a user's request follows its rating
            next_too = np.concatenate(((row[1:] == row[:-1]) & (ids[1:] == ids[:-1]), [False]))[: len(ids)]
            own = (v["_kind"] == 0) & (v["_asks"] > 0)
            asked = own & next_too | (v["_kind"] == 1) & ~np.concatenate(([False], next_too[:-1]))[: len(ids)]
            for kind, at, n, mine in ((1, np.flatnonzero(asked), 4, ("_kind", "rating", "_item")), (0, np.flatnonzero(own & ~asked), 1, ("rating",))):
                yield kind, (ids[at], [v[c][at] for c in mine], start[row[at]], end[row[at]], raters[0], raters[1][:n])

    def sent(batches):
        return blob_batches(((k, kind, b) for batch in gathered(batches) for kind, u in units(batch) for k, b in sends(*u, parts, only)), names)

    def own_sums(batches):
        def blobs():
            for batch in batches:
                ids, *values = (c.to_numpy() for c in batch.columns)
                at = np.arange(len(ids))
                yield from ((k, 2, b) for k, b in sends(ids, values, at, at + 1, ids, [], parts, only))

        return blob_batches(blobs(), names)

    names, schema = ["_k", "_kind", "_sent"], "_k int, _kind int, _sent binary"
    return lists.mapInArrow(sent, schema).unionByName(users.where("_asks > 0").select("user_id", "_sum", "_n", "_norm").mapInArrow(own_sums, schema))


def _best_raters(table: pa.Table, k: int, include_self: bool) -> pa.Table:
    """(user_id, item_id, estimate, n_neighbors) of every requested cell of the users whose lists (``_rater_lists``) are in ``table``."""
    kinds = table["_kind"].to_numpy()
    n_own = {0: 1, 1: 3, 2: 3}
    sides = {kind: received(table["_sent"].filter(pa.array(kinds == kind)), n) for kind, n in n_own.items() if (kinds == kind).any()}
    schema = pa.schema([("user_id", pa.int64()), ("item_id", pa.int64()), ("estimate", pa.float64()), ("n_neighbors", pa.int64())])
    if 1 not in sides or 2 not in sides:
        return schema.empty_table()  # no request, or none of a user with ratings
    users = np.unique(np.concatenate([s[0] for s in sides.values()]))
    mean, norm = np.full(len(users), np.nan), np.zeros(len(users))
    member, _, (total, n, root), *_ = sides[2]
    u = np.searchsorted(users, member)
    mean[u], norm[u] = total / n, root
    member, size, (kind_own, own_rating, item), nb, (rating, total, n, root) = sides[1]
    u, has = np.searchsorted(users, member), kind_own == 0
    unit = np.repeat(np.arange(len(size)), size)
    others, number = np.unique(nb, return_inverse=True)
    pairs, first, pair = np.unique(u[unit] * len(others) + number, return_index=True, return_inverse=True)
    nb_mean = (total / n)[first]
    at = np.flatnonzero(has[unit])
    dot = np.bincount(pair[at], weights=(own_rating - mean[u])[unit[at]] * (rating[at] - nb_mean[pair[at]]), minlength=len(pairs))
    if 0 in sides:
        member0, size0, (own_rating0,), nb0, (rating0,) = sides[0]
        u0 = np.searchsorted(users, member0)
        unit0 = np.repeat(np.arange(len(size0)), size0)
        number0 = np.minimum(np.searchsorted(others, nb0), len(others) - 1)
        at = np.flatnonzero(others[number0] == nb0)
        key = u0[unit0[at]] * len(others) + number0[at]
        p = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
        at, p = at[pairs[p] == key], p[pairs[p] == key]  # raters that no request of the user asks for are left out
        dot = dot + np.bincount(p, weights=(own_rating0 - mean[u0])[unit0[at]] * (rating0[at] - nb_mean[p]), minlength=len(pairs))
    norms = norm[pairs // len(others)] * root[first]
    sim = np.divide(dot, norms, out=np.zeros(len(pairs)), where=norms != 0)[pair]
    keep = ~np.isnan(mean[u])[unit]  # a user without ratings has no neighbours
    if not include_self:
        keep &= nb != member[unit]
    keep = np.flatnonzero(keep)
    sim, nb, rating, unit = sim[keep], nb[keep], rating[keep], unit[keep]
    items, item_no = np.unique(item, return_inverse=True)
    cells, cell = np.unique((u * len(items) + item_no)[unit], return_inverse=True)  # a large item's raters come in several lists
    rounded = np.copysign(np.floor(np.abs(sim) * 1e9 + 0.5), sim)
    order = np.lexsort((nb, -rounded, cell))
    sim, rating, cell = sim[order], rating[order], cell[order]
    start = np.searchsorted(cell, np.arange(len(cells)))
    top = np.arange(len(cell)) - start[cell] < k
    sim, rating, cell = sim[top], rating[top], cell[top]
    weight, value = (np.bincount(cell, weights=x, minlength=len(cells)) for x in (sim, sim * rating))
    estimate = np.divide(value, weight, out=np.zeros(len(cells)), where=weight != 0)  # similarities that add up to 0 give none
    cols = [users[cells // len(items)], items[cells % len(items)], pa.array(estimate, mask=weight == 0), np.bincount(cell, minlength=len(cells))]
    return pa.table([pa.array(c) for c in cols], schema=schema)


def estimate_ratings(
    um: DataFrame, requests: DataFrame, k: int, include_self: bool = False, tile_rows: int = 2048, task_entries: int = 1 << 20, wave_entries: int = 1 << 28
) -> DataFrame:
    """Estimate many requested (user_id, item_id) cells.

    Similarity is the centred cosine (full norms, 0 when a norm is 0) between the requesting user and
    each rater of the requested item; the k most similar raters (ties: lower id) give the weighted mean.
    A requesting user is sent the raters of each of its items and of the requested ones, packed (``member_lists``): its candidates, their products with it and the
    best of them come from there, so that neither candidates nor pairs are rows. An item of many raters is cut into chunks. Where more than ``wave_entries``
    raters are sent, the users take turns, and the shuffled lists of one turn go before the next. Output: (user_id, item_id, estimate, n_neighbors).
    """
    spark = um.sparkSession
    req = written(requests.select("user_id", "item_id").distinct())
    asks = req.select(F.col("user_id").cast("bigint")).distinct().withColumn("_asks", F.lit(1).cast("bigint"))
    sums = center_ratings(um, totals=True).groupBy("user_id").agg(F.max("_sum").alias("_sum"), F.max("_n").alias("_n"), F.sqrt(F.sum(F.col("centered") ** 2)).alias("_norm"))
    sums = sums.select(F.col("user_id").cast("bigint"), "_sum", "_n", "_norm")
    users = written(sums.join(asks, "user_id", "left").withColumn("_asks", F.coalesce("_asks", F.lit(0).cast("bigint"))))
    zero, none = F.lit(0).cast("bigint"), F.lit(0.0)
    rated = um.select(F.col("item_id").cast("bigint"), F.col("user_id").cast("bigint"), F.col("rating").cast("double")).where("item_id IS NOT NULL")
    wanted = req.where("user_id IS NOT NULL AND item_id IS NOT NULL").select(
        F.col("item_id").cast("bigint"), F.col("user_id").cast("bigint"), F.lit(1).cast("bigint").alias("_kind"),
        none.alias("rating"), none.alias("_sum"), zero.alias("_n"), none.alias("_norm"), zero.alias("_asks"),
    )
    # sizes come from the plain tables: the users' columns do not travel for them
    deg = written(rated.select("item_id").unionByName(wanted.select("item_id")).groupBy("item_id").agg(F.count(F.lit(1)).alias("_deg")).where("_deg > 1"))
    total = int(deg.agg(F.sum(F.col("_deg").cast("double") * F.col("_deg"))).first()[0] or 0)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // task_entries))
    entries = rated.join(users, "user_id").withColumn("_kind", zero).unionByName(wanted)
    lists = list_rows(entries.join(deg, "item_id").withColumn("_item", F.col("item_id")), "item_id", "user_id", ENTRY, tile_rows)
    waves = min(parts, max(1, -(-total // wave_entries)))
    if waves > 1:
        lists = written(lists)

    def estimated(only):
        sent = _rater_lists(lists, users, parts, only)
        return sent.groupBy("_k").applyInArrow(lambda t: _best_raters(t, k, include_self), "user_id bigint, item_id bigint, estimate double, n_neighbors bigint")

    turns = [(parts * w // waves, parts * (w + 1) // waves) for w in range(waves)]
    est = estimated(turns[0]) if waves == 1 else reduce(DataFrame.unionByName, [written(estimated(t)) for t in turns])
    return req.join(est, ["user_id", "item_id"], "left").select(
        "user_id", "item_id", "estimate", F.coalesce("n_neighbors", F.lit(0)).cast("bigint").alias("n_neighbors")
    )
