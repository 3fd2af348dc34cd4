"""Mini-batch training of latent factors over ratings that are placed once: one model, or all points of a grid together.

*Placement.* Items and users are hashed to p ranges each. A rating belongs to block (item range, user range); blocks are written once, bucketed and
sorted, so that no step shuffles ratings. A hot item's ratings lie in p blocks, by user, and a hot user's likewise. ``routes`` holds, once, which
blocks of a part need which item's and user's factors.

*Step.* The factor rows, all models of a grid in one row, travel to the blocks that need them for this batch, every block computes the errors of its ratings
and its part of the gradients with numpy, and the parts are summed by (side, id). That is one pass over the ratings of the batch, whatever the number of
models; the batch's loss comes from the same pass. The new factors are written before the next step.

Gradients are those of the mean squared error of the batch plus reg * (sum U^2 + sum V^2), both sides from the old values. ``normalize='batch'`` divides a
row's gradient by the batch's ratings (the literal mean: with large batches each row moves little), ``'row'`` by the row's own ratings in the batch.

Ratings without a factor row on either side take no part. An empty batch changes nothing and has no loss.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .factors import FitConfig, fcols, learning_rate
from .groups import reliable_checkpoint, written
from .stored import write_bucketed

ITEM, USER, LOSS = "item", "user", "loss"
ROWS_PER_BLOCK = 1 << 21  # of all parts; larger blocks share more factor rows


@dataclass(frozen=True)
class PlacedRatings:
    """``cells`` (block, part, item_id, user_id, rating) bucketed by block, ``routes`` (part, side, id, blocks ARRAY<INT>), ratings per part.

    Block = item range * ranges + user range.
    """

    cells: DataFrame
    routes: DataFrame
    sizes: dict
    ranges: int


def place_ratings(ratings: DataFrame, rows_per_block: int | None = None) -> PlacedRatings:
    """``ratings`` (part STRING, item_id, user_id, rating): a part is what one step or one evaluation reads (a batch, the validation rows).

    They are read twice, for the parts' sizes and to be placed: write a costly input first.
    """
    spark = ratings.sparkSession
    x = ratings.select("part", "item_id", "user_id", F.col("rating").cast("double").alias("rating"))
    sizes = {r["part"]: r["n"] for r in x.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a part
    side = max(math.isqrt(2 * spark.sparkContext.defaultParallelism - 1) + 1, math.isqrt(sum(sizes.values()) // (rows_per_block or ROWS_PER_BLOCK)) + 1)
    block = F.pmod(F.xxhash64("item_id"), F.lit(side)) * side + F.pmod(F.xxhash64("user_id"), F.lit(side))
    cells = write_bucketed(x.select(block.cast("int").alias("block"), "*"), "block", side * side, ["block", "part"])
    both = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_id").cast("bigint").alias("id")) for s in (ITEM, USER)])
    pairs = cells.select("block", "part", F.inline(both)).distinct()  # within a block: not shuffled
    routes = written(pairs.groupBy("part", "side", "id").agg(F.collect_list("block").alias("blocks")))  # at most ``side`` blocks
    return PlacedRatings(cells, routes, sizes, side)


def start_factors(item_f: DataFrame, user_f: DataFrame, k: int, models: int) -> DataFrame:
    """(model, side, id, f0 ..): every model starts from the same factors."""
    sides = [f.select(F.lit(s).alias("side"), F.col("id").cast("bigint").alias("id"), *[F.col(c).cast("double").alias(c) for c in fcols(k)]) for s, f in ((ITEM, item_f), (USER, user_f))]
    both = sides[0].unionByName(sides[1])
    return both.select(F.explode(F.sequence(F.lit(0), F.lit(models - 1))).alias("model"), "*")


def _wcols(m: int, k: int) -> list[str]:
    return [f"f{m}_{i}" for i in range(k)]


def _widen(factors: DataFrame, models: Sequence[int], k: int) -> DataFrame:
    """(side, id, f{model}_{i} ..) of (model, side, id, f0 ..): null where a model has no such row."""
    if len(models) == 1:
        own = [F.col(f).alias(w) for f, w in zip(fcols(k), _wcols(models[0], k), strict=True)]
        return factors.where(F.col("model") == models[0]).select("side", "id", *own)
    own = [F.max(F.when(F.col("model") == m, F.col(f))).alias(w) for m in models for f, w in zip(fcols(k), _wcols(m, k), strict=True)]
    return factors.groupBy("side", "id").agg(*own)


def _narrow(wide: DataFrame, models: Sequence[int], k: int) -> DataFrame:
    """The inverse of ``_widen``."""
    rows = [F.struct(F.lit(m).alias("model"), "side", "id", *[F.col(w).alias(f) for f, w in zip(fcols(k), _wcols(m, k), strict=True)]) for m in models]
    return wide.select(F.inline(F.array(*rows))).where(F.col("f0").isNotNull())


def _sums(placed: PlacedRatings, wide: DataFrame, models: Sequence[int], part: str, k: int, learn: bool) -> DataFrame:
    """(side, id, n{model}, g{model}_{i} ..) summed over the blocks: gradient sums of every row in ``part``, and one ``loss`` row (g{model}_0 = squared error)."""
    sums = [(f"n{m}", pa.int64()) for m in models] + [(f"g{m}_{i}", pa.float64()) for m in models for i in range(k)]
    schema = pa.schema([("side", pa.string()), ("id", pa.int64()), *sums])
    types = ", ".join(["side string", "id bigint", *[f"{c} {'bigint' if t == pa.int64() else 'double'}" for c, t in sums]])

    def rows(side, ids, n, g):
        """``n`` a column a model, ``g`` k columns a model; rows without a rating are left out."""
        some = np.flatnonzero(np.any(n, axis=0))
        cols = [pa.array([side] * len(some), pa.string()), pa.array(ids[some]), *[pa.array(c[some].astype(np.int64)) for c in n], *[pa.array(c[some]) for c in g]]
        return pa.record_batch(cols, schema=schema)

    def block(key, cells, routed):
        if not len(cells) or not len(routed):
            return schema.empty_table()
        item, user, rating = cells["item_id"].to_numpy(), cells["user_id"].to_numpy(), cells["rating"].to_numpy()
        is_item, ids = pc.equal(routed["side"], ITEM).to_numpy(), routed["id"].to_numpy()
        at, own_ids, order, known = [], [], [], np.ones(len(item), dtype=bool)
        for own, wanted in ((is_item, item), (~is_item, user)):
            pick = np.flatnonzero(own)
            if not len(pick):
                return schema.empty_table()
            pick = pick[np.argsort(ids[pick])]
            p = np.minimum(np.searchsorted(ids[pick], wanted), len(pick) - 1)
            known &= ids[pick][p] == wanted
            at.append(p)
            own_ids.append(ids[pick])
            order.append(pick)
        n, g, counts, squares = ([], []), ([], []), [], []
        for m in models:
            columns = [routed[w] for w in _wcols(m, k)]
            there = columns[0].is_valid().to_numpy()
            both = known & there[order[0]][at[0]] & there[order[1]][at[1]]
            i, u = at[0][both], at[1][both]
            values = np.column_stack([c.to_numpy() for c in columns])
            item_v, user_v = values[order[0]][i], values[order[1]][u]
            e = rating[both] - np.einsum("ij,ij->i", item_v, user_v)
            counts.append(np.array([len(e)]))
            squares += [np.array([e @ e]), *[np.zeros(1)] * (k - 1)]
            if learn:
                for s, (own, other) in enumerate(((i, user_v), (u, item_v))):
                    n[s].append(np.bincount(own, minlength=len(own_ids[s])))
                    g[s].extend(np.bincount(own, e * other[:, f], minlength=len(own_ids[s])) for f in range(k))
        out = [rows(LOSS, np.zeros(1, dtype=np.int64), counts, squares)]
        if learn:
            out += [rows(side, own_ids[s], n[s], g[s]) for s, side in enumerate((ITEM, USER))]
        return pa.Table.from_batches(out, schema=schema)

    cells = placed.cells.where(F.col("part") == part).select("block", "item_id", "user_id", "rating")
    columns = [w for m in models for w in _wcols(m, k)]
    routed = placed.routes.where(F.col("part") == part).join(wide.select("side", "id", *columns), ["side", "id"]).select(F.explode("blocks").alias("block"), "side", "id", *columns)
    added = cells.groupBy("block").cogroup(routed.groupBy("block")).applyInArrow(block, types)
    return added.groupBy("side", "id").agg(*[F.sum(c).alias(c) for c, _ in sums])


def _models(factors: DataFrame) -> list[int]:
    return sorted(r["model"] for r in factors.select("model").distinct().collect())  # one row a model


def _pass(placed: PlacedRatings, factors: DataFrame, part: str, k: int, learn: bool) -> DataFrame:
    """(model, side, id, n, g0 ..): ``_sums`` of factors given as (model, side, id, f0 ..)."""
    models = _models(factors)
    sums = _sums(placed, _widen(factors, models, k), models, part, k, learn)
    rows = [F.struct(F.lit(m).alias("model"), "side", "id", F.col(f"n{m}").alias("n"), *[F.col(f"g{m}_{i}").alias(f"g{i}") for i in range(k)]) for m in models]
    return sums.select(F.inline(F.array(*rows))).where(F.col("n") > 0)


def _step(placed, wide, part, k, rates, regs, normalize) -> tuple[DataFrame, list]:
    """New factors (written; one more row carries the batch's errors) and the batch's loss of every model, both from one pass."""
    models, total = range(len(rates)), float(placed.sizes[part])
    sums = _sums(placed, wide, models, part, k, True)
    is_loss, columns = F.col("side") == LOSS, []
    for m, (rate, reg) in enumerate(zip(rates, regs, strict=True)):
        by = F.lit(total) if normalize == "batch" else F.nullif(F.col(f"n{m}"), F.lit(0))
        for i, w in enumerate(_wcols(m, k)):
            move = F.coalesce(F.lit(rate * 2.0) * F.col(f"g{m}_{i}") / by, F.lit(0.0))
            columns.append(F.when(~is_loss, F.col(w) * F.lit(1.0 - rate * 2.0 * reg) + move).alias(w))
        square = sum((F.col(w) * F.col(w) for w in _wcols(m, k)), F.lit(0.0))
        columns.append(F.when(is_loss, F.col(f"g{m}_0") / F.lit(total)).otherwise(F.lit(float(reg)) * square).alias(f"_loss{m}"))
    old = wide.where(F.col("side") != LOSS).select("side", "id", *[w for m in models for w in _wcols(m, k)])
    new = written(old.join(sums, ["side", "id"], "full_outer").select("side", "id", *columns))
    return new, list(new.agg(*[F.sum(f"_loss{m}") for m in models]).first())


def _errors(placed: PlacedRatings, wide: DataFrame, models: Sequence[int], part: str, k: int) -> dict:
    r = _sums(placed, wide, models, part, k, False).where(F.col("side") == LOSS).first()
    return {m: r[f"g{m}_0"] / r[f"n{m}"] for m in models if r[f"n{m}"]} if r else {}


def evaluate(placed: PlacedRatings, factors: DataFrame, part: str, k: int) -> dict:
    """model -> mean squared error over the rows of ``part`` (a model without such rows is absent)."""
    models = _models(factors)
    return _errors(placed, _widen(factors, models, k), models, part, k) if models else {}


@dataclass(frozen=True)
class Fit:
    """``written`` factors (model, side, id, f0 ..) after the last step; ``report`` (model, epoch, lr, train_loss, valid_mse)."""

    written: DataFrame
    k: int
    report: DataFrame

    def side(self, side: str, model: int = 0) -> DataFrame:
        """(id, f0 ..) of one side of a model."""
        return self.written.where((F.col("side") == side) & (F.col("model") == model)).select("id", *fcols(self.k))


def fit_models(
    placed: PlacedRatings, batches: Sequence[str], valid: str, item_f: DataFrame, user_f: DataFrame, cfg: FitConfig, points: Sequence[tuple] = ((None, None),)
) -> Fit:
    """Train one model a point (fixed learning rate, reg; None = the configuration's) over the same passes."""
    if cfg.normalize not in ("batch", "row"):
        raise ValueError("normalize must be 'batch' or 'row'")
    regs = [cfg.reg if reg is None else reg for _, reg in points]
    models = range(len(points))
    one = start_factors(item_f, user_f, cfg.k, 1)  # every model starts from the same row
    factors = written(one.select("side", "id", *[F.col(f).alias(w) for m in models for f, w in zip(fcols(cfg.k), _wcols(m, cfg.k), strict=True)]))
    report = []
    for epoch in range(cfg.epochs):
        rates = [learning_rate(epoch, cfg.fixed_lr if lr is None else lr, cfg.lr_initial, cfg.lr_decay, cfg.lr_steps) for lr, _ in points]
        losses = []
        for part in batches:
            if placed.sizes.get(part):
                factors, loss = _step(placed, factors, part, cfg.k, rates, regs, cfg.normalize)
                losses.append(loss)
        mse = _errors(placed, factors, models, valid, cfg.k) if placed.sizes.get(valid) else {}
        for m in models:
            mean = sum(x[m] for x in losses) / len(losses) if losses else None
            report.append((m, epoch, float(rates[m]), mean, mse.get(m)))
    spark = item_f.sparkSession
    return Fit(_narrow(factors, models, cfg.k), cfg.k, spark.createDataFrame(report, "model INT, epoch INT, lr DOUBLE, train_loss DOUBLE, valid_mse DOUBLE"))


def batch_name(b: int) -> str:
    return f"batch{b}"


def split_parts(train: DataFrame, valid: DataFrame, batches: int, test: DataFrame | None = None) -> DataFrame:
    """The parts of a split: training rows by rank mod ``batches``, ``valid`` and ``test``."""
    cols = ["item_id", "user_id", "rating"]
    x = train.select(F.concat(F.lit("batch"), F.pmod(F.col("rank"), F.lit(batches)).cast("string")).alias("part"), *cols)
    for name, rows in (("valid", valid), ("test", test)):
        if rows is not None:
            x = x.unionByName(rows.select(F.lit(name).alias("part"), *cols))
    return x


def fit_factors(train: DataFrame, valid: DataFrame, item_f: DataFrame, user_f: DataFrame, cfg: FitConfig):
    """Mini-batch gradient descent (batch = rank mod batches). Returns the factors and a report
    (epoch, lr, train_loss, valid_mse): the mean of the batches' losses before their steps, and the validation error after the epoch."""
    placed = place_ratings(split_parts(train, valid, cfg.batches_per_epoch))
    fit = fit_models(placed, [batch_name(b) for b in range(cfg.batches_per_epoch)], "valid", item_f, user_f, cfg)
    return fit.side(ITEM), fit.side(USER), fit.report.drop("model")


@dataclass(frozen=True)
class Grid:
    """``report`` (lr, reg, valid_mse, best, test_mse: the refit's, for the best pair) and the refit's factors."""

    report: DataFrame
    item_factors: DataFrame
    user_factors: DataFrame


def grid_search(
    train: DataFrame, valid: DataFrame, item_f: DataFrame, user_f: DataFrame, lrs: Sequence[float], regs: Sequence[float], cfg: FitConfig,
    test: DataFrame | None = None, refit_epochs: int | None = None,
) -> Grid:
    """Validation error of every (lr, reg), all points trained in the same passes; then the best pair (least error, then the first) is refitted.

    The refit starts again from the given factors and runs ``refit_epochs`` (those of the grid unless given) on the training rows; ``test`` rows,
    if given, are evaluated with it. A refit of as many epochs would repeat the point's own steps, so its factors are taken as they are.
    """
    points = [(lr, reg) for lr in lrs for reg in regs]
    names = [batch_name(b) for b in range(cfg.batches_per_epoch)]
    placed = place_ratings(split_parts(train, valid, cfg.batches_per_epoch, test))
    fit = fit_models(placed, names, "valid", item_f, user_f, cfg, points)
    last = fit.report.where(F.col("epoch") == cfg.epochs - 1).collect()  # one row a point
    mse = {r["model"]: r["valid_mse"] for r in last}
    best = min(range(len(points)), key=lambda m: (mse[m] is None or math.isnan(mse[m]), mse[m] or 0.0, m))
    model = best
    if refit_epochs not in (None, cfg.epochs):
        again = FitConfig(**{**cfg.__dict__, "epochs": refit_epochs})
        fit, model = fit_models(placed, names, "valid", item_f, user_f, again, [points[best]]), 0
    own = fit.written.where(F.col("model") == model)
    error = evaluate(placed, own, "test", cfg.k).get(model) if placed.sizes.get("test") else None
    rows = [(float(lr), float(reg), mse[m], m == best, error if m == best else None) for m, (lr, reg) in enumerate(points)]
    report = item_f.sparkSession.createDataFrame(rows, "lr DOUBLE, reg DOUBLE, valid_mse DOUBLE, best BOOLEAN, test_mse DOUBLE")
    return Grid(report, fit.side(ITEM, model), fit.side(USER, model))


# ---------------------------------------------------------------- one rating at a time


def _record_steps(item, user, rating, U, V, lr: float, reg: float):
    """One pass over a block's ratings: each moves its item's and its user's factors before the next is read. Rows of U and V are lists of floats."""
    # a fixed order that follows neither ids nor partitioning
    order = np.argsort((item.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (user.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)), kind="stable")
    for i, u, r in zip(item[order].tolist(), user[order].tolist(), rating[order].tolist(), strict=True):
        a, b = U.get(i), V.get(u)
        if a is None or b is None:
            continue
        e = r - sum(x * y for x, y in zip(a, b, strict=True))
        U[i] = [x + lr * (e * y - reg * x) for x, y in zip(a, b, strict=True)]
        V[u] = [y + lr * (e * x - reg * y) for x, y in zip(a, b, strict=True)]


def stratified_sgd(placed: PlacedRatings, part: str, item_f: DataFrame, user_f: DataFrame, k: int, epochs: int, lr: float, reg: float = 0.0, valid: str | None = None) -> Fit:
    """Per-record gradient descent, U[i] += lr (e V[u] - reg U[i]) and V[u] alike, in strata.

    A strictly sequential pass cannot be dealt out, but ratings that share neither item nor user do not touch each other. The blocks (d, d + s) of the grid
    of ranges, for one s, share no range: they run at the same time, each in the order of its own ratings, and an epoch takes as many strata as there
    are ranges. The result is that of one sequential pass over the strata. The report gives the error over ``part`` (and ``valid``) after each epoch;
    epoch -1 is before the first.
    """
    types = f"side string, id bigint, {', '.join(f'{f} double' for f in fcols(k))}"
    schema = pa.schema([("side", pa.string()), ("id", pa.int64()), *[(f, pa.float64()) for f in fcols(k)]])

    def block(key, cells, routed):
        if not len(cells):
            return schema.empty_table()
        rows = list(zip(*[routed[f].to_pylist() for f in fcols(k)], strict=True))
        tables = {ITEM: {}, USER: {}}
        for side, i, f in zip(routed["side"].to_pylist(), routed["id"].to_pylist(), rows, strict=True):
            tables[side][i] = list(f)
        _record_steps(*[cells[c].to_numpy() for c in ("item_id", "user_id", "rating")], tables[ITEM], tables[USER], lr, reg)
        flat = [(s, i, *f) for s, t in tables.items() for i, f in t.items()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*flat, strict=True), schema.types, strict=True)], schema=schema) if flat else schema.empty_table()

    factors = reliable_checkpoint(start_factors(item_f, user_f, k, 1))
    own = placed.cells.where(F.col("part") == part).select("block", "item_id", "user_id", "rating")
    routes = placed.routes.where(F.col("part") == part).select(F.explode("blocks").alias("block"), "side", "id")
    report = []

    def measure(epoch):
        errors = [evaluate(placed, factors, p, k).get(0) if p else None for p in (part, valid)]
        report.append((0, epoch, float(lr), *errors))

    measure(-1)
    for epoch in range(epochs):
        for s in range(placed.ranges):
            blocks = [d * placed.ranges + (d + s) % placed.ranges for d in range(placed.ranges)]
            cells = own.where(F.col("block").isin(blocks))
            routed = routes.where(F.col("block").isin(blocks)).join(factors.select("side", "id", *fcols(k)), ["side", "id"])
            moved = cells.groupBy("block").cogroup(routed.select("block", "side", "id", *fcols(k)).groupBy("block")).applyInArrow(block, types)
            moved = moved.select("side", "id", *[F.col(f).alias(f"_{f}") for f in fcols(k)])  # an item or user lies in one block of a stratum
            factors = factors.join(moved, ["side", "id"], "left").select("model", "side", "id", *[F.coalesce(f"_{f}", f).alias(f) for f in fcols(k)])
            factors = reliable_checkpoint(factors)
        measure(epoch)
    return Fit(factors, k, item_f.sparkSession.createDataFrame(report, "model INT, epoch INT, lr DOUBLE, train_loss DOUBLE, valid_mse DOUBLE"))
