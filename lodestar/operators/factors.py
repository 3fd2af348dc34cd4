"""Latent factors on long ratings: dictionary encoding, exact seeded split, factor init, prediction, MSE,
full-batch gradient steps (with and without L2), a training loop with learning-rate schedule, and ALS.

Factor tables are wide: (id, f0 .. f{k-1}) DOUBLE, so a prediction is k multiplications inside one
codegen'd projection and a gradient is k sums in one aggregate. ``factors_long`` gives (side, id, f, value).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import normal_from_key, seeded_key
from .groups import global_row_number, written


# ---------------------------------------------------------------- encoding and split


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """(value, cnt, idx): values by falling frequency, ties by value; idx starts at 1, 0 is the unknown slot.

    Vocabulary size including the unknown slot = number of rows + 1.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("value").isNotNull())
    ranked = global_row_number(counts, [F.col("cnt").desc(), F.col("value").asc()], "idx")
    return ranked.select("value", "cnt", F.col("idx").cast("bigint"))


def apply_vocabulary(df: DataFrame, column: str, vocab: DataFrame, out: str | None = None) -> DataFrame:
    """Replace ``column`` by its index; values missing from the vocabulary map to 0."""
    v = vocab.select(F.col("value").alias("_v"), F.col("idx").alias("_idx"))
    j = df.join(v, df[column] == F.col("_v"), "left")
    return j.withColumn(out or column, F.coalesce(F.col("_idx"), F.lit(0)).cast("bigint")).drop("_v", "_idx")


def split_order(ratings: DataFrame, seed: int, keys: Sequence[str] = ("user_id", "item_id")) -> DataFrame:
    """Seeded shuffle: every row gets ``rank`` (1..n) in the order of md5('seed:key1:key2'), key-unique."""
    k = F.md5(seeded_key(seed, *[F.col(c) for c in keys]))
    return global_row_number(ratings, [k], "rank", write=written)


def assign_split(ranked: DataFrame, ratios: Sequence[float] = (0.8, 0.1, 0.1)) -> DataFrame:
    """split = train for rank <= int(n*r0), valid for the next int(n*r1), test for the rest (exact sizes)."""
    n = ranked.select(F.count(F.lit(1))).scalar()
    n_train = F.floor(n * F.lit(float(ratios[0])))
    n_valid = F.floor(n * F.lit(float(ratios[1])))
    split = (
        F.when(F.col("rank") <= n_train, F.lit("train"))
        .when(F.col("rank") <= n_train + n_valid, F.lit("valid"))
        .otherwise(F.lit("test"))
    )
    return ranked.withColumn("split", split)


# ---------------------------------------------------------------- factors


def fcols(k: int) -> list[str]:
    return [f"f{i}" for i in range(k)]


def init_factors(ids: DataFrame, id_col: str, side: str, k: int, seed: int) -> DataFrame:
    """Standard normal factors per id: Box-Muller on md5('seed:side:id:f'), the same under any partitioning."""
    return ids.select(
        F.col(id_col).alias("id"),
        *[normal_from_key(seeded_key(seed, side, F.col(id_col), i)).alias(f) for i, f in enumerate(fcols(k))],
    )


def factors_long(factors: DataFrame, side: str, k: int) -> DataFrame:
    return factors.select(
        F.lit(side).alias("side"), "id", F.posexplode(F.array(*fcols(k))).alias("f", "value")
    )


def _dot(k: int, a: str, b: str) -> Column:
    terms = [F.col(f"{a}{i}") * F.col(f"{b}{i}") for i in range(k)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def _with_factors(ratings: DataFrame, item_f: DataFrame, user_f: DataFrame, k: int) -> DataFrame:
    u = item_f.select(F.col("id").alias("item_id"), *[F.col(f).alias(f"u{i}") for i, f in enumerate(fcols(k))])
    v = user_f.select(F.col("id").alias("user_id"), *[F.col(f).alias(f"v{i}") for i, f in enumerate(fcols(k))])
    return ratings.join(u, "item_id").join(v, "user_id")


def predict(ratings: DataFrame, item_f: DataFrame, user_f: DataFrame, k: int) -> DataFrame:
    """The columns of ``ratings`` and prediction = U[item] . V[user]: two equi joins, never the full product."""
    j = _with_factors(ratings, item_f, user_f, k)
    return j.select(*ratings.columns, _dot(k, "u", "v").alias("prediction"))


def mse(pred: DataFrame) -> DataFrame:
    return pred.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("rating") - F.col("prediction")) ** 2).alias("mse"))


def mse_by_batch(pred_ranked: DataFrame, batch_size: int) -> DataFrame:
    """Batches of ``batch_size`` consecutive ranks: mean of the batch MSEs (a short last batch weighs the
    same, as a mean over a list of batch losses does) and the row-weighted MSE."""
    b = pred_ranked.withColumn("_batch", F.floor((F.col("rank") - 1) / batch_size))
    per = b.groupBy("_batch").agg(
        F.avg((F.col("rating") - F.col("prediction")) ** 2).alias("_m"),
        F.sum((F.col("rating") - F.col("prediction")) ** 2).alias("_s"),
        F.count(F.lit(1)).alias("_n"),
    )
    return per.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.avg("_m").alias("mean_batch_mse"),
        (F.sum("_s") / F.sum("_n")).alias("row_mse"),
    )


def sgd_step(batch: DataFrame, item_f: DataFrame, user_f: DataFrame, k: int, lr: float, reg: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """One gradient step of mean squared error (+ reg * (sum U^2 + sum V^2)) over one batch.

    e = r - U[i].V[u]; U[i] += lr*(2/B)*sum_u e*V[u], V[u] += lr*(2/B)*sum_i e*U[i], both from the old
    values; with reg every row of both tables first shrinks by (1 - 2*lr*reg), in the batch or not.
    Gradients are k sums in one aggregate over both sides; the update is a left join onto all factor rows.
    """
    n = batch.select(F.count(F.lit(1))).scalar()
    # the error is scaled by lr*2/B once per rating row, so the batch-size subquery appears in one place
    scaled = (F.col("rating") - _dot(k, "u", "v")) * (F.lit(2.0 * lr) / n)
    j = _with_factors(batch, item_f, user_f, k).withColumn("_e", scaled)

    def part(side, other):
        g = [(F.col("_e") * F.col(f"{other}{i}")).alias(f"_g{i}") for i in range(k)]
        return F.struct(F.lit(side).alias("_side"), F.col(f"{side}_id").alias("id"), *g)

    # both gradients come from one pass over the joined rows, written before the two updates read them
    parts = j.select(F.inline(F.array(part("item", "v"), part("user", "u"))))
    grads = written(parts.groupBy("_side", "id").agg(*[F.sum(f"_g{i}").alias(f"_g{i}") for i in range(k)]))
    shrink = F.lit(1.0 - 2.0 * lr * reg)

    def update(fac, side):
        x = fac.join(grads.where(F.col("_side") == side).drop("_side"), "id", "left")
        return x.select("id", *[(F.col(f) * shrink + F.coalesce(F.col(f"_g{i}"), F.lit(0.0))).alias(f) for i, f in enumerate(fcols(k))])

    return update(item_f, "item"), update(user_f, "user")


def learning_rate(epoch: int, fixed: float | None = None, initial: float = 1.0, decay: float = 0.99, steps: int = 2) -> float:
    """Fixed rate, else initial * decay ** (epoch / steps) (a real exponent, no staircase)."""
    return fixed if fixed is not None else initial * decay ** (epoch / steps)


@dataclass
class FitConfig:
    k: int = 10
    epochs: int = 10
    batches_per_epoch: int = 4
    reg: float = 0.0
    fixed_lr: float | None = None
    lr_initial: float = 1.0
    lr_decay: float = 0.99
    lr_steps: int = 2
    seed: int = 42
    normalize: str = "batch"  # or "row", see ``training``


def fit_factors(train: DataFrame, valid: DataFrame, item_f: DataFrame, user_f: DataFrame, cfg: FitConfig):
    """Mini-batch gradient descent (``training.fit_factors``): the factors of both sides and a report (epoch, lr, train_loss, valid_mse)."""
    from . import training

    return training.fit_factors(train, valid, item_f, user_f, cfg)


def grid_search(train, valid, item_f, user_f, lrs: Sequence[float], regs: Sequence[float], cfg: FitConfig) -> DataFrame:
    """Validation MSE for every (lr, reg), all trained in the same passes; ``training.grid_search`` also refits the best pair."""
    from . import training

    return training.grid_search(train, valid, item_f, user_f, lrs, regs, cfg).report.select("lr", "reg", "valid_mse")


def dense_ids(df: DataFrame, column: str) -> DataFrame:
    """(column, idx INT from 1): a dense index of a column's distinct values in ascending order."""
    return global_row_number(df.select(column).where(F.col(column).isNotNull()).distinct(), [column], name="idx", write=written).select(column, F.col("idx").cast("int"))


def als_fit(train: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.1, seed: int = 42):
    """Spark ML ALS as the factoriser at scale (blocked, checkpointed by Spark); rows of an unseen
    user or item keep a NaN prediction. Ids must fit an INT: index them densely first (``dense_ids``)."""
    from pyspark.ml.recommendation import ALS

    als = ALS(
        rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol="user_id", itemCol="item_id",
        ratingCol="rating", coldStartStrategy="nan", nonnegative=False,
    )
    return als.fit(train.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating"))


def als_grid_search(train: DataFrame, ranks: Sequence[int], regs: Sequence[float], max_iter: int = 10, seed: int = 42, train_ratio: float = 0.8):
    """Grid over (rank, regParam) for ALS with Spark ML ``TrainValidationSplit`` (RMSE on the held-out
    part); returns the fitted ``TrainValidationSplitModel`` (``bestModel``, ``validationMetrics``)."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.recommendation import ALS
    from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit

    als = ALS(maxIter=max_iter, seed=seed, userCol="user_id", itemCol="item_id", ratingCol="rating", coldStartStrategy="drop")
    grid = ParamGridBuilder().addGrid(als.rank, list(ranks)).addGrid(als.regParam, list(regs)).build()
    ev = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    tvs = TrainValidationSplit(estimator=als, estimatorParamMaps=grid, evaluator=ev, trainRatio=train_ratio, seed=seed)
    return tvs.fit(train.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating"))
