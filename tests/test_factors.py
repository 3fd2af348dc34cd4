import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import factors as FA
from lodestar.sources.files import ratings_by_name


def test_vocabulary_frequency_order_with_unknown_slot(spark):
    df = spark.createDataFrame([(v,) for v in "b a c a b a d".split()], "x STRING")
    voc = {r.value: (r.cnt, r.idx) for r in FA.vocabulary(df, "x").collect()}
    assert voc == {"a": (3, 1), "b": (2, 2), "c": (1, 3), "d": (1, 4)}
    probe = spark.createDataFrame([("a",), ("zzz",)], "x STRING")
    got = {r.x_orig: r.x for r in FA.apply_vocabulary(probe.withColumn("x_orig", F.col("x")), "x", FA.vocabulary(df, "x")).collect()}
    assert got == {"a": 1, "zzz": 0}


def test_split_sizes_are_exact(spark):
    df = spark.range(1003).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("item_id"), F.lit(1.0).alias("rating"))
    s = FA.assign_split(FA.split_order(df, 22))
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": int(1003 * 0.8), "valid": int(1003 * 0.1), "test": 1003 - int(1003 * 0.8) - int(1003 * 0.1)}
    ranks = sorted(r.rank for r in s.select("rank").collect())
    assert ranks == list(range(1, 1004))


def test_learning_rate_schedule():
    assert FA.learning_rate(0) == 1.0
    assert FA.learning_rate(4) == pytest.approx(0.99 ** 2)
    assert FA.learning_rate(3) == pytest.approx(0.99 ** 1.5)
    assert FA.learning_rate(7, fixed=0.1) == 0.1


def _dense(df_rows, ids, k, side):
    return {r.id: np.array([r[f] for f in FA.fcols(k)]) for r in df_rows}


def test_sgd_step_matches_numpy(spark):
    k = 3
    um = ratings_by_name(spark, "lecture_1")
    items = FA.init_factors(um.select("item_id").distinct(), "item_id", "item", k, 42)
    users = FA.init_factors(um.select("user_id").distinct(), "user_id", "user", k, 42)
    U = _dense(items.collect(), None, k, "item")
    V = _dense(users.collect(), None, k, "user")
    rows = um.collect()
    lr, reg = 0.5, 0.1
    gU = {i: np.zeros(k) for i in U}
    gV = {u: np.zeros(k) for u in V}
    for r in rows:
        e = r.rating - U[r.item_id] @ V[r.user_id]
        gU[r.item_id] += e * V[r.user_id]
        gV[r.user_id] += e * U[r.item_id]
    B = len(rows)
    ni, nu = FA.sgd_step(um, items, users, k, lr, reg)
    NI = _dense(ni.collect(), None, k, "item")
    NU = _dense(nu.collect(), None, k, "user")
    for i in U:
        np.testing.assert_allclose(NI[i], U[i] * (1 - 2 * lr * reg) + lr * 2 / B * gU[i], rtol=1e-9)
    for u in V:
        np.testing.assert_allclose(NU[u], V[u] * (1 - 2 * lr * reg) + lr * 2 / B * gV[u], rtol=1e-9)


def test_init_factors_look_standard_normal(spark):
    ids = spark.range(4000).select(F.col("id").alias("item_id"))
    f = FA.init_factors(ids, "item_id", "item", 2, 7)
    m = f.agg(F.avg("f0").alias("m"), F.stddev("f0").alias("s")).first()
    assert abs(m.m) < 0.06 and abs(m.s - 1) < 0.06


def test_fit_lowers_training_loss(spark):
    k = 2
    um = ratings_by_name(spark, "lecture_1")
    ranked = FA.split_order(um, 1)
    items = FA.init_factors(um.select("item_id").distinct(), "item_id", "item", k, 3)
    users = FA.init_factors(um.select("user_id").distinct(), "user_id", "user", k, 3)
    cfg = FA.FitConfig(k=k, epochs=6, batches_per_epoch=1, fixed_lr=0.05)
    _, _, rep = FA.fit_factors(ranked, ranked, items, users, cfg)
    losses = [r.train_loss for r in rep.orderBy("epoch").collect()]
    assert losses[-1] < losses[0]
    assert all(math.isfinite(x) for x in losses)


def test_mse_by_batch_weights(spark):
    rows = [(i, 0, 1.0, 0.0 if i < 4 else 1.0, i + 1) for i in range(5)]
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE, prediction DOUBLE, rank BIGINT")
    r = FA.mse_by_batch(df, 4).first()
    assert r.n_batches == 2
    assert r.mean_batch_mse == pytest.approx(0.5)  # (1 + 0) / 2
    assert r.row_mse == pytest.approx(0.8)  # 4 / 5


def test_als_fit_predicts(spark):
    um = ratings_by_name(spark, "lecture_1")
    model = FA.als_fit(um, rank=2, max_iter=3)
    out = model.transform(um.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating"))
    assert out.count() == um.count()


def test_grid_search_one_row_per_pair_and_best(spark):
    k = 2
    um = ratings_by_name(spark, "lecture_1")
    ranked = FA.split_order(um, 1)
    items = FA.init_factors(um.select("item_id").distinct(), "item_id", "item", k, 3)
    users = FA.init_factors(um.select("user_id").distinct(), "user_id", "user", k, 3)
    cfg = FA.FitConfig(k=k, epochs=2, batches_per_epoch=1)
    g = FA.grid_search(ranked, ranked, items, users, [0.01, 0.05], [0.0, 0.1], cfg)
    rows = g.collect()
    assert len(rows) == 4 and all(r.valid_mse is not None for r in rows)
    best = g.agg(F.min_by(F.struct("lr", "reg"), "valid_mse").alias("b")).first().b
    assert (best.lr, best.reg) == min(((r.lr, r.reg) for r in rows), key=lambda p: next(r.valid_mse for r in rows if (r.lr, r.reg) == p))


def test_als_grid_search(spark):
    import random

    rnd = random.Random(0)
    rows = [(u, i, float(rnd.randint(1, 5))) for u in range(30) for i in range(20) if rnd.random() < 0.5]
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    m = FA.als_grid_search(df, [2, 4], [0.1, 1.0], max_iter=3)
    assert len(m.validationMetrics) == 4
    assert min(m.validationMetrics) > 0


def test_fit_plan_does_not_grow_with_the_steps(spark):
    """With the default batches the factor tables are cut after every step."""
    m = spark.createDataFrame([(u, i, float(u + i)) for u in range(6) for i in range(5)], "user_id bigint, item_id bigint, rating double")
    s = FA.assign_split(FA.split_order(m, 1), (0.8, 0.1, 0.1))
    items = FA.init_factors(m.select("item_id").distinct(), "item_id", "item", 2, 1)
    users = FA.init_factors(m.select("user_id").distinct(), "user_id", "user", 2, 1)
    u, v, rep = FA.fit_factors(s.where("split = 'train'"), s.where("split = 'valid'"), items, users, FA.FitConfig(k=2, epochs=2, fixed_lr=0.01))
    assert rep.count() == 2
    for f in (u, v):
        assert len(f._jdf.queryExecution().logical().toString().splitlines()) < 5


def test_als_ids_beyond_an_int(spark):
    m = spark.createDataFrame([(3_000_000_000 + u, 5_000_000_000 + i, float(u * i % 5)) for u in range(8) for i in range(6)], "user_id bigint, item_id bigint, rating double")
    x = m.join(FA.dense_ids(m, "user_id").withColumnRenamed("idx", "u"), "user_id").join(FA.dense_ids(m, "item_id").withColumnRenamed("idx", "i"), "item_id")
    model = FA.als_fit(x.selectExpr("u AS user_id", "i AS item_id", "rating"), rank=2, max_iter=2)
    p = model.transform(spark.createDataFrame([(1, 1), (99, 1)], "user_id int, item_id int")).orderBy("user_id").collect()
    assert p[0]["prediction"] == p[0]["prediction"] and p[1]["prediction"] != p[1]["prediction"]


def test_large_steps_are_read_from_parquet(spark):
    """Ranks, dense ids and gradients are written by column; a row-wise checkpoint of them costs most of a step at size."""
    um = spark.createDataFrame([(u, i, float(u + i)) for u in range(6) for i in range(5) if (u + i) % 3], "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    items, users = (FA.init_factors(um.select(c).distinct(), c, c[:4], 2, 1) for c in ("item_id", "user_id"))
    ranked, (new_items, _) = FA.split_order(um, 3), FA.sgd_step(um, items, users, 2, 0.1)
    ids = FA.dense_ids(um.selectExpr("user_id * 10000000000 AS user_id"), "user_id")
    assert [tuple(r) for r in ids.orderBy("idx").collect()] == [(u * 10**10, u + 1) for u in range(6)]
    for df in (ranked, new_items, ids):
        assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()
