"""Placed ratings, training loop, grid and refit against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import factors as FA
from lodestar.operators import training as T

K = 3
TRAIN = 45


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(8)
    cells = sorted({(rnd.randrange(12), rnd.randrange(9)) for _ in range(70)} | {(u, 0) for u in range(12)})  # item 0 is hot
    rows = [(u, i, float(rnd.randint(1, 5)), n + 1) for n, (u, i) in enumerate(cells)]
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE, rank BIGINT")
    items = FA.init_factors(df.select("item_id").distinct(), "item_id", "item", K, 5)
    users = FA.init_factors(df.select("user_id").distinct(), "user_id", "user", K, 5)
    start = [{r["id"]: np.array([r[c] for c in FA.fcols(K)]) for r in f.collect()} for f in (items, users)]
    return df, rows, items, users, start


def numpy_fit(rows, start, cfg, lr=None, reg=None):
    U, V = ({k: v.copy() for k, v in s.items()} for s in start)
    reg = cfg.reg if reg is None else reg
    train, valid = [r for r in rows if r[3] <= TRAIN], [r for r in rows if r[3] > TRAIN]
    report = []
    for epoch in range(cfg.epochs):
        rate = FA.learning_rate(epoch, cfg.fixed_lr if lr is None else lr, cfg.lr_initial, cfg.lr_decay, cfg.lr_steps)
        losses = []
        for b in range(cfg.batches_per_epoch):
            batch = [r for r in train if r[3] % cfg.batches_per_epoch == b]
            e = {(u, i): x - U[i] @ V[u] for u, i, x, _ in batch}
            squares = sum((f @ f) for side in (U, V) for f in side.values())
            losses.append(np.mean([v * v for v in e.values()]) + reg * squares)
            new = []
            for own, other, at in ((U, V, 1), (V, U, 0)):
                out = {}
                for key, f in own.items():
                    mine = [(v, other[k[1 - at]]) for k, v in e.items() if k[at] == key]
                    n = len(batch) if cfg.normalize == "batch" else max(1, len(mine))
                    out[key] = f * (1 - 2 * rate * reg) + sum((v * o for v, o in mine), np.zeros(K)) * 2 * rate / n
                new.append(out)
            U, V = new
        report.append((epoch, rate, np.mean(losses), np.mean([(x - U[i] @ V[u]) ** 2 for u, i, x, _ in valid])))
    return U, V, report


def split(df):
    return df.where(f"rank <= {TRAIN}"), df.where(f"rank > {TRAIN}")


@pytest.mark.parametrize("normalize,reg,rows_per_block", [("batch", 0.0, 10), ("row", 0.02, 10), ("row", 0.0, 1 << 18)])
def test_training_is_that_of_numpy(spark, data, monkeypatch, normalize, reg, rows_per_block):
    df, rows, items, users, start = data
    monkeypatch.setattr(T, "ROWS_PER_BLOCK", rows_per_block)
    cfg = FA.FitConfig(k=K, epochs=2, batches_per_epoch=3, reg=reg, lr_initial=0.05, lr_decay=0.9, normalize=normalize)
    u, v, report = T.fit_factors(*split(df), items, users, cfg)
    U, V, want = numpy_fit(rows, start, cfg)
    for got, exp in ((u, U), (v, V)):
        got = {r["id"]: [r[c] for c in FA.fcols(K)] for r in got.collect()}
        assert got.keys() == exp.keys()
        for key, f in exp.items():
            np.testing.assert_allclose(got[key], f, rtol=1e-9)
    np.testing.assert_allclose([list(r) for r in report.orderBy("epoch").collect()], want, rtol=1e-9)


def test_grid_in_the_same_passes_and_refit(spark, data):
    df, rows, items, users, start = data
    cfg = FA.FitConfig(k=K, epochs=1, batches_per_epoch=2, normalize="row")
    lrs, regs = (0.01, 0.2), (0.0, 0.05)
    test = df.where("rank % 7 = 3")
    grid = T.grid_search(*split(df), items, users, lrs, regs, cfg, test, refit_epochs=3)
    got = {(r["lr"], r["reg"]): r for r in grid.report.collect()}
    want = {(lr, reg): numpy_fit(rows, start, cfg, lr, reg)[2][-1][3] for lr in lrs for reg in regs}
    for p, mse in want.items():
        assert got[p]["valid_mse"] == pytest.approx(mse)
    best = min(want, key=want.get)
    assert [p for p, r in got.items() if r["best"]] == [best] and all(r["test_mse"] is None for p, r in got.items() if p != best)
    longer = FA.FitConfig(**{**cfg.__dict__, "epochs": 3})
    U, V, _ = numpy_fit(rows, start, longer, *best)
    assert got[best]["test_mse"] == pytest.approx(np.mean([(x - U[i] @ V[u]) ** 2 for u, i, x, rank in rows if rank % 7 == 3]))
    refit = {r["id"]: r["f0"] for r in grid.item_factors.collect()}
    assert refit == pytest.approx({k: f[0] for k, f in U.items()})
    same = T.grid_search(*split(df), items, users, lrs, regs, cfg, test)  # as many epochs: the point's own factors
    U, V, _ = numpy_fit(rows, start, cfg, *best)
    assert {r["id"]: r["f1"] for r in same.user_factors.collect()} == pytest.approx({k: f[1] for k, f in V.items()})


def test_rows_without_factors_and_empty_parts(spark, data):
    df, _, items, users, _ = data
    cfg = FA.FitConfig(k=K, epochs=1, batches_per_epoch=1, fixed_lr=0.01)
    some = users.where("id < 6")
    _, v, report = T.fit_factors(df, df.where("false"), items, some, cfg)
    r = report.first()
    assert r["valid_mse"] is None and r["train_loss"] > 0 and v.count() == 6
    placed = T.place_ratings(T.split_parts(df, df.where("user_id >= 6"), 1))
    assert T.evaluate(placed, T.start_factors(items, some, K, 2), "valid", K) == {}
    _, _, report = T.fit_factors(df.where("false"), df, items, users, cfg)
    assert report.first()["train_loss"] is None and report.first()["valid_mse"] > 0
    with pytest.raises(ValueError, match="normalize"):
        T.fit_factors(df, df, items, users, FA.FitConfig(normalize="sum"))


def test_ratings_are_placed_once(spark, data):
    """A step shuffles factor rows and gradients; the placed ratings reach the blocks' tasks without an exchange."""
    df, _, items, users, _ = data
    placed = T.place_ratings(T.split_parts(df, df, 2))
    assert placed.sizes["valid"] == df.count() and sum(n for p, n in placed.sizes.items() if p != "valid") == df.count()
    blocks = placed.cells.where("item_id = 0").agg(F.countDistinct("block")).first()[0]
    assert blocks > 1  # the hot item's ratings are cut by user
    sums = T._pass(placed, T.start_factors(items, users, K, 1), "batch0", K, True)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    cells = plan[plan.index("FlatMapCoGroupsInArrow"):]
    scan = next(i for i, line in enumerate(cells.splitlines()) if "FileScan" in line and "rating" in line)
    assert not any("Exchange" in line for line in cells.splitlines()[1:scan])


def test_a_part_ships_its_own_rows_once_for_all_models(spark, data):
    """A pass sends a factor row to a block only if the part has such a rating there, and one row for all models."""
    df, _, items, users, _ = data
    placed = T.place_ratings(T.split_parts(df, df.where("user_id = 3"), 2), rows_per_block=10)
    routes = {(r["part"], r["side"], r["id"]): sorted(r["blocks"]) for r in placed.routes.collect()}
    want = {}
    for c in placed.cells.collect():
        for side in (T.ITEM, T.USER):
            want.setdefault((c["part"], side, c[f"{side}_id"]), set()).add(c["block"])
    assert routes == {k: sorted(v) for k, v in want.items()}
    sums = T._sums(placed, T._widen(T.start_factors(items, users, K, 3), [0, 1, 2], K), [0, 1, 2], "valid", K, True)
    rows = sums.where("side <> 'loss'").collect()
    assert len(rows) == sum(1 for p, _, _ in routes if p == "valid") and all(r["g0_1"] == r["g2_1"] for r in rows)


def test_ranks_keep_no_sort_key(spark, data):
    df = data[0].drop("rank")
    ranked = FA.split_order(df, 22)
    assert ranked.columns == [*df.columns, "rank"] and sorted(r["rank"] for r in ranked.collect()) == list(range(1, df.count() + 1))
    assert "md5" not in ranked._jdf.queryExecution().optimizedPlan().toString() and "_skey" not in ranked._jdf.queryExecution().toString()


def test_strata_are_one_sequential_pass(spark, data):
    """Blocks of a stratum share nothing, so running them together is running them one after the other."""
    df, _, items, users, start = data
    placed = T.place_ratings(T.split_parts(df.where(f"rank <= {TRAIN}"), df.where(f"rank > {TRAIN}"), 1))
    fit = T.stratified_sgd(placed, "batch0", items, users, K, 2, 0.02, 0.1, "valid")
    cells = placed.cells.where("part = 'batch0'").collect()
    U, V = ({i: list(f) for i, f in s.items()} for s in start)
    for _ in range(2):
        for s in range(placed.ranges):
            for d in range(placed.ranges):
                own = [c for c in cells if c["block"] == d * placed.ranges + (d + s) % placed.ranges]
                columns = [np.array([c[n] for c in own]) for n in ("item_id", "user_id", "rating")]
                if own:
                    T._record_steps(*columns, U, V, 0.02, 0.1)
    for side, want in ((T.ITEM, U), (T.USER, V)):
        got = {r["id"]: [r[c] for c in FA.fcols(K)] for r in fit.side(side).collect()}
        assert got.keys() == want.keys()
        for k, f in want.items():
            np.testing.assert_allclose(got[k], f, rtol=1e-9)
    losses = [r["train_loss"] for r in fit.report.orderBy("epoch").collect()]
    assert len(losses) == 3 and losses[0] > losses[1] > losses[2]
    e = [(r["rating"] - np.dot(U[r["item_id"]], V[r["user_id"]])) ** 2 for r in cells]
    assert losses[-1] == pytest.approx(np.mean(e))
    assert fit.report.where("valid_mse IS NULL").count() == 0


def test_one_record_moves_both_sides_from_the_old_values():
    U, V = {1: [1.0, 2.0]}, {5: [0.5, -1.0]}
    T._record_steps(np.array([1, 9]), np.array([5, 5]), np.array([3.0, 1.0]), U, V, 0.1, 0.2)
    e = 3.0 - (0.5 - 2.0)
    np.testing.assert_allclose(U[1], [1 + 0.1 * (e * 0.5 - 0.2), 2 + 0.1 * (-e - 0.4)])
    np.testing.assert_allclose(V[5], [0.5 + 0.1 * (e - 0.1), -1 + 0.1 * (2 * e + 0.2)])
