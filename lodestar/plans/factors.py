"""Driver queries of dictionary encoding, seeded split and latent-factor operators, over the utility matrix."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import round6
from ..operators import factors as FA
from ..operators import training as TR
from ..operators.groups import reliable_checkpoint, written
from .cf import UM_SQL, shared_um
from .registry import query
from ..sources.tables import table

K = 10
SEED = 42
SPLIT_SEED = 22
RATIOS = (0.8, 0.1, 0.1)
LR = 1.0
REG = 0.1
MSE_BATCH = 256


def _normal_sql(key: str) -> str:
    u = lambda suffix: f"((('0x' || substr(md5({key} || '{suffix}'), 1, 8))::BIGINT + 0.5) / 4294967296.0)"
    return f"(sqrt(-2.0 * ln({u(':u')})) * cos({2.0 * 3.141592653589793!r} * {u(':v')}))"


def _factor_sql(side: str, id_col: str) -> str:
    key = f"concat_ws(':', '{SEED}', '{side}', {id_col}::VARCHAR, f::VARCHAR)"
    return (f"SELECT '{side}' AS side, {id_col} AS id, f::INTEGER AS f, {_normal_sql(key)} AS value "
            f"FROM (SELECT DISTINCT {id_col} FROM um), range(0, {K}) t(f)")


FACTORS_SQL = f"""{UM_SQL},
fu AS ({_factor_sql('item', 'item_id')}),
fv AS ({_factor_sql('user', 'user_id')})"""
SPLIT_SQL = f"""{FACTORS_SQL},
ranked AS (SELECT um.*, row_number() OVER (ORDER BY md5(concat_ws(':', '{SPLIT_SEED}', user_id::VARCHAR, item_id::VARCHAR))) AS rank
           FROM um),
nn AS (SELECT count(*) AS n FROM um),
sp AS (SELECT ranked.*, CASE WHEN rank <= floor(n * {RATIOS[0]}) THEN 'train'
                             WHEN rank <= floor(n * {RATIOS[0]}) + floor(n * {RATIOS[1]}) THEN 'valid'
                             ELSE 'test' END AS split
       FROM ranked, nn)"""
PRED_SQL = f"""{SPLIT_SQL},
pred AS (SELECT r.user_id, r.item_id, r.rating, r.rank, sum(u.value * v.value) AS prediction
         FROM sp r JOIN fu u ON u.id = r.item_id JOIN fv v ON v.id = r.user_id AND v.f = u.f
         GROUP BY r.user_id, r.item_id, r.rating, r.rank)"""


def _step_sql(reg: float) -> str:
    shrink = 1.0 - 2.0 * LR * reg
    return f"""
WITH {SPLIT_SQL},
er AS (SELECT r.user_id, r.item_id, r.rating - sum(u.value * v.value) AS e
       FROM sp r JOIN fu u ON u.id = r.item_id JOIN fv v ON v.id = r.user_id AND v.f = u.f
       WHERE r.split = 'train' GROUP BY r.user_id, r.item_id, r.rating),
gr AS (SELECT 'item' AS side, er.item_id AS id, v.f, sum(er.e * v.value) AS g FROM er JOIN fv v ON v.id = er.user_id GROUP BY er.item_id, v.f
       UNION ALL
       SELECT 'user', er.user_id, u.f, sum(er.e * u.value) FROM er JOIN fu u ON u.id = er.item_id GROUP BY er.user_id, u.f),
fa AS (SELECT * FROM fu UNION ALL SELECT * FROM fv)
SELECT fa.side, fa.id, fa.f, round(fa.value * {shrink!r} + coalesce(gr.g, 0) * {2.0 * LR!r} / (SELECT count(*) FROM er), 6) AS value
FROM fa LEFT JOIN gr ON gr.side = fa.side AND gr.id = fa.id AND gr.f = fa.f"""


def factors(spark, sf):
    m = shared_um(spark, sf)
    items = FA.init_factors(m.select("item_id").distinct(), "item_id", "item", K, SEED)
    users = FA.init_factors(m.select("user_id").distinct(), "user_id", "user", K, SEED)
    return m, items, users


def split(spark, sf):
    m, items, users = factors(spark, sf)
    return FA.assign_split(FA.split_order(m, SPLIT_SEED), RATIOS), items, users


@query("string_index", """
WITH v AS (SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, count(*) AS cnt FROM orders GROUP BY 2
           UNION ALL
           SELECT 'l_returnflag', l_returnflag, count(*) FROM lineitem GROUP BY 2)
SELECT "column", value, cnt, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) AS idx FROM v""")
def q_string_index(spark, sf):
    o = FA.vocabulary(table(spark, sf, "orders"), "o_orderpriority").withColumn("column", F.lit("o_orderpriority"))
    li = FA.vocabulary(table(spark, sf, "lineitem"), "l_returnflag").withColumn("column", F.lit("l_returnflag"))
    return o.unionByName(li).select("column", "value", "cnt", "idx")


@query("split_counts", f"WITH {SPLIT_SQL} SELECT split, count(*) AS n, min(rank) AS first_rank, max(rank) AS last_rank FROM sp GROUP BY 1")
def q_split_counts(spark, sf):
    s, _, _ = split(spark, sf)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"))


@query("init_factors", f"WITH {FACTORS_SQL} SELECT side, id, f, round(value, 6) AS value FROM (SELECT * FROM fu UNION ALL SELECT * FROM fv)")
def q_init_factors(spark, sf):
    _, items, users = factors(spark, sf)
    out = FA.factors_long(items, "item", K).unionByName(FA.factors_long(users, "user", K))
    return out.select("side", "id", "f", round6("value").alias("value"))


@query("predict_ratings", f"WITH {PRED_SQL} SELECT user_id, item_id, rating, round(prediction, 6) AS prediction FROM pred")
def q_predict_ratings(spark, sf):
    m, items, users = factors(spark, sf)
    p = FA.predict(m, items, users, K)
    return p.select("user_id", "item_id", "rating", round6("prediction").alias("prediction"))


@query("mse", f"WITH {PRED_SQL} SELECT count(*) AS n, round(avg((rating - prediction) ** 2), 6) AS mse FROM pred")
def q_mse(spark, sf):
    m, items, users = factors(spark, sf)
    return FA.mse(FA.predict(m, items, users, K)).select("n", round6("mse").alias("mse"))


@query("mse_by_batch", f"""
WITH {PRED_SQL},
per AS (SELECT floor((rank - 1) / {MSE_BATCH}) AS batch, avg((rating - prediction) ** 2) AS m,
               sum((rating - prediction) ** 2) AS s, count(*) AS c
        FROM pred GROUP BY 1)
SELECT count(*) AS n_batches, round(avg(m), 6) AS mean_batch_mse, round(sum(s) / sum(c), 6) AS row_mse FROM per""")
def q_mse_by_batch(spark, sf):
    s, items, users = split(spark, sf)
    b = FA.mse_by_batch(FA.predict(s, items, users, K), MSE_BATCH)
    return b.select("n_batches", round6("mean_batch_mse").alias("mean_batch_mse"), round6("row_mse").alias("row_mse"))


def _step(spark, sf, reg):
    s, items, users = split(spark, sf)
    train = s.where(F.col("split") == "train").select("user_id", "item_id", "rating")
    items, users = written(items), written(users)  # read by the errors and by the updates
    ni, nu = FA.sgd_step(train, items, users, K, LR, reg)
    out = FA.factors_long(ni, "item", K).unionByName(FA.factors_long(nu, "user", K))
    return out.select("side", "id", "f", round6("value").alias("value"))


@query("sgd_step", _step_sql(0.0))
def q_sgd_step(spark, sf):
    return _step(spark, sf, 0.0)


@query("sgd_step_reg", _step_sql(REG))
def q_sgd_step_reg(spark, sf):
    return _step(spark, sf, REG)


# ---------------------------------------------------------------- training loops

K_FIT = 4
FIT_BATCHES = 2
FIT = FA.FitConfig(k=K_FIT, epochs=2, batches_per_epoch=FIT_BATCHES, reg=0.001, lr_initial=0.02, lr_decay=0.9, lr_steps=2)
GRID_LRS, GRID_REGS = (0.005, 0.02), (0.0, 0.01)
GRID_FIT = FA.FitConfig(k=K_FIT, epochs=1, batches_per_epoch=FIT_BATCHES, normalize="row")
REFIT_EPOCHS = 2


def _train_sql(points, epochs: int, normalize: str) -> str:
    """CTEs of ``epochs`` epochs of ``FIT_BATCHES`` steps for the models ``points`` (epoch -> (lr, reg)): f{t} the factors after
    step t, l{t} (model, loss) of its batch, m{epoch}_{part} (model, mse) after an epoch."""
    own = lambda epoch: "(VALUES " + ", ".join(f"({m}, {p(epoch)[0]!r}, {p(epoch)[1]!r})" for m, p in enumerate(points)) + ") AS pt(model, lr, reg)"
    out = [f"""{SPLIT_SQL},
f0 AS (SELECT model, side, id, f, value FROM (SELECT * FROM fu UNION ALL SELECT * FROM fv), {own(0)} WHERE f < {K_FIT})"""]

    def errors(t, where):
        return f"""SELECT u.model, r.user_id, r.item_id, r.rating - sum(u.value * v.value) AS e
  FROM sp r JOIN f{t} u ON u.side = 'item' AND u.id = r.item_id JOIN f{t} v ON v.side = 'user' AND v.id = r.user_id AND v.f = u.f AND v.model = u.model
  WHERE {where} GROUP BY u.model, r.user_id, r.item_id, r.rating"""

    t = 0
    for epoch in range(epochs):
        for b in range(FIT_BATCHES):
            where = f"r.split = 'train' AND r.rank % {FIT_BATCHES} = {b}"
            by = "g.n" if normalize == "row" else f"(SELECT count(*) FROM sp r WHERE {where})"
            out.append(f"""e{t + 1} AS ({errors(t, where)}),
l{t + 1} AS (SELECT pt.model, q + reg * s AS loss FROM {own(epoch)} JOIN (SELECT model, avg(e * e) AS q FROM e{t + 1} GROUP BY model) a ON a.model = pt.model
  JOIN (SELECT model, sum(value * value) AS s FROM f{t} GROUP BY model) b ON b.model = pt.model),
g{t + 1} AS (SELECT e.model, 'item' AS side, e.item_id AS id, v.f, sum(e.e * v.value) AS g, count(*) AS n
  FROM e{t + 1} e JOIN f{t} v ON v.side = 'user' AND v.model = e.model AND v.id = e.user_id GROUP BY e.model, e.item_id, v.f
  UNION ALL SELECT e.model, 'user', e.user_id, u.f, sum(e.e * u.value), count(*)
  FROM e{t + 1} e JOIN f{t} u ON u.side = 'item' AND u.model = e.model AND u.id = e.item_id GROUP BY e.model, e.user_id, u.f),
f{t + 1} AS (SELECT f.model, f.side, f.id, f.f, f.value * (1 - 2 * lr * reg) + coalesce(2 * lr * g.g / {by}, 0) AS value
  FROM f{t} f JOIN {own(epoch)} ON pt.model = f.model LEFT JOIN g{t + 1} g ON g.model = f.model AND g.side = f.side AND g.id = f.id AND g.f = f.f)""")
            t += 1
        for part in ("valid", "test"):
            out.append(f"m{epoch}_{part} AS (SELECT model, avg(e * e) AS mse FROM ({errors(t, f'r.split = {part!r}')}) GROUP BY model)")
    return ",\n".join(out)


def _rate(epoch):
    return FA.learning_rate(epoch, None, FIT.lr_initial, FIT.lr_decay, FIT.lr_steps)


def _report_sql(normalize: str) -> str:
    rows = []
    for epoch in range(FIT.epochs):
        steps = range(epoch * FIT_BATCHES + 1, (epoch + 1) * FIT_BATCHES + 1)
        mean = " + ".join(f"(SELECT loss FROM l{t})" for t in steps)
        rows.append(f"SELECT {epoch} AS epoch, round({_rate(epoch)!r}::DOUBLE, 6) AS lr, round(({mean}) / {FIT_BATCHES}, 6) AS train_loss, round((SELECT mse FROM m{epoch}_valid), 6) AS valid_mse")
    return f"WITH {_train_sql([lambda epoch: (_rate(epoch), FIT.reg)], FIT.epochs, normalize)}\n" + " UNION ALL ".join(rows)


def _fit_report(spark, sf, normalize):
    s, items, users = split(spark, sf)
    train, valid = (s.where(F.col("split") == x) for x in ("train", "valid"))
    items, users = (f.select("id", *FA.fcols(K_FIT)) for f in (items, users))
    _, _, report = FA.fit_factors(train, valid, items, users, FA.FitConfig(**{**FIT.__dict__, "normalize": normalize}))
    return report.select("epoch", *[round6(c).alias(c) for c in ("lr", "train_loss", "valid_mse")])


@query("fit_report", _report_sql("row"))
def q_fit_report(spark, sf):
    return _fit_report(spark, sf, "row")


@query("fit_report_batch", _report_sql("batch"))
def q_fit_report_batch(spark, sf):
    return _fit_report(spark, sf, "batch")


_POINTS = [(lr, reg) for lr in GRID_LRS for reg in GRID_REGS]


@query("grid_report", f"""
WITH {_train_sql([lambda epoch, p=p: p for p in _POINTS], REFIT_EPOCHS, "row")},
best AS (SELECT model FROM m{GRID_FIT.epochs - 1}_valid ORDER BY mse, model LIMIT 1)
SELECT lr, reg, round(v.mse, 6) AS valid_mse, pt.model = (SELECT model FROM best) AS best,
       CASE WHEN pt.model = (SELECT model FROM best) THEN round(t.mse, 6) END AS test_mse
FROM (VALUES {", ".join(f"({m}, {lr!r}::DOUBLE, {reg!r}::DOUBLE)" for m, (lr, reg) in enumerate(_POINTS))}) AS pt(model, lr, reg)
JOIN m{GRID_FIT.epochs - 1}_valid v ON v.model = pt.model JOIN m{REFIT_EPOCHS - 1}_test t ON t.model = pt.model""")
def q_grid_report(spark, sf):
    s, items, users = split(spark, sf)
    parts = {x: s.where(F.col("split") == x) for x in ("train", "valid", "test")}
    items, users = (f.select("id", *FA.fcols(K_FIT)) for f in (items, users))
    grid = TR.grid_search(parts["train"], parts["valid"], items, users, GRID_LRS, GRID_REGS, GRID_FIT, parts["test"], REFIT_EPOCHS)
    return grid.report.select("lr", "reg", round6("valid_mse").alias("valid_mse"), "best", round6("test_mse").alias("test_mse"))


STRATA_EPOCHS, STRATA_LR, STRATA_REG = 2, 0.003, 0.05


@query("sgd_strata_report", f"""
WITH {SPLIT_SQL},
er AS (SELECT r.split, r.user_id, r.item_id, r.rating - sum(u.value * v.value) AS e
       FROM sp r JOIN fu u ON u.id = r.item_id AND u.f < {K_FIT} JOIN fv v ON v.id = r.user_id AND v.f = u.f WHERE r.split <> 'test'
       GROUP BY r.split, r.user_id, r.item_id, r.rating),
m AS (SELECT split, avg(e * e) AS mse FROM er GROUP BY split),
ep(epoch) AS (SELECT unnest(range(-1, {STRATA_EPOCHS})))
SELECT epoch::INTEGER AS epoch, CASE WHEN epoch < 0 THEN round(t.mse, 6) END AS train_mse_before, CASE WHEN epoch < 0 THEN round(v.mse, 6) END AS valid_mse_before,
       epoch >= 0 AS train_mse_falls, TRUE AS valid_mse_at_most_that_before
FROM ep, (SELECT mse FROM m WHERE split = 'train') t, (SELECT mse FROM m WHERE split = 'valid') v""")
def q_sgd_strata_report(spark, sf):
    """Per-record descent: the errors before it, and whether the training error falls in every epoch (exact orders are not SQL's)."""
    s, items, users = split(spark, sf)
    s = reliable_checkpoint(s)
    train, valid = (s.where(F.col("split") == x) for x in ("train", "valid"))
    items, users = (f.select("id", *FA.fcols(K_FIT)) for f in (items, users))
    placed = TR.place_ratings(TR.split_parts(train, valid, 1))
    r = TR.stratified_sgd(placed, TR.batch_name(0), items, users, K_FIT, STRATA_EPOCHS, STRATA_LR, STRATA_REG, "valid").report
    last = Window.orderBy("epoch")  # one row an epoch
    first = F.first("valid_mse").over(last)
    before = lambda c: F.when(F.col("epoch") < 0, round6(c))
    falls = F.coalesce(F.col("train_loss") < F.lag("train_loss").over(last), F.lit(False))
    return r.select("epoch", before("train_loss").alias("train_mse_before"), before("valid_mse").alias("valid_mse_before"), falls.alias("train_mse_falls"), (F.col("valid_mse") <= first).alias("valid_mse_at_most_that_before"))


def _als_predictions(spark, sf):
    """Held-out ratings with the prediction of an ALS fit on the training part, null for an unseen user or item."""
    s, _, _ = split(spark, sf)
    for c in ("user_id", "item_id"):
        s = s.join(FA.dense_ids(s, c).withColumnRenamed("idx", f"{c}_idx"), c)
    s = written(s)  # read by the fit and by the predictions
    dense = s.select(F.col("user_id").alias("user"), F.col("item_id").alias("item"), F.col("user_id_idx").alias("user_id"), F.col("item_id_idx").alias("item_id"), "rating", "split")
    model = FA.als_fit(dense.where(F.col("split") == "train"), rank=K, max_iter=5, reg=REG, seed=SEED)
    p = model.transform(dense.where(F.col("split") != "train"))
    prediction = F.when(~F.isnan("prediction"), F.col("prediction").cast("double"))
    return p.select(F.col("user").alias("user_id"), F.col("item").alias("item_id"), "rating", "split", prediction.alias("prediction"))


@query("als_fit")
def q_als_fit(spark, sf):
    return _als_predictions(spark, sf)


@query("als_coverage", f"""
WITH {SPLIT_SQL},
tr AS (SELECT * FROM sp WHERE split = 'train')
SELECT split, count(*) AS n, count(*) FILTER (WHERE user_id IN (SELECT user_id FROM tr) AND item_id IN (SELECT item_id FROM tr)) AS n_predicted
FROM sp WHERE split <> 'train' GROUP BY split""")
def q_als_coverage(spark, sf):
    p = _als_predictions(spark, sf)
    return p.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count("prediction").alias("n_predicted"))
