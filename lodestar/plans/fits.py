"""Driver queries of the curve and polynomial fits, stream moments and Bloom filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import round6
from ..operators import fits as FI
from ..operators import sketches as SK
from ..operators.groups import reliable_checkpoint
from ..sources.tables import table
from .registry import query

W0 = 1.0
SWEEP = (-3.0, 10.0, 100)
POLY_DEG = (2, 2, 2)
AMS_K, AMS_V = 2, 20
BLOOM_TARGETS = (0.01, 0.005, 0.001)
BLOOM_MAX_FACTOR = 20


def poly_coefficients() -> dict[tuple[int, int, int], float]:
    """Fixed coefficients for the evaluation query: c_ijk = ((i+1)(j+2)(k+3) mod 7 - 3) / 4."""
    return {e: (((e[0] + 1) * (e[1] + 2) * (e[2] + 3)) % 7 - 3) / 4 for e in FI.monomial_exponents(*POLY_DEG)}


COEFS = poly_coefficients()


def _mono_sql(i, j, k) -> str:
    parts = ["x"] * i + ["y"] * j + ["z"] * k
    return "*".join(["1.0"] + parts)


POLY_SQL = " + ".join(f"{c!r} * ({_mono_sql(*e)})" for e, c in COEFS.items())
CURVE_PTS_SQL = "p AS (SELECT -3.0 + 9.0 * l_quantity / 50 AS x, l_extendedprice / 10000 AS y FROM lineitem)"
POLY_PTS_SQL = "q AS (SELECT l_orderkey, l_linenumber, l_quantity / 50 AS x, l_discount AS y, l_tax AS z, l_extendedprice / 10000 AS t FROM lineitem)"


def curve_points(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select((F.lit(-3.0) + F.lit(9.0) * F.col("l_quantity") / 50).alias("x"), (F.col("l_extendedprice") / 10000).alias("y"))


def poly_points(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") / 50).alias("x"), F.col("l_discount").alias("y"),
        F.col("l_tax").alias("z"), (F.col("l_extendedprice") / 10000).alias("t"),
    )


@query("curve_gradient", f"""
WITH {CURVE_PTS_SQL}, r AS (SELECT x, y - (x - {W0}) * (x - 2.0 * {W0}) AS r FROM p)
SELECT {W0} AS w, round(ln(sum(r * r)), 6) AS loss, round(-2.0 * sum(r * ({4.0 * W0} - 3.0 * x)) / sum(r * r), 6) AS grad FROM r""")
def q_curve_gradient(spark, sf):
    g = FI.curve_loss_grad(curve_points(spark, sf), W0)
    return g.select("w", round6("loss").alias("loss"), round6("grad").alias("grad"))


_STEP = (SWEEP[1] - SWEEP[0]) / (SWEEP[2] - 1)


@query("curve_sweep", f"""
WITH {CURVE_PTS_SQL},
g AS (SELECT i, (CASE WHEN i = {SWEEP[2] - 1} THEN {SWEEP[1]} ELSE i * {_STEP!r} + {SWEEP[0]} END)::DOUBLE AS w FROM range({SWEEP[2]}) t(i)),
r AS (SELECT i, w, x, y - (x - w) * (x - 2.0 * w) AS r FROM p, g)
SELECT i::INTEGER AS i, round(w, 6) AS w, round(ln(sum(r * r)), 6) AS loss,
       round(-2.0 * sum(r * (4.0 * w - 3.0 * x)) / sum(r * r), 6) AS grad
FROM r GROUP BY i, w""")
def q_curve_sweep(spark, sf):
    s = FI.curve_sweep(curve_points(spark, sf), *SWEEP)
    return s.select("i", round6("w").alias("w"), round6("loss").alias("loss"), round6("grad").alias("grad"))


MOMENTS_SQL = """count(*)::DOUBLE AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y - x * x) AS sa, sum((y - x * x) * (y - x * x)) AS saa, sum((y - x * x) * x) AS sax"""
LOSS_SQL = "(saa + 9 * w * w * sxx + 4 * pow(w, 4) * n + 6 * w * sax - 4 * w * w * sa - 12 * pow(w, 3) * sx)"
GRAD_SQL = f"(-2.0 * (4 * w * sa - 3 * sax + 18 * w * w * sx - 9 * w * sxx - 8 * pow(w, 3) * n) / {LOSS_SQL})"
DESCENT = {"w0": 0.5, "lr": 0.005, "epochs": 300}
BATCHED = {"w0": 0.5, "lr": 0.01, "epochs": 50}
POLY_LR, POLY_STEPS = 0.05, 2


@query("curve_descent", f"""
WITH RECURSIVE {CURVE_PTS_SQL}, m AS (SELECT {MOMENTS_SQL} FROM p),
d(epoch, w, grad) AS (
  SELECT -1, {DESCENT["w0"]}::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT epoch + 1, w - {DESCENT["lr"]} * {GRAD_SQL}, {GRAD_SQL} FROM d, m WHERE epoch + 1 < {DESCENT["epochs"]})
SELECT epoch::INTEGER AS epoch, round(w, 6) AS w, round(grad, 6) AS grad, round(ln({LOSS_SQL}), 6) AS loss FROM d, m WHERE epoch >= 0""")
def q_curve_descent(spark, sf):
    _, history = FI.fit_curve(curve_points(spark, sf), **DESCENT)
    rows = spark.createDataFrame(history, "epoch INT, w DOUBLE, grad DOUBLE, loss DOUBLE")
    return rows.select("epoch", *[round6(c).alias(c) for c in ("w", "grad", "loss")])


@query("curve_descent_batched", f"""
WITH RECURSIVE p AS (SELECT l_linenumber AS batch, -3.0 + 9.0 * l_quantity / 50 AS x, l_extendedprice / 10000 AS y FROM lineitem),
m AS (SELECT row_number() OVER (ORDER BY batch) - 1 AS b, count(*) OVER () AS batches, * FROM (SELECT batch, {MOMENTS_SQL} FROM p GROUP BY batch)),
d(step, w) AS (
  SELECT 0::BIGINT, {BATCHED["w0"]}::DOUBLE
  UNION ALL
  SELECT step + 1, w - {BATCHED["lr"]} * {GRAD_SQL} FROM d JOIN m ON b = step % batches WHERE step < {BATCHED["epochs"]} * batches)
SELECT round(w, 6) AS w FROM d WHERE step = (SELECT max(step) FROM d)""")
def q_curve_descent_batched(spark, sf):
    li = table(spark, sf, "lineitem")
    pts = li.select(F.col("l_linenumber").alias("batch"), (F.lit(-3.0) + F.lit(9.0) * F.col("l_quantity") / 50).alias("x"), (F.col("l_extendedprice") / 10000).alias("y"))
    w = FI.fit_curve_batched(pts, "batch", **BATCHED)
    return spark.createDataFrame([(w,)], "w DOUBLE").select(round6("w").alias("w"))


def _poly_descent_sql() -> str:
    out = [POLY_PTS_SQL, f"c0(i, j, k, c) AS (VALUES {', '.join(f'({i}, {j}, {k}, {c!r}::DOUBLE)' for (i, j, k), c in COEFS.items())})"]
    for s in range(POLY_STEPS):
        out.append(f"""d{s} AS (SELECT r, x, y, z, sum(c * pow(x, i) * pow(y, j) * pow(z, k)) - any_value(t) AS d
  FROM (SELECT row_number() OVER () AS r, * FROM q), c{s} GROUP BY r, x, y, z),
c{s + 1} AS (SELECT i, j, k, any_value(c) - {POLY_LR} * 2.0 * sum(d * pow(x, i) * pow(y, j) * pow(z, k)) / sum(d * d) AS c FROM d{s}, c{s} GROUP BY i, j, k)""")
    return ", ".join(out)


@query("poly_descent", f"WITH {_poly_descent_sql()} SELECT i, j, k, round(c, 6) AS c FROM c{POLY_STEPS}")
def q_poly_descent(spark, sf):
    c = FI.fit_poly(poly_points(spark, sf), COEFS, POLY_LR, POLY_STEPS)
    return spark.createDataFrame([(*e, float(v)) for e, v in c.items()], "i INT, j INT, k INT, c DOUBLE").select("i", "j", "k", round6("c").alias("c"))


@query("poly_eval", f"""
WITH {POLY_PTS_SQL}
SELECT l_orderkey, l_linenumber, round(t, 6) AS target, round({POLY_SQL}, 6) AS prediction FROM q""")
def q_poly_eval(spark, sf):
    q = poly_points(spark, sf)
    p = FI.poly_value(F.col("x"), F.col("y"), F.col("z"), COEFS)
    return q.select("l_orderkey", "l_linenumber", round6("t").alias("target"), round6(p).alias("prediction"))


@query("poly_gradient", f"""
WITH {POLY_PTS_SQL},
d AS (SELECT x, y, z, ({POLY_SQL}) - t AS d FROM q),
e(i, j, k) AS (VALUES {", ".join(f"({i}, {j}, {k})" for i, j, k in COEFS)}),
s AS (SELECT sum(d * d) AS ss FROM d),
g AS (SELECT i, j, k, sum(d * pow(x, i) * pow(y, j) * pow(z, k)) AS g FROM d, e GROUP BY 1, 2, 3)
SELECT i, j, k, round(ln(ss), 6) AS loss, round(2.0 * g / ss, 6) AS grad FROM g, s""")
def q_poly_gradient(spark, sf):
    g = FI.poly_loss_grad(poly_points(spark, sf), COEFS)
    return g.select("i", "j", "k", round6("loss").alias("loss"), round6("grad").alias("grad"))


@query("exact_moment", """
WITH c AS (SELECT user_id, count(*) AS c FROM events GROUP BY 1)
SELECT count(*)::DECIMAL(38,0) AS f0, sum(c)::DECIMAL(38,0) AS f1, sum(c::HUGEINT * c)::DECIMAL(38,0) AS f2, sum(c::HUGEINT * c * c)::DECIMAL(38,0) AS f3 FROM c""")
def q_exact_moment(spark, sf):
    return SK.exact_moments(table(spark, sf, "events"), "user_id")


def _events(spark, sf):
    return table(spark, sf, "events").select((F.col("event_id") + 1).alias("pos"), F.col("user_id").alias("el"))


@query("ams_moment", f"""
WITH ev AS (SELECT event_id + 1 AS p, user_id AS el FROM events),
cand AS (SELECT s, p, el FROM ev, range(1, {AMS_V + 1}) t(s)
         WHERE ((('0x' || substr(md5(s::VARCHAR || ':' || p::VARCHAR), 1, 13))::BIGINT + 0.5) / {float(16**13)!r}) * p < 1),
smp AS (SELECT s, max(p) AS t FROM cand GROUP BY 1),
smp2 AS (SELECT s, t, el FROM smp JOIN ev ON ev.p = smp.t),
cnt AS (SELECT s, count(*) AS c FROM smp2 JOIN ev USING (el) WHERE ev.p >= t GROUP BY 1),
nn AS (SELECT count(*) AS n FROM events)
SELECT {AMS_K} AS k, {AMS_V} AS v, n::BIGINT AS n, sum(c)::BIGINT AS sum_counts,
       round(avg(n * (pow(c, {AMS_K}) - pow(c - 1, {AMS_K}))), 6) AS estimate
FROM cnt, nn GROUP BY n""")
def q_ams_moment(spark, sf):
    a = SK.ams_moment(_events(spark, sf), "el", "pos", AMS_K, AMS_V)
    return a.select("k", "v", "n", "sum_counts", round6("estimate").alias("estimate"))


SAMPLE_KS = (1, 2, 3)


@query("ams_samples", f"""
WITH RECURSIVE nn AS (SELECT count(*) AS n FROM events),
jump(variable, t, following) AS (
  SELECT s, 1::BIGINT, floor(1 / ((('0x' || substr(md5('skip:' || s || ':1'), 1, 13))::BIGINT + 0.5) / {float(16**13)!r}))::BIGINT + 1 FROM range(1, {AMS_V + 1}) r(s)
  UNION ALL
  SELECT variable, following,
         floor(following / ((('0x' || substr(md5('skip:' || variable || ':' || following), 1, 13))::BIGINT + 0.5) / {float(16**13)!r}))::BIGINT + 1
  FROM jump, nn WHERE following <= n),
smp AS (SELECT variable, max(t) AS position FROM jump, nn WHERE t <= n GROUP BY 1),
picked AS (SELECT variable, position, user_id AS element FROM smp JOIN events ON event_id + 1 = position),
cnt AS (SELECT variable, position, element, count(*) AS count FROM picked JOIN events ON user_id = element AND event_id + 1 >= position GROUP BY 1, 2, 3)
SELECT variable::INTEGER AS variable, position, element, count, {", ".join(f"round(avg(n * (pow(count, {k}) - pow(count - 1, {k}))) OVER (), 6) AS estimate_{k}" for k in SAMPLE_KS)}
FROM cnt, nn""")
def q_ams_samples(spark, sf):
    ev = _events(spark, sf)
    s = reliable_checkpoint(SK.ams_skip_samples(ev, "el", "pos", AMS_V))  # v rows
    n = ev.select(F.count(F.lit(1))).scalar()
    e = SK.ams_from_samples(s, n, SAMPLE_KS).groupBy().pivot("k", list(SAMPLE_KS)).agg(F.first("estimate"))
    for k in SAMPLE_KS:
        s = s.withColumn(f"estimate_{k}", round6(e.select(str(k)).scalar()))
    return s


SIZING_SQL = f"""mm AS (SELECT count(DISTINCT c_custkey) AS m FROM customer),
g AS (SELECT m, j * greatest(1, m // 8) AS n FROM mm, range(1, {BLOOM_MAX_FACTOR * 8 + 9}) t(j) WHERE j * greatest(1, m // 8) <= {BLOOM_MAX_FACTOR} * m),
gk AS (SELECT m, n, round_even(n / m * {SK.LN2!r}, 0)::INTEGER AS k FROM g),
gp AS (SELECT m, n, k, pow(1.0 - exp(-k * m / n), k) AS p FROM gk),
bt(b) AS (VALUES {", ".join(f"({b!r}::DOUBLE)" for b in BLOOM_TARGETS)}),
hit AS (SELECT b, min(n)::BIGINT AS n_bits, arg_min(k, n) AS k, arg_min(p, n) AS p_fp FROM gp, bt WHERE p <= b GROUP BY b),
sizing AS (SELECT b, m::BIGINT AS n_keys, n_bits, k, p_fp FROM bt LEFT JOIN hit USING (b), mm)"""


def sizing(spark, sf):
    return SK.bloom_sizing(table(spark, sf, "customer"), "c_custkey", BLOOM_TARGETS, BLOOM_MAX_FACTOR)


@query("bloom_sizing", f"WITH {SIZING_SQL} SELECT b, n_keys, n_bits, k, round(p_fp, 10) AS p_fp FROM sizing")
def q_bloom_sizing(spark, sf):
    s = sizing(spark, sf)
    return s.select("b", "n_keys", "n_bits", "k", F.round("p_fp", 10).alias("p_fp"))


PARTS_SQL = "('0x' || substr(md5(key::VARCHAR), 1, 13))::BIGINT AS h1, ('0x' || substr(md5(key::VARCHAR), 14, 13))::BIGINT AS h2"


def _bits_sql(keys: str) -> str:
    """Distinct (key, block, bit) of the blocked filter."""
    return f"""(SELECT DISTINCT key, h1 % blocks AS block, (h2 % 512 + i * ((h2 // 512) % 256 * 2 + 1)) % 512 AS bit
     FROM (SELECT key, {PARTS_SQL}, blocks, unnest(range(k)) AS i FROM ({keys}), sz))"""


@query("bloom_probe", f"""
WITH {SIZING_SQL},
sz AS (SELECT n_bits, k, p_fp, greatest(1, ceil(n_bits / 512.0))::BIGINT AS blocks FROM sizing WHERE b = {BLOOM_TARGETS[0]!r}),
bits AS (SELECT DISTINCT block, bit FROM {_bits_sql("SELECT c_custkey AS key FROM customer")}),
pk AS {_bits_sql("SELECT DISTINCT o_orderkey AS key FROM orders")},
pp AS (SELECT key, count(*) = count(b.one) AS passed FROM pk LEFT JOIN (SELECT block, bit, 1 AS one FROM bits) b USING (block, bit) GROUP BY key),
mem AS (SELECT pp.key, passed, c_custkey IS NOT NULL AS member FROM pp LEFT JOIN customer ON c_custkey = pp.key)
SELECT (SELECT count(DISTINCT c_custkey) FROM customer) AS n_keys, n_bits, k, count(*) AS n_probes,
       sum(member::INTEGER)::BIGINT AS n_members, sum(passed::INTEGER)::BIGINT AS n_passed,
       sum((passed AND NOT member)::INTEGER)::BIGINT AS false_positives,
       round(sum((passed AND NOT member)::INTEGER) / nullif(sum((NOT member)::INTEGER), 0), 6) AS fp_rate,
       round(p_fp, 10) AS expected_fp
FROM mem, sz GROUP BY n_bits, k, p_fp""")
def q_bloom_probe(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey")
    row = sizing(spark, sf).where(F.col("b") == BLOOM_TARGETS[0]).first()  # one row of parameters
    n_bits, k = int(row["n_bits"]), int(row["k"])
    blocks = SK.block_count(n_bits)
    bits = SK.blocked_bloom_build(cust, "c_custkey", blocks, k)
    probes = table(spark, sf, "orders").select("o_orderkey").distinct()
    p = SK.blocked_bloom_probe(probes, "o_orderkey", bits, blocks, k)
    members = cust.select(F.col("c_custkey").alias("key")).distinct().withColumn("member", F.lit(True))
    m = p.join(members, "key", "left").withColumn("member", F.coalesce("member", F.lit(False)))
    fp = F.col("passed") & ~F.col("member")
    return m.agg(
        F.lit(int(row["n_keys"])).cast("bigint").alias("n_keys"),
        F.lit(n_bits).cast("bigint").alias("n_bits"),
        F.lit(k).alias("k"),
        F.count(F.lit(1)).alias("n_probes"),
        F.sum(F.col("member").cast("int")).cast("bigint").alias("n_members"),
        F.sum(F.col("passed").cast("int")).cast("bigint").alias("n_passed"),
        F.sum(fp.cast("int")).cast("bigint").alias("false_positives"),
        round6(F.try_divide(F.sum(fp.cast("int")), F.sum((~F.col("member")).cast("int")))).alias("fp_rate"),
        F.round(F.lit(float(row["p_fp"])), 10).alias("expected_fp"),
    )
