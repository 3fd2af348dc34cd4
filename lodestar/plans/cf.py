"""Driver queries of the rating and collaborative-filtering operators, over orders x lineitem.

*um* = the utility matrix (o_custkey, l_partkey) -> sum(l_quantity).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import round6
from ..operators import ratings as R
from ..operators import recommend as REC
from ..operators import similarity as SIM
from ..operators.groups import reliable_checkpoint, written
from ..sources.files import sample_rows
from ..sources.tables import rating_events, table
from .registry import query

TARGET_USER = 0
OTHER_USER = 1
NEIGHBOURHOOD = 2
TOP_K = 10
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

UM_SQL = """um AS (
  SELECT o_custkey::BIGINT AS user_id, l_partkey::BIGINT AS item_id, sum(l_quantity)::DOUBLE AS rating
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY 1, 2)"""
CENTER_SQL = UM_SQL + """,
mu AS (SELECT user_id, avg(rating) AS mean_rating FROM um GROUP BY 1),
c AS (SELECT user_id, item_id, rating, rating - mean_rating AS centered FROM um JOIN mu USING (user_id))"""
SIM_TO_TARGET_SQL = CENTER_SQL + f""",
t AS (SELECT item_id, centered AS tc FROM c WHERE user_id = {TARGET_USER}),
tn AS (SELECT sqrt(sum(tc * tc)) AS tnorm FROM t),
a AS (SELECT user_id, sum(centered * coalesce(tc, 0)) AS dot, sqrt(sum(centered * centered)) AS norm,
             count(tc) AS n_common
      FROM c LEFT JOIN t USING (item_id) GROUP BY 1),
sims AS (SELECT user_id, dot / nullif(norm * tnorm, 0) AS sim, n_common FROM a, tn)"""


def um(spark, sf):
    return R.utility_matrix(rating_events(spark, sf))


def shared_um(spark, sf):
    """The utility matrix written once for queries that read it in several branches.

    Branches filter it differently (the target user, everyone else, all items), and each differently
    filtered branch would otherwise rescan and re-join orders x lineitem; here the raw tables are read
    once and every branch reads the much smaller written matrix.
    """
    return written(um(spark, sf))


@query("ratings_scan", f"""
SELECT o_custkey::BIGINT AS user_id, l_partkey::BIGINT AS item_id, l_quantity::DOUBLE AS rating
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL""")
def q_ratings_scan(spark, sf):
    return rating_events(spark, sf)


@query("utility_matrix", f"WITH {UM_SQL} SELECT * FROM um")
def q_utility_matrix(spark, sf):
    return um(spark, sf)


@query("sample_rows", f"WITH {UM_SQL} SELECT * FROM um ORDER BY user_id, item_id LIMIT 20")
def q_sample_rows(spark, sf):
    return sample_rows(um(spark, sf), 20, ["user_id", "item_id"])


@query("ratings_profile", f"""
WITH {UM_SQL}
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       min(rating) AS min_rating, max(rating) AS max_rating, round(avg(rating), 6) AS avg_rating,
       round(count(*) / (count(DISTINCT user_id)::DOUBLE * count(DISTINCT item_id)), 6) AS density
FROM um""")
def q_ratings_profile(spark, sf):
    return R.ratings_profile(um(spark, sf))


@query("user_stats", f"""
WITH {UM_SQL}
SELECT user_id, count(*) AS n_ratings, round(avg(rating), 6) AS mean_rating,
       round(sqrt(sum(rating * rating)), 6) AS norm
FROM um GROUP BY 1""")
def q_user_stats(spark, sf):
    s = R.user_stats(um(spark, sf))
    return s.select("user_id", "n_ratings", round6("mean_rating").alias("mean_rating"), round6("norm").alias("norm"))


@query("center_ratings", f"WITH {CENTER_SQL} SELECT user_id, item_id, rating, round(centered, 6) AS centered FROM c")
def q_center_ratings(spark, sf):
    c = R.center_ratings(um(spark, sf))
    return c.select("user_id", "item_id", "rating", round6("centered").alias("centered"))


@query("center_items", f"""
WITH {UM_SQL}
SELECT user_id, item_id, rating, round(rating - avg(rating) OVER (PARTITION BY item_id), 6) AS centered FROM um""")
def q_center_items(spark, sf):
    c = R.center_ratings(shared_um(spark, sf), "item")
    return c.select("user_id", "item_id", "rating", round6("centered").alias("centered"))


@query("center_all", f"WITH {UM_SQL} SELECT user_id, item_id, rating, round(rating - (SELECT avg(rating) FROM um), 6) AS centered FROM um")
def q_center_all(spark, sf):
    c = R.center_ratings(shared_um(spark, sf), "all")
    return c.select("user_id", "item_id", "rating", round6("centered").alias("centered"))


@query("rated_by", f"""
WITH {UM_SQL},
d AS (SELECT item_id, count(*) AS n_in_key FROM um GROUP BY 1),
x AS (SELECT um.*, n_in_key,
             ('0x' || substr(md5(user_id::VARCHAR), 1, 8))::BIGINT % greatest(1, ceil(n_in_key / 10000.0))::BIGINT AS chunk
      FROM um JOIN d USING (item_id))
SELECT item_id, chunk, n_in_key, array_to_string(list_sort(list(user_id)), ',') AS users
FROM x GROUP BY item_id, chunk, n_in_key""")
def q_rated_by(spark, sf):
    r = R.rated_by(shared_um(spark, sf))
    return r.select("item_id", "chunk", "n_in_key", F.array_join("users", ",").alias("users"))


@query("user_vectors", f"""
WITH {UM_SQL},
d AS (SELECT user_id, count(*) AS n_in_key FROM um GROUP BY 1),
x AS (SELECT um.*, n_in_key,
             ('0x' || substr(md5(item_id::VARCHAR), 1, 8))::BIGINT % greatest(1, ceil(n_in_key / 10000.0))::BIGINT AS chunk
      FROM um JOIN d USING (user_id))
SELECT user_id, chunk, n_in_key,
       string_agg(item_id::VARCHAR || ':' || rating::BIGINT::VARCHAR, ',' ORDER BY item_id) AS entries
FROM x GROUP BY user_id, chunk, n_in_key""")
def q_user_vectors(spark, sf):
    v = R.user_vectors(shared_um(spark, sf))
    txt = F.transform("entries", lambda e: F.concat(e["item_id"].cast("string"), F.lit(":"), e["rating"].cast("bigint").cast("string")))
    return v.select("user_id", "chunk", "n_in_key", F.array_join(txt, ",").alias("entries"))


@query("um_pivot", f"""
WITH {UM_SQL}
SELECT item_id, {", ".join(f"sum(rating) FILTER (WHERE c_mktsegment = '{s}') AS {s}" for s in SEGMENTS)}
FROM um JOIN customer ON c_custkey = user_id GROUP BY 1""")
def q_um_pivot(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    per = um(spark, sf).join(cust, "user_id").groupBy("item_id", "c_mktsegment").agg(F.sum("rating").alias("rating"))
    return R.um_pivot(reliable_checkpoint(per), "item_id", "c_mktsegment", SEGMENTS)  # read by the duplicate check and the pivot


@query("user_similarities", f"WITH {SIM_TO_TARGET_SQL} SELECT user_id, round(sim, 6) AS similarity, n_common FROM sims")
def q_user_similarities(spark, sf):
    s = SIM.similarity_to_user(shared_um(spark, sf), TARGET_USER, undefined="null")
    return s.select("user_id", round6("similarity").alias("similarity"), "n_common")


@query("centered_cosine_all", f"WITH {SIM_TO_TARGET_SQL} SELECT user_id, round(coalesce(sim, 0), 6) AS similarity, n_common FROM sims")
def q_centered_cosine_all(spark, sf):
    s = SIM.similarity_to_user(shared_um(spark, sf), TARGET_USER, undefined="zero")
    return s.select("user_id", round6("similarity").alias("similarity"), "n_common")


@query("centered_cosine_pair", f"""
WITH {CENTER_SQL},
x AS (SELECT item_id, centered AS x FROM c WHERE user_id = {TARGET_USER}),
y AS (SELECT item_id, centered AS y FROM c WHERE user_id = {OTHER_USER})
SELECT {TARGET_USER}::BIGINT AS user_a, {OTHER_USER}::BIGINT AS user_b,
       round(coalesce(coalesce(sum(x * y), 0) / nullif(sqrt(sum(x * x)) * sqrt(sum(y * y)), 0), 0), 6) AS similarity
FROM x FULL JOIN y USING (item_id)""")
def q_centered_cosine_pair(spark, sf):
    s = SIM.centered_cosine_pair(um(spark, sf), TARGET_USER, OTHER_USER)
    return s.select("user_a", "user_b", round6("similarity").alias("similarity"))


@query("rate_all_items", f"""
WITH {SIM_TO_TARGET_SQL},
r AS (SELECT um.item_id, um.user_id, um.rating, sims.sim,
             row_number() OVER (PARTITION BY um.item_id
                                ORDER BY (sim IS NULL) DESC, round(sim, 9) DESC, um.user_id ASC) AS rk
      FROM um JOIN sims USING (user_id) WHERE um.user_id <> {TARGET_USER}),
e AS (SELECT item_id, sum(sim * rating) / nullif(sum(sim), 0) AS est, count(*) AS n_nb
      FROM r WHERE rk <= {NEIGHBOURHOOD} AND sim IS NOT NULL GROUP BY 1),
k AS (SELECT item_id, rating AS known FROM um WHERE user_id = {TARGET_USER}),
items AS (SELECT DISTINCT item_id FROM um)
SELECT item_id, round(coalesce(known, est), 6) AS rating, known IS NOT NULL AS is_known,
       (CASE WHEN known IS NULL THEN coalesce(n_nb, 0) ELSE 0 END)::BIGINT AS n_neighbors
FROM items LEFT JOIN k USING (item_id) LEFT JOIN e USING (item_id)""")
def q_rate_all_items(spark, sf):
    r = REC.rate_all_items(shared_um(spark, sf), TARGET_USER, NEIGHBOURHOOD)
    return r.select("item_id", round6("rating").alias("rating"), "is_known", "n_neighbors")


def latest_order_requests(spark, sf):
    """(user, item) cells of every customer's latest order: the estimate requests."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate").where(
        F.col("o_orderkey").isNotNull() & F.col("o_custkey").isNotNull()
    )
    latest = orders.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey"))["o_orderkey"].alias("o_orderkey"))
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").where(
        F.col("l_orderkey").isNotNull() & F.col("l_partkey").isNotNull()
    )
    return latest.join(items, latest.o_orderkey == items.l_orderkey).select(
        F.col("o_custkey").cast("bigint").alias("user_id"), F.col("l_partkey").cast("bigint").alias("item_id")
    ).distinct()


@query("estimate_ratings", f"""
WITH {CENTER_SQL},
norms AS (SELECT user_id, sqrt(sum(centered * centered)) AS nrm FROM c GROUP BY 1),
lo AS (SELECT o_orderkey, o_custkey FROM (
         SELECT o_orderkey, o_custkey,
                row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) WHERE rn = 1),
req AS (SELECT DISTINCT o_custkey::BIGINT AS user_id, l_partkey::BIGINT AS item_id
        FROM lo JOIN lineitem ON l_orderkey = o_orderkey),
cand AS (SELECT req.user_id, req.item_id, c.user_id AS nb, c.rating AS nb_rating
         FROM req JOIN c USING (item_id) WHERE c.user_id <> req.user_id),
pairs AS (SELECT DISTINCT user_id, nb FROM cand),
dots AS (SELECT p.user_id, p.nb, sum(t.centered * n.centered) AS dot
         FROM pairs p JOIN c t ON t.user_id = p.user_id JOIN c n ON n.user_id = p.nb AND n.item_id = t.item_id
         GROUP BY 1, 2),
sims AS (SELECT p.user_id, p.nb, coalesce(coalesce(d.dot, 0) / nullif(n1.nrm * n2.nrm, 0), 0) AS sim
         FROM pairs p LEFT JOIN dots d USING (user_id, nb)
         JOIN norms n1 ON n1.user_id = p.user_id JOIN norms n2 ON n2.user_id = p.nb),
sc AS (SELECT cand.*, sim, row_number() OVER (PARTITION BY cand.user_id, cand.item_id
                                                ORDER BY round(sim, 9) DESC, nb ASC) AS rk
       FROM cand JOIN sims USING (user_id, nb)),
est AS (SELECT user_id, item_id, sum(sim * nb_rating) / nullif(sum(sim), 0) AS estimate, count(*) AS n_nb
        FROM sc WHERE rk <= {NEIGHBOURHOOD} GROUP BY 1, 2)
SELECT user_id, item_id, round(estimate, 6) AS estimate, coalesce(n_nb, 0)::BIGINT AS n_neighbors
FROM req LEFT JOIN est USING (user_id, item_id)""")
def q_estimate_ratings(spark, sf):
    e = REC.estimate_ratings(shared_um(spark, sf), latest_order_requests(spark, sf), NEIGHBOURHOOD)
    return e.select("user_id", "item_id", round6("estimate").alias("estimate"), "n_neighbors")


@query("pearson_pairs", f"""
WITH {CENTER_SQL}
SELECT a.user_id AS user_a, b.user_id AS user_b,
       round(sum(a.centered * b.centered)
             / nullif(sqrt(sum(a.centered * a.centered)) * sqrt(sum(b.centered * b.centered)), 0), 6) AS pearson_corr,
       count(*) AS n_common
FROM c a JOIN c b ON a.item_id = b.item_id AND a.user_id < b.user_id GROUP BY 1, 2""")
def q_pearson_pairs(spark, sf):
    p = SIM.pearson_pairs(shared_um(spark, sf))
    return p.select("user_a", "user_b", round6("pearson_corr").alias("pearson_corr"), "n_common")


@query("pair_correlations", f"""
WITH {CENTER_SQL},
q AS (SELECT c_custkey::BIGINT AS user_a, lead(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey)::BIGINT AS user_b FROM customer),
j AS (SELECT q.user_a, q.user_b, sum(a.centered * b.centered) AS xy, sum(a.centered * a.centered) AS xx, sum(b.centered * b.centered) AS yy, count(*) AS n
      FROM q JOIN c a ON a.user_id = q.user_a JOIN c b ON b.user_id = q.user_b AND b.item_id = a.item_id GROUP BY 1, 2)
SELECT q.user_a, q.user_b, round(xy / nullif(sqrt(xx) * sqrt(yy), 0), 6) AS pearson_corr, coalesce(n, 0)::BIGINT AS n_common
FROM q LEFT JOIN j ON j.user_a = q.user_a AND j.user_b = q.user_b WHERE q.user_b IS NOT NULL""")
def q_pair_correlations(spark, sf):
    """Asked pairs: every customer and the next one of the same nation and segment."""
    by = Window.partitionBy("c_nationkey", "c_mktsegment").orderBy("c_custkey")
    key = F.col("c_custkey").cast("bigint")
    asked = table(spark, sf, "customer").select(key.alias("user_a"), F.lead(key).over(by).alias("user_b")).where("user_b IS NOT NULL")
    p = SIM.pair_correlations(shared_um(spark, sf), asked)
    return p.select("user_a", "user_b", round6("pearson_corr").alias("pearson_corr"), "n_common")


@query("topk_similar_users", f"""
WITH {CENTER_SQL},
t AS (SELECT item_id, centered AS tc FROM c WHERE user_id = {TARGET_USER}),
corr AS (SELECT c.user_id, sum(tc * centered) / nullif(sqrt(sum(tc * tc)) * sqrt(sum(centered * centered)), 0) AS pc,
                count(*) AS n_common
         FROM c JOIN t USING (item_id) WHERE c.user_id <> {TARGET_USER} GROUP BY 1)
SELECT {TARGET_USER}::BIGINT AS user_a, user_id AS user_b, round(pc, 6) AS pearson_corr, n_common
FROM corr ORDER BY round(pc, 9) DESC NULLS LAST, user_id LIMIT {TOP_K}""")
def q_topk_similar_users(spark, sf):
    t = SIM.topk_similar_users(shared_um(spark, sf), TARGET_USER, TOP_K)
    return t.select("user_a", "user_b", round6("pearson_corr").alias("pearson_corr"), "n_common")


@query("embedding_cosine", """
WITH t AS (SELECT embedding::DOUBLE[] AS te FROM embeddings WHERE vec_id = 0)
SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], te)
                     / nullif(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))
                              * sqrt(list_dot_product(te, te)), 0), 6) AS cosine
FROM embeddings, t""")
def q_embedding_cosine(spark, sf):
    return SIM.embedding_cosine(table(spark, sf, "embeddings"), 0)
