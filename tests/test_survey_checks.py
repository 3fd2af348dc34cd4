"""Engine-level check values at sf0.01 recorded in FIXTURES.md section 3 (same in Spark and DuckDB)."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from lodestar.operators import minhash as M
from lodestar.plans.sets import cust_sets

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")


def test_utility_matrix_shape(spark):
    r = E.queries()["ratings_profile"](spark, SF).first()
    assert (r.n_ratings, r.n_users, r.n_items) == (59391, 1500, 2000)
    q = E.queries()["ratings_scan"](spark, SF).agg(F.min("rating"), F.max("rating")).first()
    assert (q[0], q[1]) == (1, 99) or (q[0], q[1]) == (1.0, 50.0) or q[0] == 1


def test_centered_cosine_over_co_rated_pairs(spark):
    # the centred cosine (full norms, as in the similarity-to-user operators) of every co-rated pair
    from lodestar.operators.groups import pairs_in_groups
    from lodestar.operators.ratings import center_ratings
    from lodestar.plans.cf import um

    c = center_ratings(um(spark, SF))
    norms = c.groupBy("user_id").agg(F.sqrt(F.sum(F.col("centered") ** 2)).alias("nrm"))
    p = pairs_in_groups(c.select("user_id", "item_id", "centered"), "item_id", "user_id", ["centered"])
    dots = p.groupBy("lo", "hi").agg(F.sum(F.col("lo_centered") * F.col("hi_centered")).alias("dot"))
    cos = (
        dots.join(norms.select(F.col("user_id").alias("lo"), F.col("nrm").alias("n1")), "lo")
        .join(norms.select(F.col("user_id").alias("hi"), F.col("nrm").alias("n2")), "hi")
        .select(F.round(F.try_divide(F.col("dot"), F.col("n1") * F.col("n2")), 6).alias("cc"))
    )
    r = cos.agg(F.count(F.lit(1)).alias("n"), F.sum("cc").alias("s"), F.max("cc").alias("mx"), F.min("cc").alias("mn")).first()
    assert r.n == 580007
    assert r.s == pytest.approx(-16.081, abs=5e-4)
    assert (r.mx, r.mn) == (0.387807, -0.34991)
    assert E.queries()["pearson_pairs"](spark, SF).count() == 580007


def test_minhash_three_hashes(spark):
    # fixed values: the three hash functions of the recorded check
    fam = [(37, 126), (1234567, 7654321), (99991, 31337)]
    sig = M.signatures_long(M.signature_arrays(cust_sets(spark, SF), fam))
    r = sig.agg(F.count(F.lit(1)), F.sum("h"), F.max("h")).first()
    assert (r[0], r[1], r[2]) == (4500, 69001613387, 1884196162)


def test_distinct_five_shingles(spark):
    s = E.queries()["shingle_counts"](spark, SF).where(F.col("n_chars_clean") >= 5)
    r = s.agg(F.count(F.lit(1)), F.sum("n_shingles_k5"), F.max("n_shingles_k5")).first()
    assert (r[0], r[1], r[2]) == (999, 1606267, 10470)


def test_moments(spark):
    assert E.queries()["exact_moment"](spark, SF).first().f2 == 677248
    a = E.queries()["ams_moment"](spark, SF).first()
    assert (a.v, a.sum_counts, a.estimate) == (20, 597, 587000.0)


def test_rate_all_items_user0(spark):
    r = E.queries()["rate_all_items"](spark, SF)
    x = r.agg(F.count(F.lit(1)), F.count("rating"), F.sum("rating")).first()
    assert (x[0], x[1]) == (2000, 2000)
    assert x[2] == pytest.approx(50571.084, abs=1e-3)
