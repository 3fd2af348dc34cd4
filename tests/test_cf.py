import itertools
import math

import pytest
from pyspark.sql import functions as F

from lodestar.operators import ratings as R
from lodestar.operators import recommend as REC
from lodestar.operators import similarity as SIM
from lodestar.sources.files import LECTURE_MATRIX, dense_to_long, ratings_by_name


def _lecture(spark):
    return ratings_by_name(spark, "lecture_1")


def test_lecture_user_means(spark):
    means = {r.user_id: r.mean_rating for r in R.user_stats(_lecture(spark)).collect()}
    # fixed values: user means of the lecture matrix
    expected = [1.333333, 3, 3.8, 2.666667, 3.5, 3.5]
    for u, e in enumerate(expected):
        assert means[u] == pytest.approx(e, abs=1e-6)


def test_lecture_similarity_to_user_4(spark):
    sims = {r.user_id: r.similarity for r in SIM.similarity_to_user(_lecture(spark), 4).collect()}
    # fixed values: cosine of the centred columns with user 4
    expected = [-0.456435, -0.948683, 0.213809, 0.552052, 1.0, -0.158114]
    for u, e in enumerate(expected):
        assert sims[u] == pytest.approx(e, abs=1e-6)


def test_lecture_rate_all_items(spark):
    out = {r.item_id: r for r in REC.rate_all_items(_lecture(spark), 4, 2).collect()}
    # fixed values: estimates for items 0 and 1, known ratings for items 2-5
    assert out[0].rating == pytest.approx(-2.677837, abs=1e-6)
    assert out[1].rating == pytest.approx(4.279175, abs=1e-6)
    assert [out[i].rating for i in (2, 3, 4, 5)] == [2.0, 5.0, 4.0, 3.0]
    assert [out[i].is_known for i in range(6)] == [False, False, True, True, True, True]
    assert out[0].n_neighbors == 2 and out[1].n_neighbors == 2


def _pair_df(spark, xs, ys, absent_zero=False):
    rows = []
    for i, (x, y) in enumerate(zip(xs, ys)):
        if x is not None:
            rows.append((0, i, float(x)))
        if y is not None:
            rows.append((1, i, float(y)))
    return spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE")


def _centered_cosine(spark, xs, ys):
    return SIM.centered_cosine_pair(_pair_df(spark, xs, ys), 0, 1).first().similarity


def test_centered_cosine_ramps(spark):
    k = 100
    x = list(range(1, k + 1))
    y = list(range(k, 0, -1))
    assert _centered_cosine(spark, x, y) == pytest.approx(-1.0, abs=1e-9)
    stored_zero = [0 if i % 10 == 0 else v for i, v in enumerate(x)]
    absent = [None if i % 10 == 0 else v for i, v in enumerate(x)]
    # fixed values: a stored zero counts in the mean, an absent cell does not
    assert _centered_cosine(spark, stored_zero, y) == pytest.approx(-0.8525776670, abs=1e-9)
    assert _centered_cosine(spark, absent, y) == pytest.approx(-0.9477815302, abs=1e-9)


def test_centered_cosine_constant_row_is_zero(spark):
    assert _centered_cosine(spark, [3] * 50, list(range(50))) == 0.0


def _brute_pearson(rows):
    by_user = {}
    for u, i, r in rows:
        by_user.setdefault(u, {})[i] = r
    mean = {u: sum(v.values()) / len(v) for u, v in by_user.items()}
    out = {}
    for a, b in itertools.combinations(sorted(by_user), 2):
        common = set(by_user[a]) & set(by_user[b])
        if not common:
            continue
        xa = [by_user[a][i] - mean[a] for i in common]
        xb = [by_user[b][i] - mean[b] for i in common]
        num = sum(p * q for p, q in zip(xa, xb))
        den = math.sqrt(sum(p * p for p in xa)) * math.sqrt(sum(q * q for q in xb))
        out[(a, b)] = (num / den if den else None, len(common))
    return out


def _random_ratings(n_users=30, n_items=12, seed=3, hot_item=0):
    import random

    rnd = random.Random(seed)
    rows = []
    for u in range(n_users):
        for i in range(n_items):
            if i == hot_item or rnd.random() < 0.35:
                rows.append((u, i, float(rnd.randint(1, 5))))
    return rows


def test_pearson_pairs_matches_brute_force_with_tiny_tiles(spark, monkeypatch):
    rows = _random_ratings()
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    from lodestar.operators import groups

    real = groups.pairs_in_groups
    # every item is a "hot" group: 3-member tiles force the tiled path
    monkeypatch.setattr(SIM, "pairs_in_groups", lambda *a, **k: real(*a, **{**k, "tile_rows": 3}))
    got = {(r.user_a, r.user_b): (r.pearson_corr, r.n_common) for r in SIM.pearson_pairs(df).collect()}
    exp = _brute_pearson(rows)
    assert set(got) == set(exp)
    for key, (c, n) in exp.items():
        assert got[key][1] == n
        if c is None:
            assert got[key][0] is None
        else:
            assert got[key][0] == pytest.approx(c, abs=1e-9)
            assert -1 - 1e-9 <= got[key][0] <= 1 + 1e-9


def test_topk_matches_pairs(spark):
    rows = _random_ratings(seed=5)
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    exp = _brute_pearson(rows)
    partners = {(b if a == 7 else a): c for (a, b), (c, _) in exp.items() if 7 in (a, b)}
    ranked = sorted(partners.items(), key=lambda kv: (kv[1] is None, -(kv[1] or 0), kv[0]))[:5]
    got = SIM.topk_similar_users(df, 7, 5).collect()
    assert [r.user_b for r in got] == [u for u, _ in ranked]


def test_result_independent_of_partitions(spark):
    rows = _random_ratings(seed=9)
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    def rows(d):
        return sorted((r.item_id, None if r.rating is None else round(r.rating, 9), r.is_known, r.n_neighbors) for r in REC.rate_all_items(d, 3, 2).collect())

    assert rows(df) == rows(df.repartition(5))


def test_estimate_ratings_excludes_self_and_uses_raters(spark):
    df = _lecture(spark)
    req = spark.createDataFrame([(4, 0), (4, 1), (0, 3)], "user_id BIGINT, item_id BIGINT")
    out = {(r.user_id, r.item_id): r for r in REC.estimate_ratings(df, req, 2).collect()}
    assert len(out) == 3
    assert all(r.n_neighbors <= 2 for r in out.values())


def test_um_pivot_rejects_duplicates(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 1, 2.0)], "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    with pytest.raises(ValueError):
        R.um_pivot(df, "item_id", "user_id", [1])


def test_dense_to_long_counts_cells(spark):
    assert dense_to_long(spark, LECTURE_MATRIX).count() == sum(v is not None for row in LECTURE_MATRIX for v in row)
    with pytest.raises(ValueError):
        ratings_by_name(spark, "nope")


def test_chunked_rated_by_reassembles(spark):
    rows = _random_ratings(seed=11)
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    out = R.rated_by(df, chunk_rows=4).groupBy("item_id").agg(F.flatten(F.collect_list("users")).alias("u")).collect()
    exp = {}
    for u, i, _ in rows:
        exp.setdefault(i, set()).add(u)
    assert {r.item_id: set(r.u) for r in out} == exp
    sizes = R.rated_by(df, chunk_rows=4).select(F.size("users").alias("s")).collect()
    assert max(r.s for r in sizes) < 30


def test_neighbours_are_raters_and_at_most_k(spark):
    rows = _random_ratings(seed=13)
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    raters = {}
    for u, i, _ in rows:
        if u != 5:
            raters.setdefault(i, set()).add(u)
    for k in (1, 3):
        for r in REC.rate_all_items(df, 5, k).collect():
            if not r.is_known:
                assert r.n_neighbors <= min(k, len(raters.get(r.item_id, ())))


@pytest.mark.parametrize("tile,wave", [(2048, 1 << 28), (5, 2000)])
@pytest.mark.parametrize("include_self", [False, True])
def test_estimate_ratings_matches_brute_force(spark, tile, wave, include_self):
    """Requests of rated and unrated items, of users without ratings, of items without raters; ties; an item of many raters in chunks; users in turns."""
    import math
    import random

    rnd = random.Random(11)
    um = {(u, i): float(rnd.randrange(1, 6)) for u in range(30) for i in range(25) if rnd.random() < 0.35 or i == 3}
    um |= {(40, 1): 2.0, (40, 2): 2.0, (41, 3): 4.0}  # no spread: norm 0
    req = {(rnd.randrange(32), rnd.randrange(27)) for _ in range(90)} | {(40, 3), (41, 3), (41, 1), (99, 3), (0, 500), (5, 3)}
    mean = {u: sum(r for (v, _), r in um.items() if v == u) / sum(1 for v, _ in um if v == u) for u, _ in um}
    cen = {c: r - mean[c[0]] for c, r in um.items()}
    norm = {u: math.sqrt(sum(x * x for (v, _), x in cen.items() if v == u)) for u in mean}
    want = {}
    for u, i in req:
        near = []
        for v in mean:
            if (v, i) in um and u in mean and (include_self or v != u):
                d = sum(cen[u, j] * cen[v, j] for j in range(500) if (u, j) in cen and (v, j) in cen)
                near.append((d / (norm[u] * norm[v]) if norm[u] * norm[v] else 0.0, v))
        best = sorted(near, key=lambda x: (-round(x[0], 9), x[1]))[:3]
        w = sum(s for s, _ in best)
        want[u, i] = (None if not w else sum(s * um[v, i] for s, v in best) / w, len(best))
    df = spark.createDataFrame([(*c, r) for c, r in um.items()], "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    asked = spark.createDataFrame([*req, (5, 3)], "user_id BIGINT, item_id BIGINT")
    rows = REC.estimate_ratings(df, asked, 3, include_self, tile_rows=tile, task_entries=200, wave_entries=wave).collect()
    got = {(r.user_id, r.item_id): (r.estimate, r.n_neighbors) for r in rows}
    assert len(rows) == len(req) and got.keys() == want.keys()
    for c, (e, n) in want.items():
        assert got[c][1] == n and (got[c][0] is None) == (e is None), c
        assert e is None or abs(e) > 1e6 or got[c][0] == pytest.approx(e, rel=1e-6), c


def test_estimate_ratings_shuffles_no_candidates(spark):
    """Candidates and pairs are no rows: nothing but the ratings, the requests, the packed lists and the result goes through the last job's shuffles."""
    df = spark.createDataFrame([(u, i, float(u % 5 + i)) for u in range(40) for i in range(12) if (u + i) % 3], "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    e = REC.estimate_ratings(df, df.select("user_id", "item_id").where("user_id < 9"), 2)
    plan = e._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "_sent" in plan and e.count() == df.where("user_id < 9").count()
