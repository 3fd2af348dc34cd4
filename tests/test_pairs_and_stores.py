"""Threshold set join, masked pair products, set overlap in tiles, sampled rates and stored tables against brute force."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import lsh as L
from lodestar.operators import minhash as M
from lodestar.operators import set_join as SJ
from lodestar.operators import similarity as SIM
from lodestar.operators.pair_products import pair_products
from lodestar.operators.stored import source_key, stored_table


@pytest.fixture(scope="module")
def sets(spark):
    rnd = random.Random(2)
    base = [rnd.sample(range(60), 14) for _ in range(6)]
    out = {}
    for k in range(60):
        own = set(base[k % 6])
        for _ in range(rnd.randrange(6)):
            own.symmetric_difference_update({rnd.randrange(60)})
        out[k] = own | {999}  # one element that every set holds
    out[70], out[71], out[72] = {5}, {5}, {1000 + k for k in range(3000)}  # single elements, a large set without a partner
    out[73] = set(list(out[72])[:2400])
    rows = [(k, e) for k, s in out.items() for e in s]
    return out, spark.createDataFrame(rows, "set_id BIGINT, element BIGINT").repartition(5).cache()


def jaccards(sets):
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            yield a, b, len(sets[a] & sets[b]), len(sets[a] | sets[b])


@pytest.mark.parametrize("num,den", [(1, 1), (3, 4), (1, 2), (7, 100)])
def test_jaccard_at_least(spark, sets, num, den):
    own, df = sets
    want = sorted((a, b, i, u, i / u) for a, b, i, u in jaccards(own) if den * i >= num * u and i)
    got = sorted(tuple(r) for r in SJ.jaccard_at_least(df, num, den, tile_rows=16).collect())
    assert got == want and want
    candidates = SJ.candidate_pairs_at_least(df, num, den).count()
    assert candidates >= len(want)
    if num / den >= 0.75:
        assert candidates < sum(1 for *_, i, _ in jaccards(own) if i) / 4  # far fewer than the pairs that share an element


def test_jaccard_at_least_of_nothing(spark, sets):
    assert SJ.jaccard_at_least(sets[1].where("false"), 1, 2).count() == 0
    for bad in ((0, 1), (3, 2)):
        with pytest.raises(ValueError):
            SJ.jaccard_at_least(sets[1], *bad)


@pytest.mark.parametrize("tile", [1 << 22, 400])
def test_array_overlap(spark, sets, tile):
    own, df = sets
    pairs = [(a, b) for a, b, *_ in jaccards(own) if (a + b) % 5 == 0] + [(1, 500), (500, 501)]
    p = spark.createDataFrame(pairs, "set_a BIGINT, set_b BIGINT")
    arrays = df.groupBy("set_id").agg(F.collect_list("element").alias("elements"))
    own = {**own, 500: set(), 501: set()}
    want = sorted((a, b, len(own[a] & own[b]), len(own[a] | own[b])) for a, b in pairs)
    assert sorted(tuple(r) for r in M.array_overlap(arrays, p, df.count(), tile).collect()) == want
    assert sorted(tuple(r) for r in M.pair_overlap(df, p).collect()) == want
    halves = arrays.withColumn("elements", F.explode(F.array(F.slice("elements", 1, 5), F.col("elements"))))  # several arrays of a set
    assert sorted(tuple(r) for r in M.array_overlap(halves, p, df.count(), tile).collect()) == want


def test_verify_arrays_is_verify_pairs(spark, sets):
    own, df = sets
    sig = M.signature_arrays(df, M.hash_family(20))
    p = spark.createDataFrame([(a, b) for a, b, *_ in jaccards(own) if a < 9], "set_a BIGINT, set_b BIGINT")
    arrays = df.groupBy("set_id").agg(F.collect_list("element").alias("elements"))
    a, b = (sorted(tuple(r) for r in x.collect()) for x in (L.verify_arrays(p, arrays, sig, df.count()), L.verify_pairs(p, df, sig)))
    assert a == b and a


@pytest.mark.parametrize("vector_entries", [1 << 20, 7])
def test_pair_products(spark, vector_entries):
    rnd = np.random.default_rng(4)
    dense = rnd.integers(-3, 4, (30, 25)) * rnd.integers(0, 2, (30, 25))
    entries = [(u, i * 10, float(dense[u, i])) for u in range(30) for i in range(25) if dense[u, i]]
    v = spark.createDataFrame(entries, "user_id BIGINT, item_id BIGINT, value DOUBLE")
    asked = [(int(a), int(b)) for a, b in rnd.integers(0, 30, (80, 2))] + [(1, 99), (99, 98)]
    asked = sorted(set(asked))
    p = spark.createDataFrame(asked, "user_a BIGINT, user_b BIGINT")
    got = {(r["user_a"], r["user_b"]): (r["n_common"], r["dot"], r["square_a"], r["square_b"]) for r in pair_products(v, p, vector_entries=vector_entries).collect()}
    want = {}
    for a, b in asked:
        if max(a, b) < 30:
            both = (dense[a] != 0) & (dense[b] != 0)
            if both.any():
                want[a, b] = (int(both.sum()), float(dense[a] @ dense[b]), float((dense[a] ** 2 * both).sum()), float((dense[b] ** 2 * both).sum()))
    assert got.keys() == want.keys()
    for k, x in want.items():
        assert got[k] == pytest.approx(x)


def test_pair_correlations_are_those_of_the_pair_table(spark):
    rnd = random.Random(6)
    um = spark.createDataFrame([(u, i, float(rnd.randint(1, 5))) for u in range(20) for i in range(15) if rnd.random() < 0.4], "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    whole = {(r["user_a"], r["user_b"]): (r["pearson_corr"], r["n_common"]) for r in SIM.pearson_pairs(um).collect()}
    asked = [(a, b) for a in range(20) for b in range(20) if (a * b) % 3 == 1] + [(0, 77)]
    got = SIM.pair_correlations(um, spark.createDataFrame(asked, "user_a BIGINT, user_b BIGINT")).collect()
    assert len(got) == len(set(asked))
    for r in got:
        a, b = r["user_a"], r["user_b"]
        if a == b:
            assert r["pearson_corr"] is None or r["pearson_corr"] == pytest.approx(1)
            continue
        corr, n = whole.get((min(a, b), max(a, b)), (None, 0))
        assert r["n_common"] == n and (r["pearson_corr"] == pytest.approx(corr) if corr is not None else r["pearson_corr"] is None)


def test_sampled_pairs_and_observed_rates(spark, sets):
    own, df = sets
    every = {(a, b): i / u for a, b, i, u in jaccards(own) if i}
    whole = L.sampled_pairs(df, anchors=10**9, per_bin=10**9)  # all sets are anchors, all pairs drawn
    assert {(r["set_a"], r["set_b"]): r["jaccard"] for r in whole.collect()} == pytest.approx(every)
    few = L.sampled_pairs(df, anchors=15, per_bin=12).collect()
    assert 0 < len(few) < len(every)
    for r in few:
        assert r["jaccard"] == pytest.approx(every[r["set_a"], r["set_b"]]) and r["jaccard_bin"] <= r["jaccard"] < r["jaccard_bin"] + 0.1 + 1e-9
    family = M.hash_family(40)
    sig = M.signature_arrays(df, family)
    by = {r["set_id"]: r["sig"] for r in sig.collect()}
    got = {(r["r"], r["b"], r["jaccard_bin"]): r for r in L.candidate_rates(whole, sig, [(2, 20), (5, 4)]).collect()}
    for (r, b, low), row in got.items():
        own_pairs = [(p, x) for p, x in every.items() if np.floor(x * 10) / 10 == low]
        hits = [any(by[p][k * r : (k + 1) * r] == by[q][k * r : (k + 1) * r] for k in range(b)) for (p, q), _ in own_pairs]
        assert row["n_sample"] == row["n_pairs"] == len(own_pairs)
        assert row["observed_rate"] == pytest.approx(np.mean(hits)) and row["expected_rate"] == pytest.approx(np.mean([1 - (1 - x**r) ** b for _, x in own_pairs]))


def test_anchor_pairs_are_not_shuffled(spark, sets):
    """Sets longer than an Arrow batch are counted across batches, and no pair waits in an aggregate."""
    own, df = sets
    every = {(a, b): i / u for a, b, i, u in jaccards(own) if i}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        size = df.groupBy("set_id").agg(F.count(F.lit(1)).alias("_n"))
        p = L._anchor_pairs(df, size.where("set_id % 3 = 0"), df.count(), 10, task_rows=40)
        got = p.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {k: x for k, x in every.items() if k[0] % 3 == 0 or k[1] % 3 == 0}
    assert len(got) == len(want) and {(r["set_a"], r["set_b"]): r["jaccard"] for r in got} == pytest.approx(want)
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("MapInArrow")[0] and "Join" not in plan


def test_stored_table_follows_its_source(spark, scratch):
    path = os.path.join(scratch, "src.parquet")
    spark.range(10).write.parquet(path)
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(path).select("id", (F.col("id") * 2).alias("twice"))

    a, b = (stored_table(spark, "twice", path, "id", build) for _ in range(2))
    assert len(calls) == 1 and a.count() == b.count() == 10
    join = a.join(b.withColumnRenamed("twice", "again"), "id")
    assert "hashpartitioning" not in join.hint("merge")._jdf.queryExecution().executedPlan().toString()
    key = source_key(spark, path)
    spark.range(5).write.mode("append").parquet(path)
    assert source_key(spark, path) != key
    assert stored_table(spark, "twice", path, "id", build).count() == 15 and len(calls) == 2
    now = stored_table(spark, "twice", path, "id", build)
    folder = os.path.dirname(now.inputFiles()[0].replace("file://", ""))
    os.remove(os.path.join(folder, "_SUCCESS"))  # the folder was emptied, or its writer died: built again
    assert stored_table(spark, "twice", path, "id", build).count() == 15 and len(calls) == 3


def test_pairs_reduced_where_lists_meet(spark, sets):
    """Counts and sums of all pairs, with groups cut into chunks and a member listed twice, and far fewer candidates at a small similarity."""
    from lodestar.operators.groups import pairs_in_groups

    own, df = sets
    x = df.select("element", "set_id", (F.col("set_id") * 2 + F.col("element")).alias("v"))
    want = {(a, b): (i, sum((2 * a + e) * (2 * b + e) for e in own[a] & own[b])) for a, b, i, _ in jaccards(own) if i}
    add = lambda lo, hi, first: [np.add.reduceat(lo[0] * hi[0], first)]
    for rows, tile in ((x, 7), (x, 2048), (x.unionByName(x.where("set_id = 70")), 7)):
        p = pairs_in_groups(rows, "element", "set_id", ["v"], tile_rows=tile, reduce=add, reduced="xy bigint")
        got = {(r.lo, r.hi): (r.n_common, r.xy) for r in p.collect()}
        assert {k for k in got if 70 not in k} == {k for k in want if 70 not in k}
        assert all(v == want[k] for k, v in got.items() if 70 not in k) and (70, 70) not in got
        if rows is x:
            assert got == want
    assert pairs_in_groups(x.where("false"), "element", "set_id", ["v"], reduce=add, reduced="xy bigint").count() == 0
    rnd = random.Random(4)
    wide = spark.createDataFrame([(k, e) for k in range(120) for e in rnd.sample(range(2000), 40)], "set_id BIGINT, element BIGINT")
    met = M.jaccard_pairs(wide).count()
    assert met > 2000 and SJ.candidate_pairs_at_least(wide, 7, 100).count() < met / 10  # the prefixes are nearly whole: sharing an element alone is no reason


def test_products_of_asked_pairs_by_lists(spark, sets):
    """The same sums in both forms, whatever the order of a pair, and only of the asked pairs; many partners choose the lists."""
    from lodestar.operators import pair_products as PP

    own, df = sets
    v = df.select(F.col("set_id").alias("user_id"), F.col("element").alias("item_id"), (F.col("set_id") + F.col("element") / 7).alias("value")).cache()
    asked = [(a, b) if (a + b) % 2 else (b, a) for a, b, *_ in jaccards(own) if (a * b) % 3 == 1] + [(0, 1), (1, 0), (5, 900)]
    pairs = spark.createDataFrame(asked, "user_a BIGINT, user_b BIGINT").distinct().cache()
    rows = lambda d: {(r.user_a, r.user_b): (r.n_common, round(r.dot, 6), round(r.square_a, 6), round(r.square_b, 6)) for r in d.collect()}
    want = {}
    for a, b in set(asked):
        e = own[a] & own.get(b, set())
        if e:
            want[a, b] = (len(e), *[round(sum(x), 6) for x in zip(*[((a + i / 7) * (b + i / 7), (a + i / 7) ** 2, (b + i / 7) ** 2) for i in e], strict=True)])
    whole = {k: x[0] for k, x in rows(PP.pair_products(v, pairs, 1 << 21)).items()}
    assert rows(PP._listed_products(v, pairs)).keys() == want.keys() == whole.keys()
    for k, x in rows(PP._listed_products(v, pairs)).items():
        assert x == pytest.approx(want[k], abs=1e-5)


def test_packed_lists_come_back():
    """Any 64-bit integers and doubles, empty columns included; sorted ids cost two to three bytes each, not eight."""
    from lodestar.operators import member_lists as ML

    rnd = np.random.default_rng(3)
    cols = [np.array([-(2**63), 2**63 - 1, 0]), np.array([0.1, -0.0, np.inf, np.nan]), np.zeros(0, dtype=np.int64), np.arange(300), rnd.integers(0, 2**33, 50)]
    for c, d in zip(cols, ML.unpacked(ML.packed(cols)), strict=True):
        assert c.dtype == d.dtype and c.tobytes() == d.tobytes()
    ids = np.sort(rnd.choice(3_000_000, 20_000, replace=False))
    start = np.arange(1, 20_001)
    sent = [b for _, b in ML.sends(ids, [ids * 2], start, np.minimum(start + 50, 20_000), ids, [], 4)]
    assert sum(map(len, sent)) < 3 * 50 * 20_000
    member, n, own, got, _ = ML.received(__import__("pyarrow").array(sent), 1)
    assert len(member) == 19_999 and (own[0] == member * 2).all()
    at = np.cumsum(n) - n
    for i in range(0, len(member), 997):
        p = int(np.searchsorted(ids, member[i]))
        assert got[at[i] : at[i] + n[i]].tolist() == ids[p + 1 : p + 51].tolist()


def test_pairs_ship_a_few_bytes_each(spark, monkeypatch):
    """The lists of 200,000 pairs take less than half of the 16 bytes that an id and a value of a pair have in rows."""
    from lodestar.operators import groups as G
    from lodestar.operators import member_lists as ML

    seen = []
    real = ML.larger_lists
    monkeypatch.setattr(ML, "larger_lists", lambda *a: seen.append(real(*a)) or seen[-1])
    rnd = random.Random(6)
    x = spark.createDataFrame([(g, m, float(rnd.randrange(50))) for g in range(500) for m in rnd.sample(range(100_000), 30)], "g BIGINT, m BIGINT, v DOUBLE")
    assert G.pairs_in_groups(x, "g", "m", ["v"], reduce=lambda lo, hi, first: [np.add.reduceat(lo[0] * hi[0], first)], reduced="xy double").count() > 200_000
    assert seen[0].agg(F.sum(F.length("_sent"))).first()[0] < 8 * 500 * 30 * 29 / 2


def test_no_spread_on_common_items_is_null(spark):
    """Ratings equal to their user's mean are centred to exactly 0 where they meet."""
    rows = [(1, 10, 0.1), (1, 11, 0.1), (1, 12, 0.1), (2, 10, 5.0), (2, 13, 1.0), (3, 11, 2.0), (3, 14, 0.0)]
    got = {(r.user_a, r.user_b): (r.pearson_corr, r.n_common) for r in SIM.pearson_pairs(spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE")).collect()}
    mean = (0.1 + 0.1 + 0.1) / 3
    assert set(got) == {(1, 2), (1, 3)} and all(n == 1 and (c is None) == (mean == 0.1) for c, n in got.values())


def test_shuffle_files_of_written_tables_go(spark):
    """What a written table or a checkpoint shuffled does not wait on disk for the next collection of garbage."""
    from lodestar.operators import groups as G

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    x = spark.range(100_000).selectExpr("id % 1000 AS k", "id").groupBy("k").count()
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: sum(f.getName().startswith("shuffle_") for f in [a.apply(i) for a in [store.getAllFiles()] for i in range(a.size())])
    before = files()
    assert G.written(x).count() == 1000 and G.reliable_checkpoint(x).count() == 1000
    spark.range(10).count()
    left = files() - before
    x.write.format("noop").mode("overwrite").save()
    assert left <= files() - before and spark.conf.get(key, "false") == "false"


def test_pearson_lists_are_short(spark, monkeypatch):
    """A co-rater's centred rating travels as rating, sum and number, each short; 8 bytes of mantissa a pair before."""
    from lodestar.operators import member_lists as ML

    seen = []
    real = ML.larger_lists
    monkeypatch.setattr(ML, "larger_lists", lambda *a: seen.append(real(*a)) or seen[-1])
    rnd = random.Random(7)
    um = spark.createDataFrame([(u, i, float(1 + rnd.randrange(50))) for i in range(400) for u in rnd.sample(range(3000), 40)], "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    assert SIM.pearson_pairs(um).count() > 100_000
    assert seen[0].agg(F.sum(F.length("_sent"))).first()[0] < 6 * 400 * 40 * 39 / 2


@pytest.mark.parametrize("block,passing,turn", [(1 << 24, 1 << 27, 1 << 30), (300, 200, 1000), (30, 200, 1000), (60, 1 << 27, 1 << 30)])
def test_block_overlaps(spark, sets, block, passing, turn):
    """Every pair once and on its own side, whatever the blocks, segments and turns; sets without a row or a signature; several rows of a set."""
    from lodestar.operators.block_overlap import block_overlaps, distinct_arrays

    own, df = sets
    pairs = [(a, b) if (a + b) % 3 else (b, a) for a, b, *_ in jaccards(own) if (a * 7 + b) % 4 == 0] + [(1, 500), (501, 500), (500, 1)]
    rows = df.groupBy("set_id").agg(F.collect_list("element").alias("content"))
    rows = rows.withColumn("content", F.explode(F.array(F.slice("content", 1, 3), F.col("content"))))
    sig = M.signature_arrays(df.where("set_id <> 7"), M.hash_family(12))
    signs = {r.set_id: r.sig for r in sig.collect()}
    o = block_overlaps(rows, spark.createDataFrame(pairs, "set_a BIGINT, set_b BIGINT"), df.count(), distinct_arrays, sig, block, passing, turn)
    own = {**own, 500: set(), 501: set()}
    both = lambda a, b: (sum(x == y for x, y in zip(signs[a], signs[b], strict=True)), 12) if a in signs and b in signs else (0, 0)
    assert sorted(tuple(r) for r in o.collect()) == sorted((a, b, len(own[a] & own[b]), len(own[a] | own[b]), *both(a, b)) for a, b in pairs)


def test_verify_arrays_joins_no_signature_to_a_pair(spark, sets):
    """A signature meets its set once a block; the plan joins the pairs' lists to the sets, never the pairs to signatures."""
    _, df = sets
    sig = M.signature_arrays(df, M.hash_family(20))
    p = spark.createDataFrame([(a, b) for a in range(20) for b in range(a + 1, 20)], "set_a BIGINT, set_b BIGINT")
    v = L.verify_arrays(p, df.groupBy("set_id").agg(F.collect_list("element").alias("elements")), sig, df.count())
    plan = v._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "set_a" not in plan[plan.index("Join") :]
