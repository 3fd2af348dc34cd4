import itertools

import pytest
from pyspark.sql import functions as F

from lodestar.operators import groups as G
from lodestar.operators import lsh as L
from lodestar.operators import minhash as M

# fixed values: the ten sets of the LSH exercise
TEN_SETS = [{1, 2, 3}, {2, 3, 4}, {4, 5, 6}, {1, 2}, {2, 3}, {1, 3, 5}, {4, 5}, {6, 7}, {2, 4}, {3, 6}]


def _sets_df(spark, sets):
    return spark.createDataFrame([(i, e) for i, s in enumerate(sets) for e in s], "set_id BIGINT, element BIGINT")


def test_toy_minhash_single_given_hash(spark):
    # fixed values: col1 {1,3,5}, col2 {2,4,6}, col3 {1,2,3,6,10}; h = ((37x + 126) % (2^31-1)) % 10^12 + 1
    df = _sets_df(spark, [{1, 3, 5}, {2, 4, 6}, {1, 2, 3, 6, 10}])
    sig = {r.set_id: r.sig for r in M.signature_arrays(df, [M.GIVEN_HASH], n=10**12).collect()}
    assert [sig[i][0] for i in range(3)] == [164, 201, 164]


def test_hash_family_is_deterministic_and_in_range():
    fam = M.hash_family(50)
    assert fam == M.hash_family(50)
    assert fam[0] == M.GIVEN_HASH
    assert all(1 <= a < 2**31 - 1 and 0 <= b < 2**31 - 1 for a, b in fam)


def test_pair_jaccard_fixture(spark):
    df = _sets_df(spark, TEN_SETS)
    pairs = spark.createDataFrame(list(itertools.combinations(range(4), 2)), "set_a BIGINT, set_b BIGINT")
    got = {(r.set_a, r.set_b): r.jaccard for r in M.pair_jaccard(df, pairs).collect()}
    # fixed values: Jaccard inside the group 0, 1, 2, 3
    exp = {(0, 1): 0.5, (0, 2): 0.0, (0, 3): 0.667, (1, 2): 0.2, (1, 3): 0.25, (2, 3): 0.0}
    for k, v in exp.items():
        assert got[k] == pytest.approx(v, abs=1e-3)


def test_jaccard_pairs_brute_force_with_tiles(spark):
    df = _sets_df(spark, TEN_SETS)
    got = {(r.set_a, r.set_b): r.jaccard for r in M.jaccard_pairs(df, tile_rows=2).collect()}
    exp = {}
    for a, b in itertools.combinations(range(len(TEN_SETS)), 2):
        i = len(TEN_SETS[a] & TEN_SETS[b])
        if i:
            exp[(a, b)] = i / len(TEN_SETS[a] | TEN_SETS[b])
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k])


def test_identical_sets_have_jaccard_one_and_full_agreement(spark):
    df = _sets_df(spark, [{1, 5, 9}, {1, 5, 9}])
    j = M.jaccard_pairs(df).first()
    assert j.jaccard == 1.0
    sig = M.signature_arrays(df, M.hash_family(20))
    pairs = spark.createDataFrame([(0, 1)], "set_a BIGINT, set_b BIGINT")
    assert M.signature_agreement(sig, pairs).first().signature_similarity == 1.0


def test_signature_agreement_tracks_jaccard(spark):
    a = set(range(0, 300))
    b = set(range(100, 400))  # Jaccard 0.5
    df = _sets_df(spark, [a, b])
    sig = M.signature_arrays(df, M.hash_family(400))
    pairs = spark.createDataFrame([(0, 1)], "set_a BIGINT, set_b BIGINT")
    assert M.signature_agreement(sig, pairs).first().signature_similarity == pytest.approx(0.5, abs=0.08)


def test_pairs_in_groups_hot_group_split(spark):
    rows = [(0, m) for m in range(40)] + [(1, m) for m in range(3)]
    df = spark.createDataFrame(rows, "g BIGINT, m BIGINT")
    got = sorted((r.g, r.lo, r.hi) for r in G.pairs_in_groups(df, "g", "m", tile_rows=7).collect())
    exp = sorted([(0, a, b) for a, b in itertools.combinations(range(40), 2)] + [(1, a, b) for a, b in itertools.combinations(range(3), 2)])
    assert got == exp


def test_global_row_number(spark):
    import random

    vals = random.Random(1).sample(range(10000), 500)
    df = spark.createDataFrame([(v,) for v in vals], "v BIGINT")
    got = {r.v: r.rn for r in G.global_row_number(df, [F.col("v")], partitions=7).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(vals))}


def test_band_hashes_and_buckets(spark):
    df = _sets_df(spark, [{1, 2, 3, 4}, {1, 2, 3, 4}, {50, 60, 70}])
    sig = M.signature_arrays(df, M.hash_family(10))
    bh = L.band_hashes(sig, 5, 2)
    assert bh.count() == 15
    coll = L.collisions(bh).collect()
    assert len(coll) == 5 and all(r.members == [0, 1] for r in coll)
    cand = L.candidate_edges(bh).collect()
    assert [(r.set_a, r.set_b) for r in cand] == [(0, 1)]
    with pytest.raises(Exception):
        L.band_hashes(sig, 3, 2).collect()
    for method in ("xxhash", "builtin"):
        assert L.band_hashes(sig, 5, 2, method).count() == 15


def test_candidate_edges_connect_the_bucket(spark):
    # a bucket of 6 members gives 5 edges to its smallest member
    df = _sets_df(spark, [{1, 2}] * 6)
    sig = M.signature_arrays(df, M.hash_family(4))
    edges = L.candidate_edges(L.band_hashes(sig, 2, 2)).collect()
    assert sorted((r.set_a, r.set_b) for r in edges) == [(0, b) for b in range(1, 6)]


def test_bucket_pairs_lists_every_pair_once(spark):
    """All pairs of a bucket, not only those with its smallest member, and a pair of several bands once."""
    base = set(range(30))
    sets = [base - {i} for i in range(8)] + [base, base, {100, 101}, {102}, set(range(200, 230)), set(range(200, 231))]
    sig = M.signature_arrays(_sets_df(spark, sets), M.hash_family(20))
    rows = {r.set_id: r.sig for r in sig.collect()}
    want = {(a, b) for a in rows for b in rows if a < b and any(rows[a][k : k + 2] == rows[b][k : k + 2] for k in range(0, 20, 2))}
    got = [(r.set_a, r.set_b) for r in L.bucket_pairs(sig, 10, 2).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {(8, 9), (1, 2), (5, 9)} <= want and L.candidate_edges(L.band_hashes(sig, 10, 2)).count() < len(want)
    assert L.bucket_pairs(sig.where("set_id in (10, 11)"), 10, 2).count() == 0


def test_lsh_candidates_holds_pairs_without_the_smallest_member(spark):
    """The query lists both copies' pairs with a third set, and the pair of the two larger ids."""
    from lodestar.plans import sets as S

    cand = S.q_lsh_candidates(spark, "/root/testdata/sf0.001").collect()
    buckets = S.q_lsh_collisions(spark, "/root/testdata/sf0.001").collect()
    want = set()
    for b in buckets:
        m = sorted(int(x) for x in b.members.split(","))
        want |= {(x, y) for i, x in enumerate(m) for y in m[i + 1 :]}
    assert sorted((r.set_a, r.set_b) for r in cand) == sorted(want) and want


def test_largest_group_and_verify(spark):
    sets = [{1, 2, 3, 4}, {1, 2, 3, 4}, {1, 2, 3, 4}, {9, 10}, {9, 10}]
    df = _sets_df(spark, sets)
    sig = M.signature_arrays(df, M.hash_family(4))
    bh = L.band_hashes(sig, 2, 2)
    g = L.largest_group(L.collisions(bh), 10).collect()
    assert g[0].size == 3
    members = bh.join(spark.createDataFrame([(g[0].band, g[0].bucket)], "band INT, bucket STRING"), ["band", "bucket"])
    v = L.verify_group(members, df, sig, strict=True).collect()
    assert sorted((r.set_a, r.set_b) for r in v) == [(0, 1), (0, 2), (1, 2)]
    assert all(r.jaccard == 1.0 and r.signature_similarity == 1.0 for r in v)


def test_s_curve_values(spark):
    df = spark.range(1).select(
        *[L.s_curve(x, r, b).alias(f"s_{r}_{b}_{int(x * 10)}") for r, b in [(2, 10), (2, 50), (5, 10), (5, 50)] for x in (0.2, 0.5, 0.8)]
    )
    got = df.first().asDict()
    # fixed values: 1 - (1 - x^r)^b at x = 0.2, 0.5, 0.8
    exp = {
        (2, 10): [0.335167, 0.943686, 0.999963],
        (2, 50): [0.870114, 0.999999, 1.0],
        (5, 10): [0.003195, 0.272024, 0.981131],
        (5, 50): [0.015875, 0.795551, 1.0],
    }
    for (r, b), vals in exp.items():
        for x, v in zip((2, 5, 8), vals):
            assert got[f"s_{r}_{b}_{x}"] == pytest.approx(v, abs=1e-6)


def test_large_prime_signature_uses_set_size(spark):
    df = _sets_df(spark, [{5, 7, 11}])
    out = {r.k: r.h for r in M.large_prime_signatures(df, M.large_prime_family()).collect()}
    for k, (a, b, p) in enumerate(M.large_prime_family()):
        assert out[k] == min(((a + x * b) % p) % 3 + 1 for x in (5, 7, 11))


def test_hot_group_tiles_are_bounded(spark):
    # one group holds most rows: its pairs are spread over t(t+1)/2 tiles, none above tile_rows^2 pairs
    hot = [(0, m) for m in range(300)]
    cold = [(g, m) for g in range(1, 40) for m in range(3)]
    df = spark.createDataFrame(hot + cold, "g BIGINT, m BIGINT")
    tile = 40
    p = G.pairs_in_groups(df, "g", "m", tile_rows=tile, keep_tiles=True)
    per_tile = p.groupBy("g", "tile_i", "tile_j").count()
    hot_tiles = per_tile.where("g = 0").collect()
    t = -(-300 // tile)
    assert len(hot_tiles) == t * (t + 1) // 2
    assert max(r["count"] for r in hot_tiles) <= tile * tile * 2
    assert p.where("g = 0").count() == 300 * 299 // 2
    assert per_tile.where("g > 0").agg(F.max("count")).first()[0] == 3


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 25)), min_size=0, max_size=60),
    st.integers(min_value=1, max_value=9),
)
def test_pairs_in_groups_property(spark, rows, tile):
    rows = sorted(set(rows))
    df = spark.createDataFrame(rows or [(0, 0)], "g BIGINT, m BIGINT")
    if not rows:
        df = df.limit(0)
    got = sorted((r.g, r.lo, r.hi) for r in G.pairs_in_groups(df, "g", "m", tile_rows=tile).collect())
    by_g = {}
    for g, m in rows:
        by_g.setdefault(g, []).append(m)
    exp = sorted((g, a, b) for g, ms in by_g.items() for a, b in itertools.combinations(sorted(ms), 2))
    assert got == exp


def test_hot_key_lists_are_built_in_several_tasks(spark):
    """A third of the rows on one key: its chunks are spread over partitions."""
    from lodestar.operators.groups import chunked_collect

    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    out = chunked_collect(df, ["k"], "v", F.col("v"), "vs", chunk_rows=500)
    parts = out.where("k = 0").select(F.spark_partition_id().alias("p"), F.size("vs").alias("n")).collect()
    assert sum(r["n"] for r in parts) == 10_000 and len({r["p"] for r in parts}) > 3


def test_candidate_pairs_are_complete_in_a_bucket(spark):
    """Pairs that do not hold the smallest member are candidates too; copies are one member."""
    sig = spark.createDataFrame([(1, [1, 1, 1, 1]), (2, [1, 1, 2, 2]), (3, [1, 1, 2, 3]), (4, [1, 1, 2, 3]), (5, [9, 9, 9, 9])], "set_id bigint, sig array<bigint>")
    got = sorted(tuple(r) for r in L.candidate_pairs(sig, 2, 2).collect())
    assert got == [(1, 2), (1, 3), (2, 3)]


def test_different_sets_of_one_signature_are_candidates(spark):
    """Near copies that agree on every hash are a pair of their own, and each meets the other sets; only equal sets are one member."""
    family = M.hash_family(4)
    a = set(range(1, 400))
    low = [min((x * h + b) % (2**31 - 1) for x in a) for h, b in family]
    more = [x for x in range(400, 5000) if all((x * h + b) % (2**31 - 1) > m for (h, b), m in zip(family, low, strict=True))][:2]
    c = a - {min(a, key=lambda x: (x * family[0][0] + family[0][1]) % (2**31 - 1))}  # another signature, one band in common
    sets = _sets_df(spark, [a, a | {more[0]}, a | set(more), c, a])
    sig = M.signature_arrays(sets, family, digest=True)
    assert len({tuple(r.sig) for r in sig.where("set_id <> 3").collect()}) == 1
    pairs = L.candidate_pairs(sig, 2, 2)
    assert sorted(tuple(r) for r in pairs.collect()) == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]
    got = {(r.set_a, r.set_b): (r.jaccard, r.signature_similarity) for r in L.verify_pairs(pairs, sets, sig).collect()}
    assert got[1, 2] == (pytest.approx(400 / 401), 1.0) and got[0, 1] == (pytest.approx(399 / 400), 1.0)
    assert sorted(tuple(r) for r in M.set_copies(sets).collect()) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 0)]


def test_document_signatures_are_made_in_place(spark, scratch):
    """Whole texts get the signatures of their long rows without a shuffle of elements; ids of several rows are united."""
    from lodestar.plans import sets as P

    texts = [(1, "the quick brown fox\njumps over"), (2, "the quick brown fox jumps over"), (3, "abc"), (4, None), (5, "\U0001f600 日本語 テスト abc def"), (6, "aaaaaaaa"), (None, "nobody's text")]
    family = M.hash_family(P.NUM_HASHES)
    frames = [spark.createDataFrame(texts, "doc_id BIGINT, text STRING").repartition(3)]
    frames.append(frames[0].unionByName(spark.createDataFrame([(3, "abc quick brown"), (2, "the quick brown dog"), (2, "the quick brown fox jumps over"), (7, "the quick brown dog")], frames[0].schema)))
    for k, docs in enumerate(frames):
        docs.write.parquet(f"{scratch}/{k}/documents.parquet")
        want = {r.set_id: (r.sig, r.n) for r in M.signature_arrays(P.doc_sets(spark, None, docs), family, digest=True).collect()}
        n = {}
        for i, t in [(r.doc_id, r.text) for r in docs.collect()]:
            t = (t or "").replace("\n", " ")
            n.setdefault(i, set()).update(t[j : j + 5] for j in range(len(t) - 4))  # code points, as SQL counts
        assert {i: v[1] for i, v in want.items()} == {i: len(s) for i, s in n.items() if s and i is not None}
        rows = P.doc_signatures(spark, f"{scratch}/{k}").collect()
        assert {r.set_id: (r.sig, r.n) for r in rows} == want and len(rows) == len(want)
        digests = {r.set_id: r.digest for r in rows}
        assert len(set(digests.values())) == len(M.set_copies(P.doc_sets(spark, None, docs)).groupBy("representative").count().collect())
    whole = frames[0].coalesce(1).select("doc_id", "text")
    plans = [d._jdf.queryExecution().executedPlan().toString() for d in (whole, M.signature_arrays(P.doc_contents(whole), family, elements=P._shingled))]
    assert plans[0].count("Exchange") == plans[1].count("Exchange")


def test_shingle_keys_compare_as_the_ids():
    """Packed keys, and ids where the alphabet is too large to pack, agree with the shingles themselves."""
    from lodestar.operators.text import shingle_ids, shingle_keys

    few = ["", None, "abcd", "abcde", "abcdeabcdef", "\U0001f600 abcde"]
    for texts in (few, [*few, "".join(map(chr, range(0x4E00, 0x7000)))]):
        want = [{t[i : i + 5] for i in range(len(t) - 4)} if t else set() for t in texts]
        for own in (shingle_ids(texts, 5), shingle_keys(texts, 5)):
            got = [set(x.tolist()) for x in own]
            assert [len(x) for x in got] == [len(x) for x in want] == [len(x) for x in own]
            assert [[len(a & b) for b in got] for a in got] == [[len(a & b) for b in want] for a in want]
