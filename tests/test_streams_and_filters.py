"""Sampling by jumps, incremental stream moments, the blocked Bloom filter and document folders."""

import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import sketches as SK
from lodestar.sources import files as FS
from lodestar.streaming import moments as SM


def test_jumps_draw_uniform_positions():
    n, v = 40, 20_000
    got = np.bincount([SK.skip_position(s, n) for s in range(1, v + 1)], minlength=n + 1)
    assert got[0] == 0 and got[1:].sum() == v
    assert abs(got[1:] - v / n).max() < 5 * (v / n) ** 0.5
    for s in range(1, 30):  # more positions: the same jumps go on
        p = [SK.skip_position(s, m) for m in range(1, 60)]
        assert p[0] == 1 and all(b == a or b == m for m, (a, b) in enumerate(zip(p, p[1:], strict=False), 2))
    assert SK.skip_position(3, 10**15) <= 10**15


def test_skip_samples_and_their_estimates(spark):
    rnd = random.Random(9)
    stream = [rnd.randrange(7) if rnd.random() < 0.7 else 0 for _ in range(300)]  # 0 is frequent
    df = spark.createDataFrame([(i + 1, e) for i, e in enumerate(stream)], "pos BIGINT, el BIGINT")
    got = {r["variable"]: (r["position"], r["element"], r["count"]) for r in SK.ams_skip_samples(df, "el", "pos", 25).collect()}
    want = {}
    for s in range(1, 26):
        p = SK.skip_position(s, 300)
        want[s] = (p, stream[p - 1], stream[p - 1 :].count(stream[p - 1]))
    assert got == want
    samples = SK.ams_skip_samples(df, "el", "pos", 25)
    for r in SK.ams_from_samples(samples, F.lit(300), (1, 2, 3)).collect():
        k = r["k"]
        assert r["estimate"] == pytest.approx(np.mean([300 * (c**k - (c - 1) ** k) for *_, c in want.values()]))
    assert SK.ams_skip_samples(df.where("false"), "el", "pos", 4).count() == 0


def test_fifty_micro_batches_see_only_changed_counts(spark, scratch, monkeypatch):
    rnd = random.Random(1)
    values = [rnd.choice([0, 0, 0, *range(1, 400)]) for _ in range(1500)] + [None] * 3
    folder, part = os.path.join(scratch, "in"), -(-len(values) // 50)
    os.makedirs(folder)
    for n in range(50):
        with open(os.path.join(folder, f"{n:03d}.json"), "w") as f:
            f.writelines('{"el": %s}\n' % ("null" if x is None else x) for x in values[n * part : (n + 1) * part])
    epochs = []
    stream = spark.readStream.schema("el BIGINT").option("maxFilesPerTrigger", 1).json(folder)
    state = os.path.join(scratch, "state")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        last = SM._last_state

        def spy(session, state_dir, epoch, schema=SM.AMS_STATE_SCHEMA):
            epochs.append(epoch)
            return last(session, state_dir, epoch, schema)

        monkeypatch.setattr(SM, "_last_state", spy)
        q = SM.incremental_moments_stream(stream, "el", state, os.path.join(scratch, "ck"))
        q.awaitTermination(300)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    monkeypatch.undo()
    assert q.exception() is None and sorted(set(epochs)) == list(range(50))
    assert all(p["stateOperators"][0]["numRowsUpdated"] <= part for p in q.recentProgress if p["stateOperators"])  # the changed counts only
    got = SM.latest_totals(spark, state).first()
    exact = SK.exact_moments(spark.createDataFrame([(v,) for v in values], "el BIGINT"), "el").first()
    assert got["n_batches"] == 50 and [got[f"f{k}"] for k in range(4)] == [exact[f"f{k}"] for k in range(4)]
    third = SM._last_state(spark, state, 3, SM._totals_schema(range(4))).first()  # totals of every epoch are kept: a replay starts from those before it
    assert third["n_batches"] == 3 and third["f1"] == 3 * part


def test_counts_of_many_elements_share_a_state_row(spark, scratch):
    """The state has a row a bucket, whatever the number of elements; a null is an element."""
    folder = os.path.join(scratch, "in")
    values = [None, None, *[x for x in range(300) for _ in range(x % 4 + 1)]]
    df = spark.createDataFrame([(x,) for x in values], "el BIGINT")
    for _ in range(2):
        df.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema("el BIGINT").option("maxFilesPerTrigger", 1).parquet(folder)
    q = SM.incremental_moments_stream(stream, "el", os.path.join(scratch, "state"), os.path.join(scratch, "ck"), buckets=8)
    q.awaitTermination(300)
    assert q.exception() is None and q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8
    counts = [4, *[2 * (x % 4 + 1) for x in range(300)]]
    got = SM.latest_totals(spark, os.path.join(scratch, "state")).first()
    assert got["n_batches"] == 2 and [int(got[f"f{k}"]) for k in range(4)] == [sum(c**k for c in counts) for k in range(4)]


def _python_block(key, blocks, k):
    h = hashlib.md5(str(key).encode()).hexdigest()
    h1, h2 = int(h[:13], 16), int(h[13:26], 16)
    return h1 % blocks, {(h2 % 512 + i * (h2 // 512 % 256 * 2 + 1)) % 512 for i in range(k)}


@pytest.mark.parametrize("broadcast_bytes", [SK.BROADCAST_BYTES, 0])
def test_blocked_filter(spark, broadcast_bytes):
    blocks, k = SK.block_count(9600), 7
    keys = spark.range(0, 2000, 2).select(F.col("id").alias("key"))
    rows = SK.blocked_bloom_build(keys.union(keys).union(spark.createDataFrame([(None,)], "key BIGINT")), "key", blocks, k)
    want = {}
    for key in range(0, 2000, 2):
        b, bits = _python_block(key, blocks, k)
        assert len(bits) == k
        want.setdefault(b, set()).update(bits)
    got = {r["block"]: {64 * w + i for w in range(8) for i in range(64) if r[f"w{w}"] >> i & 1} for r in rows.collect()}
    assert got == want
    probes = spark.range(0, 4000).select(F.col("id").alias("key")).union(spark.createDataFrame([(None,)], "key BIGINT"))
    res = {r["key"]: r["passed"] for r in SK.blocked_bloom_probe(probes, "key", rows, blocks, k, broadcast_bytes).collect()}
    assert len(res) == 4001 and res[None] is False
    assert all(res[i] for i in range(0, 2000, 2))
    others = [res[i] for i in range(4000) if i % 2 or i >= 2000]
    assert sum(others) / len(others) < 0.06
    assert all(res[i] == (_python_block(i, blocks, k)[1] <= want.get(_python_block(i, blocks, k)[0], set())) for i in range(4000))
    plan = SK.blocked_bloom_probe(probes, "key", rows, blocks, k, broadcast_bytes)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # one join row a probe
    with pytest.raises(ValueError):
        SK.blocked_bloom_build(keys, "key", blocks, 600)


def test_document_folder(spark, scratch):
    folder = os.path.join(scratch, "odd %+names")
    texts = {"7": "one\ntwo", "12": "", "30": "café + 100%"}
    for k, t in texts.items():
        os.makedirs(os.path.join(folder, f"doc no={k}"))
        with open(os.path.join(folder, f"doc no={k}", "a b+c.txt"), "w") as f:
            f.write(t)
    with open(os.path.join(folder, "stray.txt"), "w") as f:
        f.write("no id")
    with open(os.path.join(folder, "other.csv"), "w") as f:
        f.write("not read")
    got = {r["doc_id"]: r["content"] for r in FS.read_document_folder(spark, folder, "%[+]names/doc no=([0-9]+)/a b[+]c", "*.txt").collect()}
    assert got.pop(None) == "no id"
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in texts.items() if v}
