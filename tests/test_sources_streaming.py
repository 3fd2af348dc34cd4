import os

import pytest
from pyspark.sql import functions as F

from lodestar.operators import clean as CL
from lodestar.operators import sketches as SK
from lodestar.sources import files as FS
from lodestar.streaming import moments as SM


def test_ratings_csv_first_three_columns_and_cap(spark, scratch):
    p = os.path.join(scratch, "ratings.csv")
    with open(p, "w") as f:
        f.write("userId,movieId,rating,timestamp\n1,10,4.5,111\n1,11,3.0,112\n2,10,5.0,113\n")
    df = FS.read_ratings_csv(spark, p)
    assert df.columns == ["user_id", "item_id", "rating"]
    assert sorted(tuple(r) for r in df.collect()) == [(1, 10, 4.5), (1, 11, 3.0), (2, 10, 5.0)]
    assert FS.read_ratings_csv(spark, p, max_rows=2).count() == 2


def test_census_reader_unknowns_and_drop(spark, scratch):
    p = os.path.join(scratch, "census.txt")
    line = "39, State-gov, 77516, Bachelors, 13, Never-married, Adm-clerical, Not-in-family, White, Male, 2174, 0, 40, United-States, <=50K"
    unk = "50, ?, 83311, Bachelors, 13, Married-civ-spouse, Exec-managerial, Husband, White, Male, 0, 0, 13, United-States, <=50K"
    with open(p, "w") as f:
        f.write(line + "\n" + unk + "\n\n" + "this is junk\n")
    df = FS.read_census(spark, p)
    rows = df.collect()
    assert len(rows) == 3  # the blank line is skipped
    assert rows[0].workclass == "State-gov" and rows[0].age == 39
    assert rows[1].workclass is None
    cleaned = CL.drop_unknown(df)
    assert [r.age for r in cleaned.collect()] == [39]


def test_tsv_and_alias_canonicalize(spark, scratch):
    plays = os.path.join(scratch, "plays.tsv")
    alias = os.path.join(scratch, "alias.tsv")
    with open(plays, "w") as f:
        f.write("1\t100\t5\n1\t200\t2\n2\t300\t1\n")
    with open(alias, "w") as f:
        f.write("200\t100\n300\t200\n")  # not transitive: 300 -> 200 only
    p = FS.read_tsv(spark, plays, "userid INT, artistid INT, playcount INT")
    a = FS.read_tsv(spark, alias, "badid INT, goodid INT")
    got = sorted(tuple(r) for r in CL.canonicalize(p, "artistid", a).collect())
    assert got == [(1, 100, 2), (1, 100, 5), (2, 200, 1)]


def test_whole_file_documents_keep_path_order(spark, scratch):
    paths = []
    for name, text in (("b.txt", "second\nfile"), ("a.txt", "first file")):
        p = os.path.join(scratch, name)
        with open(p, "w") as f:
            f.write(text)
        paths.append(p)
    got = {r.doc_id: r.content for r in FS.load_documents(spark, paths).collect()}
    assert got == {0: "second\nfile", 1: "first file"}


def test_sorted_int_sink(spark, scratch):
    out = os.path.join(scratch, "ints")
    df = spark.createDataFrame([(v,) for v in (5, 3, 9, 1)], "p BIGINT")
    FS.write_sorted_ints(df, "p", out)
    lines = []
    for name in sorted(os.listdir(out)):
        if name.startswith("part-"):
            with open(os.path.join(out, name)) as f:
                lines += f.read().split()
    assert lines == ["1", "3", "5", "9"]


def _write_stream_files(spark, folder, values, per_file):
    os.makedirs(folder, exist_ok=True)
    for n, start in enumerate(range(0, len(values), per_file)):
        chunk = [(start + i + 1, v) for i, v in enumerate(values[start:start + per_file])]
        spark.createDataFrame(chunk, "pos BIGINT, el BIGINT").coalesce(1).write.parquet(os.path.join(folder, f"f{n:04d}"))


def test_streaming_exact_and_ams_match_batch(spark, scratch):
    import random

    rnd = random.Random(4)
    values = [rnd.randint(1, 30) for _ in range(600)]
    src = os.path.join(scratch, "src")
    _write_stream_files(spark, src, values, 100)
    files = sorted(os.path.join(src, d) for d in os.listdir(src))
    # one folder per batch: read them in position order as one streaming source
    flat = os.path.join(scratch, "flat")
    os.makedirs(flat)
    for i, d in enumerate(files):
        for name in os.listdir(d):
            if name.endswith(".parquet"):
                os.link(os.path.join(d, name), os.path.join(flat, f"{i:04d}.parquet"))
                os.utime(os.path.join(flat, f"{i:04d}.parquet"), (1_000_000 + i, 1_000_000 + i))
    stream = spark.readStream.schema("pos BIGINT, el BIGINT").option("maxFilesPerTrigger", 1).parquet(flat)
    batch = spark.read.parquet(flat)

    q = SM.exact_moments_stream(stream, "el", os.path.join(scratch, "exact"), os.path.join(scratch, "ck1"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(scratch, "exact")).first()
    exp = SK.exact_moments(batch, "el").first()
    assert (got.f0, got.f1, got.f2, got.f3) == (exp.f0, exp.f1, exp.f2, exp.f3)

    state_dir = os.path.join(scratch, "ams_state")
    q = SM.ams_stream(stream, "el", "pos", 12, state_dir, os.path.join(scratch, "ck2"))
    q.awaitTermination(180)
    st = SM.latest_ams_state(spark, state_dir)
    s = SM.ams_estimate(st, 2).first()
    b = SK.ams_moment(batch, "el", "pos", 2, 12).first()
    assert s.sum_counts == b.sum_counts
    assert s.estimate == pytest.approx(b.estimate)
    assert st.agg(F.max("n")).first()[0] == 600


def test_whole_file_documents_with_odd_names(spark, scratch):
    names = ["Lorem Ipsum.txt", "plain.txt", "100%.txt", "empty.txt"]
    paths = [os.path.join(scratch, n) for n in names]
    for n, p in zip(names, paths, strict=True):
        with open(p, "w") as f:
            f.write("" if n == "empty.txt" else f"text of {n}")
    got = sorted(tuple(r) for r in FS.load_documents(spark, paths).collect())
    assert got == [(0, "text of Lorem Ipsum.txt"), (1, "text of plain.txt"), (2, "text of 100%.txt"), (3, "")]


def test_stream_queries_read_a_folder_table(spark, scratch):
    import __spark_entry__ as E

    spark.range(1000).selectExpr("id AS event_id", "id % 7 AS user_id").coalesce(1).write.parquet(os.path.join(scratch, "events.parquet"))
    q = E.queries()
    a, b = (q[n](spark, scratch).first() for n in ("exact_moment_stream", "exact_moment"))
    assert a == b and int(a["f1"]) == 1000
    a, b = (q[n](spark, scratch).first() for n in ("ams_moment_stream", "ams_moment"))
    assert a == b and a["n"] == 1000


def test_stream_step_refuses_positions_out_of_order(spark):
    first = spark.createDataFrame([(p, p % 3) for p in range(5, 20)], "pos bigint, el bigint")
    state = SM.ams_step(first, None, "el", "pos", 4)
    late = spark.createDataFrame([(19, 1), (20, 2)], "pos bigint, el bigint")
    with pytest.raises(ValueError, match="position"):
        SM.ams_step(late, state, "el", "pos", 4)
    later = spark.createDataFrame([(20, 2)], "pos bigint, el bigint")
    assert SM.ams_step(later, state, "el", "pos", 4).count() == 4


def test_cluster_without_a_shared_checkpoint_folder_is_an_error():
    from types import SimpleNamespace

    from lodestar.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))
