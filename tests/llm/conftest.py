import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, label int, cls string, _id string, start int"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, source) with copies, near copies, shared passages, odd texts, repeated rows and nulls."""
    rng = random.Random(5)
    passage, out = words(rng, 60), []
    for i in range(24):
        out.append((i, " ".join(words(rng, rng.randrange(5, 160))), f"s{i % 3}"))
    out += [(30 + k, out[2][1], "s0") for k in range(4)]  # copies
    base = words(rng, 120)
    for k in range(8):  # near copies
        w = list(base)
        w[rng.randrange(120)] = f"edit{k}"
        out.append((40 + k, " ".join(w), "s0"))
    for k in range(5):
        out.append((50 + k, " ".join(words(rng, 30) + passage + words(rng, 30)), "s1"))
    out.append((60, " ".join(words(rng, 40) * 4), "s1"))  # repeats itself
    out.append((61, "Über älter\tÀ la carte 日本語 テスト\nтекст\n\n  ünïcode é " * 9, "é"))
    out.append((62, " ".join(words(rng, 30_000, 50_000)), "s2"))  # very long
    out += [(63, None, "s1"), (64, "", "s1"), (65, " \t\n ", None), (66, "one two three", None), (67, "One two THREE", None), (68, "!!! ... $$$", "s2")]
    out += [(69, "tie " * 30, "s2"), (69, "tie " * 30, "s2"), (70, out[5][1], "s0"), (70, out[6][1], "s0")]  # repeated rows, one id twice
    out += [(None, out[7][1], "s1"), (None, None, None)]
    return out


def frame(spark, rows):
    data = [(i, t, ("en", "fr")[(i or 0) % 2], s, len(t or ""), -1, 7, "c", "x", 3) for i, t, s in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
