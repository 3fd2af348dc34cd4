import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestar.functions.columns import char_shingles, text_clean
from lodestar.operators import text as TX

# fixed values: the four sentences of the word-count exercise
SENTENCES = ["apple banana apple", "orange banana orange", "apple orange", "banana apple orange"]


def _sentences(spark):
    return spark.createDataFrame([(s,) for s in SENTENCES], "text STRING")


def test_word_count(spark):
    got = {r.word: r.n for r in TX.word_count(_sentences(spark)).collect()}
    assert got == {"apple": 4, "orange": 4, "banana": 3}
    assert TX.word_total(_sentences(spark)).first().n_words == 11
    assert TX.distinct_words(_sentences(spark)).count() == 3


def test_single_space_split_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("a  b ",)], "text STRING")
    got = sorted(r.word for r in TX.words(df).collect())
    assert got == sorted("a  b ".split(" "))
    assert TX.word_total(df).first().n_words == len("a  b ".split(" "))


def _py_clean(t):
    for c in "\n\t\r":
        t = t.replace(c, " ")
    return t.replace("- ", "")


def test_text_clean_joins_hyphenated_breaks(spark):
    df = spark.createDataFrame([("pro-\nbably\tfine\r- x",)], "text STRING")
    assert df.select(text_clean(F.col("text")).alias("c")).first().c == _py_clean("pro-\nbably\tfine\r- x")


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="ab -\néç\t", max_size=40), st.integers(min_value=1, max_value=9))
def test_shingles_match_python(spark, text, k):
    df = spark.createDataFrame([(0, text)], "doc_id BIGINT, text STRING")
    got = TX.shingle_counts(df, (k,)).first()[f"n_shingles_k{k}"]
    t = _py_clean(text)
    assert got == len({t[i:i + k] for i in range(len(t) - k + 1)})


def test_short_documents_kept_or_dropped(spark):
    df = spark.createDataFrame([(0, "abc"), (1, "abcdefghij")], "doc_id BIGINT, text STRING")
    assert TX.shingle_counts(df, (5,)).count() == 2
    assert {r.doc_id: r.n_shingles_k5 for r in TX.shingle_counts(df, (5,)).collect()} == {0: 0, 1: 6}
    assert TX.shingle_counts(df, (5,), drop_short=True).count() == 1


def test_shingles_of_wide_characters_and_null_text(spark):
    """A character beyond 16 bits is one character, alphabets too large to pack are numbered, null text has null counts."""
    texts = ["a😀b😀a😀b", "".join(chr(0x4E00 + i * i % 3001) for i in range(4000)) + "abcdefghij" * 3, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    got = {r.doc_id: r for r in TX.shingle_counts(df, (2, 9)).collect()}
    for i, t in enumerate(texts):
        want = [None] * 3 if t is None else [len(t), *[len({t[j:j + k] for j in range(len(t) - k + 1)}) for k in (2, 9)]]
        assert [got[i].n_chars_clean, got[i].n_shingles_k2, got[i].n_shingles_k9] == want


def test_char_shingles_keep_repeats(spark):
    df = spark.createDataFrame([("aaaa",)], "t STRING")
    assert df.select(char_shingles(F.col("t"), 2).alias("s")).first().s == ["aa", "aa", "aa"]


def test_digit_shingles(spark):
    # fixed values: digit strings and their sorted distinct 4-shingles
    cases = {
        "1234567": [1234, 2345, 3456, 4567],
        "2024": [2024],
        "0002024": [2, 20, 202, 2024],
        "00000": [0],
        "1010101": [101, 1010],
    }
    df = spark.createDataFrame([(k,) for k in cases], "d STRING")
    got = {r.d: r.shingles for r in TX.digit_string_shingles(df, "d", 4).collect()}
    assert got == cases


def test_digit_shingles_too_short_raises(spark):
    df = spark.createDataFrame([("123",)], "d STRING")
    with pytest.raises(Exception):
        TX.digit_string_shingles(df, "d", 4).collect()
    with pytest.raises(ValueError):
        TX.digit_string_shingles(df, "d", 0)
