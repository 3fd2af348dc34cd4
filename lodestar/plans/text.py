"""Driver queries of the word, shingle and cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import utc_date_string
from ..operators import clean as CL
from ..operators import ratings as R
from ..operators import text as TX
from ..sources.tables import documents, rating_events, table
from .registry import query

SHINGLE_KS = (5, 9)
DIGIT_K = 4
CLEAN_SQL = "replace(translate(text, chr(10) || chr(9) || chr(13), '   '), '- ', '')"


def docs(spark, sf):
    return documents(spark, sf)


@query("word_count", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1""")
def q_word_count(spark, sf):
    return TX.word_count(docs(spark, sf))


@query("distinct_words", "SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM documents")
def q_distinct_words(spark, sf):
    return TX.distinct_words(docs(spark, sf))


@query("word_total", "SELECT coalesce(sum(len(string_split(text, ' '))), 0)::BIGINT AS n_words FROM documents")
def q_word_total(spark, sf):
    return TX.word_total(docs(spark, sf))


@query("text_clean", f"SELECT doc_id, {CLEAN_SQL} AS text_clean FROM documents")
def q_text_clean(spark, sf):
    return TX.clean_documents(docs(spark, sf)).select("doc_id", "text_clean")


@query("shingle_counts", f"""
WITH d AS (SELECT doc_id, {CLEAN_SQL} AS t FROM documents)
SELECT doc_id, length(t)::INTEGER AS n_chars_clean,
       {", ".join(f"len(list_distinct(list_transform(range(1, length(t) - {k - 2}), lambda i: substring(t, i, {k}))))::INTEGER AS n_shingles_k{k}" for k in SHINGLE_KS)},
       doc_id = 0 AS is_doc0
FROM d""")
def q_shingle_counts(spark, sf):
    s = TX.shingle_counts(docs(spark, sf), SHINGLE_KS)
    return s.withColumn("is_doc0", F.col("doc_id") == 0)


@query("digit_shingles", f"""
WITH d AS (SELECT o_orderkey, round(o_totalprice * 100)::BIGINT::VARCHAR AS digits FROM orders),
s AS (SELECT o_orderkey, digits,
             list_sort(list_distinct(list_transform(range(1, length(digits) - {DIGIT_K - 2}),
                                                    lambda i: substring(digits, i, {DIGIT_K})::BIGINT))) AS sh
      FROM d)
SELECT o_orderkey, digits, len(sh)::INTEGER AS n_shingles, array_to_string(sh, ',') AS shingles FROM s""")
def q_digit_shingles(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("digits")
    )
    s = TX.digit_string_shingles(o, "digits", DIGIT_K)
    return s.select("o_orderkey", "digits", F.size("shingles").alias("n_shingles"), F.array_join("shingles", ",").alias("shingles"))


UNKNOWN_PRIORITY = "4-NOT SPECIFIED"


@query("drop_unknown", f"""
WITH o AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN trim(o_orderstatus) IN ('', '?', '{UNKNOWN_PRIORITY}') THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
         CASE WHEN trim(o_orderpriority) IN ('', '?', '{UNKNOWN_PRIORITY}') THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders)
SELECT * FROM o WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL
  AND o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL""")
def q_drop_unknown(spark, sf):
    orders = table(spark, sf, "orders")
    o = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        utc_date_string("o_orderdate", orders.schema["o_orderdate"].dataType).alias("o_orderdate"),
        "o_orderpriority",
    )
    return CL.drop_unknown(o, markers=("?", UNKNOWN_PRIORITY), columns=["o_orderstatus", "o_orderpriority"])


@query("alias_canonicalize", """
WITH g AS (SELECT p_brand, p_type, min(p_partkey) AS goodid FROM part GROUP BY 1, 2),
alias AS (SELECT p.p_partkey AS badid, g.goodid FROM part p JOIN g USING (p_brand, p_type) WHERE p.p_partkey <> g.goodid),
ev AS (SELECT o_custkey::BIGINT AS user_id, l_partkey::BIGINT AS item_id, l_quantity AS q
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL)
SELECT user_id, coalesce(goodid, item_id)::BIGINT AS item_id, sum(q)::DOUBLE AS rating
FROM ev LEFT JOIN alias ON badid = item_id GROUP BY 1, 2""")
def q_alias_canonicalize(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    good = part.groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("goodid"))
    alias = part.join(good, ["p_brand", "p_type"]).where(F.col("p_partkey") != F.col("goodid")).select(
        F.col("p_partkey").alias("badid"), "goodid"
    )
    ev = CL.canonicalize(rating_events(spark, sf), "item_id", alias)
    return R.utility_matrix(ev)
