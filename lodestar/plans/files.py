"""Driver queries of the file sources and sinks: a table is written in the source's format under the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import clean as CL
from ..operators import factors as FA
from ..session import ensure_checkpoint_dir
from ..sources import files as FS
from ..sources.tables import rating_events, table
from .registry import query


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lodestar-files/{uuid.uuid4().hex}-{name}"


@query("csv_ratings", """
SELECT o_custkey::BIGINT AS user_id, l_partkey::BIGINT AS item_id, l_quantity::DOUBLE AS rating
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL""")
def q_csv_ratings(spark, sf):
    path = _folder(spark, "ratings.csv")
    x = rating_events(spark, sf).select(F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"), "rating", F.lit(0).alias("timestamp"))
    x.write.csv(path, header=True)
    return FS.read_ratings_csv(spark, path)


@query("ratings_by_name", """
SELECT o_custkey::BIGINT AS user_id, count(*) AS n, sum(l_quantity)::DOUBLE AS rating
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY 1""")
def q_ratings_by_name(spark, sf):
    """The ratings under their name, from a CSV file written first, summed per user."""
    path = _folder(spark, "named.csv")
    rating_events(spark, sf).write.csv(path, header=True)
    x = FS.ratings_by_name(spark, "ratings_csv", path)
    return x.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("rating"))


@query("tsv_plays", "SELECT o_custkey AS userid, o_orderkey AS artistid, o_orderpriority AS name FROM orders")
def q_tsv_plays(spark, sf):
    path = _folder(spark, "plays.tsv")
    table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority").write.option("sep", "\t").csv(path)
    return FS.read_tsv(spark, path, "userid BIGINT, artistid BIGINT, name STRING")


@query("census_text", """
WITH t AS (
  SELECT l_linenumber AS age, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS workclass, l_quantity::INTEGER AS fnlwgt,
         p_type AS education, p_size AS education_num, c_mktsegment AS marital_status, p_brand AS occupation, l_returnflag AS relationship,
         l_linestatus AS race, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS sex, round(100 * l_discount)::INTEGER AS capital_gain,
         round(100 * l_tax)::INTEGER AS capital_loss, c_nationkey AS hours_per_week, n_name AS native_country, r_name AS income
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT age, workclass, education, marital_status, relationship, race, sex, income, count(*) AS n, sum(fnlwgt)::BIGINT AS fnlwgt, sum(education_num)::BIGINT AS education_num,
       sum(capital_gain)::BIGINT AS capital_gain, sum(capital_loss)::BIGINT AS capital_loss, sum(hours_per_week)::BIGINT AS hours_per_week,
       count(DISTINCT occupation) AS occupations, count(DISTINCT native_country) AS countries
FROM t WHERE age IS NOT NULL AND workclass IS NOT NULL AND sex IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""")
def q_census_text(spark, sf):
    """Census lines (comma and space, "?" for what is not known) of every line item; rows with an unknown field are dropped.

    Unknown are the order priority '4-NOT SPECIFIED' and the status of an order under way.
    """
    path = _folder(spark, "census.txt")
    t = {n: table(spark, sf, n) for n in ("lineitem", "orders", "part", "customer", "nation", "region")}
    x = t["lineitem"].join(t["orders"], F.col("o_orderkey") == F.col("l_orderkey")).join(t["part"], F.col("p_partkey") == F.col("l_partkey"))
    x = x.join(t["customer"], F.col("c_custkey") == F.col("o_custkey")).join(t["nation"], F.col("n_nationkey") == F.col("c_nationkey"))
    x = x.join(t["region"], F.col("r_regionkey") == F.col("n_regionkey"))
    unknown = lambda c, value: F.when(F.col(c) == value, F.lit(None)).otherwise(F.col(c))
    cents = lambda c: F.round(F.col(c) * 100).cast("int")
    fields = [
        "l_linenumber", unknown("o_orderpriority", "4-NOT SPECIFIED"), F.col("l_quantity").cast("int"), "p_type", "p_size", "c_mktsegment", "p_brand",
        "l_returnflag", "l_linestatus", unknown("o_orderstatus", "P"), cents("l_discount"), cents("l_tax"), "c_nationkey", "n_name", "r_name",
    ]
    known = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("?")) for c in fields]
    x.select(F.concat_ws(", ", *known)).write.text(path)
    by = ["age", "workclass", "education", "marital_status", "relationship", "race", "sex", "income"]
    sums = [F.sum(c).alias(c) for c in ("fnlwgt", "education_num", "capital_gain", "capital_loss", "hours_per_week")]
    kinds = [F.countDistinct("occupation").alias("occupations"), F.countDistinct("native_country").alias("countries")]
    return CL.drop_unknown(FS.read_census(spark, path)).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums, *kinds)


DOCS_A_FILE = 200


@query("whole_file_documents", f"""
WITH f AS (SELECT (doc_id // {DOCS_A_FILE})::BIGINT AS doc_id, string_agg(text || chr(10), '' ORDER BY doc_id) AS content FROM documents WHERE text IS NOT NULL GROUP BY 1)
SELECT doc_id, length(content)::BIGINT AS n_chars, md5(content) AS content_md5 FROM f""")
def q_whole_file_documents(spark, sf):
    """The documents as files of ``DOCS_A_FILE`` each under odd folder names, read whole, ids from the paths."""
    base = _folder(spark, "odd %names")
    own = F.floor(F.col("doc_id") / DOCS_A_FILE).cast("bigint")
    x = table(spark, sf, "documents").where("text IS NOT NULL").select(own.alias("file no"), "doc_id", "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = x.repartition(n, "file no").sortWithinPartitions("file no", "doc_id")
    x.select("file no", "text").write.partitionBy("file no").text(base)
    d = FS.read_document_folder(spark, base, "file no=([0-9]+)/", "*.txt")
    return d.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.length("content").cast("bigint").alias("n_chars"), F.md5("content").alias("content_md5"))


@query("sorted_int_sink", "SELECT p_size::VARCHAR AS value, count(*) AS n FROM part WHERE p_size IS NOT NULL GROUP BY 1")
def q_sorted_int_sink(spark, sf):
    path = _folder(spark, "ints")
    FS.write_sorted_ints(table(spark, sf, "part").where("p_size IS NOT NULL"), "p_size", path)
    return spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("vocabulary_lookup", """
WITH v AS (SELECT o_orderpriority AS value, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) AS idx
           FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority < '4' GROUP BY 1)
SELECT o_orderpriority AS value, coalesce(idx, 0)::BIGINT AS idx, count(*) AS n FROM orders LEFT JOIN v ON v.value = o_orderpriority GROUP BY 1, 2""")
def q_vocabulary_lookup(spark, sf):
    """Order priorities through a vocabulary learned from some of them; the rest take the unknown slot 0."""
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    v = FA.vocabulary(o.where("o_orderstatus = 'F' AND o_orderpriority < '4'"), "o_orderpriority")
    x = FA.apply_vocabulary(o, "o_orderpriority", v, "idx")
    return x.groupBy(F.col("o_orderpriority").alias("value"), "idx").agg(F.count(F.lit(1)).alias("n"))
