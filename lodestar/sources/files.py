"""File sources and sinks: ratings CSV, tab-separated tables, the census text format, whole-file documents,
a named-dataset switch, sorted-integer text output and ordered samples."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

RATINGS_SCHEMA = "user_id BIGINT, item_id BIGINT, rating DOUBLE"

# The census columns, in file order (6 integer, 9 string columns).
CENSUS_SCHEMA = StructType([
    StructField("age", IntegerType(), True),
    StructField("workclass", StringType(), True),
    StructField("fnlwgt", IntegerType(), True),
    StructField("education", StringType(), True),
    StructField("education_num", IntegerType(), True),
    StructField("marital_status", StringType(), True),
    StructField("occupation", StringType(), True),
    StructField("relationship", StringType(), True),
    StructField("race", StringType(), True),
    StructField("sex", StringType(), True),
    StructField("capital_gain", IntegerType(), True),
    StructField("capital_loss", IntegerType(), True),
    StructField("hours_per_week", IntegerType(), True),
    StructField("native_country", StringType(), True),
    StructField("income", StringType(), True),
])

# The lecture utility matrix, rows = items 0-5, columns = users 0-5, None = unrated.
LECTURE_MATRIX = [
    [1.0, None, 3.0, None, None, 5.0],
    [None, None, 5.0, 4.0, None, None],
    [2.0, 4.0, None, 1.0, 2.0, None],
    [None, 2.0, 4.0, None, 5.0, None],
    [None, None, 4.0, 3.0, 4.0, 2.0],
    [1.0, None, 3.0, None, 3.0, None],
]


def read_ratings_csv(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """Header CSV whose first three columns are user, item, rating; later columns are ignored.

    ``max_rows`` keeps the first rows in file order (a ``limit`` on the scan; on one file this is the
    file order, across many files Spark does not promise which rows).
    """
    df = spark.read.csv(path, header=True, schema=RATINGS_SCHEMA, mode="PERMISSIVE")
    return df.limit(max_rows) if max_rows is not None else df


def dense_to_long(spark: SparkSession, matrix: Sequence[Sequence[float | None]]) -> DataFrame:
    """Dense items x users matrix (None or NaN = unrated) to (user_id, item_id, rating) rows."""
    rows = [
        (u, i, float(v))
        for i, row in enumerate(matrix)
        for u, v in enumerate(row)
        if v is not None and not (isinstance(v, float) and math.isnan(v))
    ]
    return spark.createDataFrame(rows, RATINGS_SCHEMA)


def ratings_by_name(spark: SparkSession, name: str, path: str | None = None, max_rows: int | None = None) -> DataFrame:
    """'lecture_1' -> the lecture matrix; 'ratings_csv' -> ``read_ratings_csv(path)``; other -> ValueError."""
    if name == "lecture_1":
        return dense_to_long(spark, LECTURE_MATRIX)
    if name == "ratings_csv":
        if path is None:
            raise ValueError("ratings_csv needs a path")
        return read_ratings_csv(spark, path, max_rows)
    raise ValueError(f"no ratings under the name {name!r}: use 'lecture_1' or 'ratings_csv'")


def read_tsv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Tab-separated file with a DDL schema (plays, aliases, names)."""
    return spark.read.option("sep", "\t").csv(path, schema=ddl)


def read_census(spark: SparkSession, path: str) -> DataFrame:
    """Comma + space separated census lines, typed; '?' is the unknown marker and reads as null.

    Blank lines are skipped; a line that does not parse gives a row of nulls (dropped by ``na.drop``).
    """
    return spark.read.csv(
        path, schema=CENSUS_SCHEMA, sep=",", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
        nullValue="?", mode="PERMISSIVE",
    )


def load_documents(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per path (doc_id = position of the path in ``paths``, content = whole text; an empty file is '')."""
    ids = spark.createDataFrame([(i, _qualified(spark, p)) for i, p in enumerate(paths)], "doc_id BIGINT, _fp STRING")
    files = spark.read.text(list(dict.fromkeys(paths)), wholetext=True)
    files = files.select(F.col("_metadata.file_path").alias("_fp"), F.col("value").alias("content"))
    return ids.join(files, "_fp", "left").select("doc_id", F.coalesce("content", F.lit("")).alias("content"))


def read_document_folder(spark: SparkSession, folder: str, id_pattern: str, glob: str = "*") -> DataFrame:
    """(doc_id, content) of every file below ``folder`` whose name matches ``glob``: its whole text, and as id the first group of ``id_pattern`` in its path.

    Paths are listed by Spark and matched on the executors, so the driver handles no list of documents. A path without a match has a null id.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(folder, wholetext=True)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    found = F.regexp_extract(path, id_pattern, 1)
    return files.select(F.when(found != "", found).alias("doc_id"), F.col("value").alias("content"))


def _qualified(spark: SparkSession, path: str) -> str:
    """The fully qualified URI Spark reports in ``_metadata.file_path`` for ``path``."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = fs.makeQualified(hp).toUri()
    host = f"//{uri.getRawAuthority()}" if uri.getRawAuthority() else ""
    return f"{uri.getScheme()}:{host}{uri.getRawPath()}"  # encoded as there: a space is %20


def write_sorted_ints(df: DataFrame, column: str, out_dir: str) -> None:
    """One integer per line in ascending order (range-partitioned sort: part files are in order)."""
    df.select(F.col(column).cast("bigint").alias("_v")).orderBy("_v").select(F.col("_v").cast("string")).write.mode("overwrite").text(out_dir)


def sample_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First n rows in a stated order (``TakeOrderedAndProject``), for repeatable samples."""
    return df.orderBy(*order).limit(n)
