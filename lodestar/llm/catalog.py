"""Queries of the pipeline operators: name -> Spark builder, name -> DuckDB twin where SQL can express it."""

from __future__ import annotations

import functools
import os

import corpus_pipeline

from ..sources.tables import table
from . import sql
from .collocations import collocations
from .decontaminate import contamination
from .language_id import predict_languages
from .mixing import plan_mix, taken_words
from .ngram_join import near_duplicate_components
from .quality_classifier import quality_scores
from .quality_rules import judge_documents
from .secret_scan import secret_digest
from .source_divergence import source_divergence
from .substring_dedup import remove_repeated_windows
from .suffix_dedup import remove_repeated_bytes
from .token_output import token_table
from .url_filter import LISTED_LABELS, filter_urls, urls_on_hosts

QUERIES: dict = {}
ORACLE: dict = {}


def _importable(spark) -> None:
    """Let Python workers of this machine import the package wherever the driver was started.

    On a cluster the package is shipped with ``--py-files``; a path that does not exist there does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def _query(name: str, twin: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            _importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if twin is not None:
            ORACLE[name] = twin.strip()
        return fn

    return deco


@_query("op9_quality_rules", sql.QUALITY_RULES)
def op9_quality_rules(spark, sf_dir):
    return judge_documents(table(spark, sf_dir, "documents"))


@_query("op1_source_mix")
def op1_source_mix(spark, sf_dir):
    return taken_words(plan_mix(table(spark, sf_dir, "documents")))


@_query("op10_substring_dedup", sql.SUBSTRING_DEDUP)
def op10_substring_dedup(spark, sf_dir):
    return remove_repeated_windows(table(spark, sf_dir, "documents"))


@_query("op7_ngram_jaccard", sql.NGRAM_JACCARD)
def op7_ngram_jaccard(spark, sf_dir):
    return near_duplicate_components(table(spark, sf_dir, "documents")).drop("_part", "_label")


@_query("op3_suffix_dedup", sql.SUFFIX_DEDUP)
def op3_suffix_dedup(spark, sf_dir):
    return remove_repeated_bytes(table(spark, sf_dir, "documents"))


@_query("op5_url_filter", sql.URL_FILTER)
def op5_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, urls_on_hosts(pages, LISTED_LABELS))


@_query("op4_decontaminate", sql.DECONTAMINATE)
def op4_decontaminate(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op6_token_output")
def op6_token_output(spark, sf_dir):
    return token_table(table(spark, sf_dir, "documents"))


@_query("op2_language_id")
def op2_language_id(spark, sf_dir):
    return predict_languages(table(spark, sf_dir, "documents"))


@_query("op8_quality_classifier")
def op8_quality_classifier(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op11_collocations", sql.COLLOCATIONS)
def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


@_query("op12_secret_scan", sql.SECRET_SCAN)
def op12_secret_scan(spark, sf_dir):
    return secret_digest(table(spark, sf_dir, "documents"))


@_query("op13_source_divergence", sql.SOURCE_DIVERGENCE)
def op13_source_divergence(spark, sf_dir):
    return source_divergence(table(spark, sf_dir, "documents"))


@_query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
