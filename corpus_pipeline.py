"""A corpus from raw documents to token files, in five stages over the operators of lodestar.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared checkpoint folder and rereads it as
the next one's documents. All stages but the last return the columns of ``documents``. All run in one session, whose Python workers and JVM memory they
share: each bounds the bytes of an Arrow batch for the session (``bounded_batches``).

1. ``language_id``: documents without a language (no letter, or no language with half of the letters) go.
2. ``ngram_jaccard``: of every group of near duplicates (linked by 5-word shingles, Jaccard 0.75) the one of smallest id stays.
3. ``decontaminate``: documents with a 10-word window of a benchmark item go.
4. ``mix``: the sources are mixed to their target weights; a document's text becomes the words that the mix takes of it, repeats
   included, and documents of which nothing is taken go.
5. ``tokens``: token ids are written as Parquet and described per document.
"""

from __future__ import annotations

import functools
import uuid

from lodestar.llm.decontaminate import clean_documents
from lodestar.llm.language_id import accepted_documents
from lodestar.llm.mixing import mixed_documents, plan_mix
from lodestar.llm.ngram_join import one_per_component
from lodestar.llm.token_output import token_table
from lodestar.session import bounded_batches, ensure_checkpoint_dir
from lodestar.sources.tables import table


def bounded(stage):
    @functools.wraps(stage)
    def run_stage(spark, docs, sf_dir):
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@bounded
def language_id(spark, docs, sf_dir):
    return accepted_documents(docs)


@bounded
def ngram_jaccard(spark, docs, sf_dir):
    return one_per_component(docs)


@bounded
def decontaminate(spark, docs, sf_dir):
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


@bounded
def mix(spark, docs, sf_dir):
    return mixed_documents(docs, plan_mix(docs))


@bounded
def tokens(spark, docs, sf_dir):
    return token_table(docs, keep_pieces=False)  # the workers go on to other stages


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

#: language scores, the draws of the mix and the tokenizer are not expressible in SQL
ORACLE_SQL = None


#: small row groups: every running task of a stage holds one in memory while it writes
WRITE_OPTIONS = {"parquet.block.size": str(16 << 20), "compression": "zstd"}


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.options(**WRITE_OPTIONS).parquet(path)
        docs = spark.read.parquet(path)
    return docs
