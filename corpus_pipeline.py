"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; the
tables between the stages are Parquet in the folder that all executors share. All stages
but the last return the columns of `documents`.
"""

import uuid

from pyspark.sql import functions as F

from tallyfold.llm import packing, quality, secret_scan, simhash, substring_dedup
from tallyfold.llm.common import shared_folder, table
from tallyfold.llm.queries import BYTE_BPE, vocabulary


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return quality.kept_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark, docs, sf_dir):
    """One document of each SimHash group stays, the one with the least doc_id."""
    return simhash.one_of_each_group(docs)


def repeated_passages(spark, docs, sf_dir):
    """Passages that an earlier document has are cut out; documents left empty go."""
    return _counted(substring_dedup.without_repeats(docs))


def secrets(spark, docs, sf_dir):
    """Secrets are masked in the texts."""
    return _counted(secret_scan.redact(docs, secret_scan.scan(docs)))


def packed(spark, docs, sf_dir):
    """The pieces of all documents with their place in a training sequence."""
    return packing.pack(packing.pieces(docs, vocabulary(BYTE_BPE)))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secrets", secrets),
    ("packed", packed),
]

#: Stages work across documents by hashes and tokenizers that SQL lacks; tests hold them against plain code.
ORACLE_SQL = None


def _counted(docs):
    """The documents with their column `n_chars`, if they have one, counted anew."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def run(spark, sf_dir):
    """The stages applied to `documents`, each written and read again but for the last."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
