"""What the operators share: reading tables and cutting lineage."""

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these characters: blank, and tab to carriage return.
BLANKS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's `spark.checkpoint.dir`.

    Only a local session that has none, as in a test, gets a temporary one; on a cluster its
    executors would not find it, so there it is an error.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut(frame: DataFrame) -> DataFrame:
    """The frame, computed now and kept in the folder that all executors share."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def words_of(text):
    """The words of a text column as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def held_out(doc_id):
    """True for the third of the documents that no model may learn from."""
    return F.crc32(doc_id.cast("string")) % 3 == 1
