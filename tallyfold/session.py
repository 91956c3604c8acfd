"""Session settings the jobs expect."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Calendar days are UTC days.
    "spark.sql.session.timeZone": "UTC",
    # Run-time re-planning: joins turn to broadcast by measured size, skewed
    # partitions are split, small ones merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where that costs a further shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


#: Input that one shuffle partition stands for to begin with; adaptive execution merges them.
PARTITION_BYTES = 128 << 20


def build_session(app="tallyfold", master=None, input_bytes=None, **extra):
    """A session with the settings above; `extra` wins over them.

    `input_bytes`, about how much the jobs read, sets the initial number of shuffle partitions.

    On a cluster leave `master` unset and let the submitter's settings stand.
    `spark.sql.shuffle.partitions` is left to the caller: a few per core locally,
    about input bytes / 128 MB on a cluster (merged downwards at run time).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if input_bytes:
        settings["spark.sql.shuffle.partitions"] = str(max(200, -(-input_bytes // PARTITION_BYTES)))
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
