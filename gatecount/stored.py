"""Tables that several plans read are computed once, in the folder that driver and executors share.

``checkpoint`` writes to the cluster's ``spark.checkpoint.dir``; where that is unset and Spark runs in one process, as in
tests, a folder under the warehouse is used. A lost executor costs a read of the files. Files go with the DataFrame if
``spark.cleaner.referenceTracking.cleanCheckpoints`` is on, as ``session`` sets it. Shuffle files that the rows were made from go
as soon as the rows are stored: left to the driver's garbage, those of every step would lie on disk until the last one ends.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def once(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed now and read from files by all that use the result."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        top = spark.conf.get("spark.checkpoint.dir", None)
        if not top:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError(f"spark.checkpoint.dir must name a shared folder on {spark.sparkContext.master}")
            top = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        spark.sparkContext.setCheckpointDir(top)
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        return df.select("*").checkpoint()  # a DataFrame has the setting of the time when it is made
    finally:
        spark.conf.set(_CLEAN_UP, before)
