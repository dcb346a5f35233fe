"""Tables written to the folder that driver and executors share.

The folder is the cluster's ``spark.checkpoint.dir``. Only where that is unset and Spark runs
in one process, as in tests, a folder under the session's warehouse directory is used instead;
a cluster without the setting is refused. Written tables cut the lineage: a lost executor costs a
re-read, never a re-computation of everything before. Shuffle files of what has been written are
removed at once, and a table that no later step reads is discarded.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Parquet's settings for rows of megabytes: row groups of 16 MB, and a look at their size after each row.
LONG_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def folder(spark: SparkSession, name: str) -> str:
    """A new path for ``name`` in the shared folder; nothing is created yet."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        top = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, compression: str = "zstd", narrow: bool = False, long_rows: bool = False) -> DataFrame:
    """``df`` written as Parquet to the shared folder, and read again.

    ``narrow`` tables, ids and links of what comes from a shuffle, go to an eighth as many files as the
    shuffle has partitions: each file costs a store several calls. ``long_rows``, of megabytes each, are written out by their bytes:
    else a task holds a hundred of them before Parquet looks, and as many when it reads.
    """
    if narrow:
        df = df.coalesce(max(1, partitions(df.sparkSession) // 8))
    return saved_in_turn([df], folder(df.sparkSession, name), compression, options=LONG_ROWS if long_rows else {})


def saved_in_turn(rounds: Iterable[DataFrame], path: str, compression: str = "zstd", by: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """The rows of all ``rounds`` in one table at ``path``; shuffle files of a round are gone before the next one runs.

    ``by`` names a column to whose values folders of their own are given, as ``column=value``.
    """
    for df in rounds:
        spark, schema = df.sparkSession, df.schema
        before = spark.conf.get(_CLEAN_UP, "false")
        spark.conf.set(_CLEAN_UP, "true")
        try:
            writer = df.write.mode("append").option("compression", compression).options(**(options or {}))
            (writer.partitionBy(by) if by else writer).parquet(path)
        finally:
            spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(schema).parquet(path)


def arrow_place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a folder, for tasks that read or write files of their own there."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``saved`` gave; they can't be read any more."""
    for table in tables:
        for top in {re.sub(r"(/\w+=[^/]*)?/[^/]*$", "", f) for f in table.inputFiles()}:
            if not re.search(r"-[0-9a-f]{32}$", top):
                raise ValueError(f"{top} is not a scratch table")
            jvm, session = table.sparkSession._jvm, table.sparkSession._jsparkSession
            path = jvm.org.apache.hadoop.fs.Path(top)
            path.getFileSystem(session.sessionState().newHadoopConf()).delete(path, True)


def bounded_batches(spark: SparkSession) -> None:
    """Has Spark hand Python workers at most about 8 MB at a time, however long the texts are.

    A setting of the session: it must still hold when the caller runs what an operator returned.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
