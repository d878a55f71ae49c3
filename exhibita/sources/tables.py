"""Tables between stages, kept in the folder that the cluster shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out to all cores where it is read in fewer pieces than there are; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def work_dir(spark: SparkSession) -> str:
    """A new folder under the session's ``spark.checkpoint.dir``.

    Only a session in one process may leave that unset and gets a temporary folder; on a cluster it is an error, since
    each machine would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="exhibita-")
    return f"{base.rstrip('/')}/exhibita-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on any file system that Spark knows."""
    context = spark.sparkContext
    own = context._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(context._jsc.hadoopConfiguration()).exists(own)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it, for tasks that write files of their own."""
    return fs.FileSystem.from_uri(path if path.startswith("file:") or "://" in path else f"file://{os.path.abspath(path)}")


def write_exhibits(exhibits: DataFrame, path: str) -> None:
    """Adds exhibits ``(run_id, item_id, order, html)``; of repeated items the last counts when they are read."""
    exhibits.write.mode("append").partitionBy("run_id").parquet(path)


#: Rows that are broadcast at most, some 150 bytes each.
BROADCAST_ROWS = 200_000


def read_exhibits(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """``(item_id, html)`` of a run; only its partition is read. Of repeated items the one with the highest order counts.

    Which row that is is settled on items, orders and places in the files alone. What is sent to the HTML are the places
    of rows that do not count: broadcast where they are few, so that no HTML is shuffled, and joined by place otherwise.
    Where items and orders are equal the later place in the files counts.
    """
    rows = spark.read.parquet(path).where(F.col("run_id") == run_id)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    known = rows.select("item_id", F.struct(F.col("order"), place.alias("place")).alias("at"))
    last = known.groupBy("item_id").agg(F.max("at").alias("last"), F.count("*").alias("n")).where("n > 1")
    lost = known.join(last, known["item_id"].eqNullSafe(last["item_id"])).where("at <> last").select("at.place.*")
    if lost.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        lost = F.broadcast(lost)
    placed = rows.select("item_id", "html", place["file"].alias("file"), place["row"].alias("row"))
    return placed.join(lost, ["file", "row"], "left_anti").select("item_id", "html")


def write_views(texts: DataFrame, path: str, run_id: str) -> None:
    """Adds the canonical texts ``(item_id, text)`` of a run to the table at ``path``, a partition for each run.

    The prompt view of an item is its canonical text, so it is no second copy but a read of this table.
    """
    texts.select(F.lit(run_id).alias("run_id"), "item_id", "text").write.mode("append").partitionBy("run_id").parquet(path)


def read_canonical(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """``(item_id, text)`` of a run; only its partition is read. A run that is not in the table is an error."""
    rows = spark.read.parquet(path).where(F.col("run_id") == run_id).select("item_id", "text")
    if rows.isEmpty():
        raise ValueError(f"no canonical texts of run {run_id}")
    return rows


def read_prompt_views(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """``(item_id, prompt_view)`` of a run: its canonical texts under the name that prompts are made from."""
    return read_canonical(spark, path, run_id).withColumnRenamed("text", "prompt_view")
