"""Run records, run properties and prompt fingerprints."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import exists


def run_record(run_id: str, accessions: DataFrame, items: DataFrame, tarballs: list[str], filters: dict[str, str]) -> DataFrame:
    """One row for each accession of a run, with its inputs; items stay a table of their own."""
    counted = items.groupBy("accession").agg(F.count("*").alias("n_items"))
    made = F.map_from_arrays(F.array(*[F.lit(k) for k in filters]), F.array(*[F.lit(v) for v in filters.values()])) if filters else F.create_map().cast("map<string,string>")
    return accessions.join(counted, "accession", "left").select(
        F.lit(run_id).alias("run_id"), "*", F.array(*[F.lit(t) for t in tarballs]).cast("array<string>").alias("tarballs"), made.alias("filters")
    )


def append_run(record: DataFrame, path: str) -> None:
    """Adds a run record to the table of runs, a partition for each run."""
    record.write.mode("append").partitionBy("run_id").parquet(path)


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """A run record; a run that is not in the table is an error."""
    found = spark.read.parquet(path).where(F.col("run_id") == run_id)
    if found.isEmpty():
        raise ValueError(f"no record of run {run_id}")
    return found


def merge_properties(*updates: DataFrame) -> DataFrame:
    """``(run_id, key, value)`` of updates ``(run_id, key, value, seq)``: the value with the highest ``seq`` wins."""
    both = updates[0]
    for u in updates[1:]:
        both = both.unionByName(u)
    return both.groupBy("run_id", "key").agg(F.max_by("value", "seq").alias("value"))


class Properties:
    """Run properties ``(run_id, key, value)`` that are kept in a folder and merged by any number of writers.

    A merge is a generation: its rows are written to a folder of their own, and then one small file in the log names it.
    Nothing is overwritten and no pointer is shared, so of two merges at once none is lost, and one that fails half way
    is never seen. Of a key's values that of the latest generation counts, and in a generation that with the highest
    ``seq``. ``compact`` writes a generation that stands for all before it; its entry in the log names those, which
    readers then leave out. What has been replaced is removed by ``clean``, when no reader needs it any more.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _commit(self, rows: DataFrame, stamp: int | None = None, replaces: list[str] | None = None) -> None:
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/data/{name}")
        entry = {"generation": name, "stamp": time.time_ns() if stamp is None else stamp, "replaces": replaces or []}
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log/.{name}.json")
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        out = files.create(path)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        files.rename(path, context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log/{name}.json"))

    def _log(self) -> tuple[dict[str, int], set[str]]:
        """Stamps of the generations that count, and the names of those that do not."""
        if not exists(self.spark, f"{self.path}/log"):
            return {}, set()
        rows = self.spark.read.schema("generation string, stamp long, replaces array<string>").json(f"{self.path}/log").collect()
        gone = {g for r in rows for g in r["replaces"]}
        return {r["generation"]: r["stamp"] for r in rows if r["generation"] not in gone}, gone

    def merge(self, updates: DataFrame) -> None:
        """Adds updates ``(run_id, key, value, seq)``, or without ``seq`` where keys are given once."""
        seq = F.col("seq").cast("long") if "seq" in updates.columns else F.lit(0).cast("long")
        self._commit(updates.select("run_id", "key", "value", seq.alias("seq"), F.lit(None).cast("long").alias("stamp")))

    def report(self, run_id: str, stage: str, counts: dict[str, int]) -> None:
        """Keeps the counts of a stage of a run, as properties ``stage.name``; a stage that runs again replaces them."""
        rows = [(run_id, f"{stage}.{name}", str(n)) for name, n in counts.items()]
        self.merge(self.spark.createDataFrame(rows, "run_id string, key string, value string"))

    def _rows(self, live: dict[str, int]) -> DataFrame:
        """The last value of each key, with the stamp of the merge that it came with."""
        if not live:
            return self.spark.createDataFrame([], "run_id string, key string, value string, seq long, stamp long")
        rows = self.spark.read.parquet(*[f"{self.path}/data/{g}" for g in live])
        stamps = self.spark.createDataFrame(list(live.items()), "_generation string, _stamp long")
        generation = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        rows = rows.withColumn("_generation", generation).join(F.broadcast(stamps), "_generation")
        order = F.struct(F.coalesce("stamp", "_stamp").alias("stamp"), "seq", "_generation")
        last = rows.groupBy("run_id", "key").agg(F.max_by(F.struct("value", "seq"), order).alias("v"), F.max(order).alias("o"))
        return last.select("run_id", "key", "v.value", "v.seq", "o.stamp")

    def read(self, run_id: str | None = None) -> DataFrame:
        """``(run_id, key, value)``, of one run or of all; an empty store has no rows."""
        rows = self._rows(self._log()[0])
        return (rows if run_id is None else rows.where(F.col("run_id") == run_id)).select("run_id", "key", "value")

    def compact(self) -> None:
        """Writes one generation in place of all that there are now; merges that are made meanwhile stay beside it."""
        live = self._log()[0]
        if len(live) > 1:
            self._commit(self._rows(live), max(live.values()), sorted(live))

    def clean(self) -> int:
        """Removes the rows of generations that others have replaced, and says how many generations they were."""
        gone, context = self._log()[1], self.spark.sparkContext
        paths = [context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/{g}") for g in gone]
        return sum(p.getFileSystem(context._jsc.hadoopConfiguration()).delete(p, True) for p in paths)


def prompts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, sha256, content)`` of prompt files; a path that does not exist is an error."""
    return fingerprints(spark.read.format("binaryFile").load(paths), "content")


def fingerprints(df: DataFrame, content: str) -> DataFrame:
    """``df`` with ``sha256``, the hex digest of ``content``'s bytes."""
    return df.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256))


def item_map(items: DataFrame, value: str = "path") -> DataFrame:
    """``(accession, items)``: each accession's map from item to path, the last path on repeats."""
    last = items.groupBy("accession", "item_id").agg(F.max_by(value, "order").alias("v"))
    return last.groupBy("accession").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("item_id", "v")))).alias("items"))
