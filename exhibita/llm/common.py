"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of rows that a Python worker gets at once, see ``small_batches``.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, through Spark's reader so that any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Only a session in one process (``local``) may leave it unset; a temporary folder then takes its place. On a
    cluster that is an error, since each machine would write to a disk of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        context = spark.sparkContext
        path = context.getCheckpointDir()
        if not path:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="exhibita-"))
            path = context.getCheckpointDir()
    return path.rstrip("/")


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing has yet."""
    return f"{shared_dir(spark)}/exhibita-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    This cuts the lineage: a lost executor costs a re-read of the files, and what was computed is neither
    computed twice nor able to come out differently the second time.
    """
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, on any file system that Spark knows."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Tables that one computation needs only until its own result is written; they go when it ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.n = spark, new_path(spark), 0

    def written(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back, see ``written``."""
        self.n += 1
        path = f"{self.path}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        remove(self.spark, self.path)


def in_blocks(spark: SparkSession, blocks: Iterator, scan: Callable[[Broadcast], DataFrame]) -> DataFrame | None:
    """What ``scan`` makes of each of ``blocks``, one after the other; None where there are no blocks.

    A block is broadcast, its result is written, and its broadcast is destroyed before the next one is built: driver
    and executors hold one block at a time, however many there are.
    """
    path, schema = new_path(spark), None
    for block in blocks:
        shared = spark.sparkContext.broadcast(block)
        found = scan(shared)
        schema = found.schema
        found.write.mode("append").parquet(path)
        shared.destroy()
    return None if schema is None else spark.read.schema(schema).parquet(path)


def named(column: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns an operator is about to add; names compare without regard to case."""
    taken = {n.lower() for n in names}
    kept = [c for c in df.columns if c.lower() not in taken]
    return df if len(kept) == len(df.columns) else df.select(*map(named, kept))


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names for an operator's own columns that no column of ``df`` has: ``names``, marked further where taken."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def small_batches(spark: SparkSession) -> None:
    """Lets Spark send rows to Python workers ``BATCH_BYTES`` at a time in this session, unless it has a limit of its own.

    By Spark's default a batch is 10,000 rows of any size, which executor and worker each hold whole, and back again.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def with_made(df: DataFrame, kept: list[str], inputs: list[Column | str], new: dict[str, T.DataType], make: Callable[[], Callable]) -> DataFrame:
    """The columns ``kept`` of ``df`` and what a function makes of ``inputs``, one Arrow batch after the other.

    ``make`` is called once in each task and returns the function; that takes an Arrow array for each input and
    returns values for each of the ``new`` columns. An input that is the name of one of ``kept`` is not sent a second time.
    Names stay out of the job, so any will do.
    """
    sent = [x for x in inputs if isinstance(x, Column)]
    others = iter(range(len(kept), len(kept) + len(sent)))
    places = [next(others) if isinstance(x, Column) else kept.index(x) for x in inputs]
    rows = df.select(*(named(c).alias(f"k{i}") for i, c in enumerate(kept)), *(x.alias(f"i{i}") for i, x in enumerate(sent)))
    fields = [T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(kept)]
    fields += [T.StructField(f"n{i}", kind) for i, kind in enumerate(new.values())]
    names, n, types = [f.name for f in fields], len(kept), [to_arrow_type(kind) for kind in new.values()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            made = function(*(batch.columns[p] for p in places))
            arrays = [m if isinstance(m, pa.Array) else pa.array(m, t) for m, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *arrays], names=names)

    return rows.mapInArrow(scan, T.StructType(fields)).toDF(*kept, *new)
