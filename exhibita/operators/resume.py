"""Results of users' functions that are kept as they come, so that no call is made twice.

A call has a key: a digest of what the function is given. Each task writes what it has got, every few seconds and when it
fails, to files of its own in the store, under the key and the name of the attempt; a mark follows when a call has ended.
What is read are the rows of one marked attempt for each key. So a failed job, a lost executor or a second run costs the
calls that had not ended, and tasks never write to one file.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.tables import exists, file_system

#: Rows and seconds after which a task writes what it has got.
ROWS, SECONDS = 20_000, 20.0
#: Keys of calls that a task gives at once.
KEYS = 1000


def _schema(values: T.StructType) -> T.StructType:
    own = T.StructType.fromDDL("key string, attempt string, mark boolean, n long")
    return T.StructType([*own, T.StructField("value", values)])


class _Writer:
    """The results of one attempt of a task."""

    def __init__(self, folder: str, run: str, schema: pa.Schema):
        self.files, self.folder = file_system(folder)
        context = TaskContext.get()
        self.schema, self.attempt = schema, uuid.uuid4().hex
        self.name, self.first = f"{run}-{context.partitionId()}", context.attemptNumber() == 0
        self.rows: list[dict] = []
        self.since, self.n = time.monotonic(), 0

    def ended(self) -> set[str]:
        """Keys of the calls that earlier attempts of this task have ended."""
        if self.first:
            return set()
        found = self.files.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        own = [f.path for f in found if f.base_name.startswith(f"{self.name}-") and f.base_name.endswith(".parquet")]
        tables = [pq.read_table(self.files.open_input_file(p), columns=["key", "mark"]) for p in own]
        return {k for t in tables for k, m in zip(t["key"].to_pylist(), t["mark"].to_pylist(), strict=True) if m}

    def add(self, key: str, value: dict | None, mark: bool) -> None:
        self.rows.append({"key": key, "attempt": self.attempt, "mark": mark, "n": self.n, "value": value})
        self.n += 1
        if len(self.rows) >= ROWS or time.monotonic() - self.since > SECONDS:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            self.files.create_dir(self.folder, recursive=True)
            name = f"{self.name}-{self.attempt}-{self.n}.parquet"
            # a file that is cut off must not be read
            with self.files.open_output_stream(f"{self.folder}/.{name}") as out:
                pq.write_table(pa.Table.from_pylist(self.rows, self.schema), out)
            self.files.move(f"{self.folder}/.{name}", f"{self.folder}/{name}")
        self.rows, self.since = [], time.monotonic()


def kept(spark: SparkSession, folder: str, values: T.StructType) -> DataFrame:
    """``(key, attempt, mark, n, value)`` of the store, of one ended attempt for each key; its marks are among the rows."""
    schema = _schema(values)
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(folder)
    ended = rows.where("mark").groupBy("key").agg(F.min("attempt").alias("attempt"))
    return rows.join(ended, ["key", "attempt"])


def each_call(folder: str, values: T.StructType, calls: Callable[[Iterator], Iterator[tuple[str, Iterator[pd.DataFrame | list[dict]]]]]) -> Callable[[Iterator], Iterator[pd.DataFrame]]:
    """A function of a task's batches that makes calls and keeps their results; it gives frames with the ``key`` of those that it made.

    Results are frames, or lists of rows where a frame for each call would cost more than the call. ``calls`` takes the task's input and gives ``(key, results)``; a call is made while its results are read. Calls whose
    keys an earlier attempt of the task has ended are passed over.
    """
    run, schema = uuid.uuid4().hex, to_arrow_schema(_schema(values))

    def keep(batches: Iterator) -> Iterator[pd.DataFrame]:
        made: list[str] = []
        out = _Writer(folder, run, schema)
        ended = out.ended()
        try:
            for key, results in calls(batches):
                if key in ended:
                    continue
                for frame in results:
                    for row in frame if isinstance(frame, list) else frame.to_dict("records"):
                        out.add(key, {k: _plain(v) for k, v in row.items()}, False)
                out.add(key, None, True)
                made.append(key)
                if len(made) == KEYS:
                    yield pd.DataFrame({"key": made})
                    made = []
            yield pd.DataFrame({"key": made}, dtype=object)
        finally:
            out.flush()

    return keep


def _plain(v):
    """A value of a frame as Arrow takes it: missing numbers as null, numpy's scalars as Python's."""
    if hasattr(v, "item") and not hasattr(v, "__len__"):
        v = v.item()
    return None if isinstance(v, float) and v != v else v
