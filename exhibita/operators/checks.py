"""Stages that are counted and checked in the pass that writes them.

A stage over a large input should run once. So what it must hold is an error inside its own job, and its counts are
observed on the way to the writer instead of being taken by jobs of their own. The observation stands directly below the
writer, in the job's last stage, where a task that is repeated after a lost executor counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.names import spare


def join_required(rows: DataFrame, other: DataFrame, item: str = "item_id", stage: str = "stage") -> DataFrame:
    """``rows`` joined with ``other`` on the item; a row whose item ``other`` lacks is an error that names it.

    One join does what a check before it would read both sides for. The error is part of the plan: it is raised while
    the result is worked out, and neither filters nor selections that follow leave it out. A null item is one that
    ``other`` lacks. Items that repeat on either side multiply as in any join; columns of ``other`` that ``rows`` has
    too are replaced. Empty ``rows`` give an empty result.
    """
    kept = [c for c in rows.columns if c == item or c not in other.columns]
    (there,) = spare([rows, other], "_there")
    joined = rows.select(*kept).join(other.withColumn(there, F.lit(True)), item, "left")
    wrong = F.raise_error(F.concat(F.lit(f"{stage}: nothing for item "), F.coalesce(F.col(item).cast("string"), F.lit("null"))))
    held = joined.where(F.coalesce(F.col(there), wrong.cast("boolean"))).drop(there)
    # filters are not pushed through an observation, so that one on other's columns cannot make this an inner join
    return held.observe(Observation(), F.count("*").alias("n"))


def write_stage(rows: DataFrame, path: str, stage: str, counts: dict[str, Column] | None = None, may_be_empty: bool = False) -> dict[str, int]:
    """Writes ``rows`` to ``path``, a folder of Parquet files that must not be there, and says what was written.

    The result has ``n_rows`` and whatever ``counts`` asks for: aggregates without DISTINCT, such as
    ``F.sum(F.size("documents"))``; one that has nothing to add up is 0. All come from the pass that writes. No rows are
    an error and leave no folder, unless they may be missing; nor does an error in the rows themselves leave files that
    are read.
    """
    wanted = {"n_rows": F.count("*"), **(counts or {})}
    seen = Observation()
    rows.observe(seen, *[F.coalesce(c, F.lit(0)).alias(name) for name, c in wanted.items()]).write.parquet(path)
    found = seen.get
    out = {name: int(found.get(name) or 0) for name in wanted}
    if not out["n_rows"] and not may_be_empty:
        context = rows.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        raise ValueError(f"{stage}: no rows")
    return out
