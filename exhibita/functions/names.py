"""Names for an operator's own columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spare(frames: DataFrame | list[DataFrame], *names: str) -> list[str]:
    """``names``, marked further where a column of the frames has one; they compare without regard to case."""
    frames = frames if isinstance(frames, list) else [frames]
    taken, out = {c.lower() for df in frames for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
