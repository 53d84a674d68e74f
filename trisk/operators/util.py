"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_rows(frames: list[DataFrame]) -> DataFrame:
    """Side by side columns of several one-row frames, as one row.

    Each frame's columns are padded with typed NULLs to a common schema, the frames
    are unioned (one row each) and folded with ``max`` per column: no cross join.
    """
    fields = []
    for f in frames:
        fields.extend(f.schema.fields)
    names = [fl.name for fl in fields]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate column names: {names}")
    padded = []
    for f in frames:
        own = set(f.columns)
        padded.append(f.select(*[
            F.col(fl.name) if fl.name in own else F.lit(None).cast(fl.dataType).alias(fl.name)
            for fl in fields]))
    out = padded[0]
    for f in padded[1:]:
        out = out.unionByName(f)
    return out.agg(*[F.max(n).alias(n) for n in names])


def require_positive(**values: int) -> None:
    """The programs' argument rule: counts such as C, R, D, W, K must be >= 1."""
    for name, v in values.items():
        if not isinstance(v, int) or v < 1:
            raise ValueError(f"{name} must be an integer >= 1, got {v!r}")
