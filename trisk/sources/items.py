"""Item sources: text lines of one integer, and batched item tables from events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value of the test streams: events per batch (FIXTURES: 8 batches of 1,250 at sf0.01).
BATCH_ROWS = 1250


def parse_items(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One integer per line to ``(item BIGINT)``; a bad line fails the job (ANSI cast)."""
    return lines.select(F.trim(F.col(value_col)).cast("bigint").alias("item"))


def item_text(table: DataFrame, col: str) -> DataFrame:
    """A numeric column rendered as text lines ``value``, as a socket feed sends them."""
    return table.select(F.col(col).cast("string").alias("value"))


def batched_events(events: DataFrame, batch_rows: int = BATCH_ROWS,
                   item_col: str = "user_id") -> DataFrame:
    """``(batch_id, item)``: events in arrival order cut into batches of ``batch_rows``."""
    return events.select(
        # exact floor division for any BIGINT id (no detour through DOUBLE)
        F.expr(f"(event_id - pmod(event_id, {int(batch_rows)})) div {int(batch_rows)}").alias("batch_id"),
        F.col(item_col).cast("bigint").alias("item"))
