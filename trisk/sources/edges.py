"""Edge-list sources: text files of ``u,v`` lines and the order graph of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_edge_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines of an edge file as ``value STRING`` (one ``u,v`` per line)."""
    return spark.read.text(path)


def parse_edges(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``u,v`` text lines to ``(src BIGINT, dst BIGINT)``.

    Fields beyond the second are ignored and blanks around numbers are allowed; a line
    with a missing or non-integer field fails the job (ANSI cast), like ``int()`` does.
    """
    parts = F.split(F.col(value_col), ",")
    return lines.select(
        F.trim(parts.getItem(0)).cast("bigint").alias("src"),
        F.trim(F.get(parts, 1)).cast("bigint").alias("dst"),
    ).select(
        # ANSI mode raises on a bad number; a missing second field gives NULL from
        # get(), which we turn into the same failure.
        F.col("src"),
        F.when(F.col("dst").isNull(), F.raise_error(F.lit("edge line without a second field")))
        .otherwise(F.col("dst")).alias("dst"),
    )


def edge_text_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Test edge text ``l_partkey,l_suppkey`` per lineitem row (a bipartite graph)."""
    return lineitem.select(
        F.concat_ws(",", F.col("l_partkey").cast("string"),
                    F.col("l_suppkey").cast("string")).alias("value"))


def order_pairs(lineitem: DataFrame) -> DataFrame:
    """Raw edges ``(src, dst)`` of the order graph: three per row, order - part,
    part - supplier and order - supplier, so linear in the table.

    Ids are kept apart as 3 * order, 3 * part + 1, 3 * supplier + 2; rows with a null key
    are skipped.
    """
    ids = (lineitem.where("l_orderkey IS NOT NULL AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL")
           .select((3 * F.col("l_orderkey")).alias("o"), (3 * F.col("l_partkey") + 1).alias("p"),
                   (3 * F.col("l_suppkey") + 2).alias("s")))
    pairs = [F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in (("o", "p"), ("p", "s"), ("o", "s"))]
    return ids.select(F.inline(F.array(*pairs)))
