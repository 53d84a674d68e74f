from trisk.sources.edges import (  # noqa: F401
    edge_text_from_lineitem,
    order_pairs,
    parse_edges,
    read_edge_text,
)
from trisk.sources.items import BATCH_ROWS, batched_events, item_text, parse_items  # noqa: F401


def table(spark, sf_dir: str, name: str):
    """One test table, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
