from trisk.streaming.runner import (  # noqa: F401
    PartialWriter,
    run_query,
    stream_distinct,
    stream_distinct_report,
    stream_partials,
    stream_sketch_cells,
    table_stream,
    text_items,
)
