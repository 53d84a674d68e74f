from trisk.functions.hashing import (  # noqa: F401
    DEFAULT_PRIME,
    SketchRow,
    draw_color_params,
    draw_partition_params,
    draw_sketch_rows,
    edge_part,
    mod_hash,
    node_color,
    sketch_col,
    sketch_sign,
)
