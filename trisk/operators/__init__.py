"""DataFrame operators: graph, triangles, sketch, batch bookkeeping, skew helpers."""
