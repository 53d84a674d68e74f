"""Independent SQL for every registered query, for DuckDB over the same parquet tables.

Written as plain joins and aggregations (the textbook 3-way triangle join, nested
VALUES tables for the hash parameters), not as a translation of the Spark plans.
DuckDB's ``%`` keeps the sign of the dividend, so ``pmod`` is spelled out.
"""

from __future__ import annotations

from trisk.plans import params as PR

P = PR.P


def _pmod(x: str, m) -> str:
    return f"((({x}) % {m}) + {m}) % {m}"


def _hash(x: str, a, b) -> str:
    """(a*x + b) mod p, non-negative."""
    return f"(({a}) * {_pmod(x, P)} + ({b})) % {P}"


GRAPH = """
raw AS (SELECT unnest([{'a': 3 * l_orderkey, 'b': 3 * l_partkey + 1}, {'a': 3 * l_partkey + 1, 'b': 3 * l_suppkey + 2},
                       {'a': 3 * l_orderkey, 'b': 3 * l_suppkey + 2}]) AS x FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL),
e AS (SELECT DISTINCT least(x.a, x.b) AS u, greatest(x.a, x.b) AS v FROM raw)"""


def _runs() -> str:
    rows = ", ".join(f"({r}, {a}, {b})" for r, (a, b) in enumerate(PR.color_params()))
    return f"runs(run, a, b) AS (VALUES {rows})"


def _triangles(edge_table: str, group: list[str]) -> str:
    """Triangles x<y<z of ``edge_table(u, v, group...)`` with all edges in one group."""
    on = "".join(f" AND e2.{g} = e1.{g}" for g in group)
    on3 = "".join(f" AND e3.{g} = e1.{g}" for g in group)
    sel = ", ".join(f"e1.{g}" for g in group)
    head = f"{sel}, " if group else ""
    gb = f" GROUP BY {sel}" if group else ""
    return (f"SELECT {head}count(*)::BIGINT AS triangles FROM {edge_table} e1 "
            f"JOIN {edge_table} e2 ON e2.u = e1.v{on} "
            f"JOIN {edge_table} e3 ON e3.u = e1.u AND e3.v = e2.v{on3}{gb}")


def _mono() -> str:
    cu = f"({_hash('e.u', 'r.a', 'r.b')}) % {PR.COLORS}"
    cv = f"({_hash('e.v', 'r.a', 'r.b')}) % {PR.COLORS}"
    return (f"mono AS (SELECT r.run, {cu} AS color, e.u, e.v FROM e, runs r WHERE {cu} = {cv})")


def _sketch_rows(depth: int = PR.DEPTH) -> str:
    rows = ", ".join(f"({r.row}, {r.ah}, {r.bh}, {r.ag}, {r.bg})" for r in PR.sketch_rows(depth))
    return f"sr(row, ah, bh, ag, bg) AS (VALUES {rows})"


def _sketch_body(hist: str, width: int = PR.WIDTH) -> str:
    """CTEs hx (item, freq, row, col, sign), cells (row, col, c) over ``hist(item, freq)``."""
    col = f"({_hash('h.item', 'sr.ah', 'sr.bh')}) % {width}"
    sign = f"CASE WHEN ({_hash('h.item', 'sr.ag', 'sr.bg')}) % 2 = 0 THEN -1 ELSE 1 END"
    return (f"hx AS (SELECT h.item, h.freq, sr.row, {col} AS col, {sign} AS sign FROM {hist} h, sr), "
            "cells AS (SELECT row, col, sum(sign * freq)::BIGINT AS c FROM hx GROUP BY row, col)")


INTERVAL = f"item BETWEEN {PR.LEFT} AND {PR.RIGHT}"
IT = "it AS (SELECT user_id AS item FROM events)"
HIST = f"{IT}, h0 AS (SELECT item, count(*)::BIGINT AS freq FROM it GROUP BY item)"
HIST_IN = f"{IT}, h0 AS (SELECT item, count(*)::BIGINT AS freq FROM it WHERE {INTERVAL} GROUP BY item)"
BATCHES = (f"bt AS (SELECT (event_id // {PR.BATCH_ROWS})::BIGINT AS batch_id, user_id AS item FROM events), "
           f"lengths AS (SELECT batch_id, count(*)::BIGINT AS n, "
           f"count(*) FILTER (WHERE {INTERVAL})::BIGINT AS n_in FROM bt GROUP BY batch_id), "
           f"cut AS (SELECT batch_id, n, n_in, coalesce(sum(n) OVER (ORDER BY batch_id ROWS BETWEEN "
           f"UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS preceding FROM lengths), "
           f"kept AS (SELECT * FROM cut WHERE preceding < {PR.THRESHOLD})")


def _report(hist: str, total: str) -> str:
    """The sketch report over ``hist(item, freq)`` with total items from ``total(items)``."""
    return (f"WITH {_sketch_rows()}, {_sketch_body(hist)}, "
            f"top AS (SELECT item, freq FROM {hist} ORDER BY freq DESC, item ASC LIMIT {PR.TOP_K}), "
            f"est AS (SELECT hx.item, hx.freq, trunc(quantile_cont(hx.sign * cells.c, 0.5))::BIGINT AS est "
            f"FROM hx JOIN cells USING (row, col) WHERE hx.item IN (SELECT item FROM top) GROUP BY hx.item, hx.freq), "
            f"sq AS (SELECT row, sum(c * c) AS s FROM cells GROUP BY row), "
            f"n AS (SELECT coalesce(sum(freq), 0)::BIGINT AS items_in_interval, count(*)::BIGINT AS distinct_in_interval, "
            f"sum(freq * freq)::DOUBLE AS f2num FROM {hist}) "
            f"SELECT {PR.DEPTH}::BIGINT AS d, {PR.WIDTH}::BIGINT AS w, {PR.LEFT}::BIGINT AS left_end, "
            f"{PR.RIGHT}::BIGINT AS right_end, {PR.TOP_K}::BIGINT AS k, "
            f"(SELECT items FROM {total})::BIGINT AS items, n.items_in_interval, n.distinct_in_interval, "
            f"round((SELECT avg(abs(freq - est)::DOUBLE / freq) FROM est), 9) AS avg_error, "
            f"round(n.f2num / (n.items_in_interval::DOUBLE * n.items_in_interval::DOUBLE), 9) AS f2, "
            f"round((SELECT quantile_cont(s, 0.5) FROM sq)::DOUBLE / "
            f"(n.items_in_interval::DOUBLE * n.items_in_interval::DOUBLE), 9) AS f2_sketch FROM n")


def _tradeoff() -> str:
    prm = []
    for i, (d, w) in enumerate(PR.TRADEOFF_GRID):
        for r in PR.sketch_rows(d):
            prm.append(f"({i}, {d}, {w}, {r.row}, {r.ah}, {r.bh}, {r.ag}, {r.bg})")
    grid = ", ".join(f"({i}, {d}, {w})" for i, (d, w) in enumerate(PR.TRADEOFF_GRID))
    col = f"({_hash('h.item', 'g.ah', 'g.bh')}) % g.w"
    sign = f"CASE WHEN ({_hash('h.item', 'g.ag', 'g.bg')}) % 2 = 0 THEN -1 ELSE 1 END"
    return (
        f"WITH g(cfg, d, w, row, ah, bh, ag, bg) AS (VALUES {', '.join(prm)}), "
        f"grid(cfg, d, w) AS (VALUES {grid}), "
        f"h AS (SELECT l_partkey AS item, count(*)::BIGINT AS freq FROM lineitem GROUP BY l_partkey), "
        f"hx AS (SELECT g.cfg, h.item, h.freq, g.row, {col} AS col, {sign} AS sign FROM h, g), "
        f"cells AS (SELECT cfg, row, col, sum(sign * freq)::BIGINT AS c FROM hx GROUP BY cfg, row, col), "
        f"top AS (SELECT item FROM h ORDER BY freq DESC, item ASC LIMIT {PR.TOP_K}), "
        f"est AS (SELECT hx.cfg, hx.item, hx.freq, trunc(quantile_cont(hx.sign * cells.c, 0.5))::BIGINT AS est "
        f"FROM hx JOIN cells USING (cfg, row, col) WHERE hx.item IN (SELECT item FROM top) "
        f"GROUP BY hx.cfg, hx.item, hx.freq), "
        f"err AS (SELECT cfg, avg(abs(freq - est)::DOUBLE / freq) AS avg_error FROM est GROUP BY cfg), "
        f"sq AS (SELECT cfg, quantile_cont(s, 0.5) AS m FROM "
        f"(SELECT cfg, row, sum(c * c) AS s FROM cells GROUP BY cfg, row) GROUP BY cfg), "
        f"n AS (SELECT sum(freq)::DOUBLE AS items, sum(freq * freq)::DOUBLE AS f2num FROM h) "
        f"SELECT grid.cfg::BIGINT AS cfg, grid.d::BIGINT AS d, grid.w::BIGINT AS w, "
        f"round(err.avg_error, 9) AS avg_error, round(n.f2num / (n.items * n.items), 9) AS f2, "
        f"round(sq.m::DOUBLE / (n.items * n.items), 9) AS f2_sketch "
        f"FROM grid CROSS JOIN n LEFT JOIN err ON err.cfg = grid.cfg LEFT JOIN sq ON sq.cfg = grid.cfg")


def oracle_sql() -> dict[str, str]:
    a0, b0 = PR.color_params()[0]
    pa, pb = PR.partition_params()
    C = PR.COLORS
    part = f"(((({pa}) * {_pmod('u', P)} + ({pb}) * {_pmod('v', P)}) % {P}) % {C})"
    cu0 = f"(({_hash('u', a0, b0)}) % {C})"
    cv0 = f"(({_hash('v', a0, b0)}) % {C})"
    sql = {}

    text = ("WITH t AS (SELECT l_partkey::VARCHAR || ',' || l_suppkey::VARCHAR AS value FROM lineitem), "
            "s AS (SELECT trim(string_split(value, ',')[1])::BIGINT AS src, "
            "trim(string_split(value, ',')[2])::BIGINT AS dst FROM t)")
    sql["edge_list_parse"] = sql["edge_text_scan"] = f"{text} SELECT src, dst FROM s"
    sql["edge_count"] = (f"{text} SELECT (SELECT count(*) FROM s)::BIGINT AS raw_edges, "
                         f"(SELECT count(*) FROM (SELECT DISTINCT least(src, dst), greatest(src, dst) "
                         f"FROM s WHERE src <> dst))::BIGINT AS edges")
    sql["edges_canonical"] = f"WITH {GRAPH} SELECT u, v FROM e"
    sql["adjacency_degree"] = (
        f"WITH {GRAPH}, nb AS (SELECT u AS node, v AS other FROM e UNION ALL SELECT v, u FROM e), "
        f"deg AS (SELECT node, count(*)::BIGINT AS degree FROM nb GROUP BY node) "
        f"SELECT d.node, d.degree, count(*) FILTER (WHERE o.degree > d.degree OR "
        f"(o.degree = d.degree AND o.node > d.node))::BIGINT AS out_degree "
        f"FROM deg d JOIN nb ON nb.node = d.node JOIN deg o ON o.node = nb.other GROUP BY d.node, d.degree")
    sql["node_color"] = (
        f"WITH {GRAPH}, {_runs()}, nodes AS (SELECT u AS node FROM e UNION SELECT v FROM e) "
        f"SELECT r.run::BIGINT AS run, n.node, (({_hash('n.node', 'r.a', 'r.b')}) % {C})::BIGINT AS color "
        f"FROM nodes n, runs r")
    sql["monochrome_edges"] = (f"WITH {GRAPH}, {_runs()}, {_mono()} "
                               f"SELECT run::BIGINT AS run, color::BIGINT AS color, u, v FROM mono")
    sql["edge_partition_sizes"] = (f"WITH {GRAPH} SELECT {part}::BIGINT AS part, count(*)::BIGINT AS edges "
                                   f"FROM e GROUP BY 1")
    sql["color_triple_edges"] = (
        f"WITH {GRAPH}, c AS (SELECT {cu0} AS cu, {cv0} AS cv FROM e), "
        f"x AS (SELECT cu, cv, i FROM c, range({C}) t(i)) "
        f"SELECT least(cu, cv, i)::BIGINT AS k1, "
        f"(cu + cv + i - least(cu, cv, i) - greatest(cu, cv, i))::BIGINT AS k2, "
        f"greatest(cu, cv, i)::BIGINT AS k3, count(*)::BIGINT AS edges FROM x GROUP BY 1, 2, 3")
    sql["color_triple_report"] = (
        f"WITH k AS ({sql['color_triple_edges']}), m AS (WITH {GRAPH} SELECT count(*)::BIGINT AS edges FROM e) "
        f"SELECT {C}::BIGINT AS colors, m.edges, sum(k.edges)::BIGINT AS copies, "
        f"round(sum(k.edges) / m.edges, 9)::DOUBLE AS replication, count(*)::BIGINT AS keys, "
        f"max(k.edges)::BIGINT AS largest_key, round(avg(k.edges), 9) AS mean_key FROM k, m GROUP BY m.edges")
    exact = f"WITH {GRAPH} {_triangles('e', [])}"
    sql["triangles_exact"] = exact
    sql["triangles_exact_colored"] = exact
    tri = _triangles("e", []).replace("SELECT count(*)::BIGINT AS triangles", "SELECT e1.u AS x, e1.v AS y, e2.v AS z")
    cols = [f"(({_hash(n, a0, b0)}) % {C})" for n in "xyz"]
    low, high = f"least({', '.join(cols)})", f"greatest({', '.join(cols)})"
    sql["triangles_per_triple_key"] = (
        f"WITH {GRAPH}, t AS ({tri}) SELECT {low}::BIGINT AS k1, ({' + '.join(cols)} - {low} - {high})::BIGINT AS k2, "
        f"{high}::BIGINT AS k3, count(*)::BIGINT AS triangles FROM t GROUP BY 1, 2, 3")
    by_color = f"WITH {GRAPH}, {_runs()}, {_mono()} {_triangles('mono', ['run', 'color'])}"
    sql["triangles_by_color"] = (f"SELECT run::BIGINT AS run, color::BIGINT AS color, triangles "
                                 f"FROM ({by_color})")
    est = (f"WITH {GRAPH}, {_runs()}, {_mono()}, bc AS ({_triangles('mono', ['run', 'color'])}), "
           f"est AS (SELECT r.run::BIGINT AS run, (coalesce(sum(bc.triangles), 0) * {C * C})::BIGINT AS estimate "
           f"FROM runs r LEFT JOIN bc ON bc.run = r.run GROUP BY r.run)")
    sql["triangles_color_estimate"] = f"{est} SELECT run, estimate FROM est"
    sql["triangles_color_median"] = (f"{est} SELECT count(*)::BIGINT AS runs, "
                                     f"round_even(quantile_cont(estimate, 0.5), 0)::BIGINT AS median_estimate FROM est")
    sql["triangles_partition_estimate"] = (
        f"WITH {GRAPH}, pe AS (SELECT u, v, {part} AS part FROM e), "
        f"tp AS ({_triangles('pe', ['part'])}) "
        f"SELECT (coalesce(sum(triangles), 0) * {C * C})::BIGINT AS estimate FROM tp")
    sql["triangle_report"] = (
        f"WITH {GRAPH}, {_runs()}, {_mono()}, "
        f"bc AS ({_triangles('mono', ['run', 'color'])}), "
        f"est AS (SELECT r.run, coalesce(sum(bc.triangles), 0) * {C * C} AS estimate "
        f"FROM runs r LEFT JOIN bc ON bc.run = r.run GROUP BY r.run), "
        f"pe AS (SELECT u, v, {part} AS part FROM e), tp AS ({_triangles('pe', ['part'])}), "
        f"ex AS ({_triangles('e', [])}) "
        f"SELECT {C}::BIGINT AS colors, {PR.RUNS}::BIGINT AS runs, (SELECT count(*) FROM raw)::BIGINT AS raw_edges, "
        f"(SELECT count(*) FROM e)::BIGINT AS edges, "
        f"(SELECT round_even(quantile_cont(estimate, 0.5), 0) FROM est)::BIGINT AS color_estimate, "
        f"(SELECT coalesce(sum(triangles), 0) * {C * C} FROM tp)::BIGINT AS partition_estimate, "
        f"(SELECT triangles FROM ex)::BIGINT AS exact_triangles")

    sql["run_report"] = (
        f"{est}, pe AS (SELECT u, v, {part} AS part FROM e), tp AS ({_triangles('pe', ['part'])}), "
        f"ex AS ({_triangles('e', [])}) "
        f"SELECT 'color' AS algorithm, run, estimate FROM est UNION ALL "
        f"SELECT 'partition', 0, (SELECT coalesce(sum(triangles), 0) * {C * C} FROM tp)::BIGINT UNION ALL "
        f"SELECT 'exact', {PR.RUNS - 1}, (SELECT triangles FROM ex)")
    sql["item_parse"] = "SELECT trim(user_id::VARCHAR)::BIGINT AS item FROM events"
    sql["interval_items"] = f"SELECT user_id AS item FROM events WHERE user_id BETWEEN {PR.LEFT} AND {PR.RIGHT}"
    sql["item_histogram"] = f"WITH {HIST} SELECT item, freq FROM h0"
    sql["item_hashes"] = (f"WITH {HIST}, {_sketch_rows()}, {_sketch_body('h0')} "
                          f"SELECT item, row::BIGINT AS row, col::BIGINT AS col, sign::BIGINT AS sign FROM hx")
    sql["stream_lengths"] = (f"SELECT count(*)::BIGINT AS items, count(*) FILTER (WHERE user_id BETWEEN "
                             f"{PR.LEFT} AND {PR.RIGHT})::BIGINT AS items_in_interval FROM events")
    cells = f"WITH {HIST}, {_sketch_rows()}, {_sketch_body('h0')}"
    sql["sketch_cells"] = f"{cells} SELECT row::BIGINT AS row, col::BIGINT AS col, c FROM cells"
    sql["sketch_estimates"] = (
        f"{cells} SELECT hx.item, hx.freq, trunc(quantile_cont(hx.sign * cells.c, 0.5))::BIGINT AS est "
        f"FROM hx JOIN cells USING (row, col) GROUP BY hx.item, hx.freq")
    sql["f2_exact"] = (f"WITH {HIST} SELECT coalesce(sum(freq), 0)::BIGINT AS items, "
                       f"round(sum(freq * freq)::DOUBLE / (sum(freq)::DOUBLE * sum(freq)::DOUBLE), 9) AS f2 FROM h0")
    sql["f2_sketch"] = (
        f"{cells}, sq AS (SELECT row, sum(c * c) AS s FROM cells GROUP BY row) "
        f"SELECT round((SELECT quantile_cont(s, 0.5) FROM sq)::DOUBLE / "
        f"((SELECT sum(freq) FROM h0)::DOUBLE * (SELECT sum(freq) FROM h0)::DOUBLE), 9) AS f2_sketch")
    topk = (f"{cells}, top AS (SELECT row_number() OVER (ORDER BY freq DESC, item ASC)::BIGINT AS rank, "
            f"item, freq FROM h0 ORDER BY freq DESC, item ASC LIMIT {PR.TOP_K}), "
            f"est AS (SELECT hx.item, trunc(quantile_cont(hx.sign * cells.c, 0.5))::BIGINT AS est "
            f"FROM hx JOIN cells USING (row, col) GROUP BY hx.item), "
            f"tk AS (SELECT top.rank, top.item, top.freq, est.est FROM top JOIN est USING (item))")
    sql["topk_items"] = f"{topk} SELECT rank, item, freq, est FROM tk"
    sql["topk_avg_error"] = f"{topk} SELECT round(avg(abs(freq - est)::DOUBLE / freq), 9) AS avg_error FROM tk"
    sql["sketch_report"] = (f"WITH {HIST_IN}, tot AS (SELECT count(*)::BIGINT AS items FROM events) "
                            f"SELECT * FROM ({_report('h0', 'tot')})")
    sql["sketch_tradeoff"] = _tradeoff()
    sql["distinct_items"] = "SELECT DISTINCT user_id AS item FROM events"
    sql["distinct_report"] = ("SELECT count(*)::BIGINT AS items, count(DISTINCT user_id)::BIGINT AS distinct_items, "
                              "max(user_id) AS largest_item FROM events")
    sql["batch_lengths"] = f"WITH {BATCHES} SELECT batch_id, n, n_in FROM lengths"
    sql["batch_prefix_cutoff"] = f"WITH {BATCHES} SELECT batch_id, n, n_in, preceding FROM kept"
    merged = (f"WITH {BATCHES}, hk AS (SELECT item, count(*)::BIGINT AS freq FROM bt "
              f"WHERE {INTERVAL} AND batch_id IN (SELECT batch_id FROM kept) GROUP BY item)")
    sql["batch_partials_merge"] = sql["item_histogram"]
    sql["stream_histogram"] = sql["item_histogram"]
    sql["stream_sketch_cells"] = sql["sketch_cells"]
    sql["stream_distinct"] = sql["distinct_items"]
    sql["stream_distinct_report"] = (
        f"WITH {BATCHES}, k AS (SELECT item FROM bt WHERE batch_id IN (SELECT batch_id FROM kept)) "
        f"SELECT count(*)::BIGINT AS items, count(DISTINCT item)::BIGINT AS distinct_items, "
        f"max(item) AS largest_item FROM k")
    sql["stream_prefix_cutoff"] = (f"{merged}, tot AS (SELECT sum(n)::BIGINT AS items FROM kept) "
                                   f"SELECT * FROM ({_report('hk', 'tot')})")
    return sql
