"""Graph queries on the part → supplier and nation → nation graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaywright.operators import graph
from delaywright.plans.registry import query
from delaywright.plans.views import (
    table,
    SUPPLY_EDGES,
    TRADE_EDGES,
    rounded,
    supply_edges,
    trade_edges,
)
from delaywright.sources import adjacency

DEGREE = "v_out AS (SELECT src AS id, CAST(sum(weight) AS BIGINT) AS out_degree FROM v_edge GROUP BY src)"
NODES = "v_node AS (SELECT src AS id FROM v_edge UNION SELECT dst FROM v_edge)"


def _records(spark, sf_dir):
    """Adjacency text of the supply graph, parsed back to (node, neighbours)."""
    lines = adjacency.adjacency_lines(supply_edges(spark, sf_dir))
    return adjacency.parse_lines(lines)


@query(
    "parse_adjacency_map",
    f"""WITH {SUPPLY_EDGES} SELECT src AS node, count(*) AS neighbours, CAST(sum(weight) AS BIGINT) AS links
    FROM v_edge GROUP BY src""",
)
def parse_adjacency_map(spark, sf_dir):
    links = F.aggregate(F.map_values("neighbours"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    parsed = _records(spark, sf_dir).select(
        "node", F.size("neighbours").alias("neighbours"), links.alias("links")
    )
    # a long adjacency list may come in several lines
    return parsed.groupBy("node").agg(F.sum("neighbours").alias("neighbours"), F.sum("links").alias("links"))


@query("explode_edges", f"WITH {SUPPLY_EDGES} SELECT src, dst, weight FROM v_edge")
def explode_edges(spark, sf_dir):
    return adjacency.explode_edges(_records(spark, sf_dir))


PER_PART = 20


@query(
    "expand_multiplicity",
    f"""WITH {SUPPLY_EDGES},
    r AS (SELECT src AS node, dst, unnest(range(weight)) AS copy FROM v_edge),
    o AS (SELECT node, dst, row_number() OVER (PARTITION BY node ORDER BY dst) - 1 AS place FROM r)
    SELECT node, place // {PER_PART} AS part, string_agg(dst, ',' ORDER BY place) AS outlinks FROM o GROUP BY node, part""",
)
def expand_multiplicity(spark, sf_dir):
    """Every link repeated by its weight, in numbered parts of bounded length."""
    return adjacency.expand_multiplicity(_records(spark, sf_dir), PER_PART)


@query("out_degree", f"WITH {SUPPLY_EDGES}, {DEGREE} SELECT id, out_degree FROM v_out")
def out_degree(spark, sf_dir):
    return graph.out_degree(supply_edges(spark, sf_dir))


@query(
    "topk_out_degree",
    f"WITH {SUPPLY_EDGES}, {DEGREE} SELECT id, out_degree FROM v_out ORDER BY out_degree DESC, id LIMIT 10",
)
def topk_out_degree(spark, sf_dir):
    return graph.top_out_degree(supply_edges(spark, sf_dir), 10)


@query(
    "avg_out_degree",
    f"WITH {SUPPLY_EDGES}, {DEGREE} SELECT round(avg(out_degree), 6) AS avg_out_degree FROM v_out",
)
def avg_out_degree(spark, sf_dir):
    found = graph.average_out_degree(supply_edges(spark, sf_dir))
    return found.select(rounded("avg_out_degree").alias("avg_out_degree"))


@query(
    "lookup_node",
    f"WITH {SUPPLY_EDGES} SELECT count(*) AS neighbours, CAST(sum(weight) AS BIGINT) AS links FROM v_edge WHERE src = 'P42'",
)
def lookup_node(spark, sf_dir):
    return graph.lookup_node(supply_edges(spark, sf_dir), "P42")


@query("graph_node_count", f"WITH {SUPPLY_EDGES}, {NODES} SELECT count(*) AS nodes FROM v_node")
def graph_node_count(spark, sf_dir):
    return graph.node_count(supply_edges(spark, sf_dir))


@query(
    "anti_join_dangling",
    f"WITH {SUPPLY_EDGES} SELECT DISTINCT dst AS id FROM v_edge WHERE dst NOT IN (SELECT src FROM v_edge)",
)
def anti_join_dangling(spark, sf_dir):
    return graph.dangling_nodes(supply_edges(spark, sf_dir))


@query(
    "dangling_ratio",
    f"""WITH {SUPPLY_EDGES}, {NODES}, f AS (SELECT id IN (SELECT src FROM v_edge) AS has FROM v_node)
    SELECT count(*) FILTER (has) AS regular, count(*) FILTER (NOT has) AS dangling,
      round(count(*) FILTER (NOT has) / count(*), 6) AS dangling_ratio FROM f""",
)
def dangling_ratio(spark, sf_dir):
    found = graph.dangling_ratio(supply_edges(spark, sf_dir))
    return found.withColumn("dangling_ratio", rounded("dangling_ratio"))


@query(
    "graph_init",
    f"""WITH {SUPPLY_EDGES}, {DEGREE}, {NODES} SELECT id, coalesce(out_degree, 0) AS out_degree,
      round(1.0 / (SELECT count(*) FROM v_node), 8) AS rank FROM v_node LEFT JOIN v_out USING (id)""",
)
def graph_init(spark, sf_dir):
    return graph.init_graph(supply_edges(spark, sf_dir)).withColumn("rank", F.round("rank", 8))


@query(
    "join_rank_edges_left",
    f"""WITH {SUPPLY_EDGES}, {NODES}, o AS (SELECT src AS id, count(*) AS neighbours,
        CAST(sum(weight) AS BIGINT) AS links FROM v_edge GROUP BY src)
    SELECT id, round(1.0 / (SELECT count(*) FROM v_node), 8) AS rank, coalesce(neighbours, 0) AS neighbours,
      coalesce(links, 0) AS links FROM v_node LEFT JOIN o USING (id)""",
)
def join_rank_edges_left(spark, sf_dir):
    edges = supply_edges(spark, sf_dir)
    ranks = graph.init_graph(edges).select("id", "rank")
    return graph.ranks_with_links(edges, ranks).withColumn("rank", F.round("rank", 8))


@query(
    "transition_probs",
    f"""WITH {SUPPLY_EDGES} SELECT src, dst, weight, round(weight / sum(weight) OVER (PARTITION BY src), 8) AS p
    FROM v_edge""",
)
def transition_probs(spark, sf_dir):
    return graph.transition_probabilities(supply_edges(spark, sf_dir)).withColumn("p", F.round("p", 8))


PER_RECORD = 50


@query(
    "adjacency_list",
    f"""WITH {SUPPLY_EDGES}, {NODES},
    o AS (SELECT src, dst, CAST((row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {PER_RECORD} AS INTEGER) AS part FROM v_edge),
    l AS (SELECT src AS id, part, string_agg(dst, ',' ORDER BY dst) AS neighbours FROM o GROUP BY src, part)
    SELECT id, coalesce(part, 0) AS part, coalesce(neighbours, '') AS neighbours FROM v_node LEFT JOIN l USING (id)""",
)
def adjacency_list(spark, sf_dir):
    lists = graph.adjacency_list(supply_edges(spark, sf_dir), PER_RECORD)
    return lists.withColumn("neighbours", F.array_join("neighbours", ","))


@query(
    "adjacency_matrix",
    f"""WITH {TRADE_EDGES}, big AS (SELECT src, dst FROM v_trade
      WHERE weight >= (SELECT avg(weight) FROM v_trade))
    SELECT a.n_nationkey AS node, string_agg(CAST(big.src IS NOT NULL AS INTEGER), ',' ORDER BY b.n_nationkey) AS links
    FROM nation a CROSS JOIN nation b LEFT JOIN big ON big.src = a.n_nationkey AND big.dst = b.n_nationkey
    GROUP BY a.n_nationkey""",
)
def adjacency_matrix(spark, sf_dir):
    """Matrix of the trade links that are at least as strong as the average link; a row's entries
    stand in ascending order of the nations."""
    edges = trade_edges(spark, sf_dir)
    strong = edges.filter(F.col("weight") >= edges.agg(F.avg("weight")).scalar())
    nations = [r[0] for r in table(spark, sf_dir, "nation").select("n_nationkey").orderBy("n_nationkey").collect()]
    wide = graph.adjacency_matrix(strong, nations)
    return wide.select("node", F.concat_ws(",", *[F.col(f"to_{n}").cast("string") for n in nations]).alias("links"))


@query("adjacency_entries", f"WITH {SUPPLY_EDGES} SELECT DISTINCT src AS i, dst AS j, 1 AS v FROM v_edge")
def adjacency_entries(spark, sf_dir):
    """The whole 0/1 matrix as (i, j, v) rows."""
    return graph.adjacency_entries(supply_edges(spark, sf_dir))


def _unrolled(edge_cte: str, name: str, steps: int, weighted: bool = True, alpha: float = 0.15) -> str:
    weight = "weight" if weighted else "1"
    parts = [
        f"{edge_cte}",
        f"e AS MATERIALIZED (SELECT src, dst, CAST({weight} AS DOUBLE) / sum({weight}) OVER (PARTITION BY src) AS p FROM {name})",
        "node AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e)",
        "c AS MATERIALIZED (SELECT count(*) AS n FROM node)",
        "sink AS MATERIALIZED (SELECT id FROM node WHERE id NOT IN (SELECT src FROM e))",
        "r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / n AS rank FROM node, c)",
    ]
    for i in range(1, steps + 1):
        before = f"r{i - 1}"
        parts.append(
            f"""r{i} AS MATERIALIZED (SELECT node.id, {alpha}::DOUBLE / c.n
              + {1 - alpha}::DOUBLE * (m.m / c.n + coalesce(f.x, 0)) AS rank
            FROM node CROSS JOIN c
            CROSS JOIN (SELECT coalesce(sum(rank), 0) AS m FROM {before} JOIN sink USING (id)) m
            LEFT JOIN (SELECT e.dst AS id, sum(r.rank * e.p) AS x FROM e JOIN {before} r ON e.src = r.id
              GROUP BY e.dst) f ON f.id = node.id)"""
        )
    return ",\n".join(parts)


@query(
    "pagerank",
    f"WITH {_unrolled(SUPPLY_EDGES, 'v_edge', 10)} SELECT id, round(rank, 8) AS pagerank FROM r10",
)
def pagerank(spark, sf_dir):
    ranks = graph.pagerank(supply_edges(spark, sf_dir), iterations=10)
    return ranks.withColumn("pagerank", F.round("pagerank", 8))


@query(
    "pagerank_trade",
    f"WITH {_unrolled(TRADE_EDGES, 'v_trade', 10)} SELECT id, round(rank, 8) AS pagerank FROM r10",
)
def pagerank_trade(spark, sf_dir):
    ranks = graph.pagerank(trade_edges(spark, sf_dir), iterations=10)
    return ranks.withColumn("pagerank", F.round("pagerank", 8))


@query(
    "pagerank_unweighted",
    f"""WITH {_unrolled(SUPPLY_EDGES, 'v_edge', 10, weighted=False)}
    SELECT id, round(rank * n, 6) AS pagerank FROM r10, c""",
)
def pagerank_unweighted(spark, sf_dir):
    ranks = graph.pagerank(supply_edges(spark, sf_dir), iterations=10, weighted=False, normalise=False)
    return ranks.withColumn("pagerank", rounded("pagerank"))


@query(
    "pagerank_total_mass",
    f"""WITH {_unrolled(SUPPLY_EDGES, 'v_edge', 3)} SELECT round(sum(rank), 8) AS total_mass,
      count(*) AS nodes FROM r3""",
)
def pagerank_total_mass(spark, sf_dir):
    mass = graph.total_mass(graph.pagerank(supply_edges(spark, sf_dir), iterations=3))
    return mass.withColumn("total_mass", F.round("total_mass", 8))


@query(
    "rank_slice",
    f"""WITH {_unrolled(SUPPLY_EDGES, 'v_edge', 10)} SELECT id, round(rank, 8) AS pagerank
    FROM r10 ORDER BY rank DESC, id LIMIT 20 OFFSET 20""",
)
def rank_slice(spark, sf_dir):
    ranks = graph.pagerank(supply_edges(spark, sf_dir), iterations=10)
    return graph.rank_slice(ranks, 20, 40).withColumn("pagerank", F.round("pagerank", 8))


def _unrolled_walk(steps: int) -> str:
    parts = [
        TRADE_EDGES,
        "e AS MATERIALIZED (SELECT src, dst, CAST(weight AS DOUBLE) / sum(weight) OVER (PARTITION BY src) AS p FROM v_trade)",
        "node AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e)",
        "s0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM node) AS x FROM node)",
    ]
    for i in range(1, steps + 1):
        parts.append(
            f"""s{i} AS MATERIALIZED (SELECT node.id, coalesce(f.x, 0) AS x FROM node LEFT JOIN
            (SELECT e.dst AS id, sum(s.x * e.p) AS x FROM e JOIN s{i - 1} s ON e.src = s.id GROUP BY e.dst) f
            ON f.id = node.id)"""
        )
    return ",\n".join(parts)


@query(
    "steady_state",
    f"WITH {_unrolled_walk(10)} SELECT id, round(x, 8) AS probability FROM s10",
)
def steady_state(spark, sf_dir):
    state = graph.steady_state(trade_edges(spark, sf_dir), 10)
    return state.withColumn("probability", F.round("probability", 8))
