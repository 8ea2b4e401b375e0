"""Relation graphs, degrees, ids and neighbour aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenlake.operators import attention, graph
from screenlake.plans import bindings as b
from screenlake.plans.registry import query
from screenlake.session import scratch_path
from screenlake.sources.adjacency import read_adjacency, write_adjacency

TOP = 50


@query(
    "first_match_lookup",
    """SELECT p.p_partkey AS protein_id, p.p_name AS preferred_name, f.first_id
       FROM part p JOIN (SELECT p_name, min(p_partkey) AS first_id FROM part GROUP BY p_name) f USING (p_name)""",
)
def first_match_lookup(spark, sf_dir):
    names = b.names(spark, sf_dir)
    firsts = graph.first_ids(names, "preferred_name", "protein_id", "file_ord")
    firsts = firsts.withColumnRenamed("protein_id", "first_id")
    return names.join(firsts, "preferred_name").select("protein_id", "preferred_name", "first_id")


@query(
    "undirected_edges",
    """SELECT l_suppkey AS src, l_partkey AS dst FROM lineitem UNION SELECT l_partkey, l_suppkey FROM lineitem""",
)
def undirected_edges(spark, sf_dir):
    return graph.undirected_edges(b.links(spark, sf_dir), "protein1", "protein2")


def _relation(spark, sf_dir):
    return graph.relation_graph(b.links(spark, sf_dir), b.names(spark, sf_dir), b.graph_labels(spark, sf_dir))


def _keys(spark, sf_dir):
    return b.graph_labels(spark, sf_dir).withColumnRenamed("label", "key")


@query("relation_graph", f"{b.RELATION_SQL} SELECT DISTINCT src, dst_id, dst FROM relation")
def relation_graph(spark, sf_dir):
    return _relation(spark, sf_dir)


@query("adjacency_json_roundtrip", f"{b.RELATION_SQL} SELECT src, dst FROM edges")
def adjacency_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "adjacency")
    write_adjacency(graph.name_edges(_relation(spark, sf_dir)), path)
    return read_adjacency(spark, path).select("src", "dst")


def _link_edges(spark, sf_dir):
    return b.links(spark, sf_dir).toDF("src", "dst")


DEGREE_SQL = """
    WITH e AS (SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem),
    d AS (SELECT node, count(*) AS degree FROM (SELECT src AS node FROM e UNION ALL SELECT dst FROM e) GROUP BY node),
    degrees AS (SELECT p_partkey AS node, coalesce(degree, 0) AS degree FROM part LEFT JOIN d ON node = p_partkey)"""
TOP_SQL = f"{DEGREE_SQL}, top AS (SELECT node, degree FROM degrees ORDER BY degree DESC, node LIMIT {TOP})"


def _degrees(spark, sf_dir):
    nodes = b.table(spark, sf_dir, "part").selectExpr("p_partkey AS node")
    return graph.node_degree(_link_edges(spark, sf_dir), nodes)


@query("node_degree", f"{DEGREE_SQL} SELECT node, degree FROM degrees")
def node_degree(spark, sf_dir):
    return _degrees(spark, sf_dir)


@query("top_degree_nodes", f"{TOP_SQL} SELECT node, degree FROM top")
def top_degree_nodes(spark, sf_dir):
    return graph.top_nodes(_degrees(spark, sf_dir), TOP)


@query(
    "induced_subgraph",
    f"{TOP_SQL} SELECT src, dst FROM e WHERE src IN (SELECT node FROM top) AND dst IN (SELECT node FROM top)",
)
def induced_subgraph(spark, sf_dir):
    top = graph.top_nodes(_degrees(spark, sf_dir), TOP)
    return graph.induced_subgraph(_link_edges(spark, sf_dir), top).distinct()


IDS_SQL = f"""{b.RELATION_SQL},
    places AS (SELECT dst AS node, src AS k, 0 AS late, dst AS spot FROM edges
               UNION ALL SELECT label, label, 1, '' FROM labels),
    seen AS (SELECT node, k, late, spot, row_number() OVER (PARTITION BY node ORDER BY k, late, spot) AS nth FROM places),
    ids AS (SELECT node, row_number() OVER (ORDER BY k, late, spot) - 1 AS id FROM seen WHERE nth = 1)"""


@query("first_seen_ids", f"{IDS_SQL} SELECT node, id FROM ids")
def first_seen_ids(spark, sf_dir):
    return graph.first_seen_ids(graph.name_edges(_relation(spark, sf_dir)), _keys(spark, sf_dir))


@query(
    "edge_index",
    f"""{IDS_SQL} SELECT s.id AS src, t.id AS dst FROM edges JOIN ids s ON s.node = src JOIN ids t ON t.node = dst
        UNION ALL SELECT id, id FROM ids""",
)
def edge_index(spark, sf_dir):
    edges, keys = graph.name_edges(_relation(spark, sf_dir)), _keys(spark, sf_dir)
    ids = graph.first_seen_ids(edges, keys)
    return graph.edge_index(graph.integer_edges(edges, ids), keys.count())


def _rule(out: int, into: int, a: int, c: int) -> list[list[float]]:
    """Fixed stand-in weights: small numbers from a rule the SQL twin repeats."""
    return [[((k * a + h * c) % 11 - 5) / 10 for k in range(into)] for h in range(out)]


def _rule_sql(a: int, c: int, k: str, h: str) -> str:
    return f"((({k}) * {a} + ({h}) * {c}) % 11 - 5) / 10.0::DOUBLE"


FIRST_LAYER = attention.AttentionWeights(
    left=_rule(1, 64, 7, 3), right=_rule(1, 64, 5, 3), attention=[0.8], bias=[0.1]
)
SECOND_LAYER = attention.AttentionWeights(
    left=_rule(5, 1, 7, 3), right=_rule(5, 1, 5, 4), attention=[0.3, -0.2, 0.5, 0.1, -0.4], bias=[0.0, 0.1, 0.2, 0.3, 0.4]
)


@query(
    "attention_aggregate",
    f"""WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS k, unnest(embedding)::DOUBLE AS v
                   FROM embeddings),
        e AS (SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem
              WHERE l_suppkey IN (SELECT vec_id FROM embeddings) AND l_partkey IN (SELECT vec_id FROM embeddings)
              UNION SELECT vec_id, vec_id FROM embeddings),
        p AS (SELECT vec_id, sum(v * {_rule_sql(7, 3, "k", "0")}) AS l, sum(v * {_rule_sql(5, 3, "k", "0")}) AS r
              FROM x GROUP BY vec_id),
        s1 AS (SELECT e.dst, a.l, 0.8::DOUBLE * CASE WHEN a.l + b.r > 0 THEN a.l + b.r ELSE (a.l + b.r) * 0.2::DOUBLE END
                      AS s FROM e JOIN p a ON a.vec_id = e.src JOIN p b ON b.vec_id = e.dst),
        m1 AS (SELECT dst, max(s) AS m FROM s1 GROUP BY dst),
        h0 AS (SELECT s1.dst AS id, sum(exp(s - m) * l) / sum(exp(s - m)) + 0.1::DOUBLE AS x
               FROM s1 JOIN m1 USING (dst) GROUP BY s1.dst),
        h1 AS (SELECT id, CASE WHEN x > 0 THEN x ELSE exp(x) - 1 END AS x FROM h0),
        d(d, a, bias) AS (VALUES (0, 0.3::DOUBLE, 0.0::DOUBLE), (1, -0.2, 0.1), (2, 0.5, 0.2), (3, 0.1, 0.3), (4, -0.4, 0.4)),
        q AS (SELECT id, d, a, x * {_rule_sql(7, 3, "0", "d")} AS l, x * {_rule_sql(5, 4, "0", "d")} AS r FROM h1, d),
        s2 AS (SELECT e.src, e.dst, sum(u.a * CASE WHEN u.l + w.r > 0 THEN u.l + w.r ELSE (u.l + w.r) * 0.2::DOUBLE END)
                      AS s FROM e JOIN q u ON u.id = e.src JOIN q w ON w.id = e.dst AND w.d = u.d GROUP BY e.src, e.dst),
        m2 AS (SELECT dst, max(s) AS m FROM s2 GROUP BY dst),
        o AS (SELECT s2.dst AS id, q.d, sum(exp(s - m) * q.l) / sum(exp(s - m)) + any_value(d.bias) AS x
              FROM s2 JOIN m2 USING (dst) JOIN q ON q.id = s2.src JOIN d ON d.d = q.d GROUP BY s2.dst, q.d),
        z AS (SELECT id, ln(sum(exp(x))) AS norm FROM o GROUP BY id)
        SELECT o.id, o.d AS state, round(o.x - z.norm, 6) AS log_probability FROM o JOIN z ON z.id = o.id""",
)
def attention_aggregate(spark, sf_dir):
    vectors = b.table(spark, sf_dir, "embeddings")
    nodes = vectors.select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"))
    ids = nodes.select(F.col("id").alias("node"))
    inner = graph.induced_subgraph(_link_edges(spark, sf_dir), ids)
    edges = inner.unionByName(ids.select(F.col("node").alias("src"), F.col("node").alias("dst"))).distinct()
    scored = attention.attention_network(nodes, edges, FIRST_LAYER, SECOND_LAYER)
    long = scored.select("id", F.posexplode("log_probability").alias("state", "v"))
    return long.select("id", "state", F.round("v", 6).alias("log_probability"))
