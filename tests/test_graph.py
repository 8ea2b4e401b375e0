import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.operators import attention, graph
from screenlake.sources.adjacency import read_adjacency, write_adjacency


def edges_of(spark, pairs, kind="string"):
    return spark.createDataFrame(pairs, f"src {kind}, dst {kind}")


def test_first_row_of_a_name_wins(spark, rows):
    names = spark.createDataFrame([("P2", "Foo", 1), ("P1", "Foo", 0)], "id string, name string, ord long")
    assert rows(graph.first_ids(names, "name", "id", "ord")) == [("Foo", "P1")]


def relation(spark, labels, strict=True):
    links = spark.createDataFrame([("P1", "P2"), ("P3", "P1"), ("P2", "P1")], "protein1 string, protein2 string")
    names = spark.createDataFrame(
        [("P1", "A", 0), ("P2", "B", 1), ("P3", "C", 2)], "protein_id string, preferred_name string, file_ord long"
    )
    return graph.relation_graph(links, names, spark.createDataFrame([(x,) for x in labels], "label string"), strict=strict)


def test_relation_graph_in_both_directions(spark, rows):
    assert rows(relation(spark, ["A", "B"]), "src", "dst") == [("A", "B"), ("B", "A")]
    assert rows(relation(spark, ["A", "B", "C"]), "src", "dst") == [("A", "B"), ("A", "C"), ("B", "A"), ("C", "A")]


def test_unknown_label_is_an_error(spark):
    with pytest.raises(KeyError, match="Q"):
        relation(spark, ["A", "Q"])
    assert relation(spark, ["A", "Q"], strict=False).count() == 0


def test_ids_that_share_a_name_stay_apart(spark, rows):
    links = spark.createDataFrame([(1, 2), (1, 3), (3, 1)], "protein1 long, protein2 long")
    names = spark.createDataFrame([(1, "A", 0), (2, "B", 1), (3, "B", 2)], "protein_id long, preferred_name string, file_ord long")
    labels = spark.createDataFrame([("A",), ("B",)], "label string")
    got = graph.relation_graph(links, names, labels)
    assert rows(got) == [("A", 2, "B"), ("A", 3, "B"), ("B", 1, "A")]  # B is looked up as id 2 only
    assert rows(graph.name_edges(got)) == [("A", "B"), ("B", "A")]


def test_undirected_edges(spark, rows):
    links = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (1, None), (5, 4)], "a long, b long")
    assert rows(graph.undirected_edges(links, "a", "b")) == [(1, 2), (2, 1), (3, 3), (4, 5), (5, 4)]


def test_first_seen_ids(spark, rows):
    edges = spark.createDataFrame([("A", 0, "B"), ("A", 1, "C"), ("C", 0, "D"), ("C", 1, "A")], "src string, pos int, dst string")
    keys = spark.createDataFrame([(0, "A"), (1, "C")], "key_ord int, key string")
    got = graph.first_seen_ids(edges, keys, "key_ord", "pos")
    assert rows(got) == [("A", 2), ("B", 0), ("C", 1), ("D", 3)]


def test_edge_index(spark):
    edges = edges_of(spark, [(0, 1), (1, 0), (0, 1)], "long")
    got = Counter(tuple(r) for r in graph.edge_index(edges, 2).collect())
    assert got == Counter([(0, 1), (1, 0), (0, 0), (1, 1)])
    loops = Counter(tuple(r) for r in graph.edge_index(edges_of(spark, [(0, 0)], "long"), 1).collect())
    assert loops == Counter({(0, 0): 2})  # self-edges are not checked against the rest
    assert graph.edge_index(edges, 2, add_self_edges=False).count() == 2


def test_degree_top_and_induced(spark, rows):
    edges = edges_of(spark, [("A", "B"), ("B", "A"), ("A", "C")])
    nodes = spark.createDataFrame([("A",), ("B",), ("C",), ("Z",)], "node string")
    degrees = graph.node_degree(edges, nodes)
    assert rows(degrees) == [("A", 3), ("B", 2), ("C", 1), ("Z", 0)]
    top = graph.top_nodes(degrees, 2)
    assert rows(top, "node") == [("A",), ("B",)]
    assert rows(graph.induced_subgraph(edges, top)) == [("A", "B"), ("B", "A")]


def test_degree_ties_go_by_the_given_order(spark, rows):
    degrees = spark.createDataFrame([("x", 1, 2), ("y", 1, 0), ("z", 5, 1)], "node string, degree int, ord int")
    assert rows(graph.top_nodes(degrees, 2, "ord"), "node") == [("y",), ("z",)]


def test_adjacency_round_trip_splits_a_hub(spark, tmp_path, rows):
    pairs = [("hub", f"n{i:03d}") for i in range(95)] + [(f"n{i:03d}", "hub") for i in range(5)]
    edges = edges_of(spark, pairs)
    nodes = spark.createDataFrame([("hub",), ("lonely",)], "node string")
    path = str(tmp_path / "adj")
    write_adjacency(edges, path, nodes, chunk=10)
    lines = spark.read.text(path)
    assert lines.filter("value like '%hub\":%'").count() >= 10
    back = read_adjacency(spark, path)
    assert rows(back.filter("dst is not null"), "src", "dst") == sorted(pairs)
    assert rows(back.filter("dst is null"), "src") == [("lonely",)]


def test_one_json_object_reads_too(spark, tmp_path, rows):
    (tmp_path / "one.txt").write_text('{"A": ["B", "C"], "C": []}')
    assert rows(read_adjacency(spark, str(tmp_path / "one.txt"))) == [("A", 0, "B"), ("A", 1, "C"), ("C", None, None)]


def dense_layer(x, edges, w, slope=0.2):
    """The same layer written out with dense numpy rows."""
    left = x @ np.array(w.left).T + np.array(w.left_bias or [0] * w.width)
    right = x @ np.array(w.right).T + np.array(w.right_bias or [0] * w.width)
    out = np.zeros((len(x), w.width))
    for i in range(len(x)):
        senders = [s for s, t in edges if t == i]
        z = left[senders] + right[i]
        score = np.where(z > 0, z, slope * z) @ np.array(w.attention)
        share = np.exp(score - score.max())
        out[i] = (share / share.sum()) @ left[senders] + np.array(w.bias or [0] * w.width)
    return out


def test_attention_network_against_dense_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6, 4)) * 20  # large scores, so the maximum has to be taken out
    pairs = [(0, 1), (1, 0), (2, 1), (3, 1), (4, 1), (5, 2)] + [(i, i) for i in range(6)]

    def weights(out, into):
        return attention.AttentionWeights(
            rng.normal(size=(out, into)).tolist(), rng.normal(size=(out, into)).tolist(), rng.normal(size=out).tolist(),
            rng.normal(size=out).tolist(), rng.normal(size=out).tolist(), rng.normal(size=out).tolist(),
        )

    first, second = weights(3, 4), weights(2, 3)
    nodes = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, x array<double>")
    got = attention.attention_network(nodes, edges_of(spark, pairs, "long"), first, second).orderBy("id").collect()
    hidden = dense_layer(x, pairs, first)
    want = dense_layer(np.where(hidden > 0, hidden, np.exp(hidden) - 1), pairs, second)
    assert np.allclose([r.x for r in got], want)
    assert all(math.isclose(sum(math.exp(v) for v in r.log_probability), 1) for r in got)


def test_hub_in_relation_graph(spark, rows):
    """A third of all links meet in one id."""
    links = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("long").alias("protein1"),
        (F.col("id") % 60).alias("protein2"),
    )
    names = spark.range(60).select(F.col("id").alias("protein_id"), F.concat(F.lit("g"), "id").alias("preferred_name"), F.col("id").alias("file_ord"))
    labels = names.filter("protein_id % 2 = 0").select(F.col("preferred_name").alias("label"))
    pairs = {(r.protein1, r.protein2) for r in links.collect()}
    want = sorted({(f"g{a}", f"g{b}") for x, y in pairs for a, b in ((x, y), (y, x)) if a % 2 == 0 and b % 2 == 0})
    assert rows(graph.relation_graph(links.repartition(7), names, labels), "src", "dst") == want
