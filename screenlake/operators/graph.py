"""Relation graphs from an edge file and a name dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.operators.index import global_index
from screenlake.session import materialize

# ----------------------------------------------------------- names and edges


def first_ids(names: DataFrame, name: str, id_: str, order: str) -> DataFrame:
    """``name, id``: the id in the first dictionary row of each name."""
    return names.groupBy(name).agg(F.min_by(id_, order).alias(id_))


def both_directions(links: DataFrame, a: str, b: str) -> DataFrame:
    """``src, dst`` for every link and its reverse, from one scan; may repeat."""
    ends = F.explode(F.array(F.struct(F.col(a).alias("src"), F.col(b).alias("dst")),
                             F.struct(F.col(b).alias("src"), F.col(a).alias("dst"))))
    return links.select(ends.alias("e")).select("e.src", "e.dst")


def undirected_edges(links: DataFrame, a: str, b: str) -> DataFrame:
    """Both directions without repeats.

    Each pair is put in one order before repeats are removed, so a link is
    shuffled once, and turned around only afterwards.
    """
    whole = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = whole.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct()
    ends = F.array(F.struct(F.col("lo").alias("src"), F.col("hi").alias("dst")),
                   F.struct(F.col("hi").alias("src"), F.col("lo").alias("dst")))
    return pairs.select(F.explode(F.array_distinct(ends)).alias("e")).select("e.src", "e.dst")


def relation_graph(
    links: DataFrame,
    names: DataFrame,
    labels: DataFrame,
    ends: tuple[str, str] = ("protein1", "protein2"),
    id_: str = "protein_id",
    name: str = "preferred_name",
    order: str = "file_ord",
    strict: bool = True,
) -> DataFrame:
    """``src, dst_id, dst``: the labelled neighbours of each label, one row per neighbour id.

    ``labels`` has one column. A label without a dictionary entry is an error
    in strict mode. Both ends of a link are cut down to labelled ids before
    repeats are removed, so the edge file is scanned once and shuffled only
    as far as it matters. Rows stay rows: no list of a hub is ever gathered.
    """
    wanted = materialize(labels.select(F.col(labels.columns[0]).alias("src")).distinct(), "labels")
    label_ids = first_ids(names, name, id_, order).select(F.col(name).alias("src"), F.col(id_).alias("src_id"))
    label_ids = materialize(label_ids.join(wanted, "src", "left_semi"), "label_ids")
    if strict:
        missing = wanted.join(label_ids, "src", "left_anti").limit(5).collect()
        if missing:
            raise KeyError(f"labels without a dictionary entry: {[r[0] for r in missing]}")
    id_names = names.groupBy(F.col(id_).alias("dst_id")).agg(F.min_by(name, order).alias("dst"))
    id_names = materialize(id_names.join(wanted.withColumnRenamed("src", "dst"), "dst", "left_semi"), "id_names")
    sided = both_directions(links, *ends).select(F.col("src").alias("src_id"), F.col("dst").alias("dst_id"))
    near = sided.join(label_ids, "src_id").join(id_names, "dst_id")
    return near.select("src", "dst_id", "dst").distinct()


def name_edges(relation: DataFrame) -> DataFrame:
    """``src, dst`` by name, without repeats."""
    return relation.select("src", "dst").distinct()


# ------------------------------------------------------- degrees, subgraphs


def node_degree(edges: DataFrame, nodes: DataFrame, node: str = "node") -> DataFrame:
    """In-degree plus out-degree of each node; nodes without edges get 0."""
    ends = edges.distinct().select(F.explode(F.array("src", "dst")).alias(node))
    counted = ends.groupBy(node).agg(F.count("*").alias("degree"))
    return nodes.select(node).join(counted, node, "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def top_nodes(degrees: DataFrame, n: int, tie_break: str = "node") -> DataFrame:
    """The ``n`` nodes of highest degree; ties go by ``tie_break``."""
    return degrees.orderBy(F.desc("degree"), tie_break).limit(n)


def induced_subgraph(edges: DataFrame, nodes: DataFrame, node: str = "node") -> DataFrame:
    """Edges with both ends in the node set."""
    kept = edges
    for end in ("src", "dst"):
        kept = kept.join(nodes.select(F.col(node).alias(end)), end, "left_semi")
    return kept.select("src", "dst")


# ------------------------------------------------------------- integer ids


def first_seen_ids(
    edges: DataFrame, keys: DataFrame, key_order: str | Column = "key", position: str | Column = "dst"
) -> DataFrame:
    """``node, id``: ids from 0 in the order names are met while walking the adjacency lists.

    Keys come in ``key_order`` and neighbours in ``position`` order. The
    neighbours of a key are met before the key itself.
    """
    walk_key = F.col(key_order) if isinstance(key_order, str) else key_order
    at = F.col(position) if isinstance(position, str) else position
    ordered = keys.select("key", walk_key.alias("_key"))
    met = edges.select(F.col("src").alias("key"), F.col("dst").alias("node"), at.alias("_at")).join(ordered, "key")
    met = met.select("node", F.struct("_key", F.lit(0).alias("_late"), "_at").alias("place"))
    own_at = F.lit(None).cast(met.schema["place"].dataType["_at"].dataType)
    own = ordered.select(
        F.col("key").alias("node"), F.struct("_key", F.lit(1).alias("_late"), own_at.alias("_at")).alias("place")
    )
    first = met.unionByName(own).groupBy("node").agg(F.min("place").alias("place")).select("node", "place.*")
    return materialize(global_index(first, ["_key", "_late", "_at"], "id").select("node", "id"), "ids")


def integer_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with names replaced by ids."""
    sources = ids.select(F.col("node").alias("src"), F.col("id").alias("_s"))
    targets = ids.select(F.col("node").alias("dst"), F.col("id").alias("_t"))
    return edges.join(sources, "src").join(targets, "dst").select(F.col("_s").alias("src"), F.col("_t").alias("dst"))


def edge_index(edges: DataFrame, num_nodes: int, add_self_edges: bool = True) -> DataFrame:
    """Integer edges without repeats, then the self-edges 0..n-1 (not checked against the rest)."""
    unique = edges.select(F.col("src").cast("long"), F.col("dst").cast("long")).distinct()
    if not add_self_edges:
        return unique
    loops = edges.sparkSession.range(num_nodes).select(F.col("id").alias("src"), F.col("id").alias("dst"))
    return unique.unionByName(loops)
