"""Tenant tree: closure, path decode, layers.

The closure is a frontier loop: each level is one equi-join of the frontier
with the (brand -> company) edge list. The edge list is partitioned by the
owner once, so a level moves only its frontier. The loop ends when a level is
empty, whatever the depth; a node already on its own path is never expanded
again, so it always ends. Every few levels the frontier is written to the
cluster's shared ``spark.checkpoint.dir`` and read back, which cuts the
lineage, so neither the plan nor a recomputation after executor loss grows with
depth.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths
from .sinks import materialize

WRITE_EVERY = 4


def closure(company: DataFrame, brand: DataFrame, write_every: int = WRITE_EVERY) -> DataFrame:
    """Recursive tenant tree.

    company: id, brand_id (NULL for roots), name, region
    brand:   id, owner_id (the parent company), name
    Returns tenant_id, parent_id, parent_name, tenant_name, region, tree_key, id_path, indent.
    ``id_path`` holds the full ids from the root down and decides everything; ``tree_key`` is the
    fixed-width display form, which shortens ids of over 7 characters.
    """
    nodes = company.select("id", "brand_id", "name", "region")
    frontier = nodes.filter(F.col("brand_id").isNull()).select(
        F.col("id").alias("tenant_id"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.lit(None).cast("string").alias("parent_name"),
        F.col("name").alias("tenant_name"),
        "region",
        paths.path_piece("id").alias("tree_key"),
        F.col("id").cast("string").alias("id_path"),
        F.lit("").alias("indent"),
    )
    edges = brand.select(F.col("id").alias("b_id"), "owner_id", F.col("name").alias("b_name")).join(
        nodes.filter(F.col("brand_id").isNotNull()).select(
            F.col("id").alias("c_id"), F.col("brand_id").alias("b_id"), F.col("name").alias("c_name")),
        "b_id",
    )
    edges = edges.repartition("owner_id").persist(StorageLevel.MEMORY_AND_DISK)
    levels, written, held = [], [], []

    def close() -> None:
        """Write the open levels as one table; their cached frames are released."""
        if levels:
            written.append(materialize(reduce(DataFrame.unionByName, levels), "tree-levels"))
        for df in held:
            df.unpersist()
        levels.clear()
        held.clear()

    while True:
        frontier = frontier.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(frontier)
        if frontier.isEmpty():
            break
        levels.append(frontier)
        if len(levels) == write_every:
            frontier = materialize(frontier, "tree-frontier")
            close()
        frontier = (
            frontier.select(F.col("tenant_id").alias("owner_id"), "region", "tree_key", "id_path", "indent")
            .join(edges, "owner_id")
            .filter(~paths.on_path("id_path", "c_id"))  # cycle guard
            .select(
                F.col("c_id").alias("tenant_id"),
                F.col("owner_id").alias("parent_id"),
                F.col("b_name").alias("parent_name"),
                F.col("c_name").alias("tenant_name"),
                "region",
                F.concat("tree_key", paths.path_piece("c_id")).alias("tree_key"),
                F.concat_ws(paths.ID_SEP, "id_path", F.col("c_id").cast("string")).alias("id_path"),
                F.concat("indent", F.lit("-> ")).alias("indent"),
            )
        )
    if not levels and not written:
        levels.append(frontier)          # no roots: an empty tree
    close()
    edges.unpersist()
    return reduce(DataFrame.unionByName, written)


def decode(tree: DataFrame, prefix_col: str = "region") -> DataFrame:
    """Global ids and depth read back from the path key."""
    ids, p = F.split("id_path", paths.ID_SEP), F.col(prefix_col)
    own = lambda i: F.concat(p, F.lit("-"), F.element_at(ids, i))
    depth = (F.size(ids) - 1).cast("int")
    return tree.select(
        "*",
        own(1).alias("root"),
        depth.alias("depth"),
        F.when(depth > 0, F.concat(p, F.lit("-"), F.try_element_at(ids, F.lit(-2)))).alias("parent_global_id"),
        own(-1).alias("tenant_global_id"),
        F.concat("indent", "tenant_name").alias("indented_name"),
    )


def with_layers(df: DataFrame, prefix_col: str = "root", n: int = 5) -> DataFrame:
    """first_layer_id .. fifth_layer_id from the path of full ids (T11); '' when unused.

    The layers are output columns; a tenant below the last one is still known by its own id.
    """
    names = ["first", "second", "third", "fourth", "fifth"][:n]
    prefix = F.concat(F.substring(F.col(prefix_col), 1, 2), F.lit("-"))
    ids = F.split("id_path", paths.ID_SEP)
    return df.select("*", *[F.coalesce(F.concat(prefix, F.get(ids, i)), F.lit("")).alias(f"{nm}_layer_id")
                            for i, nm in enumerate(names)])


def leaf_id(prefix_col: str = "root") -> Column:
    """The last id of the path of full ids, region-prefixed: the tenant that is billed (T13), at any depth."""
    return F.concat(F.substring(F.col(prefix_col), 1, 2), F.lit("-"), F.element_at(F.split("id_path", paths.ID_SEP), -1))


def layer_names(df: DataFrame, names: DataFrame, key=("record_date", "tenant_global_id"), n: int = 5) -> DataFrame:
    """Resolve each layer id to its tenant name on the same date.

    ``names`` holds (record_date, tenant_global_id, tenant_name), one row per
    tenant per day; ``key`` is the unique key of ``df``. Instead of five
    self-joins the layer ids are exploded, joined once to the name map and
    folded back per key, so the name map is shuffled once whatever the depth.
    """
    labels = ["first", "second", "third", "fourth", "fifth"][:n]
    key = list(key)
    exploded = df.select(
        *key,
        F.posexplode(F.array(*[F.col(f"{nm}_layer_id") for nm in labels])).alias("_k", "_layer"),
    ).filter(F.col("_layer") != "")
    # only the days present in df are needed from the (day x tenant) name map
    days = df.select("record_date").distinct()
    lookup = names.join(days, "record_date", "left_semi").select(
        "record_date", F.col("tenant_global_id").alias("_layer"), F.col("tenant_name").alias("_name"))
    named = exploded.join(lookup, ["record_date", "_layer"], "left")
    folded = named.groupBy(*key).agg(
        *[F.max(F.when(F.col("_k") == i, F.col("_name"))).alias(f"{nm}_layer_name") for i, nm in enumerate(labels)]
    )
    out = df.join(folded, key, "left")
    return out.select(*df.columns, *[F.coalesce(F.col(f"{nm}_layer_name"), F.lit("")).alias(f"{nm}_layer_name")
                                     for nm in labels])
