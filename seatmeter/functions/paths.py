"""Tree path keys: encode, decode, and layer extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import as_col

# Fixed values of the path format: each node is the last 7 characters of
# 'XXXXXXX' followed by its id, then one space.
PAD = "XXXXXXX"
WIDTH = 7
SEP = " "
# between the full ids of a path
ID_SEP = "/"


def path_piece(node_id) -> Column:
    return F.concat(F.substring(F.concat(F.lit(PAD), as_col(node_id).cast("string")), -WIDTH, WIDTH), F.lit(SEP))


def on_path(id_path, node_id) -> Column:
    """True if the node stands on the path of full ids."""
    mark = F.lit(ID_SEP)
    return F.contains(F.concat(mark, as_col(id_path), mark), F.concat(mark, as_col(node_id).cast("string"), mark))


def _node(tree_key, k: int) -> Column:
    # k-th space-separated part (negative counts from the end); pad letters stripped
    return F.split_part(F.split_part(as_col(tree_key), F.lit(SEP), F.lit(k)), F.lit("X"), F.lit(-1))


def depth(tree_key) -> Column:
    return (F.regexp_count(as_col(tree_key), F.lit(SEP)) - 1).cast("int")


def root_id(tree_key, prefix) -> Column:
    return F.concat(as_col(prefix), F.lit("-"), _node(tree_key, 1))


def self_id(tree_key, prefix) -> Column:
    return F.concat(as_col(prefix), F.lit("-"), _node(tree_key, -2))


def parent_id(tree_key, prefix) -> Column:
    return F.when(depth(tree_key) > 0, F.concat(as_col(prefix), F.lit("-"), _node(tree_key, -3)))


def layer(tree_key, prefix, k: int) -> Column:
    """k-th (1-based) id on the path, region-prefixed; '' when the path is shorter."""
    digits = F.regexp_extract_all(as_col(tree_key), F.lit("[0-9]+"), 0)
    return F.coalesce(F.concat(as_col(prefix), F.lit("-"), F.get(digits, k - 1)), F.lit(""))


def region_of(global_id) -> Column:
    """Letters before the dash of a global id ('US-12' -> 'US')."""
    return F.regexp_extract(as_col(global_id), r"^([A-Za-z]+)-", 1)


def number_of(global_id) -> Column:
    """Digits of a global id ('US-12' -> '12')."""
    return F.regexp_replace(as_col(global_id), r"[^0-9]", "")


def leaf(*layers) -> Column:
    """Deepest non-empty layer (the billed tenant)."""
    cols = [F.nullif(F.trim(as_col(c)), F.lit("")) for c in reversed(layers)]
    return F.coalesce(*cols)
