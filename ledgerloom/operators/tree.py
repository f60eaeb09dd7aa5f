"""Flatten a cost-centre tree of depth two or three."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def flatten_tree(nodes: DataFrame, values: DataFrame) -> DataFrame:
    """One row per path: division, group (if the branch has one) and cost centre, with texts.

    ``nodes``: tree_node_id, parent_tree_node_id, depth, pk1_start_value, tree_version_id of the
    tree and versions wanted.  ``values``: flex_value, description.  Branches without a described
    division, middle node or cost centre drop out.
    """
    def level(tag: str) -> DataFrame:
        return nodes.select(*(F.col(c).alias(f"{tag}_{n}") for n, c in (
            ("id", "tree_node_id"), ("parent", "parent_tree_node_id"), ("depth", "depth"),
            ("code", "pk1_start_value"), ("version", "tree_version_id"))))

    def text(tag: str) -> DataFrame:
        return values.select(F.col("flex_value").alias(f"{tag}_value"), F.col("description").alias(f"{tag}_text"))

    top, mid, low = level("top").filter("top_parent IS NULL"), level("mid"), level("low")
    paths = (
        top.join(mid, (F.col("top_id") == F.col("mid_parent")) & (F.col("top_version") == F.col("mid_version"))
                 & (F.col("top_depth") < F.col("mid_depth")))
        .join(low, (F.col("mid_id") == F.col("low_parent")) & (F.col("mid_version") == F.col("low_version"))
              & (F.col("mid_depth") < F.col("low_depth")), "left"))
    is_group = F.col("mid_depth") == 1
    return (
        paths.join(text("top"), F.col("top_code") == F.col("top_value"))
        .join(text("mid"), F.col("mid_code") == F.col("mid_value"))
        .filter(F.col("top_text") != "Historical Cost Centres")
        .select(F.col("top_code").alias("dce_group"), F.col("top_text").alias("dec_group_desc"),
                F.when(is_group, F.col("mid_code")).alias("gm_group"),
                F.when(is_group, F.col("mid_text")).alias("gm_group_desc"),
                F.when(F.col("mid_depth") == 2, F.col("mid_code")).otherwise(F.col("low_code")).alias("cost_center"))
        .distinct()
        .join(text("leaf"), F.col("cost_center") == F.col("leaf_value"))
        .select("dce_group", "dec_group_desc", "gm_group", "gm_group_desc", "cost_center", F.col("leaf_text").alias("cc_group_desc")))
