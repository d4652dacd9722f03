"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querymill.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its
    smallest node.

    Each round hooks every node to its smallest neighbour, follows the hooks to
    their ends, and replaces the links by those between different ends. At least
    half of the nodes that still have links go in a round. Everything stays in
    tables, each written to the shared folder, so nothing depends on one executor.
    Links with a NULL end and links of a node with itself are ignored.
    """
    todo = links.select("a", "b").where("a <> b")
    found = None
    while True:
        both = todo.unionByName(todo.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialize(
            both.groupBy("a")
            .agg(F.min("b").alias("b"))
            .select(F.col("a").alias("node"), F.least("a", "b").alias("component")),
            "hooks",
        )
        if hooks.isEmpty():
            empty = hooks if found is None else found
            return empty
        hooks = _roots(hooks)
        found = hooks if found is None else _follow(found, hooks)
        ends = _relabel(_relabel(todo, hooks, "a"), hooks, "b").where("a <> b")
        todo = materialize(
            ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links",
        )
        if todo.isEmpty():
            return found


def _relabel(links: DataFrame, labels: DataFrame, end: str) -> DataFrame:
    """Links with one end replaced by its label."""
    named = labels.withColumnsRenamed({"node": end, "component": "_label"})
    return links.join(named, end).drop(end).withColumnRenamed("_label", end)


def _follow(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    """Labels replaced by what those are hooked to, where they are."""
    onward = hooks.select(F.col("node").alias("component"), F.col("component").alias("_next"))
    return materialize(
        labels.join(onward, "component", "left").select(
            "node", F.coalesce("_next", "component").alias("component")
        ),
        "labels",
    )


def _roots(hooks: DataFrame) -> DataFrame:
    """Hooks followed to nodes that are hooked to themselves; steps double each time."""
    onward = hooks.select(F.col("node").alias("component"), F.col("component").alias("_next"))
    while True:
        followed = materialize(
            hooks.join(onward, "component").select(
                "node",
                F.col("_next").alias("component"),
                (F.col("_next") != F.col("component")).alias("moved"),
            ),
            "hooks",
        )
        hooks = followed.select("node", "component")
        if followed.where("moved").isEmpty():
            return hooks
        onward = hooks.select(F.col("node").alias("component"), F.col("component").alias("_next"))
