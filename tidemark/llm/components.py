"""Connected components of a table of links, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(id, component) for every id of ``links`` (a, b) and of ``labels``: the least id that links reach.

    ``labels``: components found before, which the links join further. Every
    round takes the least label of the neighbours, then the label's own label,
    so long chains halve; rounds are written out, and end when none changes.
    """
    if labels is not None:  # links between components
        a = labels.select(F.col("id").alias("a"), F.col("component").alias("ca"))
        b = labels.select(F.col("id").alias("b"), F.col("component").alias("cb"))
        links = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    both = links.filter("a <> b").select("a", "b").union(links.filter("a <> b").select("b", "a")).distinct()
    both = written(both, "edges")
    found = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component"))
    while True:
        found = written(found, "labels")
        near = both.join(found.select(F.col("id").alias("b"), F.col("component").alias("m")), "b").groupBy("a").agg(F.min("m").alias("m"))
        least = found.join(near, found["id"] == near["a"]).select("id", F.least("component", "m").alias("component"), F.col("component").alias("old"))
        least = written(least, "least")
        jump = least.select(F.col("id").alias("j"), F.col("component").alias("jc"))
        found = least.join(jump, F.col("component") == F.col("j"), "left").select("id", F.least("component", "jc").alias("component"), "old")
        if least.filter("component <> old").isEmpty():
            break
        found = found.select("id", "component")
    found = found.select("id", "component")
    if labels is None:
        return found
    joined = found.select(F.col("id").alias("c"), F.col("component").alias("cc"))
    old = labels.join(joined, labels["component"] == F.col("c"), "left").select("id", F.coalesce("cc", "component").alias("component"))
    new = found.join(labels.select("id"), "id", "left_anti").select("id", "component")
    return written(old.unionByName(new), "components")
