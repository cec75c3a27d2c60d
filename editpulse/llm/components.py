"""Connected components of a stored graph, by alternating stars.

Every step is a join and a grouped minimum; nothing is collected but the two
numbers that tell whether the edges still change.  Each star is stored, and an
edge that goes two ways is read once: what a step reads twice doubles the plan
that the driver holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import common as C


def _toward_min(edges: DataFrame) -> DataFrame:
    """For each ``u`` the least of itself and its neighbours, beside its edges."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _both(edges: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """``(u, v)`` of each row's two pairs of columns, those of equal ends left out."""
    pairs = F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in ends])
    return edges.select(F.inline(pairs)).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """``(v, root)`` for every node of ``edges (u, v)`` but the roots: the least
    node that it reaches.  Large and small stars alternate until both rest."""
    spark = edges.sparkSession
    edges = C.staged(spark, edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = _both(edges, ("u", "v"), ("v", "u"))
        large = _toward_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = C.staged(spark, large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "stars")
        small = _both(_toward_min(down), ("v", "m"), ("u", "m")).distinct()
        edges = C.staged(spark, small, "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        before = now
