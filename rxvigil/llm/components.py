"""Connected components of a link table by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxvigil.session import written_table


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every end of ``links`` (columns ``a``, ``b``, both long and not null).

    Nodes of one component share a root, which is one of them. In each round every node moves to the neighbour, or
    itself, with the smallest hash under that round's seed; links between the nodes that are left go on. The
    number of nodes shrinks by a constant factor a round, whatever the links' shape. Each round is written out.
    """
    moves, left = [], written_table(links.filter("a <> b").select("a", "b").distinct(), "links")
    while not left.isEmpty():
        seed = F.lit(len(moves))
        both = left.union(left.select("b", "a"))
        near = both.groupBy(F.col("a").alias("node")).agg(
            F.min(F.struct(F.xxhash64("b", seed).alias("h"), F.col("b").alias("to"))).alias("best")
        )
        own = F.struct(F.xxhash64("node", seed).alias("h"), F.col("node").alias("to"))
        move = written_table(near.select("node", F.least("best", own)["to"].alias("to")), "moves")
        moves.append(move)
        ends = left.join(move.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
        ends = ends.join(move.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
        left = written_table(
            ends.filter("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct(),
            "links",
        )
    roots = None
    for move in reversed(moves):
        if roots is None:
            roots = move.select("node", F.col("to").alias("root"))
            continue
        later = roots.select(F.col("node").alias("to"), "root")
        roots = move.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return links.sparkSession.createDataFrame([], "node long, root long") if roots is None else roots
