"""Connected components of links, on Spark, in rounds of star contraction."""

from pyspark.sql import DataFrame, functions as F

from barforge.functions.storage import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour, or to itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; ``a`` > ``b`` in and out."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    told = links.join(least, "a")
    return (told.select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(told.select("a", F.col("least").alias("b")))
            .where("a > b").distinct())


def component_labels(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node in ``links``; the component is its smallest node.

    Links with a null end or of a node with itself count for nothing. Each round is
    written to the shared folder; rounds end when one changes no link. Nothing is
    gathered per node: smallest neighbours are partial aggregates, and a hub's links
    are rows of a join that the engine may split.
    """
    first = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    now = stored(first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == before or not state[0]:
            break
        before = state
        now = stored(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("b").alias("node")).distinct()
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
