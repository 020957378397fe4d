"""Connected components of a link table, without collecting links.

Alternates large-star and small-star (each node links its larger, then its smaller
neighbours to the smallest node it knows); the number of rounds grows with the
logarithm of the longest chain. Each round is stored and the one before it deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import handed_on, noted, removed, stored


#: Tasks over which the links of one node are dealt.
SALTS = 8


def _joined(links: DataFrame, low: DataFrame) -> DataFrame:
    """``links`` (u, v) with the ``m`` of their ``u``."""
    salted = low.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS))).join(salted, ["u", "salt"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node it can reach.

    Nodes are of any type that has an order. Links count both ways; self-links, repeated
    links and links with a null end are ignored. The smallest neighbour of a node is an
    aggregate that sums up before it is shuffled, and joined back to the links, never to a
    group of them; the links of a hub are dealt over SALTS keys.
    """
    x, y = F.col(a), F.col(b)
    spark, before, state = links.sparkSession, [], None
    with noted(before):
        pairs = stored(links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _joined(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _joined(large, low).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        folders: list[str] = []
        with noted(folders):
            pairs = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        removed(spark, before)
        before = folders
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    handed_on(before)
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
