"""Connected components of a link table, by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.tables import held


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links`` that is not itself the smallest of its
    component; ``root`` is the smallest node that it can reach.

    In each round every node with a smaller neighbour hooks below its smallest one, hooks
    are followed to their end, and the links are contracted to what still joins two
    roots.  A round is a few joins on node, whose large side AQE can split, and minima
    that are combined before the shuffle; no neighbour list is ever collected.
    Nodes may be of any ordered type.  Null ends and loops are ignored.
    """
    links = held(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                 .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    root = links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    while not links.isEmpty():
        hook = held(links.groupBy("a").agg(F.min("b").alias("to")))
        while True:
            up = hook.select(F.col("a").alias("to"), F.col("to").alias("next"))
            jumped = held(hook.join(up, "to", "left").select("a", F.coalesce("next", "to").alias("to"), "next"))
            hook = jumped.select("a", "to")
            if jumped.where("next is not null").isEmpty():
                break
        moved = root.join(hook.select(F.col("a").alias("root"), "to"), "root", "left")
        root = moved.select("node", F.coalesce("to", "root").alias("root")) \
                    .unionByName(hook.select(F.col("a").alias("node"), F.col("to").alias("root")))
        root = held(root)
        ends = {x: hook.select(F.col("a").alias(x), F.col("to").alias(f"r{x}")) for x in "ab"}
        left = links.join(ends["a"], "a").join(ends["b"], "b", "left") \
                    .select(F.col("ra").alias("x"), F.coalesce("rb", "b").alias("y")).where("x <> y")
        links = held(left.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    return root
