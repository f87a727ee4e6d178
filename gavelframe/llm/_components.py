"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelframe.llm._store import Folder

HUBS = 1000  # a node with more than this share of all edges (one in HUBS), and more than HUBS of them, is a hub


def _with_least(edges: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """edges joined with least (u, m, n) on u. Hubs, of which there are at most HUBS, as each has more than 1 / HUBS of the edges, are
    broadcast, so that no task holds all edges of one; the others are joined by shuffle."""
    many = max(HUBS, total // HUBS)
    hubs = least.where(F.col("n") > many).select("u", F.col("m").alias("__m"))
    split = edges.join(F.broadcast(hubs), "u", "left")
    rest = split.where("__m IS NULL").drop("__m").join(least.where(F.col("n") <= many).select("u", "m"), "u")
    return split.where("__m IS NOT NULL").withColumnRenamed("__m", "m").unionByName(rest)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node that links reach. Nodes without links are absent.

    Links may repeat, stand in both directions or join a node to itself; an empty table gives an empty one. Each step keeps at most as
    many rows as there are links, aggregates before it shuffles and is written to the shared folder, where the one before it then goes;
    no link reaches the driver.
    """
    spark = links.sparkSession
    folder = Folder(spark, "components")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder.uri}/{name}")
        return spark.read.schema("u long, v long").parquet(f"{folder.uri}/{name}")

    given = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "given")
    e, last, total, step = given, None, 2 * given.count(), 0
    while True:
        both = e.where("u <> v").select("u", "v").union(e.where("u <> v").select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = _with_least(both, least, total).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        now = _with_least(large, small, total).select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        step += 1
        e = stored(now, f"step{step}")
        folder.drop([f"step{step - 1}"])
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == last:
            break
        last, total = state, 2 * state["n"]
    own = given.select(F.col("u").alias("node")).union(given.select("v")).distinct()
    return own.join(e.withColumnRenamed("u", "node").withColumnRenamed("v", "root"), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
