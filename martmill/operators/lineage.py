"""Questions to a dependency graph, given as an edge table ``parent, child``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martmill.session import materialise, scratch_path, write_counted


def downstream_count(edges: DataFrame, min_children: int = 2) -> DataFrame:
    """Direct children per parent, and whether there are enough to store the parent as a table."""
    counted = edges.select("parent", "child").distinct().groupBy("parent").agg(
        F.count(F.lit(1)).alias("downstream_count")
    )
    return counted.withColumn("is_candidate", F.col("downstream_count") >= min_children)


def materialization_candidates(
    edges: DataFrame, views: DataFrame, traffic: DataFrame, min_children: int = 2, min_queries: int = 1
) -> DataFrame:
    """Views worth storing as tables: enough direct children, or enough queries of their own.

    ``views``: ``view_name``; ``traffic``: ``view_name, query_count``, from the query log.
    """
    children = downstream_count(edges).select(F.col("parent").alias("view_name"), "downstream_count")
    joined = views.select("view_name").join(children, "view_name", "left")
    joined = joined.join(traffic.select("view_name", "query_count"), "view_name", "left")
    counts = joined.select(
        "view_name",
        F.coalesce("downstream_count", F.lit(0)).alias("downstream_count"),
        F.coalesce("query_count", F.lit(0)).alias("query_count"),
    )
    gate = (F.col("downstream_count") >= min_children) | (F.col("query_count") >= min_queries)
    return counts.withColumn("is_candidate", gate)


def _chains(arcs: DataFrame) -> DataFrame:
    """Views with a single way down, each with the first relation on that way that is no such view, and the steps to it.

    Pointer doubling: every view points at its child, then at what its target points at, twice per round, so a chain of n
    views takes log n doublings. Views that still point at one of their kind when a round changes no more are on
    a ring or lead into one.
    """
    ways = arcs.groupBy("parent").agg(F.count(F.lit(1)).alias("n"), F.max("child").alias("end"))
    state, before = ways.where("n = 1").select(F.col("parent").alias("view"), "end", F.lit(1).alias("steps"), F.lit(False).alias("open")), None
    while True:
        for _ in range(2):
            on = state.select(F.col("view").alias("end"), F.col("end").alias("next"), F.col("steps").alias("more"))
            state = state.join(on, "end", "left").select(
                "view",
                F.coalesce("next", "end").alias("end"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                F.col("next").isNotNull().alias("open"),
            )
        path = scratch_path(arcs.sparkSession, "chains")
        still = write_counted(state, path, still=F.count_if("open"))["still"]
        state = arcs.sparkSession.read.schema(state.schema).parquet(path)
        if not still or still == before:
            return state.where("not open").drop("open")
        before = still


def view_chain_hops(
    edges: DataFrame, relations: DataFrame, max_depth: int | None = None, steps_per_round: int = 4
) -> DataFrame:
    """Fewest steps downstream from each view to something stored.

    ``relations`` holds ``name, is_stored``. Views with a single way down are cut out first: an arc to one becomes
    a longer arc to the end of its chain. What remains, views with several ways, is settled from the stored
    relations backwards. In each step only views that have just come closer pass their distance on; a round
    of steps is one plan without a repeated input, its result is written, and the rounds end when one improves nothing.
    Rings end by themselves. A graph deeper than ``max_depth``, where one is given, is an error, not a shorter answer.
    """
    spark = edges.sparkSession
    views = relations.filter(~F.col("is_stored")).select("name")
    arcs = edges.select("parent", "child").where("parent <> child").distinct().join(views, F.col("parent") == F.col("name"), "left_semi")
    arcs = materialise(arcs, "arcs")
    chains = _chains(arcs)
    ends = chains.select(F.col("view").alias("child"), "end", "steps")
    branching = arcs.join(chains.select(F.col("view").alias("parent")), "parent", "left_anti")  # views on rings stay, and do no harm
    longer = branching.join(ends, "child", "left").select(
        "parent", F.coalesce("end", "child").alias("child"), (1 + F.coalesce("steps", F.lit(0))).alias("steps")
    )
    longer = materialise(longer.groupBy("parent", "child").agg(F.min("steps").alias("steps")), "arcs")
    state = relations.filter("is_stored").select(F.col("name").alias("view"), F.lit(0).alias("hops"), F.lit(True).alias("closer"))
    while True:
        for _ in range(steps_per_round):
            met = state.join(longer, (F.col("view") == F.col("child")) & F.col("closer"), "left")
            own = F.struct("view", "hops", F.lit(True).alias("own"))
            passed = F.struct(F.col("parent").alias("view"), (F.col("hops") + F.col("steps")).alias("hops"), F.lit(False).alias("own"))
            told = met.select(F.explode(F.array(own, passed)).alias("s")).select("s.*").where(F.col("view").isNotNull())
            nearest = told.groupBy("view").agg(F.min("hops").alias("hops"), F.min(F.when(F.col("own"), F.col("hops"))).alias("old"))
            state = nearest.select("view", "hops", (F.col("old").isNull() | (F.col("hops") < F.col("old"))).alias("closer"))
        path = scratch_path(spark, "hops")
        moved = write_counted(state, path, moved=F.count_if("closer"))["moved"]
        state = spark.read.schema(state.schema).parquet(path)
        if not moved:
            break
    along = chains.join(state.select(F.col("view").alias("end"), "hops"), "end").select("view", (F.col("hops") + F.col("steps")).alias("hops"))
    settled = state.where("hops > 0").select("view", "hops").unionByName(along)
    settled = settled.select(F.col("view").alias("view_name"), F.col("hops").cast("int").alias("min_hops_to_table"))
    if max_depth is not None and (settled.agg(F.max("min_hops_to_table")).first()[0] or 0) > max_depth:
        raise RuntimeError(f"views more than {max_depth} steps away from a stored relation")
    return settled
