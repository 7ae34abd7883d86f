"""Steps written to the shared work folder, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.session import bounded_broadcast, join_path, work_folder


class Steps:
    """Writes each step below one work folder and reads it back.

    The files cut the lineage: what follows a lost executor starts from them.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.n = spark, work_folder(spark, name), 0

    def write(self, df: DataFrame, rows: int | None = None, per_task: int = 20_000) -> DataFrame:
        """``df`` written and read again.

        ``rows`` is the most that it may hold, if that is known: a table that is
        small beside the input is then not cut into as many files as the input.
        """
        self.n += 1
        if rows is not None:
            df = df.coalesce(rows // per_task + 1)
        path = join_path(self.folder, f"step-{self.n:03d}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def components(steps: Steps, edges: DataFrame) -> DataFrame:
    """id, root for every end of ``edges`` (u, v); the root is the smallest id of a component.

    Every node that has a smaller neighbour hooks to the smallest one, edges are
    drawn anew between the roots, and so on until none is left; each round at
    most half of the nodes remain.  The smallest node of a component never hooks.
    ``edges`` are read several times in the first round, so they should be written.
    """
    maps = []
    edges = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u < v")
    while n := edges.count():
        ends = edges.select(F.col("u").alias("id"), F.col("u").alias("low")).unionByName(
            edges.select(F.col("v").alias("id"), F.col("u").alias("low"))
        )
        hooked = steps.write(ends.groupBy("id").agg(F.min("low").alias("to")), 2 * n)
        far = hooked.select(F.col("id").alias("to"), F.col("to").alias("further"))
        hooked = steps.write(hooked.join(far, "to").select("id", F.col("further").alias("to")), 2 * n)
        maps.append(hooked)
        a = hooked.select(F.col("id").alias("u"), F.col("to").alias("a"))
        b = hooked.select(F.col("id").alias("v"), F.col("to").alias("b"))
        moved = edges.join(a, "u").join(b, "v").where("a <> b")
        edges = steps.write(moved.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), n)
    if not maps:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    root = maps[0].select("id", F.col("to").alias("root"))
    for later in maps[1:]:
        step = later.select(F.col("id").alias("root"), F.col("to").alias("next"))
        root = root.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
    return steps.write(root, maps[0].count())


def _match_ids(steps: Steps, docs: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    name = "id"
    while name in docs.columns:
        name += "_"
    ids = steps.write(ids.select(F.col(key).alias(name)).distinct())
    return docs.join(bounded_broadcast(ids, ids.count()), F.col(key).eqNullSafe(F.col(name)), how)


def without_ids(steps: Steps, docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose key is among the (distinct) ``ids``.

    The ids are counted first and broadcast only while they are few.
    """
    return _match_ids(steps, docs, ids, key, "left_anti")


def with_ids(steps: Steps, docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key is among ``ids``, found in the same way."""
    return _match_ids(steps, docs, ids, key, "left_semi")
