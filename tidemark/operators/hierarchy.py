"""Parent-child category tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import work_path


def category_roots(categories: DataFrame) -> DataFrame:
    """Root and depth of each category, however deep the tree is.

    ``resolved`` is false when a parent is missing or the chain runs into a
    cycle; root and depth are NULL then. Each round doubles the length of the
    jumps, so the rounds are the logarithm of the number of categories; a jump
    that is still open after them has gone round a cycle. The jumps are stored
    between the rounds.
    """
    spark = categories.sparkSession
    edges = categories.where(F.col("category_id").isNotNull()).select(
        F.col("category_id").alias("_id"), F.col("parent_category_id").alias("_up")
    ).distinct()
    known = edges.select(F.col("_id").alias("_up"), F.lit(True).alias("_known")).distinct()
    is_root, found = F.col("_up").isNull(), F.col("_known").isNotNull()
    jumps = edges.join(known, "_up", "left").select(
        "_id",
        F.when(found, F.col("_up")).otherwise(F.col("_id")).alias("_at"),
        F.when(found, 1).otherwise(0).cast("bigint").alias("_steps"),
        F.when(is_root, "root").when(found, "open").otherwise("lost").alias("_state"),
    )

    def stored(df: DataFrame) -> DataFrame:
        path = work_path(spark, "category-jumps")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    jumps = stored(jumps)
    total, still_open = jumps.agg(F.count("*"), F.count_if(F.col("_state") == "open")).first()
    reach = 1
    while still_open and reach < total:
        ahead = jumps.select(F.col("_id").alias("_at"), F.col("_at").alias("_to"), F.col("_steps").alias("_more"),
                             F.col("_state").alias("_then"))
        moving = jumps.where(F.col("_state") == "open").join(ahead, "_at").select(
            "_id", F.col("_to").alias("_at"), (F.col("_steps") + F.col("_more")).alias("_steps"),
            F.col("_then").alias("_state"),
        )
        jumps = stored(jumps.where(F.col("_state") != "open").unionByName(moving))
        still_open = jumps.where(F.col("_state") == "open").count()
        reach *= 2
    resolved = F.coalesce(F.col("_state") == "root", F.lit(False))
    return categories.join(jumps, F.col("category_id") == F.col("_id"), "left").select(
        *[categories[c] for c in categories.columns],
        F.when(resolved, F.col("_at")).alias("root_category_id"),
        F.when(resolved, F.col("_steps") + 1).cast("int").alias("depth"),
        resolved.alias("resolved"),
    )
