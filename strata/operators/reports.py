"""Small summary reports over candidates / enriched rows.

Every report is a DataFrame (aggregated on the executors with map-side
partial aggregation); callers ``show`` or write it. Top-k reports carry a
total order (count, then the key) so they are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F


def signal_distribution(df: DataFrame) -> DataFrame:
    """Rows per ``comment_signal``."""
    return df.groupBy("comment_signal").agg(F.count(F.lit(1)).alias("count"))


def top_editors(df: DataFrame, n: int = 15, drop_null: bool = False) -> DataFrame:
    """Most frequent ``cs_created_by`` values. The Spark job kept the NULL
    group and showed 15; the local script dropped NULLs and showed 10."""
    src = df.filter(F.col("cs_created_by").isNotNull()) if drop_null else df
    return (src.groupBy("cs_created_by").agg(F.count(F.lit(1)).alias("count"))
               .orderBy(F.col("count").desc(), F.col("cs_created_by").asc_nulls_first())
               .limit(n))


def strong_comments(df: DataFrame, n: int = 20) -> DataFrame:
    """Up to ``n`` distinct comments of ``strong`` rows, in text order."""
    return (df.filter(F.col("comment_signal") == "strong")
              .select("cs_comment").distinct()
              .orderBy(F.col("cs_comment").asc_nulls_first())
              .limit(n))


def tag_key_frequency(df: DataFrame, n: int = 20, tags_col: str = "good_tags") -> DataFrame:
    """Top ``n`` tag keys of the last visible version, per object type.

    ``(type, key)`` counts are aggregated partially before the shuffle, so a
    key present on every object costs one row per map task; the ranking
    runs on the aggregated counts only.
    """
    counts = (df.select("type", F.explode(F.map_keys(F.col(tags_col))).alias("key"))
                .groupBy("type", "key").agg(F.count(F.lit(1)).alias("count")))
    w = Window.partitionBy("type").orderBy(F.col("count").desc(), F.col("key").asc())
    return (counts.withColumn("rank", F.row_number().over(w))
                  .filter(F.col("rank") <= n))


def run_metrics(df: DataFrame, changeset_col: str = "last_changeset") -> DataFrame:
    """One row: total rows, rows per type and distinct changesets."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("type") == "node").alias("nodes"),
        F.count_if(F.col("type") == "way").alias("ways"),
        F.count_distinct(F.col(changeset_col)).alias("unique_changesets"),
    )


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach row counters computed during the next action on ``df``, so a
    job gets its metrics from the write itself instead of extra passes."""
    obs = Observation(name)
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("type") == "node").alias("nodes"),
        F.count_if(F.col("type") == "way").alias("ways"),
    )
    return observed, obs


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def preview(df: DataFrame, n: int = 5, order_by: str = "id") -> DataFrame:
    """The first ``n`` rows of each object type, by ``order_by``."""
    w = Window.partitionBy("type").orderBy(F.col(order_by).asc())
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") <= n).drop("_rn"))
