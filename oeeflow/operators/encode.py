"""Article grouping (C3, C4, D4) — the top-N list is a bounded table (N rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oeeflow.schema import OTHER_ARTICLE


def top_articles(df: DataFrame, n: int = 20, col: str = "article") -> DataFrame:
    """The ``n`` most frequent values (count desc, value asc on ties); NULL not counted."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)).limit(n))


def group_rare_articles(df: DataFrame, top: DataFrame | list[str], col: str = "article",
                        out: str = "article_group") -> DataFrame:
    """The article when it is in ``top``, else ``ALTRO`` (NULL included)."""
    if isinstance(top, list):
        if not top:
            return df.withColumn(out, F.lit(OTHER_ARTICLE))
        return df.withColumn(out, F.when(F.col(col).isin(top), F.col(col)).otherwise(F.lit(OTHER_ARTICLE)))
    t = top.select(F.col(col).alias("_top_article")).distinct()
    # N rows at most: safe to broadcast
    j = df.join(F.broadcast(t), F.col(col) == F.col("_top_article"), "left")
    return (j.withColumn(out, F.when(F.col("_top_article").isNotNull(), F.col(col))
                         .otherwise(F.lit(OTHER_ARTICLE))).drop("_top_article"))


def filter_known_articles(df: DataFrame, known: DataFrame | list[str], col: str = "article_group") -> DataFrame:
    """C4: keep rows whose (grouped) article is in the model's list (semi join)."""
    if isinstance(known, list):
        return df.filter(F.col(col).isin(known))
    k = known.select(F.col(known.columns[0]).alias(col)).distinct()
    return df.join(F.broadcast(k), col, "left_semi")
