"""Labels for a stream of posts: the rules are plain expressions, so they run on streams as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame

from winnowry.plans.pipeline import label


def label_stream(posts: DataFrame, path: str, checkpoint: str):
    """Starts a query that appends labelled posts to Parquet files under ``path``."""
    return label(posts).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
