"""CSV, Parquet and JSON sources and sinks with explicit schemas."""

from __future__ import annotations

import json
import logging
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("winnowry")

_STRINGS = ("title", "body", "subreddit", "url", "author", "link_flair_text", "search_query", "post_id")
POST = T.StructType(
    [T.StructField(n, T.StringType()) for n in _STRINGS[:7]]
    + [T.StructField(n, T.LongType()) for n in ("score", "num_comments", "total_awards_received", "gilded")]
    + [T.StructField(n, T.DoubleType()) for n in ("upvote_ratio", "created_utc")]
    + [T.StructField(n, T.BooleanType()) for n in ("is_original_content", "edited")]
)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV file with header; columns that POST doesn't know are strings; null strings become ''.

    A missing file raises FileNotFoundError.
    """
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(path)
    kinds = {f.name: f.dataType for f in (schema or POST)}
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    names = csv_header(spark, path)
    strings = read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(path)
    return strings.select(*[F.coalesce(c, F.lit("")).alias(n) if isinstance(k := kinds.get(n, T.StringType()), T.StringType) else F.expr(f"try_cast(`{n}` AS {k.simpleString()})").alias(n) for n in names for c in [F.col(f"`{n}`")]])


def read_strings(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with all columns as strings and no nulls: gold labels, checkpoints."""
    return read_csv(spark, path, T.StructType([]))


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with header; arrays and maps as JSON."""
    flat = [F.to_json(c).alias(c) if isinstance(t, (T.ArrayType, T.MapType, T.StructType)) else F.col(c) for c, t in ((f.name, f.dataType) for f in df.schema)]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def plain(x: object) -> object:
    """Paths as strings, all through nested containers."""
    if isinstance(x, Path):
        return str(x)
    if isinstance(x, dict):
        return {k: plain(v) for k, v in x.items()}
    if isinstance(x, (list, tuple)):
        return [plain(v) for v in x]
    return x


def write_json(x: object, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(plain(x), ensure_ascii=False, indent=2), encoding="utf-8")


def read_history(path: str | None) -> list[dict]:
    """The evaluation of one earlier report; a file that can't be read is logged and counts as none."""
    if not path or not os.path.exists(path):
        return []
    try:
        return [json.loads(Path(path).read_text(encoding="utf-8")).get("evaluation", {})]
    except (OSError, ValueError) as error:
        log.warning("history at %s can't be read: %s", path, error)
        return []


def write_mapping(mapping: DataFrame, path: str) -> None:
    """(post_id, canonical_post_id) as Parquet, for any size."""
    mapping.write.mode("overwrite").parquet(path)


def structured_log(level: int, **payload: object) -> None:
    log.log(level, json.dumps(payload, sort_keys=True, default=str))
