"""Posts by search phrases: a Python data source with one partition per phrase and an injected client."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from winnowry.operators.dedupe import drop_duplicate_urls, with_index
from winnowry.operators.split import sample_head
from winnowry.sources.files import POST

PHRASES = tuple(
    sorted(
        (
            "why isn't there|waste time doing|wish there was an app|tool to help with|tired of manually|there must be a better way"
            "|struggling with|software to manage|software solution for|recommend software for|need help organizing|need an app that"
            "|looking for solution to|looking for software that|looking for program to|how to automate|frustrated with current app"
            "|does software exist for|can't find software|better way to|app to track|app recommendation for|anyone know tool for"
            "|annoying problem with|alternative to"
        ).split("|")
    )
)


def require_env(name: str) -> str:
    value = os.environ.get(name)
    if not value:
        raise RuntimeError(f"Environment variable {name} is not set")
    return value


def credentials(*names: str) -> dict[str, str]:
    """Options for a client from the environment."""
    return {n: require_env(n) for n in names}


class _Phrase(InputPartition):
    def __init__(self, phrase: str):
        super().__init__(0)
        self.phrase = phrase


def search_source(client: Callable[[str, int], list[dict]], name: str = "post_search") -> type[DataSource]:
    """A data source class: ``client(phrase, limit)`` gives the newest posts as dictionaries, in the workers."""

    class Reader(DataSourceReader):
        def __init__(self, options: dict, schema):
            self.phrases = (options.get("phrases") or "|".join(PHRASES)).split("|")
            self.limit = int(options.get("limit", "50"))
            self.names = schema.names

        def partitions(self) -> list[InputPartition]:
            return [_Phrase(p) for p in self.phrases]

        def read(self, partition: _Phrase) -> Iterator[tuple]:
            for post in client(partition.phrase, self.limit):
                post = post | {"search_query": partition.phrase}
                yield tuple(post.get(n) for n in self.names)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self):
            return POST

        def reader(self, schema):
            return Reader(self.options, schema)

    return Source


def fetch(spark: SparkSession, client: Callable[[str, int], list[dict]], limit: int = 50, phrases: tuple[str, ...] = PHRASES) -> DataFrame:
    spark.dataSource.register(search_source(client))
    return spark.read.format("post_search").option("phrases", "|".join(phrases)).option("limit", limit).load()


def matching(posts: DataFrame, phrases: tuple[str, ...] = PHRASES, text: str = "body") -> DataFrame:
    """The same over a table: each post once per phrase in its text, as ``search_query``."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    found = F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(low, p))
    return posts.withColumn("search_query", F.explode(found))


def ingest(posts: DataFrame, n: int = 500, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(posts with distinct URLs, the first of each; a seeded sample of n for labelling)."""
    first = drop_duplicate_urls(with_index(posts))
    return first.drop("idx"), sample_head(first, "url", n, seed).drop("idx")
