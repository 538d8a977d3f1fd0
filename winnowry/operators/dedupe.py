"""Near-duplicate posts: blocking, staged similarity, clusters, canonical rows.

Equal texts and shared URLs merge by themselves, so they become stars to the least row of their group. Other pairs come
from shared domains and tokens; ``pairs`` makes and scores them by blocks of posts, with lossless bounds.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnowry.functions import text as T
from winnowry.operators.components import connected_components
from winnowry.operators.pairs import Posts, Rule, scored, scored_all, scored_given, shared_keys
from winnowry.session import cut

BUCKET = (2, 100)
MIN_TOKEN = 4
#: Tokens of more posts than a bucket holds that are broadcast, the most common first.
HOT = 20_000


@dataclass(frozen=True)
class DedupeConfig:
    enabled: bool = True
    similarity_threshold: float = 0.5
    soft_similarity_threshold: float = 0.35
    cross_subreddit: bool = True
    canonical_policy: str = "earliest"
    exact_entities: bool = False
    #: The least and the most posts of a token that makes candidates; None: any number.
    bucket: tuple[int, int] | None = None


def with_index(df: DataFrame, name: str = "idx") -> DataFrame:
    """``df`` with consecutive row numbers in its order: numbers within partitions plus offsets from one count of each."""
    raw = df.withColumn("__m", F.monotonically_increasing_id())
    part = F.shiftright("__m", 33)
    counts = sorted(raw.groupBy(part.alias("p")).count().collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    starts = F.create_map(*[F.lit(x).cast("long") for o in offsets for x in o]) if offsets else F.create_map(F.lit(0).cast("long"), F.lit(0).cast("long"))
    return raw.withColumn(name, starts[part] + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__m")


def with_post_id(df: DataFrame) -> DataFrame:
    """``df`` with ``idx`` and a ``post_id``: its own, else its url, else its row number."""
    df = with_index(df)
    if "post_id" in df.columns:
        return df.withColumn("post_id", F.col("post_id").cast("string"))
    if "url" in df.columns:
        return df.withColumn("post_id", F.coalesce(F.col("url").cast("string"), F.lit("")))
    return df.withColumn("post_id", F.concat(F.lit("row_"), F.col("idx").cast("string")))


def normalised(posts: DataFrame, exact: bool = False) -> DataFrame:
    """(idx, post_id, norm, urls, subreddit, created, body_length) of posts with ``idx`` and ``post_id``."""
    col = lambda n, d="": F.coalesce(F.col(n).cast("string"), F.lit(d)) if n in posts.columns else F.lit(d)
    created = F.coalesce(F.col("created_utc").cast("double"), F.lit(float("inf"))) if "created_utc" in posts.columns else F.lit(float("inf"))
    whole = T.post_text(col("title"), col("body"))
    return posts.select(
        "idx", "post_id",
        T.normalise(whole, exact).alias("norm"), T.clean_urls(whole).alias("urls"),
        T.strip_ends(col("subreddit")).alias("subreddit"), created.alias("created"), F.length(col("body")).alias("body_length"),
    )


def _star(df: DataFrame, key: str) -> DataFrame:
    """Edges from each row to the least row with the same key."""
    least = F.min("idx").over(Window.partitionBy(key))
    return df.select("idx", least.alias("to")).filter("idx <> to").select(F.col("to").alias("i"), F.col("idx").alias("j")).distinct()


def block_text(n: DataFrame) -> DataFrame:
    return _star(n, "norm")


def block_url(n: DataFrame) -> DataFrame:
    return _star(n.select("idx", F.explode(F.array_distinct("urls")).alias("url")), "url")


def domain_pairs(n: DataFrame) -> DataFrame:
    """All pairs that share the domain of a URL, each once; there is no limit to a bucket."""
    posts = Posts(n, texts=False)
    return shared_keys(posts, domain_keys(posts.df), counted=False)


def token_rows(n: DataFrame) -> DataFrame:
    return n.select("idx", F.explode(F.array_distinct(T.words(F.col("norm")))).alias("token"))


def domain_keys(posts: DataFrame) -> DataFrame:
    """(key, pos, idx): posts by the domains that two or more have; keys are below 0."""
    rows = posts.select("pos", "idx", F.explode("domains").alias("d"))
    known = rows.groupBy("d").count().filter("count > 1").sortWithinPartitions("d").select("d", (-1 - F.monotonically_increasing_id()).alias("key"))
    return rows.join(known, "d").select("key", "pos", "idx")


def token_keys(posts: DataFrame, bucket: tuple[int, int] = BUCKET) -> DataFrame:
    """(key, pos, idx): posts by tokens of more than 3 characters that ``bucket`` posts have; keys are 0 or more.

    The HOT most common tokens over the bucket are left out by a broadcast, so that few rows are shuffled.
    """
    rows = posts.select("pos", "idx", F.explode(F.array_distinct(T.words(F.col("norm")))).alias("token")).filter(F.length("token") >= MIN_TOKEN)
    hot = rows.groupBy("token").count().filter(F.col("count") > bucket[1]).orderBy(F.desc("count"), "token").limit(HOT).select("token")
    lists = rows.join(F.broadcast(hot), "token", "left_anti").groupBy("token").agg(F.collect_list(F.struct("pos", "idx")).alias("l"))
    lists = lists.filter(F.size("l").between(*bucket)).sortWithinPartitions("token").withColumn("key", F.monotonically_increasing_id())
    return lists.select("key", F.explode("l").alias("p")).select("key", "p.pos", "p.idx")


def token_pairs(n: DataFrame) -> DataFrame:
    """(i, j, r): pairs that share r tokens of more than 3 characters found in 2 to 100 posts."""
    posts = Posts(n)
    return shared_keys(posts, token_keys(posts.df))


def candidate_pairs(n: DataFrame) -> DataFrame:
    """(i, j) of all pairs to compare beside the stars, with token blocks of 2 to 100 posts."""
    posts = Posts(n)
    return shared_keys(posts, token_keys(posts.df).unionByName(domain_keys(posts.df)), counted=False)


def _rule(c: DedupeConfig) -> Rule:
    return Rule(c.similarity_threshold, c.soft_similarity_threshold, c.cross_subreddit, MIN_TOKEN)


def scored_pairs(n: DataFrame, pairs: DataFrame, config: DedupeConfig = DedupeConfig()) -> DataFrame:
    """(i, j, similarity, soft) of the given pairs that reach their threshold: exact values, others never computed."""
    return scored_given(Posts(n, measured=True), pairs, replace(_rule(config), least_token=0))


def similar_pairs(n: DataFrame, config: DedupeConfig = DedupeConfig()) -> DataFrame:
    """(i, j, similarity, soft) of the pairs that share a domain or a token of more than 3 characters and reach their threshold.

    With ``config.bucket``, only tokens count that so many posts have. Without, all blocks of posts are compared with
    each other: the time is quadratic, memory and disk aren't.
    """
    posts = Posts(n, measured=True)
    if config.bucket is None:
        return scored_all(posts, _rule(config))
    return scored(posts, token_keys(posts.df, config.bucket).unionByName(domain_keys(posts.df)), replace(_rule(config), least_token=0))


def duplicate_edges(n: DataFrame, config: DedupeConfig = DedupeConfig()) -> DataFrame:
    """(i, j) of rows to merge."""
    parts = [block_text(n), block_url(n), similar_pairs(n, config).select("i", "j")]
    return reduce(DataFrame.union, parts).distinct()


def clusters(n: DataFrame, config: DedupeConfig = DedupeConfig()) -> DataFrame:
    """``n`` with ``component``: the least idx of its cluster."""
    if not config.enabled:
        return n.withColumn("component", F.col("idx"))
    found = connected_components(duplicate_edges(n, config), "i", "j").withColumnRenamed("id", "idx")
    return n.join(found, "idx", "left").withColumn("component", F.coalesce("component", "idx"))


def canonical(clustered: DataFrame, policy: str = "earliest") -> DataFrame:
    """One row per cluster: (component, idx, canonical_post_id, members, subreddits, normalized_text)."""
    if policy not in ("earliest", "longest"):
        raise ValueError(f"no such policy: {policy}")
    length = -F.col("body_length")
    order = F.struct(length, "created", "post_id", "idx") if policy == "longest" else F.struct("created", length, "post_id", "idx")
    best = F.min_by(F.struct("idx", "post_id", "norm"), order)
    members = F.array_sort(F.collect_list(F.struct("idx", "post_id")))
    out = clustered.groupBy("component").agg(best.alias("b"), members.alias("m"), F.array_sort(F.collect_set(F.nullif(F.col("subreddit"), F.lit("")))).alias("subreddits"))
    return out.select("component", "b.idx", F.col("b.post_id").alias("canonical_post_id"), F.col("m.post_id").alias("members"), "subreddits", F.col("b.norm").alias("normalized_text"))


@dataclass
class Deduped:
    """The canonical rows with all columns of the input and four more, the mapping, and the clusters."""

    rows: DataFrame
    mapping: DataFrame
    clusters: DataFrame
    total: int


def deduplicate(df: DataFrame, config: DedupeConfig = DedupeConfig()) -> Deduped:
    posts = cut(with_post_id(df), "dedupe-posts")
    n = cut(normalised(posts, config.exact_entities), "dedupe-normalised")
    chosen = cut(canonical(clusters(n, config), config.canonical_policy), "dedupe-canonical")
    keep = posts.drop(*(set(posts.columns) & {"canonical_post_id", "duplicate_post_ids", "duplicate_subreddits", "normalized_text"}))
    if "post_id" not in df.columns:
        keep = keep.drop("post_id")
    rows = keep.join(
        chosen.select("idx", "component", "canonical_post_id", F.to_json("members").alias("duplicate_post_ids"), F.to_json("subreddits").alias("duplicate_subreddits"), "normalized_text"),
        "idx",
    )
    mapping = chosen.select(F.explode("members").alias("post_id"), "canonical_post_id")
    found = chosen.select("component", "canonical_post_id", "members", "subreddits")
    return Deduped(rows.withColumnRenamed("component", "cluster_order").drop("idx"), mapping, found, posts.count())


def report(found: DataFrame) -> DataFrame:
    """(canonical_post_id, member_post_ids, subreddits) joined by bars, by id."""
    return found.select("canonical_post_id", F.array_join("members", "|").alias("member_post_ids"), F.array_join(F.array_sort("subreddits"), "|").alias("subreddits")).orderBy("canonical_post_id")


def drop_duplicate_urls(df: DataFrame, key: str = "url", order: str = "idx") -> DataFrame:
    """The first row of each URL by ``order``; nulls count as one URL."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("__n", first).filter("__n = 1").drop("__n")
