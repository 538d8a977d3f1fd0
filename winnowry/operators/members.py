"""Members that ask a model: batches in Python workers, with retries, a rate limit for each task, errors as values."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.functions.labels import parse_answer
from winnowry.functions.rules import FIELDS
from winnowry.operators.ensemble import member

PROMPT_VERSION = "2.0.0"
DEFAULT = {"direct": 0.8, "reasoning": 0.9}
PROMPTS = {
    "direct": "Label the post. Answer with JSON only: is_problem, is_software_solvable and is_external as 0 or 1, confidence from 0 to 1, and a short plain rationale.",
    "reasoning": "Consider step by step if the post has a problem, if software alone solves it, and if others are needed. Then answer with JSON only: is_problem, is_software_solvable, is_external, confidence, rationale.",
}


class RateLimiter:
    """At most ``per_minute`` slots a minute, evenly spaced; 0 sets no limit. A job of k tasks gives each its share."""

    def __init__(self, per_minute: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap = 60.0 / per_minute if per_minute > 0 else 0.0
        self.clock, self.sleep, self.next = clock, sleep, float("-inf")

    def acquire(self) -> None:
        if self.gap:
            now = self.clock()
            if now < self.next:
                self.sleep(self.next - now)
            self.next = max(now, self.next) + self.gap

    def __enter__(self) -> RateLimiter:
        self.acquire()
        return self

    def __exit__(self, *_: object) -> None:
        return None


def with_retries(call: Callable[[str], str], text: str, attempts: int = 3, first: float = 1.0, most: float = 8.0, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None]:
    """(answer, None) or (None, error) after the last attempt; waits 1, 2, 4, ... seconds, at most 8, in between."""
    wait = first
    for k in range(attempts):
        try:
            return call(text), None
        except Exception as error:  # a failure is a value of the row
            if k == attempts - 1:
                return None, f"classification_failed: {error}"
            sleep(wait)
            wait = min(wait * 2, most)
    return None, "classification_failed"


def map_texts(df: DataFrame, call: Callable[[str], str], per_minute: float = 0.0, tasks: int | None = None, attempts: int = 3) -> DataFrame:
    """(key, value, error) of rows (key, text). ``call`` runs once per row in the workers; ``tasks`` share the limit."""
    if tasks:
        df = df.repartition(tasks)
    share = per_minute / tasks if tasks and per_minute > 0 else per_minute

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = RateLimiter(share)

        def limited(text: str) -> str:
            with limit:
                return call(text)

        for b in batches:
            done = [with_retries(limited, t or "", attempts) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([v for v, _ in done], pa.string()), pa.array([e for _, e in done], pa.string())], ["key", "value", "error"])

    return df.select("key", "text").mapInArrow(run, "key string, value string, error string")


def answer_member(name: str, content: str = "value"):
    """The struct of a member from the column of its answers; null where it failed or isn't JSON."""
    a = parse_answer(F.col(content), DEFAULT.get(name, 0.8))
    fields = {f: a[f] for f in FIELDS}
    return F.when(F.col(content).isNotNull() & a["error"].isNull(), member(name, fields, a["confidence"], a["rationale"]))


def dead_letters(df: DataFrame, key: str = "canonical_post_id") -> DataFrame:
    """(key, error) of rows whose labelling failed."""
    return df.filter("error IS NOT NULL").select(key, "error")
