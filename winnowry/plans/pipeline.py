"""The whole run: duplicates, labels, splits, evaluation, report."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.functions import rules
from winnowry.functions.labels import cache_key
from winnowry.functions.text import post_text
from winnowry.operators import dedupe, evaluate, split
from winnowry.operators.cache import ResponseCache
from winnowry.operators.ensemble import Registry, agreement, ensemble
from winnowry.operators.members import PROMPT_VERSION, answer_member, map_texts
from winnowry.plans.config import RunConfig
from winnowry.session import cut
from winnowry.sources.files import read_history, read_strings, write_json


@dataclass
class Run:
    rows: DataFrame
    mapping: DataFrame
    clusters: DataFrame
    dead_letters: DataFrame
    report: dict


def _text(df: DataFrame) -> DataFrame:
    col = lambda n: F.col(n) if n in df.columns else F.lit("")
    return df.withColumn("text", post_text(col("title"), col("body")))


def label(df: DataFrame) -> DataFrame:
    """The nine fields of the rules over title and body; one pass, no shuffle."""
    return rules.classify(_text(df), F.col("text")).drop("text")


def classify(df: DataFrame, config: RunConfig | None = None) -> dedupe.Deduped:
    """Duplicates, rules and splits: the deterministic run."""
    c = config or RunConfig()
    d = dedupe.deduplicate(df, c.dedupe)
    d.rows = split.assign_splits(label(d.rows), c.split)
    return d


def model_members(config: RunConfig, call: Callable[[str, str], str]) -> Registry:
    """Members whose answers come from ``call(member, text)``, through the cache."""

    def make(name: str):
        def add(df: DataFrame, to: str) -> DataFrame:
            cache = ResponseCache(df.sparkSession, config.cache)
            ask = lambda rows: map_texts(rows, lambda t: call(name, t), config.parallel.rate_limit, config.parallel.max_workers)
            key = cache_key(F.col("text"), config.model.name, f"{PROMPT_VERSION}:{name}")
            out = cache.call(df, key, ask)
            return out.withColumn(to, answer_member(name)).withColumn(f"hit_{name}", F.col("hit")).drop("key", "value", "hit")

        return add

    return {name: make(name) for name in ("direct", "reasoning")}


def run(df: DataFrame, config: RunConfig | None = None, registry: Registry | None = None) -> Run:
    """Everything: rows with labels and split, mapping, clusters, dead letters, and the report as a dictionary."""
    c = config or RunConfig()
    d = dedupe.deduplicate(df, c.dedupe)
    began = time.time()
    rows = d.rows
    done = None
    if c.resume_from:
        old = read_strings(df.sparkSession, c.resume_from)
        done, rows = evaluate.resume(rows, old)
        fields = [f for f in rules.FIELDS if f in old.columns]
        old = old.dropDuplicates(["canonical_post_id"]).select("canonical_post_id", *[F.col(f).try_cast("double").alias(f) if f == "confidence" else F.col(f) for f in fields])
        done = done.join(old, "canonical_post_id", "left").withColumn("disagreement", F.lit(0.0))
    ruled = rules.classify(_text(rows), F.col("text"), "rules_")
    made = ensemble(ruled, c.ensemble, registry or {}).drop("text")
    bad = ~rules.valid()
    made = made.withColumn("error", F.when(bad, "classification_failed"))
    for f in rules.FIELDS:
        made = made.withColumn(f, F.when(F.col("error").isNull(), F.col(f)))
    if done is not None:
        made = made.unionByName(done, allowMissingColumns=True)
    made = cut(split.assign_splits(made, c.split), "run-rows")
    dead = made.filter("error IS NOT NULL").select("canonical_post_id", "error")
    hits = [h for h in made.columns if h.startswith("hit_")]
    evaluation, drifts = {}, {}
    if c.evaluation.enabled and c.evaluation.gold_set_path:
        m = evaluate.matched(made, read_strings(df.sparkSession, c.evaluation.gold_set_path)).persist()
        evaluation = metrics(m)
        drifts = drift_of(evaluation, read_history(c.report_path))
        m.unpersist()
    report = summary(made, d, evaluation, drifts, c, time.time() - began, hits)
    if c.report_path:
        write_json(report, c.report_path)
    return Run(made.drop("error", *hits), d.mapping, d.clusters, dead, report)


def metrics(m: DataFrame) -> dict:
    """The evaluation as a dictionary by field; its size depends on the number of labels alone."""
    out: dict = {}
    for r in evaluate.accuracy(m).join(evaluate.macro_f1(m), "field").collect():
        out[r["field"]] = {"accuracy": r["accuracy"], "macro_f1": r["macro_f1"], "per_label": {}, "confusion_matrix": {}}
        out["matches"] = r["n"]
        if r["ci_low"] is not None:
            out[r["field"]]["confidence_interval"] = (r["ci_low"], r["ci_high"])
    for r in evaluate.per_label(m).collect():
        out[r["field"]]["per_label"][r["label"]] = {k: r[k] for k in ("precision", "recall", "f1")}
    for r in evaluate.confusion(m).collect():
        out[r["field"]]["confusion_matrix"].setdefault(r["pred"], {})[r["gold"]] = r["n"]
    return out or {"matches": 0}


def drift_of(current: dict, history: list[dict]) -> dict:
    out = {}
    for f, now in current.items():
        old = [h[f]["accuracy"] for h in history if isinstance(h.get(f), dict) and "accuracy" in h[f]]
        if isinstance(now, dict) and old:
            base = sum(old) / len(old)
            out[f] = {"baseline_accuracy": base, "current_accuracy": now["accuracy"], "delta": now["accuracy"] - base}
    return out


def summary(rows: DataFrame, d: dedupe.Deduped, evaluation: dict, drifts: dict, c: RunConfig, seconds: float, hits: list[str] = ()) -> dict:
    """The report from small aggregates over the labelled rows."""
    labels: dict = {}
    for r in evaluate.distribution(rows.filter("error IS NULL")).orderBy("field", F.desc("n")).collect():
        x = labels.setdefault(r["field"], {"counts": {}, "total": r["total"], "confidence_interval": {}})
        x["counts"][r["label"]], x["confidence_interval"][r["label"]] = r["n"], r["half_width"]
    a = agreement(rows, c.ensemble.disagreement_threshold).first().asDict()
    count = lambda v: [F.coalesce(F.sum(sum((F.coalesce(F.col(h) == v, F.lit(False)).cast("long") for h in hits), F.lit(0))), F.lit(0))]
    n, dead, hit, miss = rows.agg(F.count("*"), F.count_if(F.col("error").isNotNull()), *count(True), *count(False)).first()
    return {
        "inputs": {"total_rows": d.total, "canonical_rows": n, "duplicates_removed": d.total - n},
        "label_distribution": labels,
        "cache": {"hits": hit, "misses": miss},
        "ensemble": {"mean_disagreement": a["mean_disagreement"], "stdev_disagreement": a["stdev_disagreement"], "count": a["count"], "buckets": {"high": a["high"], "low": a["low"]}},
        "evaluation": evaluation,
        "drift": drifts,
        "performance": {"total_rows": d.total, "total_time_seconds": seconds, "avg_latency_seconds": seconds / max(1, n), "cache_enabled": c.cache.enabled, "dead_letter_count": dead},
        "config": c.plain(),
    }


def high_disagreement(rows: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(canonical_post_id, disagreement) of rows at or above the threshold."""
    return rows.filter(F.col("disagreement") >= threshold).select("canonical_post_id", "disagreement")
