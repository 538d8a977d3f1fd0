"""Evaluation against gold labels, drift, distributions and latencies, all as small aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnowry.functions.rules import LABELS


def matched(pred: DataFrame, gold: DataFrame, fields: Sequence[str] = LABELS) -> DataFrame:
    """(field, gold, pred) of rows with gold labels, by canonical_post_id or else post_id; labels as strings."""
    key = "canonical_post_id" if "canonical_post_id" in pred.columns else "post_id"
    if key not in gold.columns:
        raise ValueError(f"Gold set missing key column {key}")
    both = [f for f in fields if f in pred.columns and f in gold.columns]
    text = lambda f: F.coalesce(F.col(f).cast("string"), F.lit(""))
    p = pred.select(F.col(key).cast("string").alias("k"), *[text(f).alias(f + "_pred") for f in both])
    g = gold.select(F.col(key).cast("string").alias("k"), *[text(f).alias(f + "_gold") for f in both])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f + "_gold").alias("gold"), F.col(f + "_pred").alias("pred")) for f in both])
    return p.join(g, "k").select(F.explode(rows).alias("r")).select("r.*")


def confusion(m: DataFrame) -> DataFrame:
    """(field, gold, pred, n) for all pairs of labels of a field, zeros too."""
    n = m.groupBy("field", "gold", "pred").agg(F.count("*").alias("n"))
    names = n.select("field", F.col("gold").alias("x")).union(n.select("field", "pred")).distinct()
    grid = names.withColumnRenamed("x", "gold").join(names.withColumnRenamed("x", "pred"), "field")
    return grid.join(n, ["field", "gold", "pred"], "left").select("field", "gold", "pred", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def per_label(m: DataFrame) -> DataFrame:
    """(field, label, precision, recall, f1); an empty denominator gives 0."""
    rows = m.select("field", F.explode(F.array_distinct(F.array("gold", "pred"))).alias("label"), "gold", "pred")
    hit = (F.col("gold") == F.col("label")) & (F.col("pred") == F.col("label"))
    c = rows.groupBy("field", "label").agg(F.count_if(hit).alias("tp"), F.count_if(F.col("pred") == F.col("label")).alias("p"), F.count_if(F.col("gold") == F.col("label")).alias("g"))
    share = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    c = c.withColumns({"precision": share(F.col("tp"), F.col("p")), "recall": share(F.col("tp"), F.col("g"))})
    both = F.col("precision") + F.col("recall")
    return c.select("field", "label", "precision", "recall", F.when(both == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / both).alias("f1"))


def accuracy(m: DataFrame) -> DataFrame:
    """(field, n, accuracy, ci_low, ci_high): the Wald interval at 1.96 within [0, 1], null below 30 rows."""
    a = m.groupBy("field").agg(F.count("*").alias("n"), F.avg((F.col("gold") == F.col("pred")).cast("double")).alias("accuracy"))
    margin = 1.96 * F.sqrt(F.col("accuracy") * (1 - F.col("accuracy")) / F.col("n"))
    enough = F.col("n") >= 30
    return a.withColumns(
        {
            "ci_low": F.when(enough, F.greatest(F.lit(0.0), F.col("accuracy") - margin)),
            "ci_high": F.when(enough, F.least(F.lit(1.0), F.col("accuracy") + margin)),
        }
    )


def macro_f1(m: DataFrame) -> DataFrame:
    return per_label(m).groupBy("field").agg(F.avg("f1").alias("macro_f1"))


def drift(current: DataFrame, history: DataFrame) -> DataFrame:
    """(field, baseline_accuracy, current_accuracy, delta); fields without history are left out."""
    base = history.groupBy("field").agg(F.avg("accuracy").alias("baseline_accuracy"))
    return current.join(base, "field").select("field", "baseline_accuracy", F.col("accuracy").alias("current_accuracy"), (F.col("accuracy") - F.col("baseline_accuracy")).alias("delta"))


def distribution(df: DataFrame, fields: Sequence[str] = LABELS) -> DataFrame:
    """(field, label, n, total, half_width) of all label columns in one pass."""
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("label")) for f in fields])
    c = df.select(F.explode(rows).alias("r")).select("r.*").groupBy("field", "label").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("field"))
    p = F.col("n") / F.col("total")
    return c.withColumn("total", total).withColumn("half_width", 1.96 * F.sqrt(p * (1 - p) / F.col("total")))


def latency(df: DataFrame, value: str = "latency") -> DataFrame:
    """One row: n, mean, and the value at place max(1, floor(0.95 n)) in ascending order.

    Values are counted first, so the ranks run over distinct values in ranges, not over all rows in one task.
    """
    c = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n"))
    bits = F.floor(F.log2(F.greatest(F.abs("v"), F.lit(1e-300)))) * F.signum("v")
    c = c.withColumn("b", bits)
    per = c.groupBy("b").agg(F.sum("n").alias("bn"), F.sum(F.col("v") * F.col("n")).alias("bs"))
    whole = Window.partitionBy()
    per = per.select("b", (F.sum("bn").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bn")).alias("before"), F.sum("bn").over(whole).alias("total"), F.sum("bs").over(whole).alias("sum"))
    upto = F.sum("n").over(Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    ranked = c.join(F.broadcast(per), "b").withColumn("upto", upto)  # one row per power of two
    k = F.greatest(F.lit(1), F.floor(F.lit(0.95) * F.col("total")))
    return ranked.filter((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k)).select(
        F.col("total").cast("long").alias("n"), (F.col("sum") / F.col("total")).alias("mean"), F.col("v").alias("p95")
    )


def resume(df: DataFrame, done: DataFrame, key: str = "canonical_post_id") -> tuple[DataFrame, DataFrame]:
    """(rows that the checkpoint has, rows still to do); blank labels count as done."""
    ids = done.select(F.col(key).alias("__k")).distinct()
    on = df[key] == F.col("__k")
    return df.join(ids, on, "left_semi"), df.join(ids, on, "left_anti")
