import random

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from winnowry.llm import sentencepiece_bpe


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    text = lambda n: " ".join(f"w{rng.randrange(9000)}" for _ in range(n))
    clean = [text(80) for _ in range(10)]
    item = text(30)
    block = "\n".join(text(6) for _ in range(3))
    rows = [(k, t) for k, t in enumerate(clean)]
    rows += [(20, "again and again " * 40), (21, clean[2]), (22, clean[3] + " " + item), (23, text(20) + "\n" + block), (24, text(20) + "\n" + block), (25, block), (26, None), (27, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == {*range(10), 23, 24, 26, 27}
    assert "\n" not in out[24]["text"] and out[24]["n_chars"] == len(out[24]["text"])
    v = sentencepiece_bpe.vocabulary()
    assert all(r["token_ids"] == v.library.encode(r["text"]) for r in out.values() if r["text"] is not None)
    assert all(r["exact"] is (None if r["text"] is None else True) for r in out.values())
    extra = docs.withColumn("extra", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, extra, str(tmp_path)).columns == extra.columns
        assert stage(spark, extra.limit(0), str(tmp_path)).count() == 0


def test_registered():
    known = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in known) == 1
    assert "pipeline" in known
