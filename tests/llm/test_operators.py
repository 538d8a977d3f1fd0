"""Each operator against brute force, an exact round trip or held-out labels, and with odd input."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from winnowry.llm import (
    chat_format,
    decontaminate,
    line_dedup,
    maxent_lm,
    ngram_join,
    quality_rules,
    rans,
    sentencepiece_bpe,
    suffix_dedup,
    toxicity,
)

SCHEMA = "doc_id long, text string, gone string, rid long, n int, score double, r string, t string"


def words(rng, n, pool=4000):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def table(spark, texts, ids=None):
    """Documents with columns whose names the operators use inside."""
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "x", 1, 2, 0.5, None, None) for i, t in zip(ids, texts)], SCHEMA)


ODD = [None, "", " \n\t ", "one", "a b", "\n\n\n", "x " * 3000, "ä ö 漢字 🙂", "same text here now", "same text here now"]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD, [None, 1, 2, 3, 4, 5, 6, 7, 8, 8])


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def test_quality_rules(spark, odd, none):
    rng = random.Random(1)
    clean = " ".join(words(rng, 300))
    block = " ".join(words(rng, 12))
    texts = [clean, " ".join([block] * 9), "line of words\n" * 9, clean + "\n" + "tail " * 3]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(table(spark, texts)).collect()}
    assert [got[k]["keep"] for k in range(4)] == [True, False, False, True]
    for k, t in enumerate(texts):
        w = t.split()
        for n in quality_rules.LIMITS:
            seen, cover = set(), set()
            for i in range(len(w) - n + 1):
                g = tuple(w[i : i + n])
                if g in seen:
                    cover.update(range(i, i + n))
                seen.add(g)
            want = sum(len(w[i]) for i in cover) / sum(map(len, w))
            assert got[k][f"dup{n}_share"] == pytest.approx(want)
    assert quality_rules.quality_rules(odd).count() == len(ODD)
    kept = quality_rules.kept(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 1  # the run of x goes
    assert quality_rules.kept(none).count() == 0


def brute_passages(docs):
    """Words inside repeated windows of 50, and inside later occurrences, by document."""
    occ = defaultdict(list)
    for d, w in enumerate(docs):
        for i in range(len(w) - 49):
            occ[tuple(w[i : i + 50])].append((d, i))
    every, later = defaultdict(set), defaultdict(set)
    for places in occ.values():
        if len(places) > 1:
            for k, (d, i) in enumerate(sorted(places)):
                every[d].update(range(i, i + 50))
                if k:
                    later[d].update(range(i, i + 50))
    return every, later


def passages(df):
    rows = suffix_dedup.repeated_passages(df).collect()
    cover = lambda spans: {x for s in spans for x in range(s["start"], s["end"])}
    return {r["doc_id"]: cover(r["spans"]) for r in rows}, {r["doc_id"]: cover(r["drop"]) for r in rows if r["drop"]}


def test_suffix_dedup(spark, odd, none):
    rng = random.Random(2)
    p, q = words(rng, 60), words(rng, 49)
    docs = [words(rng, 200) for _ in range(12)]
    for k in (1, 4, 7):
        docs[k] = docs[k][:70] + p + docs[k][70:]
    for k in (2, 5):
        docs[k] = docs[k][:20] + q + docs[k][20:]
    docs += [docs[3], words(rng, 9000) + p + words(rng, 9000)]
    df = table(spark, [" ".join(w) for w in docs])
    assert passages(df) == brute_passages(docs)
    assert passages(df.union(df)) == brute_passages(docs)  # repeated rows are the same occurrence
    assert passages(odd) == ({6: set(range(3000))}, {6: set(range(1, 3000))})
    assert passages(none) == ({}, {})


def test_suffix_dedup_of_repeated_words(spark):
    """Runs of one word, as many different ones as have equal 16-bit codes among them, and lines said again and again."""
    rng = random.Random(20)
    docs = [[f"run{rng.randrange(10**9)}" for _ in range(8)] for _ in range(60)]
    docs = [[w for w in d for _ in range(rng.randrange(52, 60))] for d in docs]
    codes = [suffix_dedup.Words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)])).hash[0] >> np.uint64(48) for d in docs for w in set(d)]
    assert len(set(codes)) < len(codes)
    line = words(rng, 17)
    docs += [line * 9, words(rng, 30) + line * 4, words(rng, 30) + line * 4 + words(rng, 30)]
    assert passages(table(spark, [" ".join(w) for w in docs])) == brute_passages(docs)


def test_multikey_quicksort():
    m = np.random.default_rng(3).integers(0, 3, (700, 9)).astype(np.uint16)
    s = m[suffix_dedup.multikey_quicksort(m)]
    assert [tuple(x) for x in s] == sorted(map(tuple, m))


def test_chat_format(spark):
    rng = random.Random(4)
    rows = []
    for c in range(80):
        for k in range(rng.randrange(2, 7)):
            rows.append((c, k, ("user", "assistant")[k % 2], " ".join(words(rng, 8 if k % 2 == 0 else 60))))
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat_format.transcripts(conv)
    held = F.col("conv_id") % 2 == 0
    got = chat_format.chat_format(made.filter(held), chat_format.train(made.filter(~held))).collect()
    want = defaultdict(list)
    for c, _, role, _ in rows:
        want[c].append(role)
    assert np.mean([r["roles"] == want[r["conv_id"]] for r in got]) > 0.9
    hmm = chat_format.train(made)
    strange = spark.createDataFrame([(None, None), (1, ""), (2, "\n \n"), (3, "User: hi\n\nBot: yes\nmore\n\nNote: x")], "conv_id long, text string")
    out = {r["conv_id"]: r for r in chat_format.chat_format(strange, hmm).collect()}
    assert out[None]["n_turns"] == out[1]["n_turns"] == out[2]["n_turns"] == 0 and out[1]["rendered"] == ""
    assert out[3]["rendered"].startswith("<|user|>\nhi\n<|end|>\n<|assistant|>\nyes\nmore")
    gaps = spark.createDataFrame([(None, None, None, None), (None, 1, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")], conv.schema)
    assert sorted((r["conv_id"] or 0, r["text"][-1:]) for r in chat_format.transcripts(gaps).collect() if r["text"])[-1] == (1, "a")
    assert chat_format.transcripts(gaps).count() == 3
    clash = conv.withColumns({c: F.lit("x") for c in ("t", "raw", "roles", "turns", "alone", "p", "n_turns")})
    same = lambda c: sorted(map(str, chat_format.chat_format(chat_format.transcripts(c), hmm).collect()))
    assert same(clash) == same(conv)
    long = chat_format.chat_format(spark.createDataFrame([(1, "User: " + "x " * 200_000 + "\n\nBot: " + "y\n" * 20_000)], "conv_id long, text string"), hmm).first()
    assert len(long["rendered"]) > 430_000 and set(long["roles"]) <= {"user", "assistant"}
    assert chat_format.chat_format(chat_format.transcripts(conv.limit(0)), chat_format.train(made.limit(0))).count() == 0


def test_viterbi_is_best_path():
    rng = np.random.default_rng(5)
    hmm = chat_format.Hmm(rng.integers(0, 9, 6).astype(float), rng.integers(0, 9, (6, 6)).astype(float), [rng.integers(0, 9, (6, n)).astype(float) for n in chat_format.SIZES])
    seqs = [np.stack([rng.integers(0, n, k) for n in chat_format.SIZES], 1) for k in (4, 1, 3)] + [np.zeros((0, 4), np.int64)]
    import itertools

    for s, path in zip(seqs, hmm.viterbi(seqs)):
        def score(p):
            e = sum(hmm.emit[f][p[t], s[t, f]] for t in range(len(s)) for f in range(4))
            return hmm.start[p[0]] + sum(hmm.move[a, b] for a, b in zip(p, p[1:])) + e if len(s) else 0
        best = max((score(p) for p in itertools.product(range(6), repeat=len(s))), default=0)
        assert score(tuple(path)) == pytest.approx(best)


def test_decontaminate(spark, odd, none, monkeypatch):
    rng = random.Random(6)
    items = [words(rng, n) for n in (2, 5, 11, 20, 33, 60, 150)]
    texts = []
    for it in items:
        w = words(rng, rng.randrange(50, 3000))
        texts += [" ".join(w[:40] + it + w[40:]), " ".join(w)]
    bench = spark.createDataFrame([(k, " ".join(it)) for k, it in enumerate(items)] + [(90, ""), (91, None), (0, " ".join(items[0]))], "item_id long, text string")
    sh = lambda w: {tuple(w)} if len(w) < 3 else {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    want = {}
    for d, t in enumerate(texts):
        for k, it in enumerate(items):
            share = len(sh(it) & sh(t.split())) / len(sh(it))
            if share >= decontaminate.THRESHOLD:
                want[d, k] = share
    docs = table(spark, texts)
    got = {(r["doc_id"], r["item_id"]): r["containment"] for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == pytest.approx(want) and len(want) >= 6
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 1000)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()} == set(want)
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and left.count() == len(texts) - len({d for d, _ in want})
    assert decontaminate.clean(odd, bench).count() == len(ODD)
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(texts)
    assert decontaminate.contaminated(none, bench).count() == 0 == decontaminate.contaminated(docs, bench.limit(0)).count()


def test_sentencepiece(spark, odd, none):
    v = sentencepiece_bpe.vocabulary()
    rng = random.Random(7)
    texts = [t for t in ODD if t is not None] + ["".join(rng.choice("ab▁ \n\té漢🙂thein<s>\0") for _ in range(rng.randrange(60))) for _ in range(800)]
    for t in texts:
        want = v.library.encode(t)
        assert v.encode(t).tolist() == want
    v.words.reset()
    for t, ids in zip(texts, v.encode_many(texts)):
        assert ids.tolist() == v.library.encode(t)
        if "▁" not in t:
            assert v.decode(v.encode(t)) == t.encode()
    rows = sentencepiece_bpe.encoded(odd).collect()
    assert [r["exact"] for r in rows] == [None] + [True] * (len(ODD) - 1)
    back = odd.select("text", sentencepiece_bpe.decode(sentencepiece_bpe.encode(F.col("text"))).alias("b")).collect()
    assert all(r["text"] == r["b"] for r in back)
    assert sentencepiece_bpe.encoded(none).count() == 0


def test_toxicity(spark, odd, none):
    rng = random.Random(8)
    bad = ["nasty", "awful"]
    texts, toxic = [], []
    for k in range(400):
        w = words(rng, 60)
        toxic.append(k % 4 == 0)
        if toxic[-1]:
            w.insert(rng.randrange(60), rng.choice(bad))
        texts.append(" ".join(w))
    docs = table(spark, texts)
    labels = spark.createDataFrame([(k, int(t)) for k, t in enumerate(toxic)] + [(None, 1), (3, None), (9999, 1)], "doc_id long, toxic int")
    crf = toxicity.train(docs, labels.filter("doc_id < 200 OR doc_id > 9000"))
    got = docs.select("doc_id", "text", toxicity.tags(F.col("text"), crf).alias("t")).collect()
    hit = {r["doc_id"]: [r["text"][s["start"] : s["end"]] for s in r["t"]["spans"]] for r in got}
    assert np.mean([bool(hit[k]) == toxic[k] for k in range(200, 400)]) > 0.98
    assert {x for s in hit.values() for x in s} <= set(bad)
    out = toxicity.toxicity(odd, labels).collect()
    assert len(out) == len(ODD)
    assert toxicity.toxicity(none, labels).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).filter("score > 0").count() == 0


def test_toxicity_returns_every_document(spark, odd, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(3, 0), (7, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = toxicity.op6_toxicity(spark, str(tmp_path)).collect()
    assert len(rows) == len(ODD) and all(r["spans"] == [] and r["score"] == 0 for r in rows)


def test_near_copies():
    rng = random.Random(16)
    # Unrelated rows that have common bigrams, a copy and near copies on both sides of the limit.
    texts = [" ".join(" ".join(rng.choice(["a b", "c d", "e f"] + words(rng, 9)) for _ in range(60)).split()) for _ in range(60)]
    texts += [texts[3], texts[4] + " tail", "x", "x", ""] + [" ".join(texts[k].split()[: 30 + 2 * k] + words(rng, 20)) for k in range(5, 25)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    t = toxicity.Tokens(data, np.cumsum([0] + [len(x) for x in texts]))
    sets = [set(zip(w, w[1:])) if len(w) > 1 else set(w) for w in map(str.split, texts)]
    kept, want = [], []
    for k, x in enumerate(sets):
        want.append(any(x and len(x & sets[j]) >= toxicity.COPY * len(x | sets[j]) for j in kept))
        if not want[-1]:
            kept.append(k)
    assert toxicity.near_copies(t.hash, t.ptr).tolist() == want
    assert not any(want[:60]) and want[60] and want[61] and 3 < sum(want) < 24
    # All unrelated rows count: a word of 20 of them is evidence.
    unlike = [" ".join(["of the", "bad"][k < 20 :][:1] + ["of the in a"] + words(rng, 60, 10**6)) for k in range(200)]
    t = toxicity.Tokens(np.frombuffer("".join(unlike).encode(), np.uint8), np.cumsum([0] + [len(x) for x in unlike]))
    assert not toxicity.near_copies(t.hash, t.ptr).any()


def crf_by_paths(crf, t, y=None):
    """Marginals of toxic by enumeration of all labellings of one short text; with y, the logarithm of its probability."""
    import itertools

    e = toxicity.VALUES @ crf.weights[t.features].astype(float)
    n = len(e)
    def weight(p):
        return crf.start * p[0] + sum(crf.move[a, b] for a, b in zip(p, p[1:])) + sum(e[k] for k in range(n) if p[k])
    paths = list(itertools.product((0, 1), repeat=n))
    w = np.array([weight(p) for p in paths])
    total = np.logaddexp.reduce(w)
    if y is not None:
        return weight(tuple(y)) - total
    return np.array([np.exp(np.logaddexp.reduce([x for x, p in zip(w, paths) if p[k]]) - total) for k in range(n)])


def tokens_of(texts):
    data = "".join(texts).encode()
    return toxicity.Tokens(np.frombuffer(data, np.uint8), np.cumsum([0] + [len(x.encode()) for x in texts]))


def test_crf_marginals_and_gradient(monkeypatch):
    rng = np.random.default_rng(22)
    monkeypatch.setattr(toxicity, "BITS", 8)
    texts = ["a b c d e", "b", "c a a b", "d e f g h i"]
    crf = toxicity.Crf(rng.normal(size=256).astype(np.float32), rng.normal(size=(2, 2)), 0.3)
    want = np.concatenate([crf_by_paths(crf, tokens_of([x])) for x in texts])
    assert np.allclose(crf.marginals(tokens_of(texts)), want, atol=1e-5)
    # One round of fit() is a step of the rate along the sign of the gradient, wherever there is one.
    t, y = tokens_of(texts), np.array([0, 1, 1, 0, 0, 1, 0, 0, 1, 1, 0, 0, 0, 1, 0, 1])
    start = toxicity.Crf(np.zeros(256, np.float32), np.array([[0.0, -3.0], [0.0, -1.0]]), -3.0)
    like = lambda c: sum(crf_by_paths(c, tokens_of([x]), y[a:b]) for x, a, b in zip(texts, t.ptr[:-1], t.ptr[1:]))
    made = toxicity.fit([(t, y)], rounds=1, rate=1.0, decay=0.0)
    for k in np.unique(t.features):
        ends = []
        for d in (1e-3, -1e-3):
            w = np.zeros(256)
            w[k] = d
            ends.append(like(toxicity.Crf(w, start.move, start.start)))
        assert made.weights[k] == pytest.approx(np.sign(ends[0] - ends[1]), abs=1e-3)
    for a, b in ((0, 1), (1, 0), (1, 1)):
        ends = []
        for d in (1e-3, -1e-3):
            move = start.move.copy()
            move[a, b] += d
            ends.append(like(toxicity.Crf(start.weights, move, start.start)))
        assert np.sign(made.move[a, b] - start.move[a, b]) == np.sign(ends[0] - ends[1])
    more = toxicity.fit([(t, y)], rounds=30, rate=0.5, decay=0.0)
    assert like(more) > like(made) > like(start)


def test_scan_is_exact():
    rng = np.random.default_rng(9)
    for n in (1, 2, 7, 100, 1001):
        a, b, c, d = rng.random((4, n)) + 0.01
        a[rng.random(n) < 0.1] = 0
        o, want = 1.0, []
        for k in range(n):
            o = (a[k] * o + b[k]) / (c[k] * o + d[k])
            want.append(o)
        assert np.allclose(toxicity.fractional_scan(a, b, c, d), want)


def test_rans(spark, odd, none):
    rng = np.random.default_rng(10)
    for n in (0, 1, 255, 256, 257, 70_000):
        ids = np.minimum(rng.geometric(0.01, n), 999).astype(np.int64)
        t = rans.Table(rans.scaled(np.bincount(ids, minlength=1000)))
        stream, marks = t.encode(ids)
        parts = [t.decode(stream, m, n) for m in marks]
        assert np.concatenate([np.zeros(0, np.int32), *parts]).tolist() == ids.tolist()
        if n > 60_000:
            assert len(marks) > 1 and t.decode(stream, marks[1], n).tolist() == ids[65536:].tolist()
            broken = bytearray(stream)
            broken[len(broken) // 2] ^= 1
            with pytest.raises((ValueError, IndexError)):
                [t.decode(bytes(broken), m, n) for m in marks]
    v = sentencepiece_bpe.vocabulary()
    got = Counter((r["doc_id"], None if r["token_ids"] is None else tuple(r["token_ids"])) for r in rans.decoded(rans.encoded_blocks(odd)).collect())
    want = Counter((r["doc_id"], None if r["text"] is None else tuple(v.library.encode(r["text"]))) for r in odd.collect())
    assert got == want
    assert rans.encoded_blocks(none).count() == 1


def test_rans_blocks(spark):
    rng = random.Random(21)
    texts = [" ".join(words(rng, n)) for n in (5, 40, 3000, 5, 5, 60, 900, 10)]
    docs = table(spark, texts).coalesce(1)
    size = [len(sentencepiece_bpe.vocabulary().library.encode(t)) for t in texts]
    blocks = [r["doc_ids"] for r in rans.encoded_blocks(docs, block=1000).filter("block >= 0").orderBy("block").collect()]
    want, now, have = [], [], 0
    for d, n in enumerate(size):
        if now and n > 1000:
            want.append(now)
            now, have = [], 0
        now, have = now + [d], have + n
        if have >= 1000:
            want.append(now)
            now, have = [], 0
    assert blocks == want + [now] * bool(now) and [2] in blocks and [6] in blocks
    for kind in ("string", "decimal(20,2)", "date", "binary", "double", "timestamp", "int"):
        some = docs.withColumn("doc_id", F.date_add(F.lit("2020-01-01"), F.col("doc_id").cast("int")) if kind in ("date", "timestamp") else F.col("doc_id").cast("string")).withColumn("doc_id", F.col("doc_id").cast(kind))
        back = rans.decoded(rans.encoded_blocks(some, block=1000)).collect()
        assert Counter((str(r["doc_id"]), len(r["token_ids"])) for r in back) == Counter((str(r["doc_id"]), n) for r, n in zip(some.select("doc_id").collect(), size))


def test_maxent_lm(spark, odd, none):
    rng = random.Random(11)
    chain = {k: [rng.randrange(30) for _ in range(2)] for k in range(30)}
    texts = []
    for _ in range(150):
        w = [rng.randrange(30)]
        for _ in range(120):
            w.append(rng.choice(chain[w[-1]]))
        texts.append(" ".join(f"w{x}" for x in w))
    docs = table(spark, texts)
    rows = maxent_lm.scored(docs, rounds=3).collect()
    mean = np.mean([r["mean_logprob"] for r in rows])
    assert mean > np.log(1 / 30) + 0.8  # far better than single words: two followers each
    model = maxent_lm.train(docs)
    shuffled = [" ".join(rng.sample(t.split(), len(t.split()))) for t in texts]
    s = table(spark, shuffled).select(maxent_lm.scores(F.col("text"), model)["mean_logprob"]).toPandas().mean().iloc[0]
    assert s < mean
    out = maxent_lm.scored(odd).collect()
    assert len(out) == len(ODD) and sum(r["perplexity"] is None for r in out) == sum(not (t or "").split() for t in ODD)
    assert maxent_lm.scored(none).count() == 0


def test_maxent_lm_grows(spark, monkeypatch):
    docs = table(spark, [" ".join(f"v{k} v{k}" for k in range(3000)) + " once"])
    monkeypatch.setattr(maxent_lm, "WIDTH", 4)
    small = maxent_lm.train(docs)
    assert small.width == 4 and small.own == 56 and all(x.shape == (1 << b, 4) for x, b in zip(small.tables, small.bits))
    monkeypatch.setattr(maxent_lm, "FREQUENT", 2)
    large = maxent_lm.train(docs)
    assert len(large.words) >= 3000 and large.width == 16 and sum(x.size for x in large.tables) > 8 * sum(x.size for x in small.tables)
    assert large.own + large.shared == large.width**3 == len(large.log_types)


def test_maxent_lm_scores_rare_words_by_their_counts(spark, monkeypatch):
    monkeypatch.setattr(maxent_lm, "WIDTH", 4)
    monkeypatch.setattr(maxent_lm, "BLOCK", 400)
    rng = random.Random(23)
    texts = [" ".join(f"r{int(rng.paretovariate(0.6))}" for _ in range(rng.randrange(1, 60))) for _ in range(120)]
    texts += ["", None, texts[0], "r1 " * 300 + "once", "  \n"]
    docs = table(spark, texts)
    model, rows = maxent_lm.train(docs), maxent_lm.scored(docs).collect()
    seen = Counter(w for t in texts for w in (t or "").split())
    home = {w: int(model.places(lm_words(w).hash)[0]) for w in seen}
    shared = Counter()
    for w, n in seen.items():
        shared[home[w]] += n
    rare = [w for w in seen if home[w] >= model.own]
    # Places hold several words of different counts: equal parts would be wrong.
    assert len({(home[w], seen[w]) for w in rare}) > len({home[w] for w in rare})
    assert len(rows) == len(texts)
    got = {r["doc_id"]: r for r in rows}
    for k, t in zip([r["doc_id"] for r in docs.collect()], texts):
        words = (t or "").split()
        assert got[k]["n_words"] == len(words)
        if words:
            w = lm_words(t)
            p = model.log_place(model.features(w), model.places(w.hash)).astype(float)
            want = np.mean(p + [np.log(seen[x] / shared[home[x]]) for x in words])
            assert got[k]["mean_logprob"] == pytest.approx(want, abs=1e-3)
            assert got[k]["perplexity"] == pytest.approx(np.exp(-want), rel=2e-3)
        else:
            assert got[k]["mean_logprob"] is None and got[k]["perplexity"] is None
    # Ids of any type, also null, come back with their rows.
    some = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.array(F.col("doc_id").cast("string"))))
    assert Counter(str(r["doc_id"]) for r in maxent_lm.scored(some).collect()) == Counter(str(r["doc_id"]) for r in some.collect())


def lm_words(text):
    return maxent_lm.Words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))


def small_model(rng):
    """A model of 4 ** 3 places with weights at random, and the words it counts on: 50 with places, 30 that share."""
    vocabulary = [f"t{k}" for k in range(80)]
    h = np.concatenate([lm_words(w).hash for w in vocabulary])
    types = np.ones(64)
    types[56:] = np.bincount((h[50:] % np.uint64(8)).astype(int), minlength=8)
    model = maxent_lm.Model(h[:50], types, 4, 8, (5, 6, 7))
    for t in model.tables:
        t += rng.normal(size=t.shape).astype(np.float32)
    return model, vocabulary


def lm_rows(model, f, place, level):
    """The rows of a level for one word: the hash of each feature with the digits so far."""
    M = 1 << 64
    before = place // model.width ** (2 - level)
    before //= model.width
    out = []
    for x in f:
        x = int(x)
        if level:
            x = (x + before * int(maxent_lm.BASE)) % M
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> shift)) * factor % M
            x ^= x >> 31
        out.append(x >> (64 - model.bits[level]))
    return out


def test_maxent_probabilities_are_softmax():
    rng = np.random.default_rng(18)
    model, vocabulary = small_model(rng)
    seen = lm_words(" ".join(rng.choice(vocabulary, 40)))
    f, place = model.features(seen), model.places(seen.hash)
    assert f.shape == (4, 40)
    got = model.score(seen)
    for k in range(40):
        want = -np.log(max(1, np.exp(model.log_types[place[k]])))
        for level in range(3):
            z = sum(model.tables[level][r].astype(float) for r in lm_rows(model, f[:, k], int(place[k]), level))
            want += z[place[k] // 4 ** (2 - level) % 4] - np.log(np.exp(z).sum())
        assert got[k] == pytest.approx(want, abs=1e-4)
    # After any words, the places share one.
    total = sum(np.exp(model.log_probability(f[:, [k] * 64], np.arange(64)) + model.log_types) for k in (0, 5, 39))
    assert total.sum() == pytest.approx(3, abs=1e-4)
    # Of the places that words share, each type has its part.
    ends = [np.exp(model.score(lm_words("t1 t2 t3 " + w))[-1]) for w in vocabulary]
    empty = [p for p in range(64) if not np.isin(p, model.places(np.concatenate([lm_words(w).hash for w in vocabulary])))]
    ghosts = np.exp(model.log_probability(model.features(lm_words("t1 t2 t3 t4"))[:, [3] * len(empty)], np.array(empty))).sum()
    assert sum(ends) + ghosts == pytest.approx(1, abs=1e-4)


def test_maxent_products_of_exponentials_equal_exponentials_of_sums():
    rng = np.random.default_rng(29)
    model, vocabulary = small_model(rng)
    seen = lm_words(" ".join(rng.choice(vocabulary, 300)))
    for scale in (1, 8 / max(np.abs(t).max() for t in model.tables), 2.4):
        for t in model.tables:
            t *= np.float32(scale)
        assert np.allclose(model.score(seen), model.score(seen, model.powers()), rtol=1e-4, atol=1e-4)
    # Sums beyond MOST are cut in either way; weights whose products could overflow take the way of sums.
    f, place = model.features(seen), model.places(seen.hash)
    assert max(np.abs(z).max() for _, _, _, z, _ in model.softmax(f, place, model.powers())) == np.exp(np.float32(maxent_lm.MOST))
    model.tables[0][0, 0] = 1 + maxent_lm.MOST / 2
    assert model.powers() is None
    # The search by first bits finds every word with a place, and no other.
    model.words[:3] = model.words[3] - np.arange(3, 0, -1).astype(np.uint64)
    again = maxent_lm.Model(model.words, np.ones(64), 4, 8, (5, 6, 7))
    assert again.longest >= 4 and again.places(model.words).tolist() == list(range(50))
    assert (again.places(model.words + np.uint64(1))[5:] >= 56).all() and again.places(np.zeros(0, np.uint64)).size == 0


def test_maxent_update_is_the_gradient():
    rng = np.random.default_rng(19)
    model, vocabulary = small_model(rng)
    seen = lm_words(" ".join(rng.choice(vocabulary[:9], 30)))
    f, place = model.features(seen), model.places(seen.hash)
    start = model.copy()
    # The gradient by differences of the likelihood.
    slope = [np.zeros(t.shape) for t in model.tables]
    for level, t in enumerate(model.tables):
        for r, c in {(r, c) for k in range(30) for r in lm_rows(model, f[:, k], int(place[k]), level) for c in range(4)}:
            old, ends = t[r, c], []
            for e in (1e-2, -1e-2):
                t[r, c] = old + np.float32(e)
                ends.append(model.score(seen).sum())
            t[r, c] = old
            slope[level][r, c] = (ends[0] - ends[1]) / 2e-2
    # Scaled steps, word by word and feature by feature.
    want, past = [t.astype(float) for t in model.tables], [np.zeros(1 << b) for b in model.bits]
    plain = [np.zeros(t.shape) for t in model.tables]
    for level in range(3):
        rows = np.array([lm_rows(model, f[:, k], int(place[k]), level) for k in range(30)])
        g = np.zeros((30, 4))
        for k in range(30):
            z = sum(start.tables[level][r].astype(float) for r in rows[k])
            g[k] = -np.exp(z) / np.exp(z).sum()
            g[k, place[k] // 4 ** (2 - level) % 4] += 1
            for r in rows[k]:
                plain[level][r] += g[k]
        for feature in range(4):
            for k in range(30):
                past[level][rows[k, feature]] += (g[k] ** 2).mean()
            for k in range(30):
                want[level][rows[k, feature]] += 0.1 * g[k] / np.sqrt(past[level][rows[k, feature]] + 1e-3)
    for x, y in zip(plain, slope):
        assert np.allclose(x, y, atol=2e-2)
    model.update(f, place, 0.1)
    for got, x in zip(model.tables, want):
        assert np.allclose(got, x, atol=1e-4)
    assert model.score(seen).sum() > start.score(seen).sum()


def brute_links(texts, ids, t=ngram_join.THRESHOLD):
    """doc_id -> (least id of its group, links), from all pairs."""
    sets = [{tuple(w)} if 0 < len(w) < 3 else {tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in ((x or "").split() for x in texts)]
    root, links = {i: i for i in ids}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t:
                links[ids[a]] += 1
                links[ids[b]] += 1
                x, y = sorted((find(ids[a]), find(ids[b])))
                root[y] = x
    groups = defaultdict(set)
    for i in ids:
        groups[find(i)].add(i)
    return {i: (min(g), links[i]) for g in groups.values() if len(g) > 1 for i in g}


def near(df, **options):
    rows = ngram_join.near_groups(df, **options).collect()
    out = {r["doc_id"]: (r["group_id"], r["n_links"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_ngram_join(spark, odd, none):
    rng = random.Random(12)
    texts = []
    for _ in range(12):
        base = words(rng, rng.choice((4, 30, 200, 900)))
        for _ in range(rng.choice((1, 2, 3, 18))):
            w = list(base)
            for k in range(len(w)):
                if rng.random() < 0.03:
                    w[k] = "new" + str(rng.random())
            texts.append(" ".join(w))
    texts += texts[:7] + texts[:3] + [" ".join(words(rng, 25_000, 10**9))]
    rng.shuffle(texts)
    want = brute_links(texts, list(range(len(texts))))
    assert near(table(spark, texts)) == want and len(want) > 20
    assert near(odd) == {}
    two = table(spark, ["a b c d", "a b c d", "z z y x", None, "", "a b c d"], [5, 4, 9, 10, 11, 4])
    assert near(two) == {4: (4, 1), 5: (4, 1)}
    left = ngram_join.one_of_each(two)
    assert left.columns == two.columns and sorted(r["doc_id"] for r in left.collect()) == [4, 4, 9, 10, 11]
    # Ids of other types, and an id with two texts, which joins the groups of both.
    named = spark.createDataFrame([("x", "a b c d"), ("y", "a b c d"), ("y", "e f g h"), ("z", "e f g h")], "doc_id string, text string")
    assert near(named) == {"x": ("x", 1), "y": ("x", 2), "z": ("x", 1)}
    assert near(none) == {}


def families(rng):
    """Families of 25 texts whose neighbours lie around the threshold, and one of 150 that share their beginning."""
    texts = []
    for _ in range(6):
        base = words(rng, 120, 10**6)
        for _ in range(25):
            w = list(base)
            for k in rng.sample(range(120), rng.randrange(8, 16)):
                w[k] = f"own{rng.randrange(10**9)}"
            texts.append(" ".join(w))
    head = words(rng, 102, 10**6)
    return texts + [" ".join(head + words(rng, rng.randrange(53, 79), 10**9)) for _ in range(150)]


@pytest.mark.parametrize("part_grams, bins", [(1 << 20, None), (3000, None), (1 << 20, "alone")])
def test_ngram_join_near_the_threshold(spark, monkeypatch, part_grams, bins):
    """Every link is found, however the work is divided: whole blocks, parts of them, or every class alone in its block."""
    texts = families(random.Random(15))
    want = brute_links(texts, list(range(len(texts))))
    assert 60 < len(want) < len(texts) and max(n for _, n in want.values()) > 12
    monkeypatch.setattr(ngram_join, "PART_GRAMS", part_grams)
    monkeypatch.setattr(ngram_join, "BATCH_BYTES", 50_000)
    if bins:
        monkeypatch.setattr(ngram_join, "_labels", lambda able: able.select("rid", F.col("rid").alias("block")).distinct())
    assert near(table(spark, texts)) == want


def test_divide_skip(monkeypatch):
    rng = np.random.default_rng(13)
    lists = [np.unique(rng.integers(0, 50, n)) for n in (3, 5, 8, 20, 45, 50)] + [np.zeros(0, np.int64)]
    count = np.bincount(np.concatenate(lists), minlength=50)
    for heap in (10**6, 0):
        monkeypatch.setattr(ngram_join, "HEAP", heap)
        for need in range(1, 8):
            found, n = ngram_join.divide_skip(lists, need, 50)
            assert found.tolist() == np.flatnonzero(count >= need).tolist() and n.tolist() == count[found].tolist()


def test_packed_grams():
    rng = np.random.default_rng(17)
    for n, top in ((0, 9), (1, 1 << 40), (5, 1 << 40), (9000, 1 << 40), (50, 60)):
        x = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        assert ngram_join.unpack(ngram_join.pack(x)).tolist() == x.tolist()
        assert ngram_join._unpack48(ngram_join._pack48(x)).tolist() == x.tolist()


def test_line_dedup(spark, odd, none):
    rng = random.Random(14)
    shared = [" ".join(words(rng, 5)) for _ in range(5)]
    texts = ["\n".join([f"own {k} {j}" for j in range(3)] + (shared if k % 2 else shared[:2]) + ["", f"end {k}"]) for k in range(6)]
    lines = [[(i, x.strip()) for i, x in enumerate(t.split("\n")) if x.strip()] for t in texts]
    occ = defaultdict(list)
    for d, ls in enumerate(lines):
        for k in range(len(ls) - 2):
            occ[tuple(x for _, x in ls[k : k + 3])].append((d, k))
    gone = defaultdict(set)
    for places in occ.values():
        for d, k in sorted(places)[1:]:
            gone[d].update(i for i, _ in lines[d][k : k + 3])
    want = ["\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in enumerate(texts)]
    docs = table(spark, texts)
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(docs).collect()}
    assert [got[d] for d in range(6)] == want and any(gone.values())
    out = line_dedup.line_dedup(odd)
    assert Counter(r["text"] for r in out.collect()) == Counter(ODD)
    docs2 = docs.withColumn("n_chars", F.length("text").cast("long"))
    assert line_dedup.rewritten(docs2).columns == docs2.columns
    assert line_dedup.line_dedup(none).count() == 0
