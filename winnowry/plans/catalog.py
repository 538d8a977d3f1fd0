"""Every operator as a query over the standard tables, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.functions import labels as L
from winnowry.functions import rules as R
from winnowry.functions import text as T
from winnowry.operators import cache, dedupe, ensemble, evaluate, members, split, zero_shot
from winnowry.plans import pipeline
from winnowry.sources import search
from winnowry.sources.files import structured_log  # noqa: F401  (part of the surface)

#: Titles by doc_id % 24, so that every branch of the rules is taken; phrases are part of every text of their rows.
TITLES = (
    "How do I fix this driver error?", "No problem with the app, a short guide", "I fixed it by a firmware update", "Looking for software to track tasks",
    "Which printer should I buy for home", "Career advice after college, need help", "I built a sensor prototype, it fails", "Maybe a bug in the script config",
    "not broken, no issues at all", "Showcase: my new tool", "hope this helps, worked for me", "quiet day at the lake", "need a vendor for replacement parts",
    "how to install the update, not sure", "Job rant and my advice, stuck", "Looking for a graphics card alternative", "randomly got a package", "I think it never failed, error in the api",
    "Launch day of the project", "can't open settings", "frustrated with customer service", "deployment problem", "tips and tricks for automation", "school laptop, anyone else",
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _posts_sql(string: str) -> str:
    titles = " ".join(f"WHEN {k} THEN {_q(t)}" for k, t in enumerate(TITLES))
    return f"""SELECT doc_id AS idx, CAST(doc_id AS {string}) AS post_id, CASE doc_id % 24 {titles} END AS title,
  text || CASE doc_id % 7 WHEN 0 THEN ' see [docs](https://ex' || CAST(doc_id % 50 AS {string}) || '.com/a).' WHEN 1 THEN ' at http://site' || CAST(doc_id % 90 AS {string}) || '.org:80/p?q=1, ok'
    WHEN 2 THEN ' <b>bold</b> &amp; `code` u/some_one' WHEN 3 THEN ' Crosspost from r/test mail me@host.org 123-45-6789 or 5551234567' ELSE '' END AS body,
  source AS subreddit, doc_id * 60.0E0 AS created_utc FROM documents"""


POSTS = _posts_sql("VARCHAR")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def posts(spark: SparkSession, d: str) -> DataFrame:
    """Posts made of documents, all of them and whole."""
    return spark.sql(_posts_sql("STRING").replace("FROM documents", "FROM {documents}"), documents=_documents(spark, d))


def _norm(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.normalised(posts(spark, d))


# SQL of the text functions. -----------------------------------------------------------------------------------------


def _rx(c: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({c}, {_q(pattern)}, {_q(to)}, {_q(flags)})"


def s_markdown(c: str) -> str:
    c = _rx(_rx(_rx(c, "```.*?```", " ", "gs"), "`[^`]+`", " "), r"[!][\[][^\]]*[\]][(][^)]*[)]", " ")
    c = _rx(_rx(_rx(c, r"[\[]([^\]]*)[\]][(][^)]*[)]", r"\1"), r"(?m)^>+\s?", " "), r"(?m)^#{1,6}\s*", " ")
    return _rx(c, r"(?m)^(?:\d+[.]\s+|\s*[*+-]\s+)", " ")


def s_html(c: str) -> str:
    c = _rx(c, "<[^>]+>", " ")
    for entity, char in T.ENTITIES:
        c = f"replace({c}, {_q(entity)}, {_q(char)})"
    return c


def s_no_urls(c: str) -> str:
    return _rx(_rx(c, T.LINK, " "), r"https?://\S+", " ")


def s_crosspost(c: str) -> str:
    return _rx(c, r"cross\s*(?:posted|post)\s{1,}from\s{1,}r/\w+", " ", "gi")


def s_mentions(c: str) -> str:
    return _rx(c, "/?u/[_0-9a-zA-Z-]+", " ")


def s_normal(c: str) -> str:
    c = s_markdown(s_no_urls(s_html(s_mentions(s_crosspost(f"lower({c})")))))
    return f"trim({_rx(_rx(c, chr(92) + 'p{So}', ''), '[^a-z0-9]+', ' ')})"


def s_urls(c: str) -> str:
    rest = _rx(c, T.LINK, " ")
    return f"list_concat(regexp_extract_all({c}, {_q(T.LINK)}, 2), regexp_extract_all({rest}, 'https?://\\S+'))"


def s_clean_urls(c: str) -> str:
    return f"list_transform({s_urls(c)}, lambda u: regexp_replace(lower(u), {_q(T.TRIMMED_TAIL)}, ''))"


S_TEXT = r"regexp_replace(title || chr(10) || chr(10) || body, '^\s+|\s+$', '', 'g')"
S_TOKENS = "list_filter(string_split_regex(norm, '[^a-z0-9]+'), lambda t: t <> '')"
S_NORM = f"SELECT idx, post_id, {s_normal(S_TEXT)} AS norm, {s_clean_urls(S_TEXT)} AS urls, subreddit, created_utc AS created, length(body) AS body_length FROM posts"


def _with_posts(sql: str) -> str:
    return f"WITH posts AS ({POSTS}) {sql}"


def _with_norm(sql: str, more: str = "", recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}posts AS ({POSTS}), n AS MATERIALIZED ({S_NORM}){more} {sql}"


# SQL of the rules. --------------------------------------------------------------------------------------------------


def s_has(cues: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(t, {_q(c)})" for c in cues) + ")"


def s_hits(cues: tuple[str, ...]) -> str:
    return f"list_filter([{', '.join(_q(c) for c in cues)}], lambda c: contains(t, c))"


S_OPEN = f"list_filter({s_hits(R.PROBLEM)}, lambda c: NOT (" + " OR ".join(f"(c IN ({', '.join(map(_q, cs))}) AND contains(t, {_q(p)}))" for p, cs in R.NEGATED.items()) + "))"


def s_three(hits: str) -> str:
    return f"array_to_string(list_slice({hits}, 1, 3), ', ')"


S_RULES = f"""
r0 AS (SELECT idx, post_id, lower({S_TEXT}) AS t FROM posts),
r1 AS (SELECT *, CASE WHEN contains(t, '?') OR {s_has(R.QUESTION)} THEN '1' WHEN {s_has(R.ADVICE + R.RESOLVED + R.CONTEXT)} THEN '2'
  WHEN {s_has(R.SHOWCASE)} THEN '3' WHEN {s_has(R.PROBLEM)} THEN '1' ELSE '4' END AS intent,
  {s_hits(R.PROBLEM)} AS cues, {S_OPEN} AS open, {s_hits(R.SOFTWARE)} AS soft, {s_hits(R.HARDWARE)} AS hard, {s_hits(R.EXTERNAL)} AS ext,
  {s_has(R.LEARNING)} AS learn, {s_has(R.RESOLVED)} AS resolved, contains(t, 'advice') AS advice FROM r0),
r2 AS (SELECT *, CASE WHEN resolved THEN '0|Story explains how the issue was already resolved.' WHEN intent = '3' AND len(cues) = 0 THEN '0|Showcase post without any unresolved frustration.'
  WHEN len(open) > 0 THEN '1|Found unresolved problem cues: ' || {s_three("open")} || '.' WHEN len(cues) > 0 THEN '0|Problem words only show up in negated phrases.'
  WHEN intent = '2' THEN '1|Post shares advice based on a real past problem.' ELSE '0|No unresolved problem indicators detected.' END AS p FROM r1),
r3 AS (SELECT *, CASE WHEN p[1] <> '1' THEN '0|No active problem, so this label stays at 0.'
  WHEN contains(t, 'looking for') AND {s_has(R.PRODUCT)} AND NOT {s_has(R.MAKING)} THEN '0|Looking for an existing product rather than fixing software.'
  WHEN len(soft) > 0 AND len(hard) = 0 THEN '1|Clear software troubleshooting cues: ' || {s_three("soft")} || '.'
  WHEN len(hard) > 0 AND len(soft) = 0 THEN '0|Signals point to hardware or market research (' || {s_three("hard")} || ').'
  WHEN learn THEN '0|Question is about learning, not repairing software.' WHEN contains(t, 'driver') OR contains(t, 'update') THEN '1|Mentions drivers or updates linking problem to software.'
  WHEN len(soft) > 0 THEN '0|Mix of hardware and product cues, so not purely software solvable.' ELSE '0|No strong software-related clues detected.' END AS s,
  CASE WHEN p[1] <> '1' THEN '0|No active problem, so this label stays at 0.' WHEN contains(t, 'which') AND contains(t, 'should i') THEN '1|Choosing between outside options, so external help is needed.'
  WHEN contains(t, 'job') AND advice THEN '0|Career advice discussion can be handled individually.' WHEN {s_has(R.STUDY)} AND advice THEN '0|Education or career advice does not need outside partners.'
  WHEN len(ext) > 0 THEN '1|Needs outside support: ' || {s_three("ext")} || '.' WHEN {s_has(R.PROTOTYPE)} THEN '1|Prototype work calls for external hardware or fabrication help.'
  WHEN learn THEN '0|User can act alone with the right guidance.' ELSE '0|No signs that external coordination is required.' END AS e,
  list_filter([CASE WHEN learn THEN 'learning_question' END, CASE WHEN contains(t, 'looking for') THEN 'seeking_existing_solution' END,
    CASE WHEN {s_has(R.ADVICE)} THEN 'advice_sharing' END, CASE WHEN resolved THEN 'resolved_problem' END], lambda x: x IS NOT NULL) AS tags FROM r2),
ruled AS (SELECT idx, post_id, intent, p[1] AS is_problem, s[1] AS is_software_solvable, e[1] AS is_external, p[3:] AS problem_reason, s[3:] AS software_reason, e[3:] AS external_reason,
  array_to_string(tags, ', ') AS detected_patterns, CASE WHEN {s_has(R.UNSURE)} THEN 0.3::DOUBLE WHEN len(tags) > 0 THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END AS confidence FROM r3)
"""


def _with_rules(sql: str, more: str = "") -> str:
    return f"WITH posts AS ({POSTS}), {S_RULES}{more} {sql}"


def _ruled(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.label(posts(spark, d)).select("idx", "post_id", *R.FIELDS)


# SQL of duplicates. -------------------------------------------------------------------------------------------------

S_BLOCKS = """, tok AS (SELECT DISTINCT idx, unnest(TOKENS) AS token FROM n),
bt AS (SELECT token, count(*) AS c FROM tok WHERE length(token) > 3 GROUP BY token HAVING count(*) BETWEEN 2 AND 100),
tp AS (SELECT a.idx AS i, b.idx AS j FROM bt JOIN tok a ON a.token = bt.token JOIN tok b ON b.token = bt.token AND a.idx < b.idx),
u AS (SELECT DISTINCT idx, unnest(urls) AS url FROM n),
dom AS (SELECT DISTINCT idx, regexp_extract(url, '^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1) AS d FROM u),
dp AS (SELECT a.idx AS i, b.idx AS j FROM dom a JOIN dom b ON a.d = b.d AND a.d <> '' AND a.idx < b.idx),
cand AS (SELECT i, j FROM tp UNION SELECT i, j FROM dp)""".replace("TOKENS", S_TOKENS)
S_SCORED = (
    S_BLOCKS
    + """, f AS MATERIALIZED (SELECT idx, subreddit, list_distinct(TOKENS) AS t, list_distinct(CASE WHEN length(norm) < 5 THEN [norm] ELSE list_transform(range(1, length(norm) - 3), lambda k: substr(norm, k, 5)) END) AS g FROM n),
ct AS MATERIALIZED (SELECT i, j, x.subreddit <> y.subreddit AS apart, len(x.g) AS gi, len(y.g) AS gj, len(list_intersect(x.t, y.t)) AS o, len(x.t) + len(y.t) AS s FROM cand JOIN f x ON x.idx = i JOIN f y ON y.idx = j),
c2 AS MATERIALIZED (SELECT *, CASE WHEN s = 0 THEN 1.0::DOUBLE ELSE o / (s - o)::DOUBLE END AS tok FROM ct),
c3 AS MATERIALIZED (SELECT * FROM c2 WHERE 0.7::DOUBLE * tok + 0.3::DOUBLE * (least(gi, gj) / greatest(gi, gj)::DOUBLE) >= CASE WHEN apart THEN 0.35::DOUBLE ELSE 0.5::DOUBLE END - 1e-9),
fg AS MATERIALIZED (SELECT idx, unnest(g) AS gram FROM f WHERE idx IN (SELECT i FROM c3 UNION SELECT j FROM c3)),
ov AS (SELECT c3.i, c3.j, count(b.idx) AS og FROM c3 JOIN fg a ON a.idx = c3.i LEFT JOIN fg b ON b.idx = c3.j AND b.gram = a.gram GROUP BY c3.i, c3.j),
sc AS (SELECT c3.i, c3.j, apart, 0.7::DOUBLE * tok + 0.3::DOUBLE * (og / (gi + gj - og)::DOUBLE) AS similarity FROM c3 JOIN ov ON ov.i = c3.i AND ov.j = c3.j),
good AS (SELECT i, j, similarity, apart AND similarity >= 0.35::DOUBLE AS soft FROM sc WHERE similarity >= 0.5::DOUBLE OR (apart AND similarity >= 0.35::DOUBLE))""".replace("TOKENS", S_TOKENS)
)
S_STARS = """, st AS (SELECT min(idx) OVER (PARTITION BY norm) AS i, idx AS j FROM n), su AS (SELECT DISTINCT min(idx) OVER (PARTITION BY url) AS i, idx AS j FROM u)"""
S_EDGES = S_SCORED + S_STARS + """, edges AS (SELECT i, j FROM st WHERE i <> j UNION SELECT i, j FROM su WHERE i <> j UNION SELECT i, j FROM good)"""
S_COMPONENTS = (
    S_EDGES
    + """, both_ways AS (SELECT i AS a, j AS b FROM edges UNION SELECT j, i FROM edges), reach(idx, far) AS (SELECT idx, idx FROM n UNION SELECT reach.idx, w.b FROM reach JOIN both_ways w ON w.a = reach.far),
comp AS (SELECT idx, min(far) AS component FROM reach GROUP BY idx)"""
)


def _s_canonical(order: str) -> str:
    return (
        S_COMPONENTS
        + f""", best AS (SELECT component, n.*, row_number() OVER (PARTITION BY component ORDER BY {order}, n.post_id) AS k FROM n JOIN comp USING (idx)),
canon AS (SELECT component, min(post_id) FILTER (k = 1) AS canonical_post_id, list(post_id ORDER BY idx) AS members, list_sort(list_distinct(list(subreddit) FILTER (subreddit <> ''))) AS subreddits FROM best GROUP BY component)"""
    )


def _s_whole(sql: str) -> str:
    """With token blocks of any number of posts."""
    return sql.replace("HAVING count(*) BETWEEN 2 AND 100", "HAVING count(*) >= 2")


S_EARLIEST, S_LONGEST = _s_canonical("created, body_length DESC"), _s_canonical("body_length DESC, created")


#: Token blocks of 2 to 100 posts, as the SQL of most queries has them.
CAPPED = dedupe.DedupeConfig(bucket=dedupe.BUCKET)


def _canonical(spark: SparkSession, d: str, policy: str = "earliest") -> DataFrame:
    n = dedupe.cut(_norm(spark, d), "catalog-posts")
    return dedupe.canonical(dedupe.clusters(n, CAPPED), policy)


def _joined(c: str) -> Column:
    return F.array_join(c, "|").alias(c)


# Members for votes: the rules, and two that vary them by the id. ----------------------------------------------------


def _members(spark: SparkSession, d: str) -> DataFrame:
    r = _ruled(spark, d)
    same = {f: F.col(f) for f in R.FIELDS}
    flip = lambda f: F.when(F.col(f) == "1", "0").otherwise("1")
    direct = same | {"is_external": flip("is_external"), "intent": F.lit("")}
    reasoning = same | {"is_problem": flip("is_problem"), "intent": F.lit("4")}
    third = F.col("idx") % 3 == 0
    made = F.array(
        ensemble.rules_member(),
        F.when(~third, ensemble.member("direct", direct, F.lit(0.9), F.lit("d"))),
        ensemble.member("reasoning", reasoning, F.when(F.col("idx") % 2 == 0, 0.1).otherwise(0.9), F.lit("r")),
    )
    return r.withColumn("members", made)


S_MEMBERS = """, mem AS (
 SELECT idx, 'rules' AS m, 2 AS pr, confidence AS w, intent, is_problem, is_external FROM ruled
 UNION ALL SELECT idx, 'direct', 1, 0.9::DOUBLE, '', is_problem, CASE is_external WHEN '1' THEN '0' ELSE '1' END FROM ruled WHERE idx % 3 <> 0
 UNION ALL SELECT idx, 'reasoning', 0, CASE idx % 2 WHEN 0 THEN 0.1::DOUBLE ELSE 0.9::DOUBLE END, '4', CASE is_problem WHEN '1' THEN '0' ELSE '1' END, is_external FROM ruled),
lab AS (SELECT idx, m, pr, w, unnest(['intent', 'is_problem', 'is_external']) AS field, unnest([intent, is_problem, is_external]) AS v FROM mem)"""

# Evaluation: the labels of documents as gold for the rules. ---------------------------------------------------------


def _matched(spark: SparkSession, d: str) -> DataFrame:
    gold = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("post_id"), F.col("quality").alias("is_problem"), F.col("toxic").alias("is_external"))
    return evaluate.matched(_ruled(spark, d), gold)


S_MATCHED = """, m AS (SELECT 'is_problem' AS field, quality::VARCHAR AS gold, is_problem AS pred FROM ruled JOIN labels ON doc_id = idx
 UNION ALL SELECT 'is_external', toxic::VARCHAR, is_external FROM ruled JOIN labels ON doc_id = idx)"""
S_PRF = S_MATCHED + """, lb AS (SELECT DISTINCT field, x FROM (SELECT field, gold AS x FROM m UNION SELECT field, pred FROM m)),
k AS (SELECT lb.field, x AS label, count(*) FILTER (gold = x AND pred = x) AS tp, count(*) FILTER (pred = x) AS p, count(*) FILTER (gold = x) AS g FROM lb JOIN m ON m.field = lb.field GROUP BY lb.field, x),
pr AS (SELECT field, label, CASE WHEN p = 0 THEN 0.0::DOUBLE ELSE tp / p::DOUBLE END AS precision, CASE WHEN g = 0 THEN 0.0::DOUBLE ELSE tp / g::DOUBLE END AS recall FROM k),
f1 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pr)"""


def _r9(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 9) for n in names})


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """Model answers of several shapes, one per document."""
    k = F.col("doc_id") % 6
    sure = (F.col("doc_id") % 13 / 10.0).cast("string")
    body = F.concat(F.lit('{"is_problem": '), F.when(k == 0, '"true"').when(k == 1, "0.7").when(k == 2, '"3"').when(k == 3, "false").otherwise('"0"'), F.lit(', "is_software_solvable": 1, "is_external": null, "confidence": '), F.when(k == 4, '"high"').otherwise(sure), F.lit(', "rationale": " why "}'))
    return _documents(spark, d).select("doc_id", F.when(k == 5, "no json").when(k == 2, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body).alias("content"))


def _dead(spark: SparkSession, d: str) -> DataFrame:
    a = _answers(spark, d).withColumn("error", L.parse_answer(F.col("content"))["error"])
    return members.dead_letters(a.withColumn("canonical_post_id", F.col("doc_id")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    text = lambda table, key, col, fn, name="out": lambda s, d: s.read.parquet(f"{d}/{table}.parquet").select(key, fn(F.col(col)).alias(name))
    post = lambda fn, name="out": lambda s, d: posts(s, d).select("post_id", fn(F.col("body")).alias(name))
    ruled = lambda *names: lambda s, d: _ruled(s, d).select("post_id", *names)
    return {
        "norm_whitespace": text("documents", "doc_id", "text", T.whitespace),
        "strip_markdown": post(T.strip_markdown),
        "strip_html": text("pages", "page_id", "html", T.strip_html),
        "strip_emoji": post(T.without_emoji),
        "remove_mentions": post(T.without_mentions),
        "remove_crosspost": post(T.without_crosspost),
        "remove_urls": post(T.without_urls),
        "normalise_text": lambda s, d: _norm(s, d).select("post_id", "norm"),
        "extract_urls": lambda s, d: posts(s, d).select("post_id", F.array_join(T.urls(F.col("body")), "|").alias("urls")),
        "clean_urls": lambda s, d: _norm(s, d).select("post_id", F.array_join("urls", "|").alias("urls")),
        "url_domain": lambda s, d: s.read.parquet(f"{d}/pages.parquet").select("page_id", T.domain(F.lower("url")).alias("domain"), T.splittable(F.col("url")).alias("valid")),
        "tokenise": lambda s, d: _norm(s, d).select("post_id", F.array_join(T.tokens(F.col("norm")), "|").alias("tokens")),
        "char_ngrams": lambda s, d: _norm(s, d).select("post_id", F.greatest(F.length("norm") - 4, F.lit(1)).cast("long").alias("n"), T.gram_counts("norm").alias("n_distinct")),
        "redact_pii": post(T.redact),
        "post_text": lambda s, d: posts(s, d).select("post_id", T.post_text(F.col("title"), F.col("body")).alias("out")),
        "cache_key": lambda s, d: s.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", L.cache_key(F.col("role"), "m", "p").alias("key")),
        "label_parse": lambda s, d: _answers(s, d).select("doc_id", L.parse_answer(F.col("content")).alias("a")).select("doc_id", "a.is_problem", "a.is_software_solvable", "a.is_external", F.when(F.col("a.error").isNull(), F.col("a.confidence")).alias("confidence"), F.col("a.error").isNotNull().alias("failed")),
        "block_token": lambda s, d: dedupe.token_rows(_norm(s, d)).filter(F.length("token") > 3).groupBy("token").agg(F.count("*").alias("n")).filter("n BETWEEN 2 AND 100"),
        "block_text": lambda s, d: dedupe.block_text(_norm(s, d)),
        "block_url": lambda s, d: dedupe.block_url(_norm(s, d)),
        "block_domain": lambda s, d: dedupe.domain_pairs(_norm(s, d)),
        "candidate_pairs": lambda s, d: dedupe.candidate_pairs(_norm(s, d)).select("i", "j"),
        "pair_similarity": lambda s, d: _r9(dedupe.similar_pairs(_norm(s, d), CAPPED), "similarity"),
        "duplicate_edges": lambda s, d: dedupe.duplicate_edges(dedupe.cut(_norm(s, d), "catalog-posts"), CAPPED),
        "duplicate_clusters": lambda s, d: dedupe.clusters(dedupe.cut(_norm(s, d), "catalog-posts")).select("post_id", "component"),
        "canonical_earliest": lambda s, d: _canonical(s, d).select("canonical_post_id", _joined("members"), _joined("subreddits")),
        "canonical_longest": lambda s, d: _canonical(s, d, "longest").select("canonical_post_id", _joined("members"), _joined("subreddits")),
        "id_mapping": lambda s, d: _canonical(s, d).select(F.explode("members").alias("post_id"), "canonical_post_id"),
        "dedupe_report": lambda s, d: dedupe.report(_canonical(s, d)),
        "dedupe_stats": lambda s, d: _canonical(s, d).agg(F.sum(F.size("members")).alias("total_rows"), F.count("*").alias("clusters"), (F.sum(F.size("members")) - F.count("*")).alias("duplicates_removed")),
        "drop_duplicate_urls": lambda s, d: dedupe.drop_duplicate_urls(s.read.parquet(f"{d}/pages.parquet"), "url", "page_id").select("page_id", "url"),
        "search_phrases": lambda s, d: search.matching(posts(s, d).withColumn("body", F.concat_ws(" ", "title", "body")), search.PHRASES + ("looking for software", "career advice")).select("post_id", "search_query"),
        "sample_head": lambda s, d: split.sample_head(s.read.parquet(f"{d}/pages.parquet"), "page_id").select("page_id"),
        "rule_intent": ruled("intent"),
        "rule_problem": ruled("is_problem", "problem_reason"),
        "rule_software": ruled("is_software_solvable", "software_reason"),
        "rule_external": ruled("is_external", "external_reason"),
        "rule_patterns": ruled("detected_patterns"),
        "rule_confidence": ruled("confidence"),
        "rule_classify": ruled(*R.FIELDS),
        "split_counts": lambda s, d: split.assign_splits(posts(s, d), key="post_id").groupBy("split").agg(F.count("*").alias("n")),
        "split_integrity": lambda s, d: split.assign_splits(posts(s, d).withColumn("cluster", F.col("idx") % 97), key="cluster").groupBy("cluster").agg(F.countDistinct("split").alias("splits")),
        "ensemble_vote": lambda s, d: _members(s, d).select("post_id", *[ensemble.vote(F.col("members"), f)["value"].alias(f) for f in ("intent", "is_problem", "is_external")], F.round(ensemble.vote(F.col("members"), "is_external")["score"], 9).alias("score")),
        "ensemble_disagreement": lambda s, d: _members(s, d).select("post_id", ensemble.disagreement(F.col("members"), ("intent", "is_problem", "is_external")).alias("disagreement")),
        "disagreement_summary": lambda s, d: _r9(ensemble.agreement(_members(s, d).withColumn("disagreement", ensemble.disagreement(F.col("members"), ("intent", "is_problem", "is_external"))), 0.5), "mean_disagreement", "stdev_disagreement"),
        "label_distribution": lambda s, d: _r9(evaluate.distribution(_ruled(s, d)), "half_width"),
        "eval_accuracy": lambda s, d: _r9(evaluate.accuracy(_matched(s, d)), "accuracy", "ci_low", "ci_high"),
        "eval_confusion": lambda s, d: evaluate.confusion(_matched(s, d)),
        "eval_prf": lambda s, d: _r9(evaluate.per_label(_matched(s, d)), "precision", "recall", "f1"),
        "eval_macro_f1": lambda s, d: _r9(evaluate.macro_f1(_matched(s, d)), "macro_f1"),
        "eval_drift": lambda s, d: _r9(evaluate.drift(evaluate.accuracy(m := _matched(s, d)), evaluate.accuracy(m.withColumn("pred", F.lit("1")))), "baseline_accuracy", "current_accuracy", "delta"),
        "latency_p95": lambda s, d: _r9(evaluate.latency(s.read.parquet(f"{d}/events.parquet"), "value"), "mean", "p95"),
        "resume_anti": lambda s, d: evaluate.resume(posts(s, d), s.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").cast("string").alias("post_id")), "post_id")[1].select("post_id"),
        "resume_done": lambda s, d: evaluate.resume(posts(s, d), s.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").cast("string").alias("post_id")), "post_id")[0].select("post_id"),
        "cache_join": lambda s, d: cache.probe(posts(s, d).select(F.col("post_id").alias("key")), _cache(s, d)).select("key", "value", "hit"),
        "cache_stats": lambda s, d: cache.statistics(cache.probe(posts(s, d).select(F.col("post_id").alias("key")), _cache(s, d))),
        "dead_letter": lambda s, d: _dead(s, d),
        "zero_shot": lambda s, d: _documents(s, d).select("doc_id", *[zero_shot.zero_shot(F.col("text"), t)["choice"].alias(t) for t in zero_shot.TASKS]),
        "label_posts": lambda s, d: _label_posts(s, d),
    }


def _cache(spark: SparkSession, d: str) -> DataFrame:
    entries = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").cast("string").alias("key"), (F.col("doc_id") * 10.0).alias("timestamp"), F.col("quality").cast("string").alias("value"))
    return cache.fresh(entries, 1.0, now=5000.0)


def _label_posts(spark: SparkSession, d: str) -> DataFrame:
    """Duplicates, rules and splits of all posts: the run without models."""
    return pipeline.classify(posts(spark, d).drop("idx")).rows.select("canonical_post_id", "duplicate_post_ids", *R.FIELDS)


S_ACC = S_MATCHED + ", a AS (SELECT field, count(*) AS n, avg((gold = pred)::INT::DOUBLE) AS x FROM m GROUP BY field)"
S_MARGIN = "1.96::DOUBLE * sqrt(x * (1 - x) / n)"


def oracle_sql() -> dict[str, str]:
    post = lambda e, name="out": _with_posts(f"SELECT post_id, {e} AS {name} FROM posts")
    ruled = lambda *names: _with_rules(f"SELECT post_id, {', '.join(names)} FROM ruled")
    phrases = ", ".join(_q(p) for p in (*search.PHRASES, "looking for software", "career advice"))
    disagree = "SELECT idx, count(*) FILTER (k > 1) / 3.0::DOUBLE AS disagreement FROM (SELECT idx, field, count(DISTINCT v) AS k FROM lab GROUP BY idx, field) GROUP BY idx"
    answers = """WITH c AS (SELECT doc_id, doc_id % 6 AS k, doc_id % 13 / 10.0::DOUBLE AS x FROM documents)"""
    canon = "SELECT canonical_post_id, array_to_string(members, '|') AS members, array_to_string(subreddits, '|') AS subreddits FROM canon"
    return {
        "norm_whitespace": r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS out FROM documents",
        "strip_markdown": post(s_markdown("body")),
        "strip_html": f"SELECT page_id, {s_html('html')} AS out FROM pages",
        "strip_emoji": post(_rx("body", r"\p{So}", "")),
        "remove_mentions": post(s_mentions("body")),
        "remove_crosspost": post(s_crosspost("body")),
        "remove_urls": post(s_no_urls("body")),
        "normalise_text": _with_norm("SELECT post_id, norm FROM n"),
        "extract_urls": post(f"array_to_string({s_urls('body')}, '|')", "urls"),
        "clean_urls": _with_norm("SELECT post_id, array_to_string(urls, '|') AS urls FROM n"),
        "url_domain": "SELECT page_id, regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1) AS domain, url <> '' AS valid FROM pages",
        "tokenise": _with_norm(f"SELECT post_id, array_to_string({S_TOKENS}, '|') AS tokens FROM n"),
        "char_ngrams": _with_norm("SELECT post_id, CASE WHEN length(norm) < 5 THEN 1 ELSE length(norm) - 4 END AS n, CASE WHEN length(norm) < 5 THEN 1 ELSE len(list_distinct(list_transform(range(1, length(norm) - 3), lambda k: substr(norm, k, 5)))) END AS n_distinct FROM n"),
        "redact_pii": post(_rx(_rx(_rx("body", r"[%+._0-9a-zA-Z-]+@[.0-9a-zA-Z-]+", "[redacted_email]"), r"\b\d\d\d-\d\d-\d{4}\b", "[redacted_ssn]"), r"\b\d{10}\b", "[redacted_phone]")),
        "post_text": post(S_TEXT),
        "cache_key": """SELECT conv_id, turn, sha256('{"model": "m", "prompt": "p", "text": "' || role || '"}') AS key FROM conversations""",
        "label_parse": answers + """ SELECT doc_id, CASE k WHEN 0 THEN '1' WHEN 1 THEN '1' WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN '0' ELSE '' END AS is_problem, CASE WHEN k = 5 THEN '' ELSE '1' END AS is_software_solvable,
            '' AS is_external, CASE k WHEN 4 THEN 0.8::DOUBLE WHEN 5 THEN NULL ELSE least(1.0::DOUBLE, x) END AS confidence, k = 5 AS failed FROM c""",
        "block_token": _with_norm("SELECT token, c AS n FROM bt", S_BLOCKS),
        "block_text": _with_norm("SELECT i, j FROM st WHERE i <> j", S_BLOCKS + S_STARS),
        "block_url": _with_norm("SELECT i, j FROM su WHERE i <> j", S_BLOCKS + S_STARS),
        "block_domain": _with_norm("SELECT i, j FROM dp", S_BLOCKS),
        "candidate_pairs": _with_norm("SELECT i, j FROM cand", S_BLOCKS),
        "pair_similarity": _with_norm("SELECT i, j, round(similarity, 9) AS similarity, soft FROM good", S_SCORED),
        "duplicate_edges": _with_norm("SELECT i, j FROM edges", S_EDGES),
        "duplicate_clusters": _with_norm("SELECT post_id, component FROM n JOIN comp USING (idx)", _s_whole(S_COMPONENTS), True),
        "canonical_earliest": _with_norm(canon, S_EARLIEST, True),
        "canonical_longest": _with_norm(canon, S_LONGEST, True),
        "id_mapping": _with_norm("SELECT unnest(members) AS post_id, canonical_post_id FROM canon", S_EARLIEST, True),
        "dedupe_report": _with_norm("SELECT canonical_post_id, array_to_string(members, '|') AS member_post_ids, array_to_string(subreddits, '|') AS subreddits FROM canon", S_EARLIEST, True),
        "dedupe_stats": _with_norm("SELECT sum(len(members))::BIGINT AS total_rows, count(*) AS clusters, (sum(len(members)) - count(*))::BIGINT AS duplicates_removed FROM canon", S_EARLIEST, True),
        "drop_duplicate_urls": "SELECT min(page_id) AS page_id, url FROM pages GROUP BY url",
        "search_phrases": _with_posts(f"SELECT post_id, p AS search_query FROM posts, (SELECT unnest([{phrases}]) AS p) WHERE contains(lower(title || ' ' || body), p)"),
        "rule_intent": ruled("intent"),
        "rule_problem": ruled("is_problem", "problem_reason"),
        "rule_software": ruled("is_software_solvable", "software_reason"),
        "rule_external": ruled("is_external", "external_reason"),
        "rule_patterns": ruled("detected_patterns"),
        "rule_confidence": ruled("confidence"),
        "rule_classify": ruled(*R.FIELDS),
        "split_counts": "WITH c AS (SELECT count(DISTINCT doc_id) AS n FROM documents), k AS (SELECT n, floor(n * 0.8::DOUBLE)::BIGINT AS a, floor(n * 0.1::DOUBLE)::BIGINT AS b FROM c) SELECT 'train' AS split, a AS n FROM k UNION ALL SELECT 'val', b FROM k UNION ALL SELECT 'test', n - a - b FROM k",
        "split_integrity": "SELECT DISTINCT doc_id % 97 AS cluster, 1::BIGINT AS splits FROM documents",
        "ensemble_vote": _with_rules(
            """SELECT post_id, max(v) FILTER (field = 'intent') AS intent, max(v) FILTER (field = 'is_problem') AS is_problem, max(v) FILTER (field = 'is_external') AS is_external, round(max(w) FILTER (field = 'is_external'), 9) AS score
            FROM (SELECT idx, field, v, w, row_number() OVER (PARTITION BY idx, field ORDER BY w DESC, pr, v) AS k FROM (SELECT idx, field, v, sum(w) AS w, min(pr) AS pr FROM lab WHERE v <> '' GROUP BY idx, field, v)) JOIN ruled USING (idx) WHERE k = 1 GROUP BY post_id""",
            S_MEMBERS,
        ),
        "ensemble_disagreement": _with_rules(f"SELECT post_id, disagreement FROM ({disagree}) JOIN ruled USING (idx)", S_MEMBERS),
        "disagreement_summary": _with_rules(f"SELECT round(avg(disagreement), 9) AS mean_disagreement, round(stddev_pop(disagreement), 9) AS stdev_disagreement, count(*) AS count, count(*) FILTER (disagreement >= 0.5) AS high, count(*) FILTER (disagreement < 0.5) AS low FROM ({disagree})", S_MEMBERS),
        "label_distribution": _with_rules("SELECT field, label, n, total::BIGINT AS total, round(1.96::DOUBLE * sqrt((n / total::DOUBLE) * (1 - n / total::DOUBLE) / total), 9) AS half_width FROM (SELECT *, sum(n) OVER (PARTITION BY field) AS total FROM (SELECT field, label, count(*) AS n FROM (SELECT unnest(['intent', 'is_problem', 'is_software_solvable', 'is_external']) AS field, unnest([intent, is_problem, is_software_solvable, is_external]) AS label FROM ruled) GROUP BY field, label))"),
        "eval_accuracy": _with_rules(f"SELECT field, n, round(x, 9) AS accuracy, CASE WHEN n >= 30 THEN round(greatest(0.0::DOUBLE, x - {S_MARGIN}), 9) END AS ci_low, CASE WHEN n >= 30 THEN round(least(1.0::DOUBLE, x + {S_MARGIN}), 9) END AS ci_high FROM a", S_ACC),
        "eval_confusion": _with_rules("SELECT x.field, x.x AS gold, y.x AS pred, count(m.gold) AS n FROM lb x JOIN lb y ON x.field = y.field LEFT JOIN m ON m.field = x.field AND m.gold = x.x AND m.pred = y.x GROUP BY ALL", S_PRF),
        "eval_prf": _with_rules("SELECT field, label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM f1", S_PRF),
        "eval_macro_f1": _with_rules("SELECT field, round(avg(f1), 9) AS macro_f1 FROM f1 GROUP BY field", S_PRF),
        "eval_drift": _with_rules("SELECT field, round(b, 9) AS baseline_accuracy, round(x, 9) AS current_accuracy, round(x - b, 9) AS delta FROM a JOIN (SELECT field, avg((gold = '1')::INT::DOUBLE) AS b FROM m GROUP BY field) USING (field)", S_ACC),
        "latency_p95": "WITH v AS (SELECT value, row_number() OVER (ORDER BY value) AS k, count(*) OVER () AS n, avg(value) OVER () AS mean FROM events WHERE value IS NOT NULL) SELECT n, round(mean, 9) AS mean, round(value, 9) AS p95 FROM v WHERE k = greatest(1, floor(0.95::DOUBLE * n))",
        "resume_anti": "SELECT doc_id::VARCHAR AS post_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "resume_done": "SELECT doc_id::VARCHAR AS post_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
        "cache_join": "SELECT d.doc_id::VARCHAR AS key, l.quality::VARCHAR AS value, l.doc_id IS NOT NULL AS hit FROM documents d LEFT JOIN (SELECT * FROM labels WHERE doc_id * 10.0 >= 1400.0) l ON l.doc_id = d.doc_id",
        "cache_stats": "SELECT count(l.doc_id) AS hits, count(*) - count(l.doc_id) AS misses FROM documents d LEFT JOIN (SELECT * FROM labels WHERE doc_id * 10.0 >= 1400.0) l ON l.doc_id = d.doc_id",
        "dead_letter": "SELECT doc_id AS canonical_post_id, 'Failed to parse JSON: no json' AS error FROM documents WHERE doc_id % 6 = 5",
        "label_posts": _with_norm(f"SELECT canonical_post_id, to_json(members)::VARCHAR AS duplicate_post_ids, {', '.join(R.FIELDS)} FROM canon JOIN ruled ON ruled.post_id = canonical_post_id", _s_whole(S_EARLIEST) + ", " + S_RULES, True),
    }
