"""The queries opN_<name>: each applies its operator to its whole table and derives digest columns."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, filter_audit, mixing, packing, quality, repeats, secret_scan, sharding, simhash, token_counts, topk, toxicity, whitening
from .common import shared_dir, table, written


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.BASE_RULES]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in base]
    return found.select("doc_id", *counts, F.sha2(joined(F.filter("secrets", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def _spans_sql(place: int, kind: str, pattern: str, tested: int = 0, least: int = 0, span: int = 0) -> str:
    """A rule's matches with their starts: what the text holds before each match, matches and the pieces between them.

    The span is that group of the match, which ends where the match does.
    """
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {place} AS place, '{kind}' AS kind, length(s[i]) AS n, length(x[i]) AS tested, {least} AS least,
         sum(length(p[i]) + length(m[i])) OVER (PARTITION BY doc_id ORDER BY i) AS stop
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {tested}) AS x, regexp_extract_all(t, '{pattern}', {span}) AS s, regexp_split_to_array(t, '{pattern}') AS p FROM d),
       unnest(range(1, len(m) + 1)) AS u(i)"""


def _extra_sql(place: int, rule: secret_scan.Rule) -> str:
    """SQL's patterns can't look behind: a match there takes in the character before it, and the span is the rest."""
    if m := re.fullmatch(r"\(\?<!\[(.+?)\]\)(.+)", rule.pattern):
        return _spans_sql(place, rule.kind, f"(?:^|[^{m[1]}])({m[2]})", span=1)
    return _spans_sql(place, rule.kind, rule.pattern)


_NAMES = re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", "password|passwd|secret|token|api_?key")
OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), a AS ({" UNION ALL ".join((
    _spans_sql(0, "assign", "(" + _NAMES + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    _spans_sql(1, "access", "AKIA[A-Z0-9]+", 0, 20),
    _spans_sql(2, "hex", "[0-9a-f]+", 0, 24),
    *(_extra_sql(3 + i, rule) for i, rule in enumerate(secret_scan.EXTRA_RULES)),
))}
), s AS (SELECT *, stop - n AS start, concat(kind, ':', stop - n, ':', stop) AS span FROM a WHERE tested >= least)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (place < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, place), '') AS spans
FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id
"""


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    made = chat.format_chats(turns.unionByName(more))
    read = made.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP2_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), u AS (
  SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS merged,
         replace(replace(text, '\', '\s'), '<|', '<\|') AS te,
         replace(replace(replace(role, '\', '\s'), chr(10), '\n'), '<|', '<\|') AS re
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(te) + CASE WHEN merged THEN 10 ELSE length(re) + 24 END) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id
"""


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM p)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (SELECT doc_id, unnest(range(len(s))) AS i, unnest(s) AS s FROM (SELECT doc_id, list_transform(range(len(h) // 2 - 99), lambda i: md5(substr(h, CAST(2 * i + 1 AS BIGINT), 200))) AS s FROM d)
), again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM w) WHERE n > 1
), part AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM again
), run AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM part) GROUP BY doc_id, g
), gap AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS k0, a AS k1 FROM run
  UNION ALL SELECT d.doc_id, NULL, NULL, coalesce(m.b, 0), len(d.h) // 2 FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM run GROUP BY 1) m USING (doc_id)
)
SELECT doc_id, CAST(any_value(len(h) // 2) AS BIGINT) AS n_bytes, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed, count(a) AS n_spans,
       sha256(unhex(string_agg(substr(h, CAST(2 * k0 + 1 AS BIGINT), CAST(2 * (k1 - k0) AS BIGINT)), '' ORDER BY k0))) AS kept_sha256
FROM gap JOIN d USING (doc_id) GROUP BY doc_id
"""


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of real tokens after a load, a takedown of toxic documents, a change of the tokenizer version for
    documents that aren't English, whose counts are revised, a move of poor ones to quarantine, and a repeated load."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    (first, files), (second, other) = token_counts.vocabularies().items()
    counts = written(token_counts.encoded(docs, first, files), "token-counts")
    foreign = "lang <> 'en' or lang is null"
    recounted = written(token_counts.encoded(docs.where(foreign), second, other), "token-recounts")
    toxic = labels.where("toxic = 1").select(F.col("doc_id").alias("id"))
    poor = labels.where("quality = 0 and toxic = 0").select(F.col("doc_id").alias("id"))
    new = recounted.join(toxic, "id", "left_anti")
    now = counts.join(toxic, "id", "left_anti").where(f"not ({foreign})").unionByName(new)
    old = now.join(poor, "id", "left_semi")
    rollup = token_counts.Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}", compact=3)
    rollup.commit("load", token_counts.inserts(counts))
    rollup.commit("takedown", token_counts.deletes(counts.join(toxic, "id", "left_semi")))
    rollup.commit("version", token_counts.revisions(counts.join(toxic, "id", "left_anti").where(foreign), new))
    rollup.commit("quarantine", token_counts.revisions(old, old.withColumn("source", F.lit("quarantine"))))
    rollup.commit("load", token_counts.inserts(counts))
    return rollup.totals()


def token_rollup_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over patterns that SQL has, too: a load, a takedown of toxic documents, a move of poor ones
    to quarantine, and a repeated load."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    counts = written(token_counts.counted(docs), "token-counts")
    toxic = labels.where("toxic = 1").select(F.col("doc_id").alias("id"))
    poor = labels.where("quality = 0 and toxic = 0").select(F.col("doc_id").alias("id"))
    taken, old = (counts.join(x, "id", "left_semi") for x in (toxic, poor))
    rollup = token_counts.Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    rollup.commit("load", token_counts.inserts(counts))
    rollup.commit("takedown", token_counts.deletes(taken))
    rollup.commit("quarantine", token_counts.revisions(old, old.withColumn("source", F.lit("quarantine"))))
    rollup.commit("load", token_counts.inserts(counts))
    return rollup.totals()


ROLLUP_SQL = r"""
WITH toxic AS (SELECT doc_id FROM labels WHERE toxic = 1), poor AS (SELECT doc_id FROM labels WHERE quality = 0 AND toxic = 0), d AS (
  SELECT CASE WHEN doc_id IN (FROM poor) THEN 'quarantine' ELSE source END AS source, lang,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w, len(regexp_extract_all(text, '[0-9A-Za-z]+|[^0-9A-Za-z\x20\x09-\x0D]')) AS p
  FROM documents WHERE doc_id NOT IN (FROM toxic)
), c AS (SELECT source, lang, 'words-1' AS tokenizer, w AS n FROM d UNION ALL SELECT source, lang, 'pieces-1', p FROM d)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n_tokens FROM c GROUP BY ALL
"""


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h FROM documents
), x AS (SELECT d.*, t.depth, h >> (60 - t.depth) AS prefix FROM d, (SELECT CAST(range AS INTEGER) AS depth FROM range(61)) t
), b AS (SELECT depth, prefix, sum(n_bytes) AS bytes, count(*) AS docs FROM x GROUP BY ALL
), leaf AS (SELECT x.doc_id, min(depth) AS depth FROM x JOIN b USING (depth, prefix) WHERE bytes <= 1048576 OR docs = 1 OR depth = 60 GROUP BY x.doc_id)
SELECT x.doc_id, CAST(x.n_bytes AS BIGINT) AS n_bytes, substr(lpad(bin(x.h), 60, '0'), 1, x.depth) AS shard, x.depth, CAST(0 AS BIGINT) AS page, CAST(b.bytes AS BIGINT) AS shard_bytes
FROM leaf JOIN x USING (doc_id, depth) JOIN b USING (depth, prefix)
"""


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(table(spark, sf_dir, "documents"), measures=True)
    return found.select("doc_id", *quality.MEASURES, "base_failed", "kept")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
), g AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) AS u(i)
), twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1
), again AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(5) AS v(j) GROUP BY 1
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM d LEFT JOIN again USING (doc_id)
), f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT 2 * n_symbols > n_words AND word_chars BETWEEN 2 * n_words AND 20 * n_words AND NOT 2 * n_dup_lines > n_lines AS kept
FROM f
"""


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d
), l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), g AS (
  SELECT part, list_concat(CASE WHEN a THEN ['A'] ELSE [] END, CASE WHEN b THEN ['B'] ELSE [] END, CASE WHEN c THEN ['C'] ELSE [] END,
                           CASE WHEN d THEN ['D'] ELSE [] END, CASE WHEN e THEN ['E'] ELSE [] END) AS failed,
         count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), o AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5
), k AS (SELECT filter_order, CAST(range AS INTEGER) AS step, filter_order[range] AS f, string_split(filter_order[1 : range - 1], '') AS before FROM o, range(1, 6)
), s AS (
  SELECT part, filter_order, step, f, n, n_good, n_toxic, failed, list_contains(failed, f) AS fails, step > 1 AND len(list_intersect(failed, before)) > 0 AS gone FROM g, k
), r AS (
  SELECT part, filter_order, step, f,
         CAST(coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (fails AND gone), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (fails AND len(failed) = 1), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n_good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(n_toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r
"""


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_chat_format,
        op3_top_k,
        op4_packing,
        op5_source_mix,
        op6_repeats,
        op7_token_counts,
        op8_sharding,
        op9_simhash_near_dedup,
        op10_quality_rules,
        op11_filter_audit,
        op12_toxicity,
        op13_embedding_whitening,
    )
}
ORACLES = {"op1_secret_scan": OP1_SQL, "op2_chat_format": OP2_SQL, "op3_top_k": OP3_SQL, "op6_repeats": OP6_SQL, "op8_sharding": OP8_SQL, "op10_quality_rules": OP10_SQL, "op11_filter_audit": OP11_SQL}
#: Operators once more, over what SQL can express.
MORE_QUERIES = {"token_rollup_words": token_rollup_words}
MORE_ORACLES = {"token_rollup_words": ROLLUP_SQL}
