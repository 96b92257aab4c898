"""The thin ``opN_*`` queries: production parameters, whole tables, the contracts' columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, divergence, exact, langid, mixing, quality, rules, simhash, substrings, tokens, toxicity, trie
from .common import fold, table

def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels, fold(F.col("doc_id"), 5) != 0)
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return quality.classify(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    categories = {"toxic_prose": toxic & good, "toxic_junk": toxic & ~good, "toxic": toxic}
    chain = toxicity.learn(docs, labels, categories, fold(F.col("doc_id"), 5) != 0)
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return toxicity.score(docs, chain).withColumn("held_out", held)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, profile = langid.prototypes(docs, fold(F.col("doc_id"), 4) != 2)
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return langid.identify(docs, langs, profile).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return rules.judge(table(spark, sf_dir, "documents"), trusted)


def chat_digest(out: DataFrame) -> DataFrame:
    spans = F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",")
    return out.select("conv_id", "piece", "perspective", "n_turns", "n_trained", "trained_chars", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"), spans.alias("spans"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digest(chat.rotate(table(spark, sf_dir, "conversations")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.build(*trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality, op2_toxicity, op3_language, op4_simhash, op5_tokens, op6_substrings, op7_mixing, op8_rules, op9_chat, op10_decontaminate, op11_trie, op12_exact, op13_divergence)}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\f\r]+'), lambda w: w <> '')"

ORACLE_SQL: dict[str, str] = {
    "op6_substrings": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i AS p0, md5(array_to_string(w[i : i + 19], ' ')) AS k FROM d, unnest(range(1, len(w) - 18)) AS u(i) WHERE len(w) >= 20),
rep AS (SELECT doc_id, p0 FROM (SELECT doc_id, p0, row_number() OVER (PARTITION BY k ORDER BY doc_id, p0) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, p FROM rep, unnest(range(p0, p0 + 20)) AS u(p)),
word AS (SELECT doc_id, i AS p, w[i] AS x FROM d, unnest(range(1, len(w) + 1)) AS u(i)),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY word.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op7_mixing": rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
 CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source) AS k, sum(source_size * 1.5::DOUBLE) OVER () AS total FROM r),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM o),
level AS (SELECT coalesce(min(lvl) FILTER (WHERE lvl < cap / weight), max(cap / weight)) AS level FROM l
 WHERE k = coalesce((SELECT min(k) FROM l WHERE lvl < cap / weight), (SELECT max(k) FROM l))),
t AS (SELECT source, source_size, least(cap, level * weight) AS target, round(least(cap, level * weight))::BIGINT AS budget FROM l, level),
p AS (SELECT d.*, source_size, target, budget, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs,
 coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target, (epochs * size + greatest(0, least(size, budget - epochs * source_size - ahead)))::BIGINT AS taken FROM p""",
    "op9_chat": r"""
WITH c AS (SELECT conv_id, role, body, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, body) AS k FROM (SELECT conv_id, coalesce(turn, 0) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS body FROM conversations)),
s AS (SELECT DISTINCT conv_id AS c, role AS perspective FROM c WHERE role <> 'system'),
m AS (SELECT conv_id, perspective, k, body, role = perspective AS own,
 '<|' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE 'user name=' || role END || '|>' || chr(10) AS head
 FROM c JOIN s ON c.conv_id IS NOT DISTINCT FROM s.c),
n AS (SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective ORDER BY k ROWS UNBOUNDED PRECEDING) AS stop FROM m)
SELECT conv_id, 0::BIGINT AS piece, perspective, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_trained,
 coalesce(sum(length(body) + 1) FILTER (WHERE own), 0)::BIGINT AS trained_chars, sum(length(head) + length(body) + 1)::BIGINT AS n_chars,
 md5(string_agg(head || body || chr(10), '' ORDER BY k)) AS text_md5,
 coalesce(string_agg((stop - length(body) - 1)::BIGINT::VARCHAR || '-' || stop::BIGINT::VARCHAR, ',' ORDER BY k) FILTER (WHERE own), '') AS spans
FROM n GROUP BY conv_id, perspective""",
    "op10_decontaminate": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS k FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, i AS p0, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM d, (SELECT DISTINCT n FROM bw) AS l, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
hits AS (SELECT doc_id, p0, n, item FROM dw JOIN bw USING (n, k)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(p0, p0 + n)) AS u(p) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN g ON d.doc_id = g.doc_id""",
    "op11_trie": r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS body, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({'role': role, 'body': body} ORDER BY k) AS s FROM t GROUP BY c),
crc AS (SELECT c, xor(list_reduce(flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END, 4294967295::BIGINT), 4294967295) % 4 AS h FROM own),
h AS (SELECT own.c, own.s, b.s AS bs, crc.h FROM own LEFT JOIN own AS b ON b.c = own.c - own.c % 20 JOIN crc ON crc.c = own.c),
r AS (SELECT c, list_concat(coalesce(bs[1 : h], []), s[h + 1 :]) AS s FROM h),
m AS (SELECT c, d, s[d]['body'] AS body, len(s) = d AS ends, md5(to_json(s[1 : d])::VARCHAR) AS key FROM r, unnest(range(0, len(s) + 1)) AS u(d)),
n AS (SELECT d, key, count(*) AS n_convs, min(c) AS conv_id, any_value(len(list_filter(regexp_split_to_array(coalesce(body, ''), '[ \t\n\x0b\f\r]+'), lambda w: w <> ''))) AS w, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM m GROUP BY d, key),
e AS (SELECT DISTINCT a.d AS d, a.key AS key, b.key AS up FROM m AS a JOIN m AS b ON a.c = b.c AND b.d = a.d - 1),
f AS (SELECT up AS key, count(*) AS n_children FROM e GROUP BY up),
x AS (SELECT n.d, n.key, b.d AS d_up, b.key AS up, (n.n_convs - 1) * n.w AS saved, (f.key IS NULL)::BIGINT AS leaf FROM n LEFT JOIN f ON f.key = n.key JOIN m AS b ON b.c = n.conv_id AND b.d <= n.d),
y AS (SELECT d_up AS d, up AS key, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM x GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children, y.n_leaves, y.saved_tokens, n.ends_sha256
FROM n JOIN y ON y.d = n.d AND y.key = n.key LEFT JOIN f ON f.key = n.key LEFT JOIN e ON e.d = n.d AND e.key = n.key LEFT JOIN n AS p ON p.d = e.d - 1 AND p.key = e.up""",
    "op12_exact": r"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM d""",
    "op13_divergence": r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
k AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 10),
o AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN o USING (lang, source) GROUP BY ALL),
v AS (SELECT lang, sum(total)::HUGEINT AS total, (SELECT count(*) FROM k WHERE k.lang = g.lang)::HUGEINT AS v FROM g GROUP BY lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 2)) // (g.total + 2 * v.v) AS p FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(p.n)::HUGEINT + 2)) // (any_value(v.total) + 2 * any_value(v.v)) AS q FROM p JOIN v USING (lang) GROUP BY lang, term),
pr AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pr ON pr.lang = a.lang AND pr.source = a.source AND pr.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL SELECT lang, source, 'term', item, value::BIGINT, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM terms QUALIFY rank <= 10""",
}
