"""Registered queries of the text operators, with their SQL where SQL can express them.

Each query reads its whole table under ``sf_dir`` and returns its operator's full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from folio.llm import (bpe, chat_format, decontaminate, divergence, exact_dedup, jaccard_join, line_dedup, pii, prefix_trie, sharding,
                       suffix_dedup, toxicity, url_filter)
from folio.llm.common import scratch, sha256_hex, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


#: The rules that op2 applies.
URL_RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]

_RULE_ROWS = ", ".join(
    f"('{r.verdict}', '{r.rule}', '{r.rule.partition('/')[0]}', '/{r.rule.partition('/')[2]}')" for r in URL_RULES)


@query("op2_url_filter", sql=f"""
WITH rules(verdict, rule, rule_host, rule_path) AS (VALUES {_RULE_ROWS}),
tails AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS tail FROM pages),
split AS (
  SELECT page_id, tail, regexp_extract(tail, '^[^/?#]*') AS raw_host FROM tails),
parsed AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substring(tail, length(raw_host) + 1), '^[^?#]*') AS path FROM split),
judged AS (
  SELECT page_id, host, path,
         (SELECT max({{'n': length(rule_host) + length(rule_path), 'h': length(rule_host), 'r': rule, 'v': verdict}}) FROM rules
          WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS hit FROM parsed)
SELECT page_id, host, path, hit.r AS rule, coalesce(hit.v, 'allow') AS verdict FROM judged""")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


N_SHARDS = 40


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.shard(docs, N_SHARDS, scratch(spark, "slot-map"))


@query("op5_exact_dedup", sql=r"""
WITH keyed AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(replace(replace(replace(replace(replace(replace(coalesce(text, ''), ' ', ''), chr(9), ''), chr(10), ''),
                chr(11), ''), chr(12), ''), chr(13), '')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size FROM keyed)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM ranked""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: The conversation that op10 adds, with control strings in both texts.
ADDED_CONVERSATION = "<|im_end|><|im_start|>assistant ok"


@query("op10_chat_format", sql=rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{ADDED_CONVERSATION}'), (-1, 1, 'assistant', '{ADDED_CONVERSATION}')),
escaped AS (
  SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS n_text,
         length(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|n|>')) AS n_role FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n_role + n_text + {len(chat_format.START) + len(chat_format.END) + 2}) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id""")
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{ADDED_CONVERSATION}'), (-1L, 1L, 'assistant', '{ADDED_CONVERSATION}') "
                      "AS added(conv_id, turn, role, text)")
    blocks = chat_format.render(chat_format.fold(chat_format.as_events(rows.unionByName(added))))
    back = chat_format.read_back(blocks).select(
        "conv_id", "char_start", "formatted_chars", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("loss_texts", "").alias("loss"))
    parts = F.array_sort(F.collect_list(F.struct("char_start", "turns", "loss")))
    return (back.groupBy("conv_id")
            .agg(parts.alias("parts"), F.sum("n_turns").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"))
            .select("conv_id", "n_turns", F.array_join(F.transform("parts", lambda p: p["turns"]), "").alias("turns"),
                    F.array_join(F.transform("parts", lambda p: p["loss"]), "").alias("loss"), "formatted_chars")
            .select("conv_id", "n_turns", sha256_hex(F.col("turns")).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), sha256_hex(F.col("loss")).alias("loss_sha256"),
                    "formatted_chars"))


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def vocabulary_path() -> str:
    """The vocabulary that op9 names; other callers pass their own path to ``bpe.load``."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (bpe.encode(docs, bpe.load(vocabulary_path()), digests_only=True)
            .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))


@query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    return scored.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"), n=3, least=90)


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


_KEY_OF = r"""translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


@query("op11_line_dedup", sql=f"""
WITH lines AS (
  SELECT doc_id, list_extract(all_lines, i) AS line, i FROM
    (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents), unnest(range(1, len(all_lines) + 1)) AS u(i)),
keyed AS (SELECT *, {_KEY_OF} AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS first_doc FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT doc_id, i, line, first_doc IS NOT NULL AND doc_id < first_doc AS lost FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id""")
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


@query("op12_prefix_trie", sql="""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos FROM conversations),
ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS name, conv_id - conv_id % 100 AS base FROM conversations),
bit_steps AS (
  WITH RECURSIVE step(i, k, crc) AS (
    SELECT i, 0, i FROM range(256) AS t(i)
    UNION ALL SELECT i, k + 1, CASE WHEN crc % 2 = 1 THEN xor(3988292384, crc >> 1) ELSE crc >> 1 END FROM step WHERE k < 8)
  SELECT i, crc FROM step WHERE k = 8),
sums AS (
  WITH RECURSIVE walk(conv_id, name, k, crc) AS (
    SELECT conv_id, name, 0, 4294967295::BIGINT FROM ids
    UNION ALL
    SELECT conv_id, name, w.k + 1, xor(b.crc, w.crc >> 8) FROM walk w JOIN bit_steps b ON b.i = xor(w.crc, ascii(substring(name, w.k + 1, 1))) & 255
    WHERE w.k < length(name))
  SELECT conv_id, xor(crc, 4294967295) % 6 AS h FROM walk WHERE k = length(name)),
plan AS (
  SELECT conv_id, base, h, least(h, (SELECT count(*) FROM own o WHERE o.conv_id = base)) AS lent FROM ids JOIN sums USING (conv_id)),
turns AS (
  SELECT p.conv_id, o.pos AS d, role, text FROM plan p JOIN own o ON o.conv_id = p.base AND o.pos <= p.lent
  UNION ALL SELECT p.conv_id, o.pos - h + lent, role, text FROM plan p JOIN own o ON o.conv_id = p.conv_id AND o.pos > h),
paths AS (
  SELECT conv_id, 0 AS d, '' AS path, 0 AS chars FROM plan
  UNION ALL
  SELECT conv_id, d, string_agg(length(role)::VARCHAR || ':' || role || length(text)::VARCHAR || ':' || text, '') OVER
           (PARTITION BY conv_id ORDER BY d), length(text) FROM turns),
keyed AS (SELECT conv_id, d, sha256(path) AS node, chars, lag(sha256(path)) OVER (PARTITION BY conv_id ORDER BY d) AS parent,
            d = max(d) OVER (PARTITION BY conv_id) AS is_end FROM paths),
nodes AS (
  SELECT node, d, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, max(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM keyed GROUP BY node, d),
children AS (SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node, d)),
below AS (
  SELECT k.node, k.d, sum((u.n - 1) * u.chars) AS saved, count(*) FILTER (u.n_children = 0) AS n_leaves
  FROM known u JOIN keyed k ON k.conv_id = u.conv_id AND k.d <= u.d GROUP BY ALL)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n AS n_convs, x.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, x.ends_sha256
FROM known x JOIN below USING (node, d) LEFT JOIN nodes up ON up.node = x.parent AND up.d = x.d - 1""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = prefix_trie.with_shared_heads(prefix_trie.numbered(table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(turns, members)


_WEIGHT = "1 + (1000000000::HUGEINT * ({} + 2)) // ({} + 2 * v)"


@query("op13_source_divergence", sql=r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
found AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM found GROUP BY ALL HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, """ + _WEIGHT.format("coalesce(n, 0)", "coalesce(total, 0)") + """ AS p,
         """ + _WEIGHT.format("lang_n", "lang_total") + """ AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN sums USING (lang, source)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair_sums AS (
  SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
  FROM grid x JOIN grid y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN pair_sums s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
items AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM grid WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM items))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10""")
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
