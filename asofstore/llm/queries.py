"""Registered queries of the training-data operators and their DuckDB SQL.

Every query applies its operator with production parameters to its whole
intended table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (chat, codes, decontaminate, embedding, fim, language, minhash, packing, rollups, sharding, substring,
               toxicity, warc)
from .common import read, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARIES = {"byte_bpe_50k": public_tokenizers.path("byte_bpe_50k.tiktoken"),
                     "byte_bpe_multi_50k": public_tokenizers.path("byte_bpe_multi_50k.tiktoken")}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def fold(divisor: int) -> Column:
    """crc32(doc_id as text) modulo ``divisor``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@register("op1_language_mixture")
def op1_language_mixture(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(fold(4) == 2, F.lit(False))
    model = language.fit(docs, (fold(4) != 2))
    found = language.identify(docs.select("doc_id", "text"), model, keep_text=False)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", F.to_json("languages").alias("languages"))


@register("op2_embedding_near_dedup", r"""
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good AS a JOIN good AS b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = reach.vec_id) AS n_links, min(other) AS component_id,
       vec_id = min(other) AS kept
FROM reach GROUP BY vec_id""")
def op2_embedding_near_dedup(spark, sf_dir):
    return embedding.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.9)


@register("op3_substring_dedup", r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS ws FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 48)) AS st,
         unnest(list_transform(range(1, len(ws) - 48), lambda i: md5(array_to_string(ws[i:i + 49], ' ')))) AS h
  FROM w WHERE len(ws) >= 50),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(st, st + 50)) AS pos
  FROM windows JOIN (SELECT h, min(doc_id) AS own FROM windows GROUP BY h) USING (h) WHERE own < doc_id),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       coalesce((SELECT count(*) FROM gone WHERE gone.doc_id = w.doc_id), 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""")
def op3_substring_dedup(spark, sf_dir):
    return substring.digests(read(spark, sf_dir, "documents"), window=50)


@register("op4_histogram_sort_shards")
def op4_histogram_sort_shards(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    sharded = sharding.shard_by_bytes(docs, shards=24)
    return sharded.select(
        "doc_id", "size", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# Both texts of this conversation look like control strings.
ODD_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@register("op5_chat_format", r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, r || x AS rx,
         regexp_matches(r, '</s>|\[INST\]|\[/INST\]|\\[bla]') OR regexp_matches(x, '</s>|\[INST\]|\[/INST\]|\\[bla]')
         AS odd FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
       CAST(coalesce(sum(length(x)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(17 + length(r) + length(x) + CASE WHEN odd THEN length(regexp_replace(rx, '[^\\\[<]', '', 'g'))
                ELSE 0 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op5_chat_format(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_CONVERSATION, turns.schema)
    return chat.digests(chat.format_conversations(turns.union(odd)))


@register("op6_toxicity_distance")
def op6_toxicity_distance(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(*toxicity.training_sample(docs, labels, fold(3) != 1, sample=2000, longest=20_000))
    held = F.coalesce(fold(3) == 1, F.lit(False))
    return toxicity.score(docs, model, cut=0.7).select(
        "doc_id", held.alias("held_out"), "score", "predicted", "toxic_windows", "n_windows")


@register("op7_token_rollups")
def op7_token_rollups(spark, sf_dir):
    """Load, delete exact copies, recount other languages with a second
    vocabulary, and repeat the last two commits, which must change nothing."""
    base, multi = BYTE_VOCABULARIES
    counted = stage(rollups.count_tokens(
        read(spark, sf_dir, "documents"), BYTE_VOCABULARIES, public_tokenizers.PATTERN,
        only={multi: lambda lang: lang != "en"}), "rollup-counts")
    first = counted.groupBy("_k1", "_k2").agg(F.min("_id").alias("_first"))
    ledger = stage(counted.join(first, ["_k1", "_k2"]).withColumn("_copy", F.coalesce(F.col("_id") > F.col("_first"),
                                                                                     F.lit(False))), "rollup-ledger")
    recounted = ledger.where(f"NOT _copy AND {multi} IS NOT NULL")
    batches = {"0-load": rollups.signed(ledger, base, 1),
               "1-copies": rollups.signed(ledger.where("_copy"), base, -1),
               "2-recount": rollups.signed(recounted, base, -1).union(rollups.signed(recounted, multi, 1))}
    totals = rollups.Rollup(spark, scratch_dir(spark, "llm-rollup"))
    for batch_id in [*batches, "1-copies", "2-recount"]:
        totals.commit(batch_id, batches[batch_id])
    return totals.totals()


@register("op8_vector_packing")
def op8_vector_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), WORD_TOKENIZER, end_id=2, tokens=4096)


@register("op9_template_decontamination")
def op9_template_decontamination(spark, sf_dir):
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op10_minhash_near_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS s FROM w),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
parts AS (SELECT doc_id, md5(unnest(s)) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM parts AS a JOIN parts AS b USING (x)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b
  WHERE 100 * m >= 80 * (p.n + q.n - m)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN comp USING (doc_id)""")
def op10_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), k=4, percent=80)


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Codebooks and codes by comparing every part with every entry, a pair of CTEs per round."""
    nearest = ("SELECT x.rid, x.p, any_value(x.v) AS v, min({{'d': list_sum(list_transform(range(1, len(x.v) + 1),"
               " lambda i: (x.v[i] - b.c[i]) * (x.v[i] - b.c[i]))), 'e': b.e}}) AS best"
               " FROM parts AS x JOIN book{0} AS b ON b.p = x.p GROUP BY x.rid, x.p")
    ctes = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""parts AS MATERIALIZED (
  SELECT rid, p, q[p * len(q) // {parts} + 1 : (p + 1) * len(q) // {parts}] AS v FROM kept, range({parts}) AS r(p))""",
            f"book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, v AS c FROM parts WHERE rid <= {entries})"]
    for k in range(rounds):
        ctes += [f"near{k} AS MATERIALIZED ({nearest.format(k)})",
                 f"""mean{k} AS MATERIALIZED (
  SELECT p, e, list((s - ((s % n + n) % n)) // n ORDER BY i) AS c FROM (
    SELECT p, e, i, sum(x) AS s, count(*) AS n FROM (
      SELECT p, best.e AS e, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM near{k}) AS u
    GROUP BY p, e, i) AS m GROUP BY p, e)""",
                 f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} AS b LEFT JOIN mean{k} AS m ON m.p = b.p AND m.e = b.e)"""]
    ctes += [f"final AS MATERIALIZED ({nearest.format(rounds)})",
             """coded AS (
  SELECT vec_id, label, code, error FROM kept JOIN (
    SELECT rid, string_agg(lower(printf('%02x', best.e)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM final GROUP BY rid) AS f USING (rid))""",
             f"""book AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM (
    SELECT p, e, unnest(range(1, len(c) + 1)) AS i, unnest(c) AS x FROM book{rounds}) AS u)"""]
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, book"""


@register("op11_equal_average_codes", _codes_sql())
def op11_equal_average_codes(spark, sf_dir):
    return codes.compress(read(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096).drop("n_compared")


@register("op12_fill_in_middle", r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS x, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s
  FROM documents),
k AS (
  SELECT *, CAST('0x' || substr(s, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(s, 9, 8) AS BIGINT) % (n + 1) AS b,
    CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>')
              OR CAST('0x' || substr(s, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
         WHEN CAST('0x' || substr(s, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (
  SELECT *, substr(x, 1, least(a, b)) AS pre, substr(x, least(a, b) + 1, abs(a - b)) AS mid,
         substr(x, greatest(a, b) + 1) AS suf FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE x END) AS output_sha256,
  sha256(x) AS restored_sha256
FROM c""")
def op12_fill_in_middle(spark, sf_dir):
    return fim.digests(fim.transform(read(spark, sf_dir, "documents"), seed=1))


@register("op13_warc_index", r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         coalesce(html, '') AS x FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS owner FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM g""")
def op13_warc_index(spark, sf_dir):
    return warc.round_trip(read(spark, sf_dir, "pages"), least_bytes=0).drop("url")
