"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, secrets
from tidemark.llm.chat import collapse_snapshots
from tidemark.llm.decontam import find_leaks
from tidemark.llm.exactdup import exact_duplicates
from tidemark.llm.merkle import LOWER, UPPER, merkle_manifest
from tidemark.llm.packing import pack_documents
from tidemark.llm.setjoin import jaccard_components
from tidemark.llm.shards import shard_documents
from tidemark.llm.spotsigs import fingerprint_documents
from tidemark.llm.tokencount import token_counts
from tidemark.llm.urlfilter import judge_urls
from tidemark.llm.variants import spelling_variants

#: Fixed values of the queries: the url rules, the tokenizer and the number of shards.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
TOKENIZER = "byte_bpe_50k.json"
SHARDS = 24


def reachable(spark: SparkSession) -> None:
    """Let local Python workers import this package as the driver did; on a cluster it is installed or shipped."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """A quarter of the documents, never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return langid.predict(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op2_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal conversations, rendered."""
    return collapse_snapshots(_table(spark, sf_dir, "conversations"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 5-word shingles, Jaccard of 0.8 or more."""
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of near equal bytes."""
    sharded = shard_documents(_table(spark, sf_dir, "documents"), SHARDS)
    return sharded.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and of its edited text, and how alike they are."""
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tokens of every document."""
    counted = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into pieces of power-of-two length, a sequence each."""
    packed = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=2048)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op8_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold, reworded ones too."""
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document."""
    docs = _table(spark, sf_dir, "documents")
    return secrets.scan_secrets(docs, secrets.fit(docs)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the url of every page."""
    judged = judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and whether the rows with a tampered text still fold to its root."""
    lowered = {"text": F.translate("text", UPPER, LOWER)}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle_manifest(_table(spark, sf_dir, "documents"), changed=lowered, tampered=tampered)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, and the more frequent spelling that each may stand for."""
    return spelling_variants(_table(spark, sf_dir, "documents"))


def op13_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all documents, and the row of each that stays."""
    return exact_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP10_SQL = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
         row_number() OVER () AS row
  FROM pages
), rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
  SELECT row, verdict, h || p AS rule,
         row_number() OVER (PARTITION BY row ORDER BY length(h || p) DESC, length(h) DESC) AS nth
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE nth = 1) USING (row)
"""

OP2_SQL = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations
), numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k,
         '<|' || replace(replace(coalesce(role, ''), '<\', '<\\'), '<|', '<\|') || '|>' || chr(10)
         || replace(replace(coalesce(text, ''), '<\', '<\\'), '<|', '<\|') || '<|end|>' || chr(10) AS piece
  FROM turns
), whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(piece, '' ORDER BY k) AS body FROM numbered GROUP BY conv_id
), kept AS (
  SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_copies, body FROM whole GROUP BY n_turns, body
)
SELECT conv_id, (k - 1) // 256 AS part, n_turns, n_copies, string_agg(piece, '' ORDER BY k) AS rendered
FROM kept JOIN numbered USING (conv_id)
WHERE NOT EXISTS (
  SELECT 1 FROM kept AS longer WHERE longer.n_turns > kept.n_turns AND starts_with(longer.body, kept.body)
)
GROUP BY conv_id, part, n_turns, n_copies
"""


OP11_SQL = """
WITH RECURSIVE changed AS (
  SELECT row_number() OVER () AS row, doc_id, source, lang, n_chars, text,
         xor(4294967295, list_reduce(
           [4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
           lambda c, d: list_reduce([xor(c, d), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))
         )) % 3 = 0 AS tampered,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents
), coded AS (
  SELECT row, doc_id, lang, coalesce(tampered, false) AS tampered, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(low) || ':' || low, '-') AS low
  FROM changed
), leaves AS (
  SELECT row, doc_id, lang, sha256(head || body) AS leaf, CASE WHEN tampered THEN sha256(head || low) ELSE sha256(head || body) END AS value
  FROM coded
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes AS (
  SELECT lang, 0 AS step, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT lang, step + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, step, pos // 8
), subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS step, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT step + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY step, pos // 8
), walk AS (
  SELECT row, lang, 0 AS step, pos, value, '' AS proof FROM placed
  UNION ALL
  SELECT row, w.lang, w.step + 1, w.pos // 8, sha256(string_agg(CASE WHEN s.pos = w.pos THEN value ELSE h END, '' ORDER BY s.pos)),
         proof || coalesce(string_agg(h, '' ORDER BY s.pos) FILTER (s.pos <> w.pos), '')
  FROM walk AS w JOIN nodes AS s ON s.lang IS NOT DISTINCT FROM w.lang AND s.step = w.step AND s.pos // 8 = w.pos // 8
  WHERE n > 1 GROUP BY row, w.lang, w.step, w.pos, value, proof
), ends AS (
  SELECT row, lang, arg_max(value, step) AS value, arg_max(proof, step) AS proof FROM walk GROUP BY row, lang
), climb AS (
  SELECT row, 0 AS step, pos, value, proof FROM ends JOIN subroots ON subroots.lang IS NOT DISTINCT FROM ends.lang
  UNION ALL
  SELECT row, w.step + 1, w.pos // 8, sha256(string_agg(CASE WHEN s.pos = w.pos THEN value ELSE h END, '' ORDER BY s.pos)),
         proof || coalesce(string_agg(h, '' ORDER BY s.pos) FILTER (s.pos <> w.pos), '')
  FROM climb AS w JOIN tops AS s ON s.step = w.step AND s.pos // 8 = w.pos // 8
  WHERE n > 1 GROUP BY row, w.step, w.pos, value, proof
), done AS (
  SELECT row, arg_max(value, step) AS folded_root, sha256(arg_max(proof, step)) AS proof_sha256 FROM climb GROUP BY row
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN done USING (row) JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang
CROSS JOIN (SELECT h AS root FROM tops WHERE n = 1)
"""


OP12_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), counted AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           [4294967295] || list_concat(list_transform(string_split(doc || ':', ''), lambda d: ascii(d)::BIGINT), flatten(list_transform(string_split(run, ''), lambda d:
             CASE WHEN unicode(d) < 128 THEN [unicode(d)::BIGINT] ELSE [192 + (unicode(d) >> 6)::BIGINT, 128 + (unicode(d) & 63)::BIGINT] END))),
           lambda c, d: list_reduce([xor(c, d), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))
         )) AS h
  FROM counted
), spelled AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS (
  SELECT word, n, place, substr(word, 1, place) || substr(word, place + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS place FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts AS a JOIN cuts AS b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION SELECT cuts.word, words.word, words.n FROM cuts JOIN words ON cuts.rest = words.word
  UNION SELECT words.word, cuts.word, cuts.n FROM cuts JOIN words ON cuts.rest = words.word
), near AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS best, max(near_n) AS best_n FROM pairs GROUP BY word
), judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
  FROM words LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS root, 0 AS step FROM judged
  UNION ALL SELECT chain.word, form, step + 1 FROM chain JOIN judged ON judged.word = chain.root WHERE form IS NOT NULL
)
SELECT word, form, arg_max(root, step) AS root, n, n_near, form_n FROM judged JOIN chain USING (word) GROUP BY ALL
"""

OP13_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f for f in (
            op1_language_id, op2_chat_snapshots, op3_ngram_jaccard_join, op4_histogram_shards, op5_spot_signatures,
            op6_token_counts, op7_binary_packing, op8_template_leaks, op9_secret_scan, op10_url_filter,
            op11_merkle_manifest, op12_spelling_variants, op13_exact_duplicates,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_snapshots": OP2_SQL, "op10_url_filter": OP10_SQL, "op11_merkle_manifest": OP11_SQL, "op12_spelling_variants": OP12_SQL, "op13_exact_duplicates": OP13_SQL}
