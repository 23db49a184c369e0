"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockmetrics.llm.bpe import bpe_round_trip
from dockmetrics.llm.common import read, ship_package
from dockmetrics.llm.conversation_trie import conversation_turns, prefix_trie, with_shared_heads
from dockmetrics.llm.decontamination import decontaminate
from dockmetrics.llm.exact_dedup import exact_dedup
from dockmetrics.llm.language_id import fit_language_model, held_out, language_column
from dockmetrics.llm.quartile_digest import compare_with_next
from dockmetrics.llm.secret_scan import joined_spans, secret_scan
from dockmetrics.llm.sharding import shard_documents
from dockmetrics.llm.simhash_dedup import simhash_dedup
from dockmetrics.llm.token_store import lookup, write_token_store
from dockmetrics.llm.url_filter import rules_frame, url_filter
from dockmetrics.llm.vector_codes import compress_vectors
from dockmetrics.llm.warc import plan_records, read_warc, write_warc
from dockmetrics.session import shared_folder


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("row_hash").withColumn("similarity", F.round("similarity", 6))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter(read(spark, sf_dir, "pages"), rules_frame(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secret_scan(read(spark, sf_dir, "documents"))
    base = ("assign", "access", "hex")
    return spans.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans((*base, "entropy")).alias("spans"),
    )


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = shared_folder(spark, "token-store")
    manifest = write_token_store(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return lookup(manifest, folder, docs.select("doc_id")).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    index = write_warc(plan_records(read(spark, sf_dir, "pages")), folder)
    records = read_warc(index, folder, keep_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit_language_model(docs.filter(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), language_column(model).alias("found"))
    return rows.select("doc_id", "held_out", "found.*")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(read(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(read(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = with_shared_heads(conversation_turns(read(spark, sf_dir, "conversations")))
    return prefix_trie(turns, convs)


def _shipping(query):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    return {
        name: _shipping(query)
        for name, query in sorted(globals().items())
        if name.startswith("op") and name[2].isdigit()
    }


OP2_SQL = """
WITH u AS (
    SELECT page_id,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), h AS (
    SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u
), p AS (
    SELECT page_id,
           translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM h
), rules(verdict, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
    SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           max_by(verdict, length(rule_host || rule_path)) AS verdict
    FROM p JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN fits USING (page_id)
"""

OP6_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), r AS (
    SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS response
    FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM r
"""

OP10_SQL = """
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+', '', 'g')) AS text_sha256
    FROM documents
), r AS (
    SELECT *, first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""


def _assigned_sql(name: str, book: str) -> str:
    """Every part with its nearest entry of a codebook table, ties to the lower index."""
    return f"""{name} AS (
    SELECT vec_id, label, p, any_value(x) AS x, min(ROW(d, e)) AS best
    FROM (SELECT vec_id, label, p, e, part.x AS x,
                 list_sum(list_transform(list_zip(part.x, {book}.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
          FROM part JOIN {book} USING (p))
    GROUP BY vec_id, label, p
)"""


def _book_sql(name: str, assigned: str, before: str) -> str:
    """Each entry replaced by the componentwise floor of its parts' mean, if it has any."""
    return f"""{name} AS (
    SELECT p, e, coalesce(m.c, b.c) AS c FROM {before} AS b LEFT JOIN (
        SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS c
        FROM (SELECT p, best[2] AS e, j, sum(x[j]) AS s, count(*) AS n
              FROM {assigned}, (SELECT unnest(range(1, 65)) AS j) WHERE j <= len(x) GROUP BY p, best[2], j)
        GROUP BY p, e) AS m USING (p, e)
)"""


OP12_SQL = f"""
WITH kept AS (
    SELECT vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS (
    SELECT vec_id, label, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x
    FROM kept, (SELECT unnest(range(16)) AS p)
), book0 AS (
    SELECT p, e, x AS c FROM part JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64) USING (vec_id)
), {_assigned_sql("a0", "book0")}, {_book_sql("book1", "a0", "book0")},
{_assigned_sql("a1", "book1")}, {_book_sql("book2", "a1", "book1")},
{_assigned_sql("a2", "book2")}, coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code,
           CAST(sum(best[1]) AS BIGINT) AS error
    FROM a2 GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded
"""

#: CRC-32 of a decimal number, bit by bit: DuckDB has no function for it.
_CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(CAST(conv_id AS VARCHAR), ''),
    lambda ch: list_transform(range(8), lambda i: (ascii(ch) >> i) & 1)))),
    lambda crc, bit: xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1))))"""

OP13_SQL = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), c AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32_SQL} % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM t)
), rebuilt AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY own, pos) AS turns FROM (
        SELECT c.conv_id, 0 AS own, t.pos, role, text FROM c JOIN t ON t.conv_id = c.base WHERE t.pos < h
        UNION ALL
        SELECT c.conv_id, 1, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.pos >= h)
    GROUP BY conv_id
), path AS (
    SELECT conv_id, depth, turns[1:depth] AS prefix, length(turns[depth].text) AS chars,
           depth = len(turns) AS ended
    FROM (SELECT c.conv_id, coalesce(turns, []) AS turns, unnest(range(coalesce(len(turns), 0) + 1)) AS depth
          FROM c LEFT JOIN rebuilt USING (conv_id))
), node AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n, coalesce(any_value(chars), 0) AS chars,
           bool_and(ended) AS leaf,
           sha256(coalesce(string_agg(CASE WHEN ended THEN conv_id END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM path GROUP BY depth, prefix
), up AS (
    SELECT node.*, path.depth AS above, path.prefix AS above_prefix
    FROM node JOIN path ON path.conv_id = node.conv_id AND path.depth <= node.depth
), subtree AS (
    SELECT above AS depth, above_prefix AS prefix, count(*) FILTER (leaf) AS n_leaves,
           count(*) FILTER (depth = above + 1) AS n_children, sum((n - 1) * chars) AS saved_tokens
    FROM up GROUP BY above, above_prefix
)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n AS n_convs, n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN subtree ON node.depth = subtree.depth AND node.prefix = subtree.prefix
LEFT JOIN up ON up.conv_id = node.conv_id AND up.depth = node.depth AND up.above = node.depth - 1
LEFT JOIN node AS parent ON parent.depth = up.above AND parent.prefix = up.above_prefix
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": OP2_SQL,
        "op6_warc": OP6_SQL,
        "op10_exact_dedup": OP10_SQL,
        "op12_vector_codes": OP12_SQL,
        "op13_conversation_trie": OP13_SQL,
    }
