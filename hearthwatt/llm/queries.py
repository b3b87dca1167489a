"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthwatt.llm.bpe import bpe_digests
from hearthwatt.llm.fingerprint import fingerprints_with_edits
from hearthwatt.llm.htmltext import extract_text
from hearthwatt.llm.linededup import dedup_lines
from hearthwatt.llm.merkle import merkle_manifest
from hearthwatt.llm.neighbours import nearest
from hearthwatt.llm.packing import pack_documents
from hearthwatt.llm.quality import score_quality
from hearthwatt.llm.sharding import shard_documents
from hearthwatt.llm.simhash import simhash_components
from hearthwatt.llm.toxicity import score_toxicity, train_toxicity
from hearthwatt.llm.warc import warc_revisits
from hearthwatt.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary files; pass others to the operators themselves.
PACKING_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PACKING_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CODEC_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_with_edits(table(spark, sf_dir, "documents"))


def op2_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), PACKING_TOKENIZER, PACKING_RANKS, capacity=2048)


def op3_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = train_toxicity(documents, table(spark, sf_dir, "labels"))
    return score_toxicity(documents, model)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), CODEC_RANKS)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), top=20, every=20)


def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source stands for its host, its language for the path on it."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_quality(documents, labels, lambda: F.col("source"), lambda: F.col("lang"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisits(table(spark, sf_dir, "pages"))


def op9_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "lines", "lines_removed")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op11_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), top=16)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


def op13_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=40)


QUERIES: dict[str, Query] = {
    "op1_closed_syncmers": op1_closed_syncmers,
    "op2_best_two_fit": op2_best_two_fit,
    "op3_toxic_segments": op3_toxic_segments,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_simhash": op5_simhash,
    "op6_nn_descent": op6_nn_descent,
    "op7_site_quality": op7_site_quality,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_line_windows": op9_line_windows,
    "op10_main_text": op10_main_text,
    "op11_exact_whitening": op11_exact_whitening,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_best_fit_shards": op13_best_fit_shards,
}

#: Line dedup, also used by the SQL of the pipeline: {source} is a table of documents.
LINE_WINDOWS_SQL = """
lined AS (
    SELECT doc_id, string_split(text, chr(10)) AS lines FROM {source}
),
windows AS (
    SELECT doc_id, place,
        lines[place + 1] || chr(10) || lines[place + 2] || chr(10) || lines[place + 3] AS passage
    FROM (SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS place FROM lined WHERE len(lines) >= 3)
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY passage ORDER BY doc_id, place) AS occurrence
    FROM windows WHERE length(trim(replace(passage, chr(10), ''))) > 0
),
covered AS (
    SELECT DISTINCT doc_id, place + k AS place
    FROM numbered, (SELECT unnest([0, 1, 2]) AS k) WHERE occurrence > 1
),
removed AS (
    SELECT doc_id, list(place) AS places FROM covered GROUP BY doc_id
),
deduped AS (
    SELECT l.doc_id,
        array_to_string(list_transform(
            list_filter(range(0, len(lines)), lambda i: places IS NULL OR NOT list_contains(places, i)),
            lambda i: lines[i + 1]), chr(10)) AS text,
        CAST(coalesce(len(lines), 0) AS INTEGER) AS lines,
        CAST(coalesce(len(places), 0) AS INTEGER) AS lines_removed
    FROM lined l LEFT JOIN removed r ON l.doc_id = r.doc_id
)
"""

WARC_SQL = """
WITH captured AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
),
resolved AS (
    SELECT page_id, payload, max(page_id) OVER (PARTITION BY payload) AS original FROM captured
),
hashed AS (
    SELECT *, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS hex FROM resolved
),
digits AS (
    SELECT *, list_transform(range(0, 32), lambda i:
        list_reduce(list_transform(range(0, 5), lambda b:
            (strpos('0123456789abcdef', hex[CAST((i * 5 + b) // 4 + 1 AS BIGINT)]) - 1)
                // CAST(2 ** (3 - (i * 5 + b) % 4) AS BIGINT) % 2), lambda x, y: x * 2 + y)) AS fives
    FROM hashed
)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(fives, lambda d:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(d + 1 AS BIGINT), 1)), '') AS payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> original THEN original END AS refers_to
FROM digits
"""

def _coded(value: str) -> str:
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(map(_coded, fields))})"


#: The remainder of the CRC-32 of the decimal id, computed bit by bit.
CRC_32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""

MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, leaf, CASE WHEN even THEN {_leaf("replace(text, chr(10), '')")} ELSE leaf END AS tampered,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
    FROM (SELECT *, {_leaf("text")} AS leaf, {CRC_32} % 2 = 0 AS even FROM documents)
),
nodes AS (
    SELECT source, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY source) AS width FROM leaves
    UNION ALL
    SELECT source, level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), any_value((width + 2) // 3)
    FROM nodes WHERE width > 1 GROUP BY source, level, place // 3
),
subroots AS (
    SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM nodes WHERE width = 1
),
tops AS (
    SELECT 0 AS level, place, subroot AS node, count(*) OVER () AS width FROM subroots
    UNION ALL
    SELECT level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), any_value((width + 2) // 3)
    FROM tops WHERE width > 1 GROUP BY level, place // 3
),
above AS (
    SELECT source, any_value(subroot) AS subroot, 1000 + level AS step,
        coalesce(string_agg(node, '' ORDER BY t.place) FILTER (t.place < own), '') AS before,
        coalesce(string_agg(node, '' ORDER BY t.place) FILTER (t.place > own), '') AS after
    FROM (SELECT s.source, s.subroot, t.level, t.node, t.place, s.place // CAST(3 ** t.level AS BIGINT) AS own
        FROM subroots s JOIN tops t ON t.width > 1 AND t.place // 3 = s.place // CAST(3 ** (t.level + 1) AS BIGINT)) t
    GROUP BY source, level
),
below AS (
    SELECT source, leaf_place, level AS step,
        coalesce(string_agg(node, '' ORDER BY n.place) FILTER (n.place < own), '') AS before,
        coalesce(string_agg(node, '' ORDER BY n.place) FILTER (n.place > own), '') AS after
    FROM (SELECT l.source, l.place AS leaf_place, n.level, n.node, n.place, l.place // CAST(3 ** n.level AS BIGINT) AS own
        FROM leaves l JOIN nodes n ON n.source IS NOT DISTINCT FROM l.source AND n.width > 1
            AND n.place // 3 = l.place // CAST(3 ** (n.level + 1) AS BIGINT)) n
    GROUP BY source, leaf_place, level
),
steps AS (
    SELECT source, leaf_place, step, before, after FROM below
    UNION ALL
    SELECT l.source, l.place, a.step, a.before, a.after FROM leaves l JOIN above a ON a.source IS NOT DISTINCT FROM l.source
),
ways AS (
    SELECT source, leaf_place, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256,
        list(before || '|' || after ORDER BY step) AS way
    FROM steps GROUP BY source, leaf_place
),
folded AS (
    SELECT l.doc_id, l.leaf, s.subroot, (SELECT node FROM tops WHERE width = 1) AS root,
        coalesce(w.proof_sha256, sha256('')) AS proof_sha256,
        list_reduce(list_prepend(l.tampered, coalesce(w.way, [])),
            lambda node, step: sha256(split_part(step, '|', 1) || node || split_part(step, '|', 2))) AS folded_root
    FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
    LEFT JOIN ways w ON w.source IS NOT DISTINCT FROM l.source AND w.leaf_place = l.place
)
SELECT *, folded_root = root AS verified FROM folded
"""

ORACLES: dict[str, str] = {
    "op8_warc_revisits": WARC_SQL,
    "op9_line_windows": "WITH " + LINE_WINDOWS_SQL.format(source="documents") + "SELECT * FROM deduped",
    "op12_merkle_manifest": MERKLE_SQL,
}
