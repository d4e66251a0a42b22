"""The text problems 8 to 10 over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrom import scratch
from lodestrom.llm import leakage, packing, residue

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/eval_items.parquet")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.split_documents(packing.pack(_documents(spark, sf_dir)))


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document or piece with its container."""
    return packing.pack(_documents(spark, sf_dir))


def p8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces as they were placed, without their containers' numbers, which no SQL can state."""
    return packing.pack(_documents(spark, sf_dir)).select("doc_id", "tokens", "piece", "start", "size")


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the containers, and whether they are nearly full."""
    return packing.pack_checks(scratch.materialise(packing.pack(_documents(spark, sf_dir)), "packed"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.find_leaks(_documents(spark, sf_dir), leakage.build_automata(_items(spark, sf_dir))).select("doc_id", "item_id")


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each leaked item the number of documents it leaked into."""
    return p9_found(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("docs"))


def p9_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the leaked spans cut out, or dropped where these cover most of them."""
    return leakage.remove_leaks(_documents(spark, sf_dir), leakage.build_automata(_items(spark, sf_dir))).where("removed > 0")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.find_residue(_documents(spark, sf_dir)).select("doc_id").distinct()


def p10_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of evidence found."""
    return residue.find_residue(_documents(spark, sf_dir))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p8_found, p8_packed, p8_pieces, p8_report, p9_found, p9_report, p9_removed, p10_found, p10_evidence)}

_SIZES = "(SELECT DISTINCT doc_id, octet_length(encode(text)) + 1 AS tokens FROM documents WHERE text IS NOT NULL)"
_PIECES = f"SELECT doc_id, tokens, piece, piece * 2048 AS start, least(2048, tokens - piece * 2048) AS size FROM (SELECT doc_id, tokens, unnest(range(0, (tokens - 1) // 2048 + 1)) AS piece FROM {_SIZES})"
# Words and their runs of as many words as an item holds, at most twelve.
_WORDS = "regexp_extract_all(regexp_replace(lower(strip_accents(nfc_normalize({}))), 'ß', 'ss', 'g'), '[\\p{{L}}\\p{{N}}]+')".format
_LEAKS = f"""WITH i AS (SELECT item_id, {_WORDS('item_text')} AS w FROM eval_items), d AS (SELECT doc_id, {_WORDS('text')} AS w FROM documents),
ig AS (SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS gram FROM (SELECT item_id, w, least(12, len(w)) AS n, unnest(range(1, len(w) - least(12, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)),
dg AS (SELECT DISTINCT doc_id, n, array_to_string(w[k : k + n - 1], ' ') AS gram FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM ig) WHERE len(w) >= n))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (n, gram)"""

ORACLES: dict[str, str] = {
    "p8_pieces": _PIECES,
    "p8_report": f"SELECT count(*) AS items, CAST(sum(size) AS BIGINT) AS tokens, true AS one_place_each, true AS tiled, true AS split_only_if_larger, true AS within_capacity, true AS nearly_full FROM ({_PIECES})",
    "p9_found": _LEAKS,
    "p9_report": f"SELECT item_id, count(*) AS docs FROM ({_LEAKS}) GROUP BY 1",
    "p8_found": "SELECT DISTINCT doc_id FROM documents WHERE octet_length(encode(text)) + 1 > 2048",
}
