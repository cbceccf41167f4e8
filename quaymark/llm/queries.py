"""Queries of the problems on training text, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.functions.text import canonical_url
from quaymark.llm import chosen_path, encoding, mixing, sentences
from quaymark.session import written
from quaymark.sources.tables import table


def _articles(spark: SparkSession, data: str) -> DataFrame:
    """Each article by its row with the smallest msg_id: ``id``, ``text`` (title and summary)."""
    m = table(spark, data, "all_messages").select("msg_id", "url", "title", "summary")
    text = F.concat("title", F.lit(" "), "summary")
    row = F.struct(F.col("msg_id").alias("id"), text.alias("text"))
    first = m.select(canonical_url("url").alias("u"), row.alias("row")).filter("u IS NOT NULL").groupBy("u").agg(F.min("row").alias("row"))
    return first.select("row.id", "row.text")


def p4_found(spark: SparkSession, data: str) -> DataFrame:
    pairs, members = chosen_path.near_duplicates(_articles(spark, data), "id", F.col("text"))
    return chosen_path.expanded(pairs, members).select(F.col("a").alias("msg_id_a"), F.col("b").alias("msg_id_b"))


def p4_classes(spark: SparkSession, data: str) -> DataFrame:
    """Per article its class of equal word sets and how many other classes tell nearly the same text."""
    pairs, members = chosen_path.near_duplicates(_articles(spark, data), "id", F.col("text"))
    ends = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a")))
    links = ends.groupBy(F.col("a").alias("rep")).agg(F.count("*").alias("links"))
    return members.join(links, "rep", "left").select(F.col("id").alias("msg_id"), F.col("rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def p8_ids(spark: SparkSession, data: str) -> DataFrame:
    return encoding.encode(table(spark, data, "documents"))


def _mix(spark: SparkSession, data: str) -> tuple[DataFrame, DataFrame]:
    sizes = written(encoding.token_counts(table(spark, data, "documents"), "doc_id", "text", mixing.source_label("source")), "token-counts")
    rate = mixing.rates(sizes, table(spark, data, "mix_targets"))
    return mixing.mixture(sizes, rate), rate


def p9_shares(spark: SparkSession, data: str) -> DataFrame:
    return mixing.shares(*_mix(spark, data))


def p9_mix(spark: SparkSession, data: str) -> DataFrame:
    mix, _ = _mix(spark, data)
    return mixing.emitted(mix).select(F.col("id").alias("doc_id"), "source", "copy", "tokens")


def p10_found(spark: SparkSession, data: str) -> DataFrame:
    return sentences.sentences(table(spark, data, "documents"))


QUERIES = {f.__name__: f for f in (p4_found, p4_classes, p8_ids, p9_mix, p9_shares, p10_found)}

#: Brute force over every pair of articles that share a word: exact, and far too slow for anything but the smaller tables.
SQL = {
    "p4_found": r"""
    WITH m AS (SELECT msg_id, title, summary, nullif(regexp_replace(regexp_replace(lower(trim(url)), '^https?://', ''), '/$', ''), '') AS u FROM all_messages),
         a AS (SELECT msg_id, title || ' ' || summary AS text FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY msg_id) AS rn FROM m WHERE u IS NOT NULL) WHERE rn = 1 AND title IS NOT NULL AND summary IS NOT NULL),
         w AS (SELECT DISTINCT msg_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM a),
         s AS (SELECT msg_id, count(*) AS n FROM w GROUP BY msg_id),
         c AS (SELECT x.msg_id AS p, y.msg_id AS q, count(*) AS k FROM w x JOIN w y ON x.word = y.word AND x.msg_id < y.msg_id GROUP BY 1, 2)
    SELECT p AS msg_id_a, q AS msg_id_b FROM c JOIN s a ON a.msg_id = p JOIN s b ON b.msg_id = q WHERE k >= 0.6 * (a.n + b.n - k)""",
}
