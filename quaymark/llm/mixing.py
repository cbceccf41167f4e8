"""Mixing sources to target shares of the total size.

Tokens are summed per source, a repetition rate per source follows from the targets,
and every document comes out floor(rate) times plus once more with the probability of
the fraction, drawn from a hash of seed and id: the same documents in every run and on
every cluster, whatever the partitioning.

The size of the mixture is the largest at which every source reaches its share within
its cap of repetitions, unless a smaller total is asked for. Sources that are on one
side only take no part: documents of a source without target are not used, and a
target without documents (or without tokens) is left out, the other shares being scaled up to 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def source_label(c: Column | str) -> Column:
    """One spelling per source: trimmed, lower case, blanks and dashes as underscores; blank is null."""
    t = F.regexp_replace(F.lower(F.trim(F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"[\s-]+", " "))), " ", "_")
    return F.when(t != "", t)


def rates(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """``source``, ``target_share``, ``scaled_share``, ``max_repeats``, ``docs``, ``tokens``, ``rate`` of every target.

    ``sizes`` has ``source`` and ``tokens`` per document, ``targets`` the wanted shares.
    ``scaled_share`` is the share among the targets that have tokens, 0 for the others.
    One row per source: sources are named in ``targets``, which is a small table of
    configuration, so what is gathered is bounded by it. Targets of null source, a
    share not above 0 or a cap below 1 are left out; a source named twice counts once, with its larger share.
    """
    wanted = (
        targets.select(source_label("source").alias("source"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("double").alias("cap"))
        .filter("source IS NOT NULL AND share > 0 AND cap >= 1")
        .groupBy("source")
        .agg(F.max(F.struct("share", "cap")).alias("r"))
        .select("source", "r.share", "r.cap")
    )
    have = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))
    both = wanted.join(have, "source", "left").fillna(0, ["docs", "tokens"])
    named = both.agg(F.collect_list(F.struct("source", "share", "cap", "docs", "tokens")).alias("all"))
    usable = F.filter("all", lambda x: x["tokens"] > 0)
    whole = F.aggregate(usable, F.lit(0.0), lambda acc, x: acc + x["share"])
    most = F.array_min(F.transform(usable, lambda x: x["cap"] * x["tokens"] * F.col("whole") / x["share"]))
    sized = named.withColumn("whole", whole).withColumn("total", most if total is None else F.least(most, F.lit(float(total))))
    scaled = F.when(F.col("tokens") > 0, F.col("share") / F.col("whole")).otherwise(0.0)
    rate = F.when(F.col("tokens") > 0, F.least("cap", scaled * F.col("total") / F.col("tokens"))).otherwise(0.0)
    return sized.select(F.inline("all"), "whole", "total").select("source", F.col("share").alias("target_share"), scaled.alias("scaled_share"), F.col("cap").cast("int").alias("max_repeats"), "docs", "tokens", rate.alias("rate"))


def uniform(seed: int, c: Column) -> Column:
    """A number in [0, 1) from the MD5 of seed and value: the same everywhere."""
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")).cast("binary")), 1, 12)
    return F.conv(head, 16, 10).cast("double") / float(16**12)


def mixture(sizes: DataFrame, rate: DataFrame, seed: int = 20240101) -> DataFrame:
    """``id``, ``source``, ``tokens``, ``copies`` of every document used at least once.

    Rates are broadcast: one row per source named in the targets.
    """
    joined = sizes.join(F.broadcast(rate.select("source", "rate")), "source")
    extra = uniform(seed, F.col("id")) < F.col("rate") - F.floor("rate")
    return joined.withColumn("copies", (F.floor("rate") + F.when(extra, 1).otherwise(0)).cast("int")).filter("copies > 0").select("id", "source", "tokens", "copies")


def emitted(mix: DataFrame) -> DataFrame:
    """One row per copy: ``id``, ``source``, ``tokens``, ``copy`` from 1."""
    return mix.select("id", "source", "tokens", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))


def shares(mix: DataFrame, rate: DataFrame) -> DataFrame:
    """What came of the mixture, per target: its share as stated, as scaled and as it is, documents, tokens and repetitions.

    Targets without documents are reported with nothing taken.
    """
    used = mix.groupBy("source").agg(F.count("*").alias("docs_used"), F.sum("copies").alias("copies"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens_out"), F.max("copies").alias("most_repeats"))
    named = rate.join(used, "source", "left").fillna(0, ["docs_used", "copies", "tokens_out", "most_repeats"])
    # one row per source named in the targets, so one task may see them all
    sum_out = F.sum("tokens_out").over(Window.partitionBy(F.lit(1)))
    return named.withColumn("sum_out", sum_out).select(
        "source", "target_share", "scaled_share", "max_repeats", "docs", F.col("tokens").alias("tokens_in"), "rate", "docs_used", "copies", "most_repeats", "tokens_out",
        F.try_divide(F.col("tokens_out").cast("double"), F.col("sum_out").cast("double")).alias("actual_share"),
    )
