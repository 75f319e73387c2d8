"""Consensus of several recognisers' transcripts, per file and channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushwire.functions.distance import pair_distances
from hushwire.functions.text import normalize_for_consensus, similarity

KEYS = ["file_id", "channel"]


def _likeness(own: Column, i: Column, j: Column, edits: Column) -> Column:
    """Similarity of text i to text j of the array own, 1 for equal ones; edits: the pairs' distances."""
    low, high, n = F.least(i, j), F.greatest(i, j), F.size(own)
    at = low * n - F.floor(low * (low + 1) / 2) + high - low - 1
    x, y = F.get(own, i)["norm"], F.get(own, j)["norm"]
    return F.when(x == y, 1.0).otherwise(F.round(similarity(x, y, F.get(edits, at.cast("int"))), 9))


def consensus(results: DataFrame, prefer: str, fallback: list[str], min_agreement: int = 3, soft: float = 0.78) -> DataFrame:
    """results: file_id, channel, engine, engine_ord, transcript, error.  Strict majority of normalised
    texts; else the medoid by similarity; else the first fallback engine, then the first with a text.  A
    channel's engines, a handful, are one row: texts are normalised once and moved once."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, fallback)), F.col("engine")), F.lit(0))
    rank = F.when(rank == 0, 999).otherwise(rank - 1)
    raw = F.trim(F.coalesce(F.col("transcript"), F.lit("")))
    good = F.col("error").isNull() & (raw != "")
    told = F.struct("engine_ord", "engine", rank.alias("rank"), (F.col("engine") == prefer).cast("int").alias("liked"), raw.alias("raw"))
    per = results.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.when(good, told))).alias("all"))
    # similarities are needed only where no majority decides
    per = per.withColumn("own", F.filter(F.transform("all", lambda e: e.withField("norm", normalize_for_consensus(e["raw"]))), lambda e: e["norm"] != ""))
    group = lambda e: F.filter("own", lambda o: o["norm"] == e["norm"])
    ranked = F.transform(
        "own",
        lambda e: F.struct(
            (-F.size(group(e))).alias("n"), (-F.array_max(F.transform(group(e), lambda o: o["liked"]))).alias("has"), (-F.length(e["norm"])).alias("len"), F.array_min(F.transform(group(e), lambda o: o["engine_ord"])).alias("first"),
            (-e["liked"]).alias("liked"), e["rank"].alias("rank"), e["engine_ord"].alias("engine_ord"), e["engine"].alias("engine"), e["raw"].alias("raw"),
        ),
    )
    per = per.withColumn("best", F.array_min(ranked))
    per = per.withColumn("major", F.when(-F.col("best.n") >= min_agreement, F.col("best")))
    texts = F.transform("own", lambda e: e["norm"])
    per = per.withColumn("edits", pair_distances(F.when(F.col("major").isNull() & (F.size("own") >= min_agreement), texts)))
    places = F.sequence(F.lit(0), F.size("own") - 1)
    sims = F.when(F.col("edits").isNotNull(), F.transform(places, lambda i: F.struct(F.get("own", i).alias("e"), F.transform(places, lambda j: F.when(i == j, 1.0).otherwise(_likeness(F.col("own"), i, j, F.col("edits")))).alias("s"))))
    medoid = F.transform(
        sims,
        lambda m: F.struct(
            (-F.size(F.filter(m["s"], lambda v: v >= soft))).alias("n"), (-F.round(F.aggregate(m["s"], F.lit(0.0), lambda a, v: a + v) / F.size(m["s"]), 9)).alias("avg"), (-m["e"]["liked"]).alias("liked"), m["e"]["rank"].alias("rank"),
            (-F.length(m["e"]["norm"])).alias("len"), m["e"]["engine_ord"].alias("engine_ord"), m["e"]["engine"].alias("engine"), m["e"]["raw"].alias("raw"),
        ),
    )
    per = per.withColumn("close", F.array_min(medoid))
    per = per.withColumn("fall", F.array_min(F.transform("all", lambda e: F.struct(e["rank"].alias("rank"), e["engine_ord"].alias("engine_ord"), e["engine"].alias("engine"), e["raw"].alias("raw")))))
    is_major, is_soft = F.col("major").isNotNull(), -F.col("close.n") >= min_agreement
    chosen = lambda f: F.when(is_major, F.col(f"major.{f}")).when(is_soft, F.col(f"close.{f}")).otherwise(F.col(f"fall.{f}"))
    method = F.when(is_major, "strict_majority").when(is_soft, "soft_similarity").when(F.col("fall.rank") < 999, "fallback_priority").when(F.col("fall").isNotNull(), "fallback_first_available").otherwise("all_empty")
    agreement = F.when(is_major, -F.col("major.n")).when(is_soft, -F.col("close.n")).otherwise(F.when(F.col("fall").isNotNull(), 1).otherwise(0))
    return per.select(*KEYS, method.alias("method"), chosen("engine").alias("selected_engine"), agreement.cast("long").alias("agreement_count"), F.coalesce(chosen("raw"), F.lit("")).alias("final_transcript"))
