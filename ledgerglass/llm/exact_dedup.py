"""Exact dedup that takes heavy hitters out of the shuffle.

A Misra-Gries summary (``freqItems`` is Spark's) names every digest that more than ``support``
of the rows carry. Their exact counts and winners are at most ``1 / support`` rows, so they are
broadcast and settle their rows on the map side. The other digests meet in an ordinary shuffle,
where no group can hold more than ``support`` of the rows.

Defined results: null text counts as empty; empty texts are one group; of equal rows (same id,
same text) one is kept; a null id sorts after every id; an empty table gives no rows; columns
other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerglass.llm.rows import keep_rows, row_key
from ledgerglass.sources.stage import stage

SPACE = r"[\x20\x09-\x0D]+"
SUPPORT = 1 / 1024


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _winner() -> list[Column]:
    """The smallest id, nulls last; a key made by ``row_key`` has a flag for null in front."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    return [first.alias("first"), F.count("*").alias("group_size")]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stage(
        docs.select(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("digest"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    summary = rows.stat.freqItems(["digest"], support)
    candidates = summary.select(F.explode(F.col("digest_freqItems")).alias("digest")).distinct()
    winners = stage(rows.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest").agg(*_winner()))
    heavy = rows.join(F.broadcast(winners), "digest")
    light = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    light = light.join(light.groupBy("digest").agg(*_winner()), "digest")
    return heavy.unionByName(light).select(
        F.col("id").alias("doc_id"),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the rows that ``exact_dedup`` drops, all columns kept."""
    return keep_rows(docs, exact_dedup(docs.withColumn("_key", row_key(id_col, text_col)), "_key", text_col), id_col, text_col)
