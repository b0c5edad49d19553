"""Naming rows by content, so that a second read of a table finds the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerglass.sources.stage import stage


def row_key(id_col: str, text_col: str) -> Column:
    """A row's id (nulls sort last) with a hash of its text; rows with one key are repeats."""
    own = F.col(f"`{id_col}`")
    return F.struct(own.isNull().alias("none"), own.alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("copy"))


def drop_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Without the rows named by ``keys`` (one column, key). The keys are staged: if their size is small, the planner broadcasts them."""
    gone = stage(keys.select(F.col("key").alias("_gone")).distinct())
    return docs.withColumn("_key", row_key(id_col, text_col)).join(gone, F.col("_key") == F.col("_gone"), "left_anti").drop("_key")


def keep_rows(docs: DataFrame, judged: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are kept by ``judged`` (doc_id: a key, kept), and one of each set of repeats among them."""
    counted = stage(judged.groupBy(F.col("doc_id").alias("key")).agg(F.max("kept").alias("kept"), F.count("*").alias("n")))
    left = drop_rows(docs, counted.where("not kept").select("key"), id_col, text_col)
    if counted.where("n > 1").isEmpty():
        return left
    columns = left.columns
    return left.withColumn("_copy", row_key(id_col, text_col)["copy"]).dropDuplicates([id_col, "_copy"]).select(*columns)
