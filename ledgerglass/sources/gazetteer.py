"""Reading and writing the job gazetteer (a JSON object: category -> list of titles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """(category, cat_ord, job, job_ord) in file order; an empty category has one null job.

    A missing file and malformed JSON both fail.
    """
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "map<string,array<string>>", {"mode": "FAILFAST"})
    return (
        text.select(F.posexplode(F.map_entries(parsed)).alias("cat_ord", "_entry"))
        .select(
            F.col("_entry.key").alias("category"),
            "cat_ord",
            F.posexplode_outer("_entry.value").alias("job_ord", "job"),
        )
        .select("category", "cat_ord", "job", "job_ord")
    )


def write_gazetteer(gaz: DataFrame, path: str) -> None:
    """One JSON object with categories and titles in their order, into a new folder.

    The dictionary is a small curated file, so a single output object is what its readers expect.
    """
    titles = F.transform(
        F.array_sort(F.collect_list(F.struct("job_ord", "job"))), lambda t: t["job"]
    )
    categories = gaz.groupBy("category").agg(
        F.first("cat_ord").alias("cat_ord"),
        F.filter(titles, lambda t: t.isNotNull()).alias("jobs"),
    )
    entries = F.transform(
        F.array_sort(F.collect_list(F.struct("cat_ord", "category", "jobs"))),
        lambda e: F.struct(e["category"], e["jobs"]),
    )
    categories.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.mode("errorifexists").text(path)
