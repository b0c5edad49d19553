"""Card-transaction views over the order and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def _with_score(df: DataFrame) -> DataFrame:
    """A deterministic score that leans towards the frauds, with ties."""
    return df.withColumn(
        "score",
        ((F.col("trans_num") % 99991) * 104729 % 1000 + F.col("is_fraud") * 300) / F.lit(1.3e3),
    )


def _label() -> Column:
    return F.when((F.col("trans_num") % 100003) * 7919 % 1000 < 20, 1).otherwise(0)


def tx_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per (order, supplier): seven years, with holder and place columns.

    Lines are combined before the order, customer and supplier attributes are joined on.
    No join is hinted: AQE broadcasts the sides it finds small at run time.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    read = lambda name, *cols: table(spark, sf_dir, name, *cols)
    lines = (
        read("lineitem", "l_orderkey", "l_suppkey", "l_partkey", "l_extendedprice")
        .join(read("part", "p_partkey", "p_type", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey", "l_suppkey")
        .agg(
            F.min("p_type").alias("category"),
            F.min("p_name").alias("job"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("amt"),
        )
    )
    joined = (
        lines.join(read("orders", "o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read("nation", "n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read("supplier", "s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    order, supp, cust = F.col("l_orderkey"), F.col("l_suppkey"), F.col("o_custkey")
    second = (order * 7919 + supp * 104729) % 86400
    tx = joined.select(
        (order * 1000000 + supp).alias("trans_num"),
        F.timestamp_micros(
            F.unix_micros(F.col("o_orderdate").cast("timestamp")) + second * 1000000
        ).alias("trans_date_trans_time"),
        cust.alias("cc_num"),
        F.col("s_name").alias("merchant"),
        "category",
        "job",
        F.when(cust % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit("C"), (cust % 40).cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        (500 + (cust % 40) * (cust % 40) * 1500).alias("city_pop"),
        F.date_add(F.lit("1930-01-01").cast("date"), (cust * 7919 % 25000).cast("int")).alias("dob"),
        (25 + (cust * 7919 % 2400) / F.lit(1e2)).alias("lat"),
        (-124 + (cust * 104729 % 5700) / F.lit(1e2)).alias("long"),
        (25 + (supp * 7919 % 2400) / F.lit(1e2)).alias("merch_lat"),
        (-124 + (supp * 104729 % 5700) / F.lit(1e2)).alias("merch_long"),
        "amt",
    )
    return _with_score(tx.withColumn("is_fraud", _label()))


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty days of second-level transactions."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    tx = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value").select(
        F.col("event_id").alias("trans_num"),
        F.col("ts").cast("timestamp").alias("trans_date_trans_time"),
        F.col("user_id").alias("cc_num"),
        F.col("event_type").alias("merchant"),
        F.col("event_type").alias("category"),
        F.col("value").cast("decimal(18,2)").alias("amt"),
    )
    return _with_score(tx.withColumn("is_fraud", _label()))


def gaz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category dictionary for ``tx_sales.job``: part names grouped by their second word.

    Only names whose smallest part key is even are listed, so the others are unseen.
    """
    names = (
        table(spark, sf_dir, "part", "p_partkey", "p_name")
        .groupBy(F.col("p_name").alias("job"))
        .agg(F.min("p_partkey").alias("_first"))
        .where(F.col("_first") % 2 == 0)
        .withColumn("category", F.split("job", " ")[1])
    )
    # the dictionary holds a few dozen names, so one task numbers the categories
    return names.select(
        "category",
        (F.dense_rank().over(Window.orderBy("category")) - 1).alias("cat_ord"),
        "job",
        (F.row_number().over(Window.partitionBy("category").orderBy("job")) - 1).alias("job_ord"),
    )
