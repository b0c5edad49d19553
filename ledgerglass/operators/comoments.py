"""Co-moments of all column pairs over the rows that have both values, from one scan.

Tasks add up masked products batch by batch and send one row per column; the parts of a column meet in one task and
are merged pairwise (counts, means and sums of squares about the means), which loses no digits to large offsets.
What is shuffled is tasks x columns^2 numbers, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PARTS = "i int, n binary, mean_a binary, mean_b binary, m2_a binary, m2_b binary, c binary, bad binary"
MOMENTS = "a string, b string, n long, mean_a double, mean_b double, m2_a double, m2_b double, c double"
NAMES = ("n", "mean_a", "mean_b", "m2_a", "m2_b", "c", "bad")


def of_batch(x: np.ndarray, present: np.ndarray) -> dict[str, np.ndarray]:
    """Co-moments of one batch (rows by columns). Values are taken relative to a column's first one, so a constant column has exactly none."""
    bad = present & np.isnan(x)
    first = np.array([x[np.argmax(p), j] if p.any() else 0.0 for j, p in enumerate((present & ~bad).T)])
    own = np.where(present & ~bad, x - first, 0.0)
    m = present.astype(float)
    n = m.T @ m
    with np.errstate(invalid="ignore", divide="ignore"):
        s = own.T @ m
        mean = np.where(n > 0, s / n, 0.0)
        m2 = np.maximum((own**2).T @ m - n * mean**2, 0.0)
        c = own.T @ own - n * mean * mean.T
    return {"n": n, "mean_a": mean + first[:, None], "mean_b": mean.T + first[None, :], "m2_a": m2, "m2_b": m2.T, "c": c, "bad": bad.T.astype(float) @ m}


def merged(p: dict[str, np.ndarray], q: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The co-moments of two sets of rows together."""
    n = p["n"] + q["n"]
    share = np.divide(q["n"], n, out=np.zeros_like(n), where=n > 0)
    weight = p["n"] * share
    da, db = q["mean_a"] - p["mean_a"], q["mean_b"] - p["mean_b"]
    return {
        "n": n,
        "mean_a": np.where(p["n"] == 0, q["mean_a"], p["mean_a"] + np.where(q["n"] == 0, 0.0, da * share)),
        "mean_b": np.where(p["n"] == 0, q["mean_b"], p["mean_b"] + np.where(q["n"] == 0, 0.0, db * share)),
        "m2_a": p["m2_a"] + q["m2_a"] + da * da * weight,
        "m2_b": p["m2_b"] + q["m2_b"] + db * db * weight,
        "c": p["c"] + q["c"] + da * db * weight,
        "bad": p["bad"] + q["bad"],
    }


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i) for i in range(batch.num_columns)]
        present = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
        x = np.column_stack([np.asarray(c.fill_null(0.0).to_numpy(zero_copy_only=False), float) for c in columns])
        part = of_batch(x, present)
        held = part if held is None else merged(held, part)
    if held is not None:
        for i in range(len(held["n"])):
            row = [pa.array([i], pa.int32())] + [pa.array([held[k][i].tobytes()], pa.binary()) for k in NAMES]
            yield pa.RecordBatch.from_arrays(row, names=["i", *NAMES])


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n, mean_a, mean_b, m2_a, m2_b, c) for every ordered pair of columns; pairs without a common row are left out.

    A NaN makes the figures of its pairs NaN, as it does in a plain average; a null is no value.
    """
    names = list(columns)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[str, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                part = {k: np.frombuffer(row[k]) for k in NAMES}
                held[row["i"]] = merged(held[row["i"]], part) if row["i"] in held else part
        for i, p in held.items():
            some = np.flatnonzero(p["n"] > 0)
            bad = p["bad"][some] > 0
            values = [np.where(bad, np.nan, p[k][some]) for k in ("mean_a", "mean_b", "m2_a", "m2_b", "c")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i]] * len(some), pa.string()), pa.array([names[j] for j in some], pa.string()), pa.array(p["n"][some].astype(np.int64)), *[pa.array(v, from_pandas=False) for v in values]],
                names=[c.split()[0] for c in MOMENTS.split(", ")],
            )

    values = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return values.mapInArrow(_scan, PARTS).repartition(tasks, "i").mapInArrow(meet, MOMENTS)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation (a, b, r) of every ordered pair of columns, over the rows with both values.

    Null where a side is constant or no row has both.
    """
    names = list(columns)
    spark = df.sparkSession
    found = co_moments(df, names).select("a", "b", F.try_divide(F.col("c"), F.sqrt("m2_a") * F.sqrt("m2_b")).alias("r"))
    listed = spark.range(len(names)).select(F.element_at(F.array(*[F.lit(c) for c in names]), (F.col("id") + 1).cast("int")).alias("a"))
    pairs = listed.select("a", F.explode(F.array(*[F.lit(c) for c in names])).alias("b"))  # one row per pair of columns
    return pairs.join(found, ["a", "b"], "left")
