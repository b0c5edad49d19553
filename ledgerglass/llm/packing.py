"""Vector bin packing of token pieces into sequences.

A document's ids are cut at multiples of the sequence length; the last piece is packed with
others. A sequence has limits on tokens, on segments and on tokens that bear loss. The heuristic
fills one sequence at a time: of the kinds of pieces that still fit, it takes the one whose demands
have the largest dot product with what is left of the limits, each dimension weighed by its mean
demand. Pieces are spread over groups by a hash, and a group packs ``GROUP`` pieces at a time, so no task holds
more than that; full pieces are sequences of their own.

Defined results: null text is empty and gives one piece with the end id; repeated rows are packed
each; an empty table gives no rows; a piece that alone exceeds a limit raises an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerglass.llm.bpe import encoded
from ledgerglass.llm.shared import bounded_batches
from ledgerglass.sources.stage import stage

GROUP = 50_000
PIECES = "doc_id long, start long, length long, loss long, ids_crc32 long, doc_tokens long"
PACKED = "sequence_id long, offset long"


def pack(demand: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each item, its first dimension's offset there). ``demand``: n items by d dimensions."""
    if len(demand) and (demand > limits).any():
        raise ValueError("a piece exceeds a limit by itself")
    kinds, kind_of, left = np.unique(demand, axis=0, return_inverse=True, return_counts=True)
    kind_of = kind_of.ravel()
    mean = demand.mean(axis=0) if len(demand) else np.ones(demand.shape[1])
    weight = mean / np.maximum(limits.astype(float) ** 2, 1)
    waiting = np.split(np.argsort(kind_of, kind="stable"), np.cumsum(left)[:-1]) if len(demand) else []
    taken = np.zeros(len(kinds), np.int64)
    bins, offsets = np.zeros(len(demand), np.int64), np.zeros(len(demand), np.int64)
    now, room, used, done = 0, limits.astype(np.int64).copy(), 0, 0
    scaled = kinds * weight
    while done < len(demand):
        fits = (left > 0) & (kinds <= room).all(axis=1)
        if not fits.any():
            now, room, used = now + 1, limits.astype(np.int64).copy(), 0
            continue
        k = int(np.argmax(np.where(fits, scaled @ room, -1.0)))
        item = waiting[k][taken[k]]
        taken[k] += 1
        left[k] -= 1
        bins[item], offsets[item] = now, used
        room = room - kinds[k]
        used += int(kinds[k][0])
        done += 1
    return bins, offsets


def cut(docs: DataFrame, tokenizer: str, end: int, length: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document; here each token but the end bears loss."""

    bounded_batches(docs.sparkSession)
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, offsets in encoded(batch.column(1), tokenizer, end):
                n = np.diff(offsets)
                count = -(-n // length)
                doc = np.repeat(np.arange(len(n)), count)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * length
                size = np.minimum(length, n[doc] - start)
                at = offsets[doc] + start
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + size).tolist())]
                last = start + size == n[doc]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)).take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, size, size - last, crc, n[doc]))],
                    [x.split()[0] for x in PIECES.split(", ")],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(pieces, PIECES)


def pack_pieces(pieces: DataFrame, limits: tuple[int, int, int], groups: int | None = None) -> DataFrame:
    """Pieces (with length and loss) with sequence_id and offset.

    ``limits``: most tokens, segments and loss-bearing tokens of a sequence.
    """
    groups = groups or max(1, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    names = pieces.columns
    most = np.array(limits)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        next_id = TaskContext.get().partitionId() << 36
        waiting: list[pd.DataFrame] = []

        def settle():
            nonlocal next_id
            rows = pd.concat(waiting, ignore_index=True)
            demand = np.stack([rows["length"], np.ones(len(rows), np.int64), rows["loss"]], axis=1)
            bins, offsets = pack(demand, most)
            rows["sequence_id"], rows["offset"] = bins + next_id, offsets
            next_id += int(bins.max()) + 1
            waiting.clear()
            return rows

        for frame in frames:
            full = frame["length"] == most[0]
            own = frame[full].copy()
            own["sequence_id"], own["offset"] = next_id + np.arange(len(own)), 0
            next_id += len(own)
            yield own
            waiting.append(frame[~full])
            if sum(map(len, waiting)) >= GROUP:
                yield settle()
        if sum(map(len, waiting)):
            yield settle()

    spread = F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id())
    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return (
        pieces.withColumn("_spread", spread)
        .repartition(groups, "_spread")
        .sortWithinPartitions("_spread")
        .select(*names)
        .mapInPandas(place, f"{schema}, {PACKED}")
    )


def pack_documents(docs: DataFrame, tokenizer: str, end: int = 1, length: int = 2048, segments: int = 64, loss: int | None = None, **columns) -> DataFrame:
    """Whole documents cut and packed; the pieces are staged, so that tokenizing runs once."""
    pieces = stage(cut(docs, tokenizer, end, length, **columns))
    return pack_pieces(pieces, (length, segments, loss or length))
