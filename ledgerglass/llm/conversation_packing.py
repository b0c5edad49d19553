"""Packing of conversations under three limits at once: tokens, segments and loss-bearing tokens.

A turn's ids end with the end id; only those of some roles bear loss. A turn is cut into pieces of at most half a limit.
A conversation's pieces, in order, are put into chunks: a piece goes by the tokens, segments and loss in front of it, in
units of half a limit, so a chunk stays within every limit however long its conversation is, and short conversations
are one chunk. What lies in front of a piece is a range-cut running total, so a conversation of any size is spread over tasks.
Chunks are then packed into sequences by the dot-product heuristic of ``packing.pack``.

Defined results: null text is empty and gives the end id; a null role bears no loss; repeated rows are packed each; rows
without a conversation or turn come first in their order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerglass.llm.bpe import encoded
from ledgerglass.llm.packing import GROUP, pack
from ledgerglass.llm.shared import bounded_batches
from ledgerglass.operators.running import running_totals
from ledgerglass.sources.stage import stage

PIECES = "conv_id long, turn long, role string, start long, length long, loss long, ids_crc32 long"


def cut_turns(turns: DataFrame, tokenizer: str, end: int, limits: tuple[int, int, int], bearing: Sequence[str] = ("assistant",)) -> DataFrame:
    """Pieces of every turn, of at most half of the limits on tokens and on loss."""
    bounded_batches(turns.sparkSession)
    plain, scarce = max(1, limits[0] // 2), max(1, min(limits[0], limits[2]) // 2)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, offsets in encoded(batch.column(3), tokenizer, end):
                n = np.diff(offsets)
                role = batch.column(2).slice(first, len(n))
                bears = np.array([r in bearing for r in role.to_pylist()], bool)
                size = np.where(bears, scarce, plain)
                count = -(-n // size)
                turn = np.repeat(np.arange(len(n)), count)
                start = (np.arange(len(turn)) - np.repeat(np.cumsum(count) - count, count)) * size[turn]
                length = np.minimum(size[turn], n[turn] - start)
                raw, at = ids.astype("<u4"), offsets[turn] + start
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                took = [batch.column(i).slice(first, len(n)).take(pa.array(turn)) for i in range(3)]
                numbers = [pa.array(x, pa.int64()) for x in (start, length, np.where(bears[turn], length, 0), crc)]
                yield pa.RecordBatch.from_arrays([*took, *numbers], names=[x.split()[0] for x in PIECES.split(", ")])

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), "text")
    return rows.mapInArrow(cut, PIECES)


def pack_conversations(
    turns: DataFrame, tokenizer: str, end: int = 1, limits: tuple[int, int, int] = (2048, 8, 1024), bearing: Sequence[str] = ("assistant",)
) -> DataFrame:
    """One row per piece: conv_id, turn, role, start, length, loss, ids_crc32, sequence_id, offset, segment.

    ``limits``: most tokens, pieces and loss-bearing tokens of a sequence.
    """
    spark = turns.sparkSession
    pieces = cut_turns(turns, tokenizer, end, limits, bearing).withColumns({"_one": F.lit(1).cast("long"), "_row": F.monotonically_increasing_id()})
    pieces = stage(pieces.withColumn("_order", F.struct("turn", "_row", "start")))
    sums = {"_tokens": ("sum", "length"), "_segments": ("sum", "_one"), "_loss": ("sum", "loss")}
    placed = running_totals(pieces, ["conv_id"], "_order", sums, staged=True)
    half = lambda name, i: F.floor(F.col(name) / max(1, limits[i] // 2))
    chunk = F.struct("conv_id", half("_tokens", 0).alias("t"), half("_segments", 1).alias("s"), half("_loss", 2).alias("l"))
    # a chunk has at most the limits' pieces
    chunks = placed.withColumn("_chunk", chunk).groupBy("_chunk").agg(
        F.sum("length").alias("tokens"),
        F.count("*").alias("segments"),
        F.sum("loss").alias("loss_tokens"),
        F.array_sort(F.collect_list(F.struct("_order", "turn", "role", "start", "length", "loss", "ids_crc32"))).alias("pieces"),
    )
    chunks = stage(chunks.select(F.col("_chunk.conv_id").alias("conv_id"), "tokens", "segments", "loss_tokens", "pieces"))
    most = np.array(limits)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        next_id, waiting = TaskContext.get().partitionId() << 36, []

        def settle():
            nonlocal next_id
            rows = pd.concat(waiting, ignore_index=True)
            demand = rows[["tokens", "segments", "loss_tokens"]].to_numpy(np.int64)
            bins, offsets = pack(demand, most)
            rows["sequence_id"], rows["base"] = bins + next_id, offsets
            next_id += int(bins.max()) + 1
            waiting.clear()
            return rows

        for frame in frames:
            for a in range(0, len(frame), GROUP):
                waiting.append(frame.iloc[a : a + GROUP])
                if sum(map(len, waiting)) >= GROUP:
                    yield settle()
        if waiting:
            yield settle()

    numbered = stage(chunks.withColumn("_id", F.monotonically_increasing_id()))
    groups = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    spread = numbered.select("_id", "tokens", "segments", "loss_tokens").repartition(groups, F.xxhash64("_id")).sortWithinPartitions("_id")
    settled = spread.mapInPandas(place, "_id long, tokens long, segments long, loss_tokens long, sequence_id long, base long")
    joined = numbered.select("_id", "conv_id", "pieces").join(settled.select("_id", "sequence_id", "base"), "_id")
    each = joined.select("conv_id", "sequence_id", "base", "pieces", F.posexplode("pieces").alias("segment", "x"))
    before = F.aggregate(F.slice("pieces", F.lit(1), F.col("segment")), F.lit(0).cast("long"), lambda a, p: a + p["length"])
    return each.select("conv_id", "x.turn", "x.role", "x.start", "x.length", "x.loss", "x.ids_crc32", "sequence_id", (F.col("base") + before).alias("offset"), "segment")
