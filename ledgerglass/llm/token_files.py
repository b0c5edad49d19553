"""Token-id files: one id array per file, document boundaries as an Elias-Fano sequence.

A file holds the ids of consecutive documents (by id), two or four bytes each, little-endian, then
the ends of the documents and the document ids as Elias-Fano sequences, then a footer with their
places. Files are numbered in order of the document ids. A task writes under a name of its own and
renames at the end, so that a repeated task replaces its file by an equal one. The folder is reached
through pyarrow's file systems (local, HDFS, S3, GCS), at the place that Spark's setting names.

Defined results: null text is empty, so its document has the end id only; documents without an id
come first, and their id is kept as null; equal ids stay next to each other, ordered by a hash of
the text; an empty table writes no file and reads back no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ledgerglass.llm import elias_fano
from ledgerglass.llm.bpe import encoded, encoder
from ledgerglass.llm.shared import bounded_batches, open_fs
from ledgerglass.sources.stage import stage

MAGIC = b"TOKEF001"
MANIFEST = "part long, file string, n_docs long, n_tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Ids that are read at a time.
READ_IDS = 1 << 20


def write_file(batches: Iterator[pa.RecordBatch], uri: str, part: int, attempt: int, tokenizer: str, end: int) -> dict | None:
    """Write one file from batches of (doc_id, text) in order; None if there are no rows."""
    fs, folder = open_fs(uri)
    width = 2 if max(encoder(tokenizer).tokenizer.get_vocab_size(), end + 1) <= 1 << 16 else 4
    own, name = f"{folder}/.part-{part:06d}-{attempt}", f"part-{part:06d}.tok"
    ids_of, ends, total, nulls = [], [], 0, 0
    out = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if out is None:
            out = fs.open_output_stream(own)
            out.write(MAGIC)
        nulls += batch.column(0).null_count
        ids_of.append(batch.column(0).drop_null().to_numpy())
        for _, ids, offsets in encoded(batch.column(1), tokenizer, end):
            out.write(ids.astype(f"<u{width}").tobytes())
            ends.append(total + offsets[1:])
            total += int(offsets[-1])
    if out is None:
        return None
    ends, ids_of = np.concatenate(ends), np.concatenate(ids_of)
    parts = [elias_fano.encode(ends), elias_fano.encode(ids_of.astype(np.int64))]
    footer = json.dumps({"width": width, "tokens": total, "documents": len(ends), "nulls": nulls, "sizes": [len(p) for p in parts]}).encode()
    for p in (*parts, footer, len(footer).to_bytes(4, "little"), MAGIC):
        out.write(p)
    out.close()
    fs.move(own, f"{folder}/{name}")
    return {"part": part, "file": name, "n_docs": len(ends), "n_tokens": total}


class TokenFile:
    """Random access to a file's documents."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        length = int.from_bytes(tail[:4], "little")
        self.about = json.loads(self.file.read_at(length, size - 12 - length))
        at = size - 12 - length - sum(self.about["sizes"])
        read = [self.file.read_at(n, at + sum(self.about["sizes"][:i])) for i, n in enumerate(self.about["sizes"])]
        self.ends, self.keys = (elias_fano.EliasFano(x) for x in read)

    def __len__(self) -> int:
        return self.about["documents"]

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Ends of documents first - 1 to last - 1; what is before the first document ends at 0."""
        if first:
            return self.ends.select(first - 1, last)
        return np.concatenate([[0], self.ends.select(0, last)])

    def ids(self, start: int, stop: int) -> np.ndarray:
        width = self.about["width"]
        return np.frombuffer(self.file.read_at((stop - start) * width, len(MAGIC) + start * width), f"<u{width}")

    def key(self, first: int, last: int) -> list:
        nulls = self.about["nulls"]
        return [None] * max(0, min(last, nulls) - first) + self.keys.select(max(first - nulls, 0), max(last - nulls, 0)).tolist()

    def blocks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first document, bounds, ids) of consecutive documents, about ``READ_IDS`` ids at a time."""
        first, step = 0, elias_fano.SAMPLE
        while first < len(self):
            last = min(first + step, len(self))
            bounds = self.bounds(first, last)
            fit = max(1, int(np.searchsorted(bounds, bounds[0] + READ_IDS, side="right")) - 1)
            bounds = bounds[: fit + 1]
            yield first, bounds, self.ids(int(bounds[0]), int(bounds[-1]))
            first += len(bounds) - 1


def write_token_files(docs: DataFrame, uri: str, tokenizer: str, end: int, files: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files; the manifest (part, file, n_docs, n_tokens), one row per file."""
    bounded_batches(docs.sparkSession)
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches):
        task = TaskContext.get()
        row = write_file(batches, uri, task.partitionId(), task.taskAttemptId(), tokenizer, end)
        if row:
            yield pa.RecordBatch.from_pylist([row])

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(files, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    return stage(ordered.mapInArrow(write, MANIFEST))


def read_token_files(manifest: DataFrame, uri: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    The manifest has one row per file, so its running total is small whatever the table's size.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = stage(manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(f"{uri}/{row['file']}")
                for first, bounds, ids in file.blocks():
                    at = bounds - bounds[0]
                    ids = ids.astype("<u4")
                    crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.key(first, first + len(crc)), pa.int64()),
                            pa.array(bounds[:-1] + row["start"], pa.int64()),
                            pa.array(np.diff(bounds), pa.int64()),
                            pa.array(crc, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return placed.select("part", "file", "start").repartition(tasks).mapInArrow(read, DOCUMENTS)
