"""Self join by n-gram Jaccard similarity, with chosen-path recursion.

Documents with equal words in equal order form a class, and only one of each class is compared. A class's
5-word shingles are embedded as ``COORDINATES`` minhash values, of which two sets share each with a
chance equal to their similarity. A run starts at a root and samples coordinates by a hash of the node: 1 / threshold
of them on average. A class follows each sampled coordinate to the child named by the coordinate
and its value there, so similar classes keep meeting and others part. A node with at most ``SMALL`` classes is
compared at once by embedding; a larger one is split again, to ``DEPTH`` levels. A node that kept ``ALIKE`` of its
parent's classes holds classes that are alike, and further splits would only repeat them: it is one cluster as it
is. Runs repeat until a pair at the threshold meets with the target recall.

Pairs that are similar enough by embedding are joined to clusters, and within a cluster every pair is compared exactly on
its shingles, so links have no false members. A cluster's sets are cut into blocks by a
hash, and a task compares two blocks, so a big cluster spreads over tasks. Links are counted where they are found; a task
passes on a count for each class and a spanning forest, never the pairs.

Defined results: null text counts as empty; texts without words are one class without links; a text of
one to four words has one shingle, all its words; two classes with equal sets are linked with similarity
1; repeated rows share a class; an empty table gives no rows; working columns have names of their own.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerglass.llm.arrays import mix, ragged, shingles, slices, texts_of
from ledgerglass.llm.components import components
from ledgerglass.llm.rows import keep_rows
from ledgerglass.llm.shared import bounded_batches
from ledgerglass.sources.stage import stage

SHINGLE = 5
THRESHOLD = 0.8
COORDINATES = 128
SMALL = 64
DEPTH = 6
ALIKE = 0.75
RECALL = 0.99
#: Standard deviations below the threshold at which the embedding still lets a pair pass.
SLACK = 3.0
#: Shingles of a cluster's block, about.
BLOCK = 1 << 20


def n_runs(threshold: float = THRESHOLD, recall: float = RECALL, levels: int = 3) -> int:
    """Runs until a pair at the threshold meets at that depth with the given chance.

    A pair shares a Poisson(1) number of children of each node it shares.
    """
    alive = 1.0
    for _ in range(levels):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def embed(values: np.ndarray, at: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Minhash values, one row per text with shingles (32 bits each)."""
    n = np.diff(at)
    some = np.flatnonzero(n)
    out = np.zeros((len(some), coordinates), np.uint32)
    if not len(some):
        return out
    factor = mix(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    begin = at[:-1][some]
    # Texts are taken a few thousand shingles at a time, which stay in the processor's cache.
    edges = np.unique(np.append(np.searchsorted(at[some], np.arange(0, at[-1], 1 << 15)), len(some)))
    for a, b in zip(np.append(0, edges[edges > 0])[:-1], edges[edges > 0]):
        part = values[begin[a] : at[some[b - 1] + 1]]
        starts = begin[a:b] - begin[a]
        for c in range(coordinates):
            out[a:b, c] = np.minimum.reduceat(part * factor[c], starts) >> np.uint64(32)
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, part in slices(texts_of(batch.column("text"))):
            values, at = shingles(part, SHINGLE)
            data = np.full(len(part), None, object)
            data[np.diff(at) > 0] = [x.tobytes() for x in embed(values, at)]
            columns = {c: batch.column(c).slice(first, len(part)) for c in ("doc_id", "row", "digest", "copy")}
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(data, pa.binary())], [*columns, "embedded"])


def classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, copy, node, class_id, n_copies, embedded): rows with equal words share a class.

    ``row`` numbers the rows as they are first read, ``node`` is the row of the class's smallest doc_id and ``copy`` a hash of the text
    as it stands. ``embedded`` is given in the class's first row only, and null without words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.trim(F.regexp_replace(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), r"[\x20\x09-\x0D]+", " "))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.unhex(F.sha2(words, 256)).alias("digest"), F.xxhash64(text).alias("copy"), text.alias("text"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, row long, digest binary, copy long, embedded binary"
    rows = stage(rows.mapInArrow(_signatures, schema))
    first = rows.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"), F.count("*").alias("n_copies"))
    own = F.when(F.col("row") == F.col("first.row"), F.col("embedded"))
    return stage(rows.join(first, "digest").select("doc_id", "row", "copy", F.col("first.row").alias("node"), F.col("first.doc_id").alias("class_id"), "n_copies", own.alias("embedded")))


def _children(threshold: float, runs: int):
    """Task: nodes of classes (node, class_id, embedded, n: classes of the node) to their children; at the root one node for each run."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            data = np.frombuffer(b"".join(batch.column("embedded").to_pylist()), np.uint32).reshape(len(node), -1)
            chosen = mix(node[:, None] + np.arange(1, data.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
            # One coordinate, and with chance 1 / threshold - 1 the next in order of their hashes: 1 / threshold on average.
            order = np.argsort(chosen, axis=1)[:, : 1 + math.ceil(1 / threshold)]
            more = (mix(node ^ np.uint64(0xA5A5A5A5)) >> np.uint64(11)).astype(np.float64) / 2**53 + 1 / threshold
            row, rank = np.nonzero(np.arange(order.shape[1])[None, :] < np.floor(more)[:, None])
            at = order[row, rank]
            child = mix(mix(node[row] + at.astype(np.uint64)) ^ data[row, at].astype(np.uint64)).view(np.int64)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(child), batch.column("class_id").take(at), batch.column("n").take(at)], ["node", "class_id", "parent_n"])

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in range(runs):
                node = pa.array(np.full(batch.num_rows, mix(np.array([run + 1], np.uint64))[0], np.uint64).view(np.int64))
                whole = pa.array(np.full(batch.num_rows, np.iinfo(np.int64).max))
                yield from split([pa.RecordBatch.from_arrays([node, batch.column("class_id"), batch.column("embedded"), whole], ["node", "class_id", "embedded", "n"])])

    return split, roots


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows of one key at a time, from sorted batches."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not table.num_rows:
            continue
        keys = table.column(key).to_numpy()
        ends = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        begin = 0
        table = table.combine_chunks()
        for end in ends.tolist():
            yield table.slice(begin, end - begin)
            begin = end
        rest = table.slice(begin)
    if rest is not None and rest.num_rows:
        yield rest


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places is connected to by the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _candidates(least: float):
    """Task: small nodes' rows, sorted by node, to links of a spanning forest of the pairs that pass."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for group in _groups(batches, "node"):
            ids = group.column("class_id").to_numpy()
            data = np.frombuffer(b"".join(group.column("embedded").to_pylist()), np.uint32).reshape(len(ids), -1)
            near = [np.flatnonzero((data[i + 1 :] == data[i]).mean(axis=1) >= least) + i + 1 for i in range(len(ids) - 1)]
            a = np.repeat(np.arange(len(near)), [len(x) for x in near])
            if len(a):
                root = forest(len(ids), a, np.concatenate(near))
                moved = np.flatnonzero(root != np.arange(len(ids)))
                out.append((ids[moved], ids[root[moved]]))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b"])

    return compare


def candidate_links(embedded: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Links (a, b) that connect all pairs found by the recursion. ``embedded``: class_id, embedded."""
    split, roots = _children(threshold, n_runs(threshold, recall))
    least = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / COORDINATES)
    tasks = int(embedded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "node long, class_id long, parent_n long"
    rows = stage(embedded.mapInArrow(roots, schema))
    links = None
    for level in range(DEPTH):
        sizes = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        together = stage(rows.join(sizes, "node"))
        big = F.col("n") > SMALL
        # What stays together is one cluster, whose classes are all linked with its first: the exact comparison follows.
        alike = big & (F.lit(level == DEPTH - 1) | (F.col("n") >= ALIKE * F.col("parent_n")))
        kept = together.where(alike)
        found = kept.join(kept.groupBy("node").agg(F.min("class_id").alias("b")), "node").select(F.col("class_id").alias("a"), "b")
        pairs = (
            together.where(~big)
            .select("node", "class_id")
            .join(embedded, "class_id")
            .repartition(tasks, "node")
            .sortWithinPartitions("node", "class_id")
            .mapInArrow(_candidates(least), "a long, b long")
        )
        links = pairs.unionByName(found) if links is None else links.unionByName(pairs).unionByName(found)
        again = together.where(big & ~alike).select("node", "class_id", "n")
        if again.isEmpty():
            break
        rows = stage(again.join(embedded, "class_id").select("node", "class_id", "embedded", "n").mapInArrow(split, schema))
    return stage(links.distinct())


def _exact(threshold: float):
    """Task: rows of units (unit, part, crossed, class_id, shingles), sorted, to counts and links of a spanning forest.

    A crossed unit has two blocks, ``part`` 0 and 1, and only pairs between them count; either may be empty.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "unit"):
            # A row that is repeated in the table brings its set twice.
            _, once = np.unique(group.column("class_id").to_numpy(), return_index=True)
            group = group.take(pa.array(once))
            ids, part = group.column("class_id").to_numpy(), group.column("part").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
            size = np.array([len(x) for x in sets])
            _, code = np.unique(np.concatenate(sets), return_inverse=True)
            owner = np.repeat(np.arange(len(ids)), size)
            order = np.argsort(code, kind="stable")
            posting, start = owner[order], np.concatenate([[0], np.cumsum(np.bincount(code))])
            at = np.concatenate([[0], np.cumsum(size)])
            crossed = group.column("crossed")[0].as_py()
            count, a, b = np.zeros(len(ids), np.int64), [], []
            for i in range(len(ids)):
                own = code[at[i] : at[i + 1]]
                shared = np.bincount(posting[ragged(start[own], start[own + 1] - start[own])], minlength=len(ids))
                alike = shared >= threshold * (size + size[i] - shared) - 1e-9
                alike[i] = False
                if crossed:
                    alike &= part != part[i]
                near = np.flatnonzero(alike)
                count[i] = len(near)
                near = near[near > i]
                a.append(np.full(len(near), i))
                b.append(near)
            root = forest(len(ids), np.concatenate(a), np.concatenate(b))
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[root[some]]), pa.array(count[some])], ["a", "b", "n"])

    return compare


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, part in slices(texts_of(batch.column("text"))):
            values, at = shingles(part, SHINGLE)
            data = [np.unique(values[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
            columns = {c: batch.column(c).slice(first, len(part)) for c in ("class_id", "root", "blocks")}
            size = pa.array([len(x) // 8 for x in data], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns.values(), size, pa.array(data, pa.binary())], [*columns, "size", "shingles"])


def verified_links(texts: DataFrame, clusters: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, n): of each class with links in a unit, the root of its spanning tree there and its number of links.

    ``texts``: class_id, text. ``clusters``: node, root.
    """
    spark = texts.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = texts.join(clusters.withColumnRenamed("node", "class_id"), "class_id").withColumn("blocks", F.lit(1))
    sets = stage(members.select("class_id", "root", "blocks", "text").mapInArrow(_sets, "class_id long, root long, blocks int, size long, shingles binary"))
    wide = sets.groupBy("root").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks"))
    placed = sets.drop("blocks").join(wide, "root").withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = placed.withColumn("other", other).select(
        F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("part"),
        (F.col("block") != F.col("other")).alias("crossed"),
        "class_id",
        "shingles",
    )
    return stage(units.repartition(tasks, "unit").sortWithinPartitions("unit", "part", "class_id").mapInArrow(_exact(threshold), "a long, b long, n long"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row: doc_id, class_id, n_copies, n_links (other classes it is linked with), group_id, kept.

    ``group_id`` is the smallest doc_id of the classes connected by links; the row kept is that document's.
    """
    bounded_batches(docs.sparkSession)
    own = classes(docs, id_col, text_col)
    firsts = own.where("row = node")
    embedded = firsts.where("embedded is not null").select(F.col("node").alias("class_id"), "embedded")
    clusters = stage(components(candidate_links(embedded, threshold, recall)))
    # The texts of clusters' classes are found by id and hash of the text, which a second read can't change.
    names = firsts.join(clusters.select("node"), "node", "left_semi").select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), F.col("node").alias("class_id"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    again = docs.select(F.col(id_col).alias("_id_"), F.xxhash64(text).alias("_copy"), text.alias("text"))
    numbered = again.join(names, again["_id_"].eqNullSafe(names["_id"]) & (again["_copy"] == names["_copy"])).select("class_id", "text")
    verified = verified_links(numbered, clusters, threshold)
    counts = verified.groupBy("a").agg(F.sum("n").alias("n_links"))
    groups = components(verified.select("a", "b"))
    linked = counts.join(groups.withColumnRenamed("node", "a"), "a").withColumnRenamed("a", "node")
    per_class = firsts.select("node", "class_id").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_class = stage(per_class)
    first_of = per_class.groupBy("root").agg(F.min(F.struct(F.col("class_id").isNull().alias("none"), "class_id", "node")).alias("first"), F.count("*").alias("group_classes"))
    per_class = per_class.join(first_of, "root").select("node", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("first.class_id").alias("group_id"), F.col("first.node").alias("first"), "group_classes")
    return own.drop("embedded").join(per_class, "node").select(
        "doc_id", "class_id", "n_copies", "n_links", "group_id", "group_classes", (F.col("row") == F.col("first")).alias("kept"), "copy"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group, all columns kept."""
    judged = jaccard_join(docs, id_col, text_col, **options)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "copy")
    return keep_rows(docs, judged.select(key.alias("doc_id"), "kept"), id_col, text_col)
