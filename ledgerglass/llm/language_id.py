"""Language identification by fusing evidence.

Four sources are combined as a Bayesian product: the likelihood of the text under byte 4-gram models, the
declared language, the country suffix of the address, and a prior of the host. The prior is smoothed along
host, domain and all rows, from sums of the posteriors that the other three give (grouped
aggregations); a row's own share is taken out at each level, so no row votes for itself.

The text models are fitted on a bounded sample: the ``sample`` rows with the smallest hash of their id, labelled by
what they declare. Everything else covers all rows. A text's evidence is scaled to at most ``EVIDENCE`` 4-grams,
because overlapping grams are not independent.

A row is rejected (language ``und``) if its text has no letters, is less likely under every language than under an even
spread over all grams, or if no language reaches ``LEAST`` of the posterior. A text too short for a 4-gram rests on
the other evidence.

Defined results: null text counts as empty, missing declarations, hosts and suffixes are no evidence; repeated rows each
get a row; without any usable label every row is ``und``; an empty table gives no rows. Working columns have names of
their own, so clashing columns do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerglass.llm.arrays import flat, ragged, slices, texts_of
from ledgerglass.llm.rows import drop_rows, row_key
from ledgerglass.llm.shared import bounded_batches
from ledgerglass.sources.stage import stage

BITS = 15
SAMPLE = 2000
EVIDENCE = 60.0
#: Chance that a declared language is right, weight of a country suffix, strength of the priors, least posterior.
DECLARED_RIGHT = 0.9
SUFFIX_WEIGHT = 3.0
STRENGTH = 5.0
LEAST = 0.5
UNIT = 1_000_000
#: Bytes of text that are scored at a time: each 4-gram takes a row of the models, some hundred bytes in all.
PART_BYTES = 1 << 19

#: Main language of country suffixes.
SUFFIXES = {"fr": "fr", "de": "de", "at": "de", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl"}


def grams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the 4 bytes from each place on, n + 1 offsets of the texts); A-Z in lower case, digits and signs as a space."""
    lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    lower = np.where(((lower >= 97) & (lower <= 122)) | (lower >= 128), lower, np.uint8(32)).astype(np.uint32)
    if len(lower) < 4:
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    window = (lower[:-3] << 24) | (lower[1:-2] << 16) | (lower[2:-1] << 8) | lower[3:]
    spaces = window == 0x20202020
    bucket = ((window * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
    count = np.maximum(np.diff(at) - 3, 0)
    place = ragged(at[:-1], count)
    kept = ~spaces[place]
    return bucket[place[kept]], np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(count)])]


def letters(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of letter bytes of each text."""
    own = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | (data >= 128)
    return np.diff(np.concatenate([[0], np.cumsum(own)])[at])


def fit(rows: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each language's grams). ``rows``: id, text, declared.

    What comes to the driver is at most ``sample`` ids with labels, and one sum per language and bucket.
    """
    labelled = rows.where(F.col("declared").isNotNull())
    chosen = labelled.select("id", "declared").orderBy(F.xxhash64("id"), "id", "declared").limit(sample)
    schema = "declared string, bucket int, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(texts_of(batch.column(1)), PART_BYTES):
                bucket, at = grams(*flat(part))
                label = np.repeat(np.array(batch.column(0).slice(first, len(part)).to_pylist(), object), np.diff(at))
                for name in sorted(set(label)):
                    n = np.bincount(bucket[label == name], minlength=1 << BITS)
                    some = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some, pa.int32()), pa.array(n[some], pa.int64())], ["declared", "bucket", "n"])

    texts = labelled.join(F.broadcast(chosen.select("id").distinct()), "id", "left_semi").select("declared", "text")
    sums = texts.mapInArrow(count, schema).groupBy("declared", "bucket").agg(F.sum("n").alias("n")).toPandas()
    totals = sums.groupby("declared")["n"].sum()
    names = sorted(totals.index)  # at most ``sample`` labels
    table = np.zeros((len(names), 1 << BITS))
    for i, name in enumerate(names):
        own = sums[sums["declared"] == name]
        table[i, own["bucket"]] = own["n"]
    table = (table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * (1 << BITS))
    return names, np.log(table).astype(np.float32)


def _evidence(names: list[str], table: np.ndarray):
    """Task: (id, row, declared, host, domain, suffix, text) to logs of the evidence and posteriors in millionths."""
    by_gram = np.ascontiguousarray(table.T)
    even = -BITS * np.log(2)
    wrong = (1 - DECLARED_RIGHT) / max(1, len(names) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(texts_of(batch.column("text")), PART_BYTES):
                bucket, at = grams(*flat(part))
                n = np.diff(at)
                sums = np.zeros((len(part), len(names)))
                some = np.flatnonzero(n)
                if len(some):
                    sums[some] = np.add.reduceat(by_gram[bucket], at[:-1][some], axis=0, dtype=np.float64)
                text = sums / np.maximum(n, 1)[:, None]
                known = (letters(*flat(part)) > 0) & ((n == 0) | (text.max(axis=1, initial=-np.inf) > even))
                logs = text * np.minimum(n, EVIDENCE)[:, None]
                own = {c: batch.column(c).slice(first, len(part)).to_pylist() for c in ("declared", "suffix")}
                for i, name in enumerate(names):
                    declared = np.array([0.0 if d not in names else np.log(DECLARED_RIGHT if d == name else wrong) for d in own["declared"]])
                    suffix = np.array([np.log(SUFFIX_WEIGHT) if SUFFIXES.get(s) == name else 0.0 for s in own["suffix"]])
                    logs[:, i] += declared + suffix
                logs -= logs.max(axis=1, keepdims=True) if len(names) else 0
                share = np.exp(logs) / np.exp(logs).sum(axis=1, keepdims=True)
                share = np.where(known[:, None], np.rint(share * UNIT), 0).astype(np.int64)
                lists = lambda x, t: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel(), t), max(1, len(names))).cast(pa.list_(t)) if len(names) else pa.array([[]] * len(part), pa.list_(t))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, len(part)) for c in ("id", "row", "host", "domain")), pa.array(n), pa.array(known), lists(logs, pa.float64()), lists(share, pa.int64())],
                    ["id", "row", "host", "domain", "n_grams", "known", "logs", "share"],
                )

    return run


def _summed(i_count: int) -> list[Column]:
    return [F.array(*[F.sum(F.col("share")[i]) for i in range(i_count)]).alias("sums"), F.count("*").alias("n_rows")]


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0).cast("double"), lambda acc, v: acc + v)


def identify(docs: DataFrame, id_col: str, text: Column, declared: Column, host: Column, domain: Column | None = None, suffix: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row per row: doc_id, language, confidence, text_language, n_grams, rejected."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]{2,3})", 1)).alias("declared"),
        F.lower(host).alias("host"),
        F.lower(domain if domain is not None else host).alias("domain"),
        F.lower(suffix if suffix is not None else F.lit(None).cast("string")).alias("suffix"),
        text.alias("text"),
    ).withColumn("declared", F.when(F.col("declared") != "", F.col("declared")))
    names, table = fit(rows, sample)
    k = len(names)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, row long, host string, domain string, n_grams long, known boolean, logs array<double>, share array<long>"
    scored = stage(rows.mapInArrow(_evidence(names, table), schema))
    if not k:
        return scored.select(F.col("id").alias("doc_id"), F.lit("und").alias("language"), F.lit(0.0).alias("confidence"), F.lit("und").alias("text_language"), "n_grams", F.lit(True).alias("rejected"))

    hosts = stage(scored.where("host is not null").groupBy("domain", "host").agg(*_summed(k)))
    sum_up = [F.array(*[F.sum(F.col("sums")[i]) for i in range(k)]).alias("above")]
    whole = hosts.groupBy().agg(*sum_up).first()["above"] or [0] * k
    whole = [x or 0 for x in whole]
    base = [(x + UNIT) / (sum(whole) + k * UNIT) for x in whole]
    domains = hosts.groupBy("domain").agg(*sum_up)
    priors = stage(
        hosts.join(domains, "domain").select(
            "domain",
            "host",
            "n_rows",
            "sums",
            "above",
        )
    )
    # Hosts with over a thousandth of the rows, a thousand at most, meet their rows by broadcast; the others in a shuffle.
    n_rows = priors.agg(F.sum("n_rows")).first()[0] or 0
    heavy = priors.where(F.col("n_rows") > n_rows / 1000).select("domain", "host", "sums", "above")
    heavy_keys = heavy.select("domain", "host")
    light = scored.join(F.broadcast(heavy_keys), ["domain", "host"], "left_anti")
    joined = scored.join(F.broadcast(heavy), ["domain", "host"]).unionByName(light.join(priors.select("domain", "host", "sums", "above"), ["domain", "host"], "left"))
    # At every level the row's own share is taken out; rows without a host are in no sum.
    own = lambda i: F.col("share")[i]
    mine = _total(F.col("share"))
    rest = lambda sums, i: F.greatest(sums - own(i), F.lit(0))
    strength = STRENGTH * UNIT
    prior = []
    for i in range(k):
        everywhere = (rest(F.lit(whole[i]), i) + UNIT) / (F.greatest(F.lit(float(sum(whole))) - mine, F.lit(0.0)) + k * UNIT)
        domain_wide = (rest(F.col("above")[i], i) + strength * everywhere) / (F.greatest(_total(F.col("above")) - mine, F.lit(0.0)) + strength)
        here = (rest(F.col("sums")[i], i) + strength * domain_wide) / (F.greatest(_total(F.col("sums")) - mine, F.lit(0.0)) + strength)
        prior.append(F.coalesce(here, F.lit(base[i])))
    fused = joined.withColumn("fused", F.array(*[F.exp(F.col("logs")[i]) * prior[i] for i in range(k)]))
    labels = F.array(*[F.lit(n) for n in names])
    first = lambda c: F.element_at(labels, F.array_position(c, F.array_max(c)).cast("int"))
    confidence = F.array_max("fused") / _total(F.col("fused"))
    rejected = ~F.col("known") | (confidence < LEAST)
    return fused.select(
        F.col("id").alias("doc_id"),
        F.when(rejected, "und").otherwise(first(F.col("fused"))).alias("language"),
        F.round(confidence, 6).alias("confidence"),
        F.when(F.col("known"), first(F.col("logs"))).otherwise("und").alias("text_language"),
        "n_grams",
        rejected.alias("rejected"),
        F.col("row"),
    )


#: Second-level names under which country suffixes give out domains.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


def domain_of(host: Column) -> Column:
    """The last two labels of a host, or three below a second-level name such as co.uk; a host without dots is its own."""
    second = "|".join(SECOND_LEVEL)
    found = F.regexp_extract(host, rf"([^.]+\.(?:(?:{second})\.[A-Za-z]{{2}}|[^.]+))$", 1)
    return F.when(found != "", found).otherwise(host)


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"\.([A-Za-z]{2})$", 1)


def _parts_of(source: str) -> dict[str, Column]:
    """A document's source as an address: host, domain and suffix."""
    return {"host": F.col(source), "domain": domain_of(F.col(source)), "suffix": suffix_of(F.col(source))}


def identify_documents(docs: DataFrame) -> DataFrame:
    """Documents: ``lang`` is the declared language, ``source`` the address."""
    return identify(docs, "doc_id", F.col("text"), F.col("lang"), **_parts_of("source"))


def identify_pages(pages: DataFrame) -> DataFrame:
    """Web pages: declared by the html element, host, domain and suffix from the address."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1)
    inner = F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    return identify(
        pages,
        "page_id",
        inner,
        F.regexp_extract("html", r"(?i)<html[^>]*\slang=[\"']?([A-Za-z-]+)", 1),
        F.when(host != "", host),
        domain_of(host),
        suffix_of(host),
    )


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents whose language is known, all columns kept."""
    found = identify(docs.withColumn("_key", row_key("doc_id", "text")), "_key", F.col("text"), F.col("lang"), **_parts_of("source"))
    return drop_rows(docs, found.where("rejected").select(F.col("doc_id").alias("key")))
