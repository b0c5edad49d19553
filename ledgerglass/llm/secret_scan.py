"""Secret scan with an incremental ledger of blobs.

Every text is addressed by its SHA-256 digest. The ledger holds one row per blob, rule and rule version
with the spans found (none, too). A run scans only the pairs that the ledger lacks, each distinct text once,
and ``findings`` joins the ledger back to all documents that hold a blob.

Spans come from two built-ins: the matches of a pattern and the pieces between them, whose
lengths add up to the positions (code points, end exclusive).

Defined results: null text counts as empty; documents without a finding get zero counts and
empty spans; repeated rows each get their row; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """A pattern; of its matches, those whose group has at least ``least`` characters count."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The patterns of the three base kinds. A run of hex digits or of access-key characters is matched
#: whole, so their length limits can stand in the pattern; the limit of an assignment can not.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", 1, r"[0-9a-f]{24,}", base=True),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of the rule's matches that are long enough."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.split(text, rule.pattern, -1)
    values = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
    parts = F.arrays_zip(
        F.transform(F.slice(pieces, F.lit(1), F.size(hits)), F.length).alias("gap"),
        F.transform(hits, F.length).alias("n"),
        F.transform(values, F.length).alias("own"),
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + x["n"]
        found = F.when(x["own"] >= rule.least, F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(empty)
        return F.struct(end.alias("at"), F.concat(acc["found"], found).alias("found"))

    begin = F.struct(F.lit(0).alias("at"), empty.alias("found"))
    found = F.aggregate(parts, begin, step, lambda acc: acc["found"])
    return F.when(text.rlike(rule.pattern), found).otherwise(empty)


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(docs: DataFrame, ledger: DataFrame | None = None, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, rule, version, spans) for the pairs that the ledger lacks."""
    texts = docs.select(blob_of(F.col(text_col)).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("seen"))
        wanted = F.array(*[F.lit(r.key) for r in rules])
        texts = texts.join(seen, "blob", "left").where(F.col("seen").isNull() | (F.size(F.array_except(wanted, F.col("seen"))) > 0))
    else:
        texts = texts.withColumn("seen", F.lit(None).cast("array<string>"))
    once = texts.dropDuplicates(["blob"])
    results = F.array(
        *[
            F.when(
                F.col("seen").isNull() | ~F.array_contains("seen", r.key),
                F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), spans(F.col("text"), r).alias("spans")),
            )
            for r in rules
        ]
    )
    return once.select("blob", F.explode(F.array_compact(results)).alias("x")).select("blob", "x.*")


def _joined(found: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"]), x["start"], x["end"])), ",")


def findings(docs: DataFrame, ledger: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document, from the ledger's rows of the rules' versions."""
    listed = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i + 1))])
    order = listed[F.concat_ws("@", "rule", "version")]
    found = (
        ledger.withColumn("kind", order)
        .where(F.col("kind").isNotNull() & (F.size("spans") > 0))
        .select("blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("kind").alias("kind"), s["end"].alias("end"))).alias("spans"))
        .groupBy("blob")
        .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("found"))
    )
    base = [i + 1 for i, r in enumerate(rules) if r.base]
    paths = docs.select(F.col(id_col).alias("doc_id"), blob_of(F.col(text_col)).alias("blob"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = paths.join(found, "blob", "left").withColumn("found", F.coalesce("found", none))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    return joined.select(
        "doc_id",
        *[count(i).alias(f"n_{rules[i - 1].kind}") for i in base],
        F.sha2(_joined(F.filter("found", lambda x: x["kind"].isin(base)), rules), 256).alias("base_sha256"),
        _joined(F.col("found"), rules).alias("spans"),
        F.col("blob"),
    )
