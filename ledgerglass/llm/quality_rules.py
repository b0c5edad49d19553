"""Quality rules combined by weak supervision.

Each rule looks at a document's figures and votes good, bad or abstains. No rule decides: a two-class model holds,
for every rule, how often it votes good on good documents and bad on bad ones. Expectation-maximisation estimates
these accuracies and the share of good documents from the votes alone, without labels. A document's posterior
probability of being good then replaces the demand that all rules pass. An abstention says nothing about the class.

Documents with the same votes are one vote pattern: EM runs on at most ``3 ** len(rules)`` counted patterns, however
large the corpus is. All figures come from built-in functions on the row itself; texts are not shuffled.

Defined results: null or empty text has no words and fails; a document without a vote gets the prior; every row gets
a result, repeated rows each their own; an empty table gives no rows; other columns are ignored. A very long text is
handled in one row, in time n log n of its words.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, functions as F

from ledgerglass.sources.stage import stage

SPACE = r"[\x20\x09-\x0D]+"
ROUNDS = 60
SETTLED = 1e-6


@dataclass(frozen=True)
class Rule:
    """SQL conditions on the figures; neither true: the rule abstains."""

    name: str
    good: str
    bad: str


#: The bounds of the rules. Shares are per word unless named otherwise.
RULES = (
    Rule("length", "n_words >= 100", "n_words < 20"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 6 * n_words", "word_chars < 2 * n_words OR word_chars > 7 * n_words"),
    Rule("symbols", "n_symbols <= 0.05 * n_words", "n_symbols > 0.3 * n_words"),
    Rule("repeated_lines", "n_lines >= 3 AND n_dup_lines <= 0.1 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    Rule("repeated_words", "n_repeat_words <= 0.1 * n_words", "n_repeat_words > 0.3 * n_words"),
    Rule("bare_words", "n_bare <= 0.05 * n_words", "n_bare > 0.2 * n_words"),
    Rule("letters", "n_letters >= 0.85 * word_chars", "n_letters < 0.7 * word_chars"),
    Rule("capitals", "n_capitals BETWEEN 0.005 * word_chars AND 0.1 * word_chars", "n_capitals > 0.3 * word_chars"),
    Rule("distinct_words", "n_distinct >= 0.45 * n_words", "n_distinct < 0.1 * n_words"),
    Rule("line_ends", "n_ended >= 0.8 * n_lines", "n_ended < 0.3 * n_lines"),
    Rule("sentences", "n_sentences BETWEEN 0.02 * n_words AND 0.25 * n_words", "n_sentences = 0 OR n_sentences > 0.4 * n_words"),
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where a lambda refers to it for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeat_words(words: Column) -> Column:
    """How many words lie in windows of three that occur twice or more.

    Windows with their places are sorted, so equal ones are neighbours; each word of the found windows counts once.
    Texts whose windows have distinct hashes have none and are not sorted.
    """

    def covered(places: Column) -> Column:
        own = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(own, F.lit(0), lambda a, x: a + x)

    def equal(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    def twice(windows: Column) -> Column:
        found = F.filter(windows, lambda x, i: equal(x, F.get(windows, i - 1)) | equal(x, F.get(windows, i + 1)))
        return let(F.array_sort(F.transform(found, lambda x: x["place"])), covered)

    def counted(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        hashed = F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        windows = F.transform(starts, lambda i: F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("place")))
        several = let(hashed, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(F.size(w) < 4, 0).when(several, let(F.array_sort(windows), twice)).otherwise(0)

    return let(words, counted)


def figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and the figures that rules look at."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    bare = lambda pattern: F.length(F.regexp_replace("text", pattern, ""))
    of_words = let(
        words,
        lambda w: F.struct(F.size(w).alias("n_words"), F.size(F.array_distinct(w)).alias("n_distinct"), repeat_words(w).alias("n_repeat_words"), F.size(F.filter(w, lambda x: ~x.rlike(r"\p{L}"))).alias("n_bare")),
    )
    of_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
            F.size(F.filter(x, lambda y: y.rlike(r"""[.!?…:;]["')\]»”]*[\x20\x09-\x0D]*$"""))).alias("n_ended"),
        ),
    )
    counted = rows.select(
        "doc_id",
        of_words.alias("w"),
        of_lines.alias("x"),
        bare(SPACE).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).alias("n_symbols"),
        bare(r"[^\p{L}]+").alias("n_letters"),
        bare(r"[^\p{Lu}]+").alias("n_capitals"),
        (F.size(F.split("text", r"[.!?…]+(?=[\x20\x09-\x0D]|$)")) - 1).alias("n_sentences"),
    )
    names = ("w.n_words", "w.n_distinct", "w.n_repeat_words", "w.n_bare", "x.n_lines", "x.n_dup_lines", "x.n_ended", "word_chars", "n_symbols", "n_letters", "n_capitals", "n_sentences")
    return counted.select("doc_id", *[F.col(c).cast("long").alias(c.split(".")[-1]) for c in names])


def votes(figured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """With a column v0, v1, ... per rule: 1 good, -1 bad, 0 abstains."""
    return figured.withColumns({f"v{i}": F.expr(f"CASE WHEN {r.good} THEN 1 WHEN {r.bad} THEN -1 ELSE 0 END") for i, r in enumerate(rules)})


@dataclass(frozen=True)
class Model:
    """The share of good documents and, per rule, P(good vote | good, voted) and P(bad vote | bad, voted)."""

    good: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def posterior(self) -> Column:
        """P(good | votes), from the columns v0, v1, ..."""
        odds = F.lit(log(self.good / (1 - self.good)))
        for i, (a, b) in enumerate(zip(self.on_good, self.on_bad, strict=True)):
            odds = odds + F.when(F.col(f"v{i}") == 1, log(a / (1 - b))).when(F.col(f"v{i}") == -1, log((1 - a) / b)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def start(n: int) -> Model:
    """A rule knows one kind of bad document: it seldom objects to a good one and passes many bad ones of other kinds."""
    return Model(0.5, (0.95,) * n, (0.55,) * n)


def _held(on_good: float, on_bad: float) -> tuple[float, float]:
    """Better than chance, so that the classes cannot swap, and never perfect, so that one vote cannot overrule all others."""
    on_good = min(0.99, max(0.55, on_good))
    return on_good, min(0.99, max(1.05 - on_good, on_bad))


def expect_maximise(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS, settled: float = SETTLED) -> Model:
    """EM on counted vote patterns (v0, v1, ..., n); each round is one aggregation of at most 3^n rows."""
    model = start(n_rules)
    for _ in range(rounds):
        p = patterns.withColumn("p", model.posterior())
        sums = [F.sum(F.col("n") * F.col("p")).alias("good"), F.sum("n").alias("all")]
        for i in range(n_rules):
            v, good, bad = F.col(f"v{i}"), F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
            sums += [
                F.sum(F.when(v == 1, good).otherwise(0.0)).alias(f"gg{i}"),
                F.sum(F.when(v == -1, good).otherwise(0.0)).alias(f"gb{i}"),
                F.sum(F.when(v == 1, bad).otherwise(0.0)).alias(f"bg{i}"),
                F.sum(F.when(v == -1, bad).otherwise(0.0)).alias(f"bb{i}"),
            ]
        s = p.agg(*sums).first()
        if not s["all"]:
            return model
        share = (s["good"] + 1) / (s["all"] + 2)
        rates = [
            _held((s[f"gg{i}"] + 4) / (s[f"gg{i}"] + s[f"gb{i}"] + 5), (s[f"bb{i}"] + 1) / (s[f"bb{i}"] + s[f"bg{i}"] + 2)) for i in range(n_rules)
        ]
        new = Model(share, tuple(a for a, _ in rates), tuple(b for _, b in rates))
        before, after = (model.good, *model.on_good, *model.on_bad), (new.good, *new.on_good, *new.on_bad)
        model = new
        if max(abs(x - y) for x, y in zip(before, after, strict=True)) < settled:
            break
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, the figures, the votes as a string, posterior and whether it reaches the threshold."""
    voted = stage(votes(figures(docs, id_col, text_col), rules))
    names = [f"v{i}" for i in range(len(rules))]
    patterns = stage(voted.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1))
    model = expect_maximise(patterns, len(rules))
    p = voted.withColumn("posterior", model.posterior())
    cast = F.array_join(F.array(*[F.when(F.col(v) == 1, "+").when(F.col(v) == -1, "-").otherwise("0") for v in names]), "")
    return p.withColumns({"votes": cast, "good": F.col("posterior") >= threshold}).drop(*names)


def filter_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: base figures, the base check, and the verdict of votes and EM on what passes it."""
    judged = judge(docs, id_col, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("good")).alias("kept"),
        "posterior",
        "votes",
    )
