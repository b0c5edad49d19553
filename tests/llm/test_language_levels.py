"""Language identification: many languages, levels of the prior, own rows left out, repeats and long texts."""

import random

from pyspark.sql import functions as F

from ledgerglass.llm import language_id

SCHEMA = "doc_id long, text string, lang string, source string, domain string, logs string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", "y") for i, t, lang, s in rows], SCHEMA)


def test_seventy_languages(spark):
    """None is dropped: each declared language gets a model."""
    rng = random.Random(1)
    names = [a + b for a in "abcdefghij" for b in "klmnopq"]
    own = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(8)] for n in names}
    rows = [(i, " ".join(rng.choice(own[n]) for _ in range(40)), n, None) for i, n in enumerate(names * 8)]
    got = {r.doc_id: r for r in language_id.identify_documents(table(spark, rows)).collect()}
    assert len({r.language for r in got.values()}) == 70 and not any(r.rejected for r in got.values())
    assert all(got[i].language == n for i, _, n, _ in rows)


def test_no_row_votes_for_itself(spark):
    """The only row of a host and domain is judged as if it had none."""
    base = [(i, "the thing with other words" if i % 2 else "das ding mit andere worte", "en" if i % 2 else "de", None) for i in range(60)]
    rows = [*base, (100, "zz", "en", None), (101, "zz", "en", "only.example.org")]
    got = {r.doc_id: r.confidence for r in language_id.identify_documents(table(spark, rows)).collect()}
    assert got[100] == got[101]


def test_a_domain_speaks_for_its_hosts(spark):
    """Hosts of one domain share their languages; the country suffix counts too."""
    base = [(i, "the thing with other words here" if i % 2 else "das ding mit andere worte hier", "en" if i % 2 else "de", f"h{i}.{'uno' if i % 2 else 'due'}.org") for i in range(80)]
    rows = [*base, (200, "zz", None, "new.uno.org"), (201, "zz", None, "new.due.org"), (202, "zz", None, "a.de"), (203, "zz", None, "a.co.uk")]
    got = {r.doc_id: r.language for r in language_id.identify_documents(table(spark, rows)).collect()}
    assert [got[i] for i in (200, 201, 202, 203)] == ["en", "de", "de", "en"]


def test_domains(spark):
    hosts = ["a.b.example.org", "www.shop.co.uk", "shop.co.uk", "plain", "x.de", None]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    found = [tuple(r) for r in df.select(language_id.domain_of(F.col("h")), language_id.suffix_of(F.col("h"))).collect()]
    assert found == [("example.org", ""), ("shop.co.uk", "uk"), ("shop.co.uk", "uk"), ("plain", ""), ("x.de", "de"), (None, None)]


def test_repeated_rows_and_long_texts(spark):
    base = [(i, "the thing with other words" if i % 2 else "das ding mit andere worte", "en" if i % 2 else "de", "s") for i in range(40)]
    rows = [*base, base[1], base[1], (300, "das ding " * 200_000, None, "s"), (None, "the thing", "en", None), (301, None, "de", "s")]
    got = language_id.identify_documents(table(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r.doc_id == 1 for r in got) == 3
    assert next(r for r in got if r.doc_id == 300).language == "de" and next(r for r in got if r.doc_id == 301).rejected
