"""As-of join, carried windows and hot keys with repeated ids."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerglass.operators import carried, rolling
from ledgerglass.operators.asof import asof_join
from ledgerglass.operators.skew import join_salted

START = dt.datetime(2024, 1, 1)
TS = "trans_date_trans_time"
SCHEMA = f"trans_num long, {TS} timestamp, cc_num long, merchant string, city string, amt decimal(18,2), distance double, is_fraud int"


def transactions(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = START + dt.timedelta(days=rng.randrange(40), seconds=rng.choice([0, 3600, rng.randrange(86400)]))
        card = 1 if rng.random() < 0.4 else rng.randrange(2, 20)
        rows.append((i, at, card, rng.choice("pppqr"), rng.choice("xyz"), Decimal(rng.randrange(9000)) / 100, rng.random() * 50, int(rng.random() < 0.1)))
    return spark.createDataFrame(rows, SCHEMA)


def as_rows(df):
    cells = lambda r: tuple(round(x, 7) if isinstance(x, float) else x for x in r)
    return sorted(map(str, map(cells, df.select(*sorted(df.columns)).collect())))


def test_day_by_day_equals_one_batch(spark, tmp_path):
    tx = transactions(spark)
    windows, risks = (1, 7, 30), (1, 7)
    means = rolling.city_means(tx)
    cards = rolling.key_profile(tx, "cc_num")
    whole = rolling.merchant_risk(rolling.card_behaviour(tx, windows, means, cards), 7, risks)
    state = carried.begin(tx.where(F.col(TS) < START + dt.timedelta(days=10)), windows, 7, risks)
    out, day = None, 10
    for n, step in enumerate((1, 1, 5, 3, 20)):
        some = tx.where((F.col(TS) >= START + dt.timedelta(days=day)) & (F.col(TS) < START + dt.timedelta(days=day + step)))
        made, state = carried.advance(state, some, windows, 7, risks, means, cards, max_rows=30 if n == 4 else 10**9)
        state.save(str(tmp_path / f"s{n}"))
        state = carried.State.load(spark, str(tmp_path / f"s{n}"))
        out, day = made if out is None else out.unionByName(made), day + step
    want = whole.where(F.col(TS) >= START + dt.timedelta(days=10)).select(*out.columns)
    assert as_rows(out) == as_rows(want)
    # totals carried forward are those of the whole table, and the tails are a part of it
    assert as_rows(state.cards.select(*cards.columns)) == as_rows(cards)
    assert as_rows(carried.city_means(state)) == as_rows(rolling.city_means(tx))
    assert state.merchant_tail.count() < tx.count() / 2
    n_days = tx.select(F.to_date(TS)).distinct().count()
    one = carried.sparsity(state, "merchant", "merchant").where("merchant = 'p'").first()
    assert one.merchant_count_sparsity == n_days / tx.where("merchant = 'p'").count()


def test_begin_with_nothing_and_late_rows(spark):
    tx = transactions(spark, 60)
    state = carried.begin(tx.limit(0))
    made, state = carried.advance(state, tx)
    assert made.count() == 60
    assert made.where("avg_amount_7_days IS NULL").count() > 0  # no earlier city mean to fall back on
    with pytest.raises(PySparkException, match="not newer"):
        carried.advance(state, tx.limit(3))
    none, _ = carried.advance(state, tx.limit(0))
    assert none.count() == 0


def brute_asof(rows, events, strict):
    out = []
    for i, k, at in rows:
        ok = [e for e in events if k is not None and at is not None and e[0] == k and e[1] is not None and (e[1] < at or (e[1] == at and not strict))]
        best = max(ok, key=lambda e: (e[1], e[2] is not None, e[2] or 0), default=(None,) * 4)
        out.append((i, best[3]))
    return sorted(out, key=str)


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join(spark, strict):
    rng = random.Random(5)
    at = lambda: None if rng.random() < 0.05 else START + dt.timedelta(hours=rng.randrange(60))
    key = lambda: rng.choice(["a"] * 6 + ["b", "c", None])
    rows = [(i, key(), at()) for i in range(300)] + [(7, "a", START), (7, "a", START), (900, "z", START)]
    events = [(key(), at(), i if i % 5 else None, float(i)) for i in range(200)]
    events = list({(k, t, n is None or n): (k, t, n, v) for k, t, n, v in events}.values())
    df = spark.createDataFrame(rows, "id long, k string, at timestamp").repartition(3)
    ev = spark.createDataFrame(events, "k string, at timestamp, n long, v double").repartition(2)
    got = asof_join(df, ev, ["k"], "at", ["v"], tie="n", strict=strict)
    assert sorted((tuple(r) for r in got.select("id", "v").collect()), key=str) == brute_asof(rows, events, strict)
    assert asof_join(df, ev.limit(0), ["k"], "at", ["v"]).where("v IS NOT NULL").count() == 0


def test_repeated_and_null_ids_give_one_result_for_every_size(spark):
    base = transactions(spark, 60).collect()
    rows = [tuple(r) for r in base] + [tuple(base[3]), tuple(base[3]), (None, *base[5][1:]), (None, *base[6][1:]), (base[7][0], *base[8][1:])]
    tx = spark.createDataFrame(rows, SCHEMA).repartition(3)
    results = [
        as_rows(rolling.merchant_risk(rolling.card_behaviour(tx, (1, 7), max_rows=limit), 2, (1, 7), max_rows=limit)) for limit in (0, 10, 10**9)
    ]
    assert len(results[0]) == len(rows)
    assert results[0] == results[1] == results[2]


def test_salted_joins_equal_plain_ones(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else str(i % 7)) for i in range(300)] + [(1, None)], "i long, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("3", 3), (None, 4)], "r string, v long")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = join_salted(left, right, {"k": "r"}, how)
        assert as_rows(join_salted(left, right, {"k": "r"}, how, max_rows=20)) == as_rows(plain)
        assert as_rows(plain) == as_rows(left.join(right, left.k == right.r, how).drop("r"))


def test_asof_join_writes_its_time_line_once(spark, monkeypatch):
    """Rows bring their columns along: one staged table, and no join of all rows back."""
    from ledgerglass.operators import asof, running
    from ledgerglass.sources import stage as staging

    staged = []
    counted = lambda df: staged.append(1) or staging.stage(df)
    for module in (asof, running):
        monkeypatch.setattr(module, "stage", counted, raising=False)
    df = spark.createDataFrame([(1, "a", 5, "x"), (2, "a", 1, "y"), (3, None, 5, "z"), (4, "a", None, None)], "id long, k string, at long, more string")
    ev = spark.createDataFrame([("a", 3, 1.0), ("a", 9, 2.0), (None, 1, 3.0)], "k string, at long, v double")
    got = asof_join(df, ev, ["k"], "at", ["v"])
    assert got.columns == ["id", "k", "at", "more", "v"] and len(staged) == 1
    assert sorted(map(tuple, got.collect())) == [(1, "a", 5, "x", 1.0), (2, "a", 1, "y", None), (3, None, 5, "z", None), (4, "a", None, None, None)]


def test_asof_join_by_date_and_totals_of_null_groups(spark):
    from ledgerglass.operators import running

    day = dt.date(2020, 1, 2)
    df = spark.createDataFrame([(1, "a", day), (2, "a", None), (3, None, day)], "id long, k string, at date")
    got = asof_join(df, spark.createDataFrame([("a", day, 1.0)], "k string, at date, v double"), ["k"], "at", ["v"])
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, 1.0), (2, None), (3, None)]
    rows = spark.range(200).select(F.col("id").alias("o"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.lit(1).cast("long").alias("x"))
    found = running.running_totals(rows, ["g"], "o", {"s": ("sum", "x")}, ranges=8)
    assert found.columns == ["o", "g", "x", "s"] and all(r.s == r.o // 3 for r in found.collect())
