"""Card and merchant windows against plain Python loops, on tied and bursty times."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerglass.operators import rolling
from ledgerglass.schema import DAY_US

COLUMNS = "trans_num long, cc_num long, merchant string, city string, us long, amt decimal(18,2), distance double, is_fraud int"


def _rows(n=240, cards=4, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # whole and half days give many equal times and exact window edges
        us = rnd.randrange(0, 80) * DAY_US // 2 + rnd.choice([0, 0, 0, 1, -1])
        card = 0 if rnd.random() < 0.4 else rnd.randrange(cards)
        amount = round(rnd.random() * 90 + 1, 2)
        rows.append((i, card, f"m{rnd.randrange(3)}", f"c{card % 2}", us + DAY_US, amount, float(rnd.randrange(900)), int(rnd.random() < 0.2)))
    return rows


def _frame(spark, rows):
    from decimal import Decimal

    rows = [(*r[:5], Decimal(str(r[5])), *r[6:]) for r in rows]
    return spark.createDataFrame(rows, COLUMNS).withColumn(
        "trans_date_trans_time", F.timestamp_micros("us")
    )


def _expected_card(rows, windows):
    out = {}
    city = {}
    for c in {r[3] for r in rows}:
        mine = [r for r in rows if r[3] == c]
        city[c] = (sum(r[5] for r in mine) / len(mine), sum(r[6] for r in mine) / len(mine))
    gaps = {}
    for card in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == card), key=lambda r: (r[4], r[0]))
        for i, r in enumerate(mine):
            got = {}
            for w in windows:
                prev = mine[i - 1] if i else None
                span = [q for q in mine[:i] if q[4] > prev[4] - w * DAY_US] if i else []
                got[f"count_amount_{w}_days"] = len(span) if i else None
                got[f"sum_amount_{w}_days"] = sum(q[5] for q in span) if i else None
                got[f"avg_amount_{w}_days"] = sum(q[5] for q in span) / len(span) if i else city[r[3]][0]
                got[f"avg_distance_{w}_days"] = sum(q[6] for q in span) / len(span) if i else city[r[3]][1]
                got[f"amount_over_average_{w}_days"] = r[5] / got[f"avg_amount_{w}_days"]
            gaps[r[0]] = (r[4] - mine[i - 1][4]) / 1e6 if i else None
            got["daily_trans_count"] = sum(q[4] // DAY_US == r[4] // DAY_US for q in mine)
            out[r[0]] = got
    known = [g for g in gaps.values() if g is not None]
    for i, g in gaps.items():
        for w in windows:
            out[i][f"inter_transaction_time_{w}_days"] = sum(known) / len(known) if g is None else g
    return out


@pytest.mark.parametrize("max_rows", [10**9, 30, 0])
def test_card_behaviour(spark, max_rows):
    rows, windows = _rows(), (1, 7)
    want = _expected_card(rows, windows)
    got = rolling.card_behaviour(_frame(spark, rows), windows, max_rows=max_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        for name, value in want[r.trans_num].items():
            assert r[name] == (None if value is None else pytest.approx(value, abs=1e-6)), (r.trans_num, name)


@pytest.mark.parametrize("max_rows", [10**9, 90, 0])
def test_merchant_risk(spark, max_rows):
    rows = _rows()
    got = rolling.merchant_risk(_frame(spark, rows), 7, (1, 30), max_rows=max_rows).collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in rows}
    for r in got:
        me = by_id[r.trans_num]
        for w in (1, 30):
            old, new = me[4] - (7 + w) * DAY_US, me[4] - 7 * DAY_US
            span = [q for q in rows if q[2] == me[2] and old < q[4] <= new]
            assert r[f"merchant_num_trans_{w}_day_window"] == len(span)
            risk = sum(q[7] for q in span) / len(span) if span else 0.0
            assert r[f"merchant_risk_{w}_day_window"] == pytest.approx(risk)


def test_one_card_only(spark):
    rows = [r for r in _rows() if r[1] == 0]
    want = _expected_card(rows, (7,))
    for r in rolling.card_behaviour(_frame(spark, rows), (7,)).collect():
        assert r.count_amount_7_days == want[r.trans_num]["count_amount_7_days"]


def test_missing_column(spark):
    with pytest.raises(ValueError, match="merchant"):
        rolling.merchant_risk(spark.range(3))


def test_all_windows_share_one_shuffle(spark):
    df = _frame(spark, _rows())
    for built in (rolling.card_totals(df, (1, 7, 30)), rolling.merchant_risk(df, 7, (1, 7, 30))):
        plan = built._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        # a sliding frame would cost rows times window
        assert "specifiedwindowframe(RangeFrame, -" not in plan
