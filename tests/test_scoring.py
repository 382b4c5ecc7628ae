"""Scores against brute force and at every threshold."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from vigil import schemas
from vigil.plans.scoring import customer_daily_volume, transaction_scores

HOUR = timedelta(hours=1)
T0 = datetime(2026, 3, 10, 12, 0, 0)
ACCOUNTS = "account_id bigint, customer_id bigint"


def tx(i, account, at=T0, amount="10.00", country=None, category=None, status="PENDING"):
    return (i, account, None, Decimal(amount), "USD", category, country, status, 0, at)


def brute_force(rows, owner):
    """(volume, others in the past hour, score) per transaction, one comparison at a time."""
    result = {}
    for i, account, _, amount, _, category, country, _, _, at in rows:
        customer = owner.get(account)
        mine = [] if customer is None else [
            r for r in rows if owner.get(r[1]) == customer and r[7] != "DECLINED"
        ]
        volume = sum((r[3] for r in mine if r[9].date() == at.date()), Decimal("0.00"))
        others = sum(r[0] != i and at - HOUR <= r[9] <= at for r in mine)
        score = 25 if amount > 10000 else 15 if amount > 5000 else 5 if amount > 1000 else 0
        score += 25 * (country in ("KP", "IR", "SY", "CU", "VE", "MM", "AF"))
        score += 20 * (category in ("GAMBLING", "CRYPTO", "ADULT_CONTENT", "WEAPONS"))
        score += 10 * (at.hour < 5)
        score += 20 if volume > 50000 else 10 if volume > 20000 else 0
        score += 20 if others >= 5 else 10 if others >= 3 else 0
        result[i] = (customer, volume, others, min(score, 100))
    return result


def run(frame, rows, owners, **options):
    scores = transaction_scores(
        frame(rows, schemas.TRANSACTIONS), frame(list(owners.items()), ACCOUNTS), **options
    )
    found = scores.collect()
    assert len(found) == len({r.transaction_id for r in found})
    return {r.transaction_id: (r.customer_id, r.daily_volume, r.recent_count, r.risk_score) for r in found}


def random_rows(n, seed, spread_hours, hot_share=0.0):
    """Rows of 8 accounts of 3 customers and one account without owner; whole-second times collide."""
    pick = random.Random(seed)
    owners = {1: 10, 2: 10, 3: 10, 4: 20, 5: 20, 6: 20, 7: 30, 8: 30}
    rows = []
    for i in range(n):
        account = 1 if pick.random() < hot_share else pick.randint(1, 9)
        at = T0 + timedelta(seconds=pick.choice([pick.randrange(spread_hours * 3600), 3600 * pick.randrange(spread_hours)]))
        at += timedelta(microseconds=pick.choice([0, 0, 1, 999999]))
        rows.append(tx(
            i, account, at, str(pick.choice([0.01, 900, 1000, 1000.01, 5000.01, 10000.01, 3333.33])),
            pick.choice([None, "KP", "UA", "AF"]), pick.choice([None, "GAMBLING", "Gambling", "WEAPONS"]),
            pick.choice(["PENDING", "APPROVED", "FLAGGED", "DECLINED"]),
        ))
    return rows, owners


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(frame, seed):
    rows, owners = random_rows(200, seed, spread_hours=30)
    assert run(frame, rows, owners) == brute_force(rows, owners)


def test_dense_hour_equals_brute_force(frame):
    rows, owners = random_rows(250, 3, spread_hours=2, hot_share=0.5)
    assert run(frame, rows, owners) == brute_force(rows, owners)


def test_hour_is_closed_at_both_ends(frame):
    rows = [
        tx(1, 1, T0 - HOUR - timedelta(microseconds=1)),
        tx(2, 1, T0 - HOUR),
        tx(3, 2, T0),
        tx(4, 1, T0),
        tx(5, 1, T0 + timedelta(microseconds=1)),
        tx(6, 1, T0, status="DECLINED"),
    ]
    found = run(frame, rows, {1: 10, 2: 10})
    counts = {i: found[i][2] for i in found}
    assert counts == {1: 0, 2: 1, 3: 2, 4: 2, 5: 2, 6: 3}


def test_amount_thresholds(frame):
    amounts = ["1000.00", "1000.01", "5000.00", "5000.01", "10000.00", "10000.01"]
    rows = [tx(i, i, amount=a) for i, a in enumerate(amounts)]
    found = run(frame, rows, {i: i for i in range(6)})
    assert [found[i][3] for i in range(6)] == [0, 5, 5, 15, 15, 25]


def test_daily_volume_thresholds_pass_over_declined_rows(frame):
    rows, owners = [], {}
    for i, (first, rest) in enumerate([("900.00", "19100.00"), ("900.00", "19100.01"),
                                       ("900.00", "49100.00"), ("900.00", "49100.01")]):
        owners[i] = i
        rows += [tx(3 * i, i, amount=first, at=T0), tx(3 * i + 1, i, amount=rest, at=T0 + 5 * HOUR),
                 tx(3 * i + 2, i, amount="99999.00", at=T0 + 9 * HOUR, status="DECLINED")]
    found = run(frame, rows, owners)
    assert [found[3 * i][3] for i in range(4)] == [0, 10, 10, 20]


def test_recent_count_thresholds(frame):
    rows, owners, last = [], {}, {}
    for customer, earlier in enumerate([2, 3, 4, 5]):
        owners[customer] = customer
        for k in range(earlier + 1):
            last[customer] = len(rows)
            rows.append(tx(len(rows), customer, T0 + timedelta(minutes=k)))
    found = run(frame, rows, owners)
    assert [found[last[c]][3] for c in range(4)] == [0, 10, 10, 20]


def test_night_hours(frame):
    times = [datetime(2026, 3, 10, 23, 59, 59), datetime(2026, 3, 10), datetime(2026, 3, 10, 4, 59, 59),
             datetime(2026, 3, 10, 5)]
    found = run(frame, [tx(i, i, t) for i, t in enumerate(times)], {i: i for i in range(4)})
    assert [found[i][3] for i in range(4)] == [0, 10, 10, 0]


def test_category_is_case_sensitive_and_absent_values_add_nothing(frame):
    rows = [tx(0, 0, category="GAMBLING"), tx(1, 1, category="Gambling"), tx(2, 2), tx(3, 3, country="KP")]
    found = run(frame, rows, {i: i for i in range(4)})
    assert [found[i][3] for i in range(4)] == [20, 0, 0, 25]


def test_score_is_capped(frame):
    night = datetime(2026, 3, 10, 1)
    rows = [tx(i, 1, night - timedelta(minutes=i)) for i in range(1, 6)]
    rows.append(tx(0, 1, night, "60000.00", "KP", "CRYPTO"))
    assert run(frame, rows, {1: 1})[0][3] == 100


def test_rows_without_account_keep_their_own_points(frame):
    rows = [tx(i, 99, amount="30000.00") for i in range(6)]
    found = run(frame, rows, {1: 1})
    assert set(found.values()) == {(None, Decimal("0.00"), 0, 25)}


def test_history_rows_count_but_are_not_scored(frame):
    rows, owners = random_rows(150, 4, spread_hours=3)
    old, new = rows[:100], rows[100:]
    truth = brute_force(rows, owners)
    found = run(frame, new, owners, history=frame(old, schemas.TRANSACTIONS))
    assert found == {r[0]: truth[r[0]] for r in new}


def test_daily_volume_is_zero_when_all_is_declined(frame):
    rows = [tx(1, 1, amount="5.00", status="DECLINED"), tx(2, 2, amount="7.00")]
    found = customer_daily_volume(
        frame(rows, schemas.TRANSACTIONS), frame([(1, 10), (2, 20)], ACCOUNTS)
    ).collect()
    assert {r.customer_id: str(r.daily_volume) for r in found} == {10: "0.00", 20: "7.00"}


def test_rows_without_a_time_are_kept_and_stand_alone(frame):
    rows = [tx(1, 1, None, "30000.00"), tx(2, 1, None), tx(3, 1, T0), tx(4, 1, T0), tx(5, None, T0)]
    found = run(frame, rows, {1: 10})
    assert found == {
        1: (10, Decimal("0.00"), 0, 25), 2: (10, Decimal("0.00"), 0, 0), 3: (10, Decimal("20.00"), 1, 0),
        4: (10, Decimal("20.00"), 1, 0), 5: (None, Decimal("0.00"), 0, 0),
    }
