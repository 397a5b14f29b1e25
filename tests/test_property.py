"""Property test: on random bar sets (gaps, missing and zero prices, ties, thin
days) the set-oriented index equals a day-by-day loop written here from the
model description: performance, holdings and the trade log."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import make_bars
from evenbasket.operators.equal_weight import equal_weight_index

DATES = [dt.date(2025, 1, d) for d in (2, 3, 6, 7, 8, 10)]
TICKERS = ["A", "B", "C", "D", "E"]

price = st.one_of(st.none(), st.just(0.0), st.sampled_from([1.0, 2.5, 4.0, 10.0, 12.5, 20.0]))
bar = st.tuples(st.sampled_from(DATES), st.sampled_from(TICKERS), price, st.sampled_from([10, 20, 40]))


def loop(rows, n, notional=1e6):
    """Reference-style loop over trading dates."""
    by_date = {}
    for d, t, p, v in rows:
        by_date.setdefault(d, {})[t] = (p, v)
    perf, cons, log = {}, {}, {}
    held, prev_total = {}, None  # ticker -> shares
    for d in sorted(by_date):
        day = by_date[d]
        elig = [(t, p, (p * v if p is not None else None)) for t, (p, v) in day.items() if p is not None and p > 0]
        elig.sort(key=lambda x: (-(x[2] if x[2] is not None else -math.inf), x[0]))  # cap desc, ticker
        top = elig[:n]
        if prev_total is None:
            total = notional
        else:
            total = sum(sh * day[t][0] for t, sh in held.items() if t in day and day[t][0] is not None)
        k = len(top)
        new = {t: (total * (1.0 / k)) / p for t, p, _ in top} if k else {}
        if prev_total is not None:
            for t in set(new) | set(held):
                cur = day.get(t, (None, None))[0]
                if t in new and t in held:
                    log[(d, t)] = ("REBALANCE", new[t] - held[t])
                elif t in new:
                    log[(d, t)] = ("ADD", new[t])
                else:
                    log[(d, t)] = ("REMOVE", -held[t], None if cur is None else -(held[t] * cur))
        for t, sh in new.items():
            cons[(d, t)] = sh
        ret = 0.0 if prev_total is None else (None if prev_total == 0 else total / prev_total - 1)
        perf[d] = (total, ret)
        held, prev_total = new, total
    return perf, cons, log


def close(a, b):
    return a == pytest.approx(b, rel=1e-9, abs=1e-6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(bar, min_size=1, max_size=22, unique_by=lambda r: (r[0], r[1])), n=st.integers(1, 4))
def test_set_form_equals_loop(spark, rows, n):
    perf, cons, log = loop(rows, n)
    ix = equal_weight_index(make_bars(spark, rows), n=n)
    got_perf = {r.date: r for r in ix.performance().collect()}
    assert set(got_perf) == set(perf)
    for d, (total, ret) in perf.items():
        assert close(got_perf[d].total_notional, total)
        if ret is None:
            assert got_perf[d].daily_return is None
        else:
            assert close(got_perf[d].daily_return, ret)
    got_cons = {(r.date, r.ticker): r.shares_held for r in ix.constituents().collect()}
    assert set(got_cons) == set(cons)
    for k, sh in cons.items():
        assert close(got_cons[k], sh)
    got_log = {(r.date, r.ticker): r for r in ix.rebalancing_log().collect()}
    assert set(got_log) == set(log)
    for k, want in log.items():
        r = got_log[k]
        assert r.action_type == want[0]
        assert close(r.shares_change, want[1])
        if want[0] == "REMOVE":
            assert (r.notional_change is None) == (want[2] is None)
            if want[2] is not None:
                assert close(r.notional_change, want[2])
