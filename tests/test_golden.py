"""Golden hand example F3 (FIXTURES.md): every table of both index variants."""

import pytest

from conftest import D
from evenbasket.operators import metrics as M
from evenbasket.operators import price_average as V1
from evenbasket.operators.equal_weight import equal_weight_index


@pytest.fixture(scope="module", params=[False, True, "derived"], ids=["lazy", "materialized", "derived"])
def ix(request, f3_bars):
    return equal_weight_index(f3_bars, n=2, materialize=request.param)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_performance(ix):
    got = rows(ix.performance(), "date")
    want = [
        (D(2025, 1, 2), 1000.0, 1_000_000.0, 0.0),
        (D(2025, 1, 3), 1100.0, 1_100_000.0, 0.1),
        (D(2025, 1, 6), 550.0, 550_000.0, -0.5),
        (D(2025, 1, 7), 550.0, 550_000.0, 0.0),
    ]
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0]
        assert g[1:] == pytest.approx(w[1:], rel=1e-12, abs=1e-12)


def test_constituents(ix):
    got = rows(ix.constituents(), "date", "ticker")
    want = [
        (D(2025, 1, 2), "A", 0.5, 50000, 10, 500000),
        (D(2025, 1, 2), "B", 0.5, 25000, 20, 500000),
        (D(2025, 1, 3), "A", 0.5, 44000, 12.5, 550000),
        (D(2025, 1, 3), "C", 0.5, 100000, 5.5, 550000),
        (D(2025, 1, 6), "A", 0.5, 22000, 12.5, 275000),
        (D(2025, 1, 6), "B", 0.5, 12500, 22, 275000),
        (D(2025, 1, 7), "A", 0.5, 22000, 12.5, 275000),
        (D(2025, 1, 7), "B", 0.5, 12500, 22, 275000),
    ]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2:] == pytest.approx(w[2:], rel=1e-12)


def test_rebalancing_log(ix):
    got = rows(ix.rebalancing_log(), "date", "ticker")
    want = [
        (D(2025, 1, 3), "A", "REBALANCE", -6000, -75000, 12.5),
        (D(2025, 1, 3), "B", "REMOVE", -25000, -475000, 19),
        (D(2025, 1, 3), "C", "ADD", 100000, 550000, 5.5),
        (D(2025, 1, 6), "A", "REBALANCE", -22000, -275000, 12.5),
        (D(2025, 1, 6), "B", "ADD", 12500, 275000, 22),
        (D(2025, 1, 6), "C", "REMOVE", -100000, None, None),
        (D(2025, 1, 7), "A", "REBALANCE", 0, 0, 12.5),
        (D(2025, 1, 7), "B", "REBALANCE", 0, 0, 22),
    ]
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want):
        for a, b in zip(g[3:], w[3:]):
            assert (a is None and b is None) or a == pytest.approx(b, rel=1e-12, abs=1e-9)


def test_summary_metrics(ix):
    m = M.summary_metrics(ix.performance(), ix.rebalancing_log(), 30, "max").first()
    assert m.cumulative_return == pytest.approx(-45.0)
    assert m.avg_daily_return == pytest.approx(-10.0)
    assert m.change_days == 3
    assert m.composition_change_days == 2


def test_v1_index(f3_bars):
    got = rows(V1.price_average_index(f3_bars, 2), "date")
    assert [r[1] for r in got] == pytest.approx([15.0, 9.0, 17.25, 17.25])


def test_v1_calendar_changes_monday_effect(f3_bars):
    got = rows(V1.composition_changes(f3_bars, 2, align="calendar"), "date", "ticker")
    assert got == [
        (D(2025, 1, 2), "A", "added"),
        (D(2025, 1, 2), "B", "added"),
        (D(2025, 1, 3), "B", "removed"),
        (D(2025, 1, 3), "C", "added"),
        (D(2025, 1, 6), "A", "added"),
        (D(2025, 1, 6), "B", "added"),
    ]


def test_v1_trading_changes(f3_bars):
    got = rows(V1.composition_changes(f3_bars, 2, align="trading"), "date", "ticker")
    # Monday compares with Friday {A, C}: B comes back, C leaves.
    assert got == [
        (D(2025, 1, 2), "A", "added"),
        (D(2025, 1, 2), "B", "added"),
        (D(2025, 1, 3), "B", "removed"),
        (D(2025, 1, 3), "C", "added"),
        (D(2025, 1, 6), "B", "added"),
        (D(2025, 1, 6), "C", "removed"),
    ]


def test_v1_metrics(f3_bars):
    m = V1.simple_metrics(
        V1.price_average_index(f3_bars, 2), V1.composition_changes(f3_bars, 2, align="calendar")
    ).first()
    assert m.cumulative_return == pytest.approx(0.15)
    assert m.avg_daily_return == pytest.approx((-0.4 + 17.25 / 9 - 1 + 0) / 3)
    assert m.num_changes == 6


def test_dashboard_views(ix):
    comp = {r.ticker: r for r in M.composition_on_date(ix.constituents(), "2025-01-06").collect()}
    assert set(comp) == {"A", "B"}
    assert comp["A"].weight_text == "50.00%"
    assert comp["A"].notional_text == "$275,000.00"
    recent = M.recent_changes(ix.rebalancing_log()).collect()
    assert recent[0].date == D(2025, 1, 7)
    texts = {(r.date, r.ticker): (r.notional_text, r.display_class) for r in recent}
    assert texts[(D(2025, 1, 6), "C")] == ("-", "color: red")
    assert texts[(D(2025, 1, 7), "A")] == ("-", "")
    assert texts[(D(2025, 1, 3), "B")] == ("$-475,000.00", "color: red")
    assert texts[(D(2025, 1, 3), "C")] == ("$550,000.00", "color: green")
    series = M.performance_series(ix.performance(), ix.rebalancing_log(), 30, "max").collect()
    assert [r.is_change_day for r in series] == [False, True, True, True]


def test_date_range_rebases_on_first_date_in_range(f3_bars):
    ix = equal_weight_index(f3_bars, n=2, start="2025-01-04", end="2025-01-07")
    got = rows(ix.performance(), "date")
    assert [r[0] for r in got] == [D(2025, 1, 6), D(2025, 1, 7)]
    assert got[0][1:] == (1000.0, 1_000_000.0, 0.0)
    assert ix.rebalancing_log().count() == 2  # only 01-07 trades


WANT_REPORT = [("2025-01-02", 0.0, "A, B"), ("2025-01-03", 0.1, "A, C"), ("2025-01-06", -0.5, "A, B"), ("2025-01-07", 0.0, "A, B")]


@pytest.mark.parametrize("materialize", [False, "derived", True])
def test_report_through_the_index(f3_bars, materialize):
    from evenbasket.operators.report import index_report, render_report

    ix = equal_weight_index(f3_bars, n=2, materialize=materialize)
    report = index_report(ix.performance(), ix.members)
    got = sorted((str(r.Date), r.IndexReturn, r.Top100Stocks) for r in report.collect())
    assert [(d, pytest.approx(x), t) for d, x, t in got] == WANT_REPORT
    assert sorted(r.text for r in render_report(report, 2).collect())[1] == "Date: 2025-01-03\nIndex Return: 0.10\nTop 100 Stocks: A, C"


def test_report_of_an_extended_store_and_of_its_seed(spark, tmp_path, f3_bars):
    from evenbasket.operators.report import index_report
    from evenbasket.plans.build import build_index_tables, extend_index_tables, open_store, stored_report

    store = open_store(spark, str(tmp_path / "wh"), "report_test")
    store.overwrite("stock_data", f3_bars.where("date < '2025-01-06'"))
    build_index_tables(store, n=2)
    store.upsert("stock_data", f3_bars.where("date >= '2025-01-06'"), keys=["date", "ticker"])
    ix = extend_index_tables(store, n=2)
    got = sorted((str(r.Date), r.IndexReturn, r.Top100Stocks) for r in stored_report(store).collect())
    assert [(d, pytest.approx(x), t) for d, x, t in got] == WANT_REPORT
    seeded = sorted((str(r.Date), r.Top100Stocks) for r in index_report(ix.performance(), ix.members).collect())
    assert seeded == [(d, t) for d, _, t in WANT_REPORT[1:]]  # the stored date's holdings are ranked by ticker
    store.drop()
