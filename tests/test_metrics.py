"""Pre-aggregated read-outs and marts equal the row-level distinct form.

The oracle statements (``plans/oracle_forms.py``) are run by Spark SQL on the
same frames, on edge rows and on the sf0.001 fixtures.
"""

import datetime as dt

import pytest

from splitlens.operators import mart, metrics
from splitlens.plans import oracle_forms as forms
from splitlens.sources.schemas import ASSIGNMENTS, EVENTS
from tests.conftest import frame

T = dt.datetime


def edge_frames(spark):
    a = frame(spark, ASSIGNMENTS, [
        dict(user_id="u1", variant="A", assigned_at=T(2024, 1, 1, 9), run_id="r1", weight=1.0),
        dict(user_id="u2", variant="B", assigned_at=T(2024, 1, 1, 9), run_id="r1", weight=2.0),
        dict(user_id="u2", variant="B", assigned_at=T(2024, 1, 1, 10), run_id="r1", weight=2.0),  # duplicate
        dict(user_id="u3", variant="B", assigned_at=T(2024, 1, 1, 9), run_id="r1", weight=1.5),   # no events
        dict(user_id="u4", variant="A", assigned_at=T(2024, 1, 1, 9), run_id=None, weight=1.0),   # history
        dict(user_id="u5", variant="A", assigned_at=None, run_id="r2", weight=1.0),
        dict(user_id="u6", variant="A", assigned_at=T(2024, 1, 2, 9), run_id="r2", weight=None),
        dict(user_id="u6", variant="B", assigned_at=T(2024, 1, 2, 11), run_id="r3", weight=1.0),  # twice in a day
    ])
    e = frame(spark, EVENTS, [
        dict(event_id="1", user_id="u1", event_name="banner_A", timestamp=T(2024, 1, 1, 9, 1), value=0.0, run_id="r1"),
        dict(event_id="2", user_id="u1", event_name="purchase", timestamp=T(2024, 1, 1, 9, 2), value=30.0, run_id="r1"),
        dict(event_id="3", user_id="u2", event_name="banner", timestamp=T(2024, 1, 1, 9, 3), value=0.0, run_id="r1"),
        dict(event_id="4", user_id="u2", event_name="purchase", timestamp=T(2024, 1, 1, 9, 4), value=12.5, run_id="r1"),
        dict(event_id="5", user_id="u2", event_name="bounce", timestamp=T(2024, 1, 1, 9, 5), value=0.0, run_id="r1"),
        dict(event_id="6", user_id="u4", event_name="click_banner", timestamp=T(2024, 1, 1, 9, 6), value=0.0, run_id=None),
        dict(event_id="7", user_id="u6", event_name="click_banner", timestamp=T(2024, 1, 2, 9, 6), value=0.0, run_id="r2"),
        dict(event_id="8", user_id="u6", event_name="purchase", timestamp=T(2024, 1, 2, 9, 7), value=7.0, run_id="r3"),
        dict(event_id="9", user_id="guest", event_name="page_view", timestamp=T(2024, 1, 1, 9, 8), value=0.0, run_id=None),
        dict(event_id="10", user_id="u1", event_name="click_banner", timestamp=T(2024, 1, 3, 9), value=0.0, run_id="r9"),
    ])
    return a, e


def rows(df, keys):
    return sorted((tuple(r[k] for k in keys) for r in df.collect()), key=repr)


def same_values(got, want, keys, col):
    g = {tuple(r[k] for k in keys): r[col] for r in got.collect()}
    w = {tuple(r[k] for k in keys): r[col] for r in want.collect()}
    assert g.keys() == w.keys()
    for k in g:
        assert g[k] == pytest.approx(w[k]), k


def as_views(spark, a, e):
    a.createOrReplaceTempView("t_assign")
    e.createOrReplaceTempView("t_events")


AB_SQL = forms.converters("t_assign", "t_events", "hit")
GUARD_SQL = forms.guardrails("t_assign", "t_events")
WEIGHTED_SQL = forms.weighted("t_assign", "t_events")
MART_SQL = forms.mart("t_assign", "t_events")
ETL_SQL = forms.etl("t_assign", "t_events")


@pytest.fixture(params=["edge", "sf0.001"])
def data(request, spark, fx):
    if request.param == "edge":
        a, e = edge_frames(spark)
    else:
        a, e = fx.assignments, fx.events
    as_views(spark, a, e)
    return a, e


def test_ab_primary_equals_distinct_form(spark, data):
    a, e = data
    keys = ["run_id", "variant", "users", "conversions"]
    assert rows(metrics.ab_primary(a, e, "CTR"), keys) == rows(spark.sql(AB_SQL), keys)


def test_guardrail_counts_equal_distinct_form(spark, data):
    a, e = data
    keys = ["run_id", "variant", "users", "conversions", "clicks", "bounces"]
    got = metrics.guardrail_counts(a, e)
    want = spark.sql(GUARD_SQL)
    assert rows(got, keys) == rows(want, keys)
    same_values(got, want, ["run_id", "variant"], "revenue")


def test_weighted_metrics_equal_row_form(spark, data):
    a, e = data
    keys = ["run_id", "variant", "visitors", "clicks", "revenue"]
    assert rows(metrics.weighted_metrics(a, e), keys) == rows(spark.sql(WEIGHTED_SQL), keys)


def test_mart_equals_distinct_form(spark, data):
    a, e = data
    keys = ["report_date", "total_users", "click_count", "total_orders"]
    got = mart.build_mart(a, e)
    want = spark.sql(MART_SQL)
    assert rows(got, keys) == rows(want, keys)
    g = {r.report_date: (r.total_revenue, r.session_depth) for r in got.collect()}
    w = {r.report_date: (r.total_revenue, r.session_depth) for r in want.collect()}
    assert g.keys() == w.keys()
    for k in g:
        assert g[k] == pytest.approx(w[k])


def test_etl_equals_user_join_form(spark, data):
    a, e = data
    keys = ["report_date", "total_users", "click_count", "total_orders"]
    got = mart.build_etl_mart(a, e)
    want = spark.sql(ETL_SQL)
    assert rows(got, keys) == rows(want, keys)
    same_values(got, want, ["report_date"], "total_revenue")


def test_edge_semantics(spark):
    a, e = edge_frames(spark)
    ab = {(r.run_id, r.variant): (r.users, r.conversions) for r in metrics.ab_primary(a, e).collect()}
    # u2's 'banner' is not 'banner_%' (needs one more character); u3 has no events.
    assert ab[("r1", "A")] == (1, 1) and ab[("r1", "B")] == (2, 0)
    assert all(k[0] is not None for k in ab)          # history rows never enter a run
    g = {(r.run_id, r.variant): r for r in metrics.guardrail_counts(a, e).collect()}
    assert g[("r1", "B")].clicks == 1                 # 'banner' matches banner%
    assert g[("r1", "B")].revenue == 25.0             # duplicated assignment doubles revenue
    m = {r.report_date: r for r in mart.build_mart(a, e).collect()}
    assert m[None].total_users == 1 and m[None].click_count == 0
    dedup = {r.report_date: r for r in mart.build_mart(a, e, dedup_assignments=True).collect()}
    assert dedup[dt.date(2024, 1, 1)].total_revenue == 42.5 and m[dt.date(2024, 1, 1)].total_revenue == 55.0


@pytest.mark.parametrize("weight,n,revenue", [(1 / 3, 3000, 1_000_000), (4e-5, 50_000, 2000), (2e6, 2, 4_000_000_000)])
def test_weights_are_neither_cut_nor_refused(spark, weight, n, revenue):
    a = spark.range(n).selectExpr("concat('u', id) AS user_id", "'A' AS variant", "'r' AS run_id", f"{weight!r}D AS weight")
    e = spark.range(n).selectExpr("concat('u', id) AS user_id", "'purchase' AS event_name", "1000.0D AS value", "'r' AS run_id")
    r = metrics.weighted_metrics(a, e).first()
    assert r["revenue"] == revenue and r["aov"] == 1000 and r["arpu"] == 1000 and r["visitors"] == r["buyers"] == round(n * weight)


def test_unknown_metric_is_refused():
    with pytest.raises(ValueError):
        metrics.metric_spec("clickiness")


# ---------------------------------------------------------------- properties

from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

NAMES = ["banner_A", "banner", "click_banner", "purchase", "bounce", "page_view", None]
RUNS = ["r1", "r2", None]
USERS = ["u1", "u2", "u3", "guest"]

assign_row = st.fixed_dictionaries(dict(
    user_id=st.sampled_from(USERS), variant=st.sampled_from(["A", "B"]), run_id=st.sampled_from(RUNS),
    weight=st.sampled_from([1.0, 1.5, 2.0, None]),
    assigned_at=st.one_of(st.none(), st.integers(0, 2).map(lambda d: T(2024, 1, 1 + d, 9)))))
event_row = st.fixed_dictionaries(dict(
    user_id=st.sampled_from(USERS), event_name=st.sampled_from(NAMES), run_id=st.sampled_from(RUNS),
    value=st.sampled_from([0.0, 1.25, 10.0]),
    timestamp=st.integers(0, 2 * 24 * 60).map(lambda m: T(2024, 1, 1) + dt.timedelta(minutes=m))))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(assign_row, min_size=1, max_size=12), st.lists(event_row, max_size=20))
def test_folds_equal_distinct_form_on_random_rows(spark, arows, erows):
    a = frame(spark, ASSIGNMENTS, arows)
    e = frame(spark, EVENTS, [dict(r, event_id=str(i)) for i, r in enumerate(erows)])
    as_views(spark, a, e)
    k = ["run_id", "variant", "users", "conversions"]
    assert rows(metrics.ab_primary(a, e, "CTR"), k) == rows(spark.sql(AB_SQL), k)
    k = ["run_id", "variant", "users", "conversions", "clicks", "bounces"]
    assert rows(metrics.guardrail_counts(a, e), k) == rows(spark.sql(GUARD_SQL), k)
    same_values(metrics.guardrail_counts(a, e), spark.sql(GUARD_SQL), ["run_id", "variant"], "revenue")
    k = ["report_date", "total_users", "click_count", "total_orders"]
    assert rows(mart.build_mart(a, e), k) == rows(spark.sql(MART_SQL), k)
    same_values(mart.build_mart(a, e), spark.sql(MART_SQL), ["report_date"], "total_revenue")
    same_values(mart.build_mart(a, e), spark.sql(MART_SQL), ["report_date"], "session_depth")
    assert rows(mart.build_etl_mart(a, e), k) == rows(spark.sql(ETL_SQL), k)
