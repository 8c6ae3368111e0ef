"""Monitoring screens, segments and reporting: edge rows and properties."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from splitlens.operators import journey, monitor, reporting, segments
from splitlens.sources.schemas import ADOPTIONS, EVENTS, ORDERS, USERS
from tests.conftest import frame

D = dt.date
T = dt.datetime


def mart_frame(spark, rows, cols=("report_date", "total_users", "click_count", "total_orders", "total_revenue",
                                  "ctr", "cvr", "aov")):
    types = {"report_date": "date", "total_users": "long", "click_count": "long", "total_orders": "long"}
    ddl = ", ".join(f"{c} {types.get(c, 'double')}" for c in cols)
    return spark.createDataFrame(rows, ddl)


def test_cards_single_day_prev_is_latest(spark):
    m = mart_frame(spark, [(D(2024, 1, 1), 10, 3, 2, 100.0, 0.3, 0.2, 50.0)])
    r = monitor.kpi_cards(m).collect()[0]
    assert r.revenue_delta == 0 and r.aov_delta == 0 and r.cvr_delta == 0.0
    assert r.avg_revenue == 100.0 and r.latest_date == D(2024, 1, 1)


def test_cards_truncate_and_missing_columns(spark):
    m = mart_frame(spark, [(D(2024, 1, 1), 10, 3, 2, 100.0, 0.3, 0.2, 50.0),
                           (D(2024, 1, 2), 10, 3, 2, 40.6, 0.3, 0.25, 20.3)])
    r = monitor.kpi_cards(m).collect()[0]
    assert r.revenue_delta == -59 and r.aov_delta == -29         # int() truncates toward zero
    assert r.cvr_delta == pytest.approx(0.05)
    small = mart_frame(spark, [(D(2024, 1, 1), 10, 3, 2)], cols=("report_date", "total_users", "click_count",
                                                                 "total_orders"))
    r = monitor.kpi_cards(small).collect()[0]
    assert r.avg_revenue is None and r.revenue_delta is None
    f = {x.step: x.users for x in monitor.kpi_funnel(small.drop("click_count")).collect()}
    assert f == {1: 10, 2: 0, 3: 2}


def test_alerts_rules(spark):
    m = mart_frame(spark, [(D(2024, 1, 1), 10, 3, 2, 0.0, 0.30, 0.2, 0.0),
                           (D(2024, 1, 2), 10, 0, 0, 50.0, 0.01, 0.005, 0.0),
                           (D(2024, 1, 3), 10, 3, 2, 20.0, 0.30, 0.2, 10.0)])
    a = sorted((r.report_date.day, r.metric, r.level) for r in monitor.kpi_alerts(m).collect())
    # Day 2: revenue rose from 0 (previous 0 never alerts); day 3 fell to 40 %.
    assert a == [(2, "ctr", "Critical"), (2, "cvr", "Critical"), (3, "total_revenue", "Warning")]
    drop = [r.drop_pct for r in monitor.kpi_alerts(m).collect() if r.metric == "total_revenue"][0]
    assert drop == pytest.approx(60.0)
    latest = monitor.kpi_alerts(m, latest_only=True).collect()
    assert [r.report_date.day for r in latest] == [3]
    none = monitor.kpi_alerts(m.select("report_date", "total_users")).collect()
    assert none == []


def test_live_pulse_and_guest(spark):
    e = frame(spark, EVENTS, [
        dict(event_id="1", user_id="guest", event_name="page_view", timestamp=T(2024, 1, 30, 11, 45)),
        dict(event_id="2", user_id="guest", event_name="page_view", timestamp=T(2024, 1, 30, 11, 50)),
        dict(event_id="3", user_id="u1", event_name="purchase", value=10.0, timestamp=T(2024, 1, 30, 8, 0)),
        dict(event_id="4", user_id="u1", event_name="purchase", value=5.0, timestamp=T(2024, 1, 29, 23, 0)),
        dict(event_id="5", user_id="u2", event_name="purchase", value=1.0, timestamp=T(2024, 1, 30, 12, 1)),
    ])
    r = monitor.live_pulse(e, "2024-01-30 12:00:00").collect()[0]
    assert (r.active_users, r.today_orders, r.today_revenue) == (1, 1, 10.0)


def test_recent_events_topk(spark):
    e = frame(spark, EVENTS, [dict(event_id=str(i), user_id=f"user_{i:04d}", event_name="purchase" if i % 2 else "x",
                                   value=float(i), timestamp=T(2024, 1, 1, 0, i % 5), run_id="r" + str(i % 2))
                              for i in range(20)])
    top = monitor.recent_events(e, k=3).collect()
    assert [r.event_id for r in top] == ["9", "4", "19"]      # newest minute, ties by event id desc
    assert top[0].label == "Purchase (User_0009: 9)" and top[0].time == "00:04:00"
    per = monitor.recent_events(e, k=2, by="run_id").collect()
    assert sorted((r.run_id, r.rank) for r in per) == [("r0", 1), ("r0", 2), ("r1", 1), ("r1", 2)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=5000), min_size=5, max_size=5))
def test_segment_mix_sums_to_100(spark, counts):
    df = spark.createDataFrame(list(zip(segments.SEGMENT_ORDER, counts)), "segment string, users long")
    rows = segments.segment_mix(df).collect()
    if sum(counts) == 0:
        assert rows == []
    else:
        assert sum(r.pct for r in rows) == 100 and len(rows) == 5


def test_segment_mix_golden(spark):
    df = spark.createDataFrame([("Window", 421), ("Cautious", 381), ("Rational", 296), ("Impulsive", 210),
                                ("Mission", 192)], "segment string, users long")
    got = {r.segment: r.pct for r in segments.segment_mix(df).collect()}
    assert got == {"Window": 30, "Cautious": 25, "Rational": 19, "Impulsive": 14, "Mission": 12}
    part = spark.createDataFrame([("Mission", 1), ("Window", 1)], "segment string, users long")
    got = {r.segment: r.pct for r in segments.segment_mix(part).collect()}
    assert got == {"Impulsive": 0, "Rational": 0, "Window": 50, "Mission": 50, "Cautious": 0}


def test_segment_rules(spark):
    users = spark.createDataFrame([("a", D(2001, 7, 1)), ("b", D(2001, 7, 1)), ("c", D(2001, 7, 20)),
                                   ("d", D(2001, 1, 1)), ("e", D(2001, 1, 1))], "user_id string, joined_at date")
    o = frame(spark, ORDERS, [dict(order_id=str(i), user_id=u, amount=a) for i, (u, a) in enumerate(
        [("b", 1.0), ("b", 1.0), ("b", 1.0), ("c", 5.0), ("d", 100.0), ("e", 2.0)])])
    got = {r.user_id: r.segment for r in segments.user_segment_labels(users, o, "2001-08-01").collect()}
    assert got == {"a": "Window", "b": "Mission", "c": "Impulsive", "d": "Rational", "e": "Cautious"}


def test_cohort_retention(spark):
    o = frame(spark, ORDERS, [dict(order_id=str(i), user_id=u, order_at=t) for i, (u, t) in enumerate([
        ("a", T(2024, 1, 1)), ("a", T(2024, 1, 9)), ("b", T(2024, 1, 3)), ("c", T(2024, 1, 10)),
        ("a", T(2024, 1, 2))])])
    users = frame(spark, USERS, [dict(user_id=u, joined_at=t) for u, t in [
        ("a", T(2024, 1, 1)), ("b", T(2024, 1, 3, 9)), ("never", T(2024, 1, 7)), ("c", T(2024, 1, 17)), ("quiet", T(2024, 2, 1))]])
    got = {(r.cohort_week, r.week_number): (r.cohort_size, r.retained, r.retention_rate)
           for r in segments.cohort_retention(users, o).collect()}
    # "never" counts in the size; c's order is from before the sign-up week.
    assert got == {(D(2024, 1, 1), 0): (3, 2, 2 / 3), (D(2024, 1, 1), 1): (3, 1, 1 / 3),
                   (D(2024, 1, 15), None): (1, 0, 0.0), (D(2024, 1, 29), None): (1, 0, 0.0)}


def test_persona_aliases(spark):
    e = frame(spark, EVENTS, [dict(user_id=u, event_name=n, run_id="r") for u, n in [
        ("agent_rational_1", "banner_A"), ("agent_window_2", "bounce"), ("agent_mission_3", "purchase"),
        ("agent_mission_3", "banner_B"), ("user_x", "purchase")]])
    got = {r.persona: (r.total, r.clicked, r.bounced, r.purchased)
           for r in segments.persona_breakdown(e.withColumnRenamed("user_id", "agent_id")).collect()}
    assert got == {"calculator": (1, 1, 0, 0), "browser": (1, 0, 1, 0), "mission": (1, 1, 0, 1)}


def test_journey_order_and_gaps(spark):
    e = frame(spark, EVENTS, [
        dict(event_id="b", user_id="u", event_name="banner_A", timestamp=T(2024, 1, 1, 9, 0, 0), run_id="r"),
        dict(event_id="a", user_id="u", event_name="click_banner", timestamp=T(2024, 1, 1, 9, 0, 0), run_id="r"),
        dict(event_id="c", user_id="u", event_name="purchase", timestamp=T(2024, 1, 1, 9, 0, 41), run_id="r"),
        dict(event_id="d", user_id="u", event_name="purchase", timestamp=T(2024, 1, 1, 9, 0, 1), run_id=None)])
    a = spark.createDataFrame([("u", "r", "B", 1.0)], "user_id string, run_id string, variant string, weight double")
    rows = journey.user_journey(e, a).orderBy("event_sequence").collect()
    assert [r.event_id for r in rows] == ["a", "b", "c"]
    assert [r.funnel_stage for r in rows] == ["Interest", "Awareness", "Conversion"]
    assert [r.time_since_last_event for r in rows] == [None, 0, 41]
    assert rows[1].prev_event == "click_banner" and rows[1].next_event == "purchase" and rows[0].variant == "B"


def adoptions(spark, rows):
    return frame(spark, ADOPTIONS, rows)


def test_reporting_edge_rows(spark):
    ex = spark.createDataFrame([("r1", None, "h1", "CTR", 0.1, 0.2, 1.0, "Significant Winner"),
                                ("r2", "t", "h2", "CTR", 0.1, 0.1, 0.0, "positive"),
                                ("r3", "t", "h3", "CTR", 0.2, 0.1, -0.5, "negative")],
                               "run_id string, target string, hypothesis string, primary_metric string, "
                               "control_rate double, test_rate double, lift double, decision string")
    ad = adoptions(spark, [dict(experiment_id="r1", variant_config="{not json", adopted_at=T(2024, 1, 2)),
                           dict(experiment_id="r2", variant_config='{"target": "json_t"}', adopted_at=T(2024, 1, 1))])
    board = {r.experiment_id: r for r in reporting.adoption_board(ad, ex).collect()}
    assert board["r1"].winning_variant is None and board["r1"].hypothesis == "h1"
    cur = reporting.current_baseline(ad, ex).collect()
    assert len(cur) == 1 and cur[0].experiment_id == "r1" and cur[0].winning_variant == "B"
    assert cur[0].target == "N/A" and cur[0].config_key is None
    p = {r.run_id: r for r in reporting.portfolio(ex).collect()}
    assert p["r1"].target_group == "unclassified" and p["r1"].group_size == 1 and p["r2"].group_size == 2
    assert p["r2"].badge == "Significant Winner" and p["r3"].badge_color == "red"
    assert [r.target for r in reporting.target_list(ex).collect()] == ["t"]
    s = reporting.adoption_summary(ex, ad).collect()[0]
    assert (s.experiments, s.adopted, s.not_adopted) == (3, 2, 1)
    assert s.adoption_rate_pct == pytest.approx(200 / 3)
    empty = reporting.adoption_summary(ex.limit(0), ad).collect()[0]
    assert empty.experiments == 0 and empty.adoption_rate_pct == 0.0


def test_guardrail_json_round_trip(spark):
    v = spark.createDataFrame([("r", "CTR", 0.1, 0.2, 1.0, True), ("r", "CVR", 0.0001, 0.00005, -0.5, False)],
                              "run_id string, metric string, control double, test double, lift double, passed boolean")
    rec = reporting.guardrail_json(v)
    r = rec.collect()[0]
    assert r.guardrail_summary == "CVR:Fail,CTR:Pass" and r.guardrails_passed == 1
    back = {x.metric: x for x in reporting.guardrail_results(rec).collect()}
    assert back["CVR"].status == "Fail" and back["CVR"].lift_pct == -50.0 and back["CTR"].status == "Pass"
    none = spark.createDataFrame([("r", "[]")], "run_id string, guardrail_results string")
    out = reporting.guardrail_results(none).collect()
    assert len(out) == 1 and out[0].metric is None
