"""Oracle statements that several queries and tests share, one definition each.

They follow SURVEY's formulas over facts folded per user: what a user did is
folded to booleans and sums first, the assigned users look their facts up, and
counts are plain filters.  The text runs in DuckDB and in Spark SQL; ``a`` and
``e`` name the assignment and event tables.
"""

from __future__ import annotations

READOUT_HIT = "event_name = 'click_banner' OR event_name LIKE 'banner_%'"
ANY_HIT = "event_name = 'click_banner' OR event_name LIKE 'banner%'"
BOUGHT = "event_name = 'purchase'"


def facts(keys: str, e: str, where: str = "true") -> str:
    """What happened per ``keys``: did they hit, buy, bounce; spent; steps."""
    return (f"SELECT {keys}, bool_or({READOUT_HIT}) AS hit, bool_or({ANY_HIT}) AS any_hit, "
            f"bool_or(event_name = 'click_banner') AS clicked, bool_or({BOUGHT}) AS bought, "
            f"bool_or(event_name = 'bounce') AS left_early, "
            f"coalesce(sum(value) FILTER (WHERE {BOUGHT}), 0) AS spent, count(event_name) AS steps "
            f"FROM {e} WHERE {where} GROUP BY ALL")


def run_members(a: str, extra: str = "") -> str:
    """Assigned users of each run with the number of their assignment rows."""
    return (f"SELECT run_id, variant, user_id{extra}, count(*) AS times FROM {a} "
            f"WHERE run_id IS NOT NULL GROUP BY ALL")


def in_run(a: str, e: str, extra: str = "") -> str:
    """Members of runs beside what they did in the run."""
    return (f"SELECT m.*, f.hit, f.any_hit, f.bought, f.left_early, coalesce(f.spent, 0) AS spent, "
            f"coalesce(f.steps, 0) AS steps FROM ({run_members(a, extra)}) m "
            f"LEFT JOIN ({facts('run_id, user_id', e, 'run_id IS NOT NULL')}) f "
            f"ON f.run_id = m.run_id AND f.user_id = m.user_id")


def converters(a: str, e: str, did: str) -> str:
    """Users and those who ``did`` it, per run and variant."""
    return (f"SELECT run_id, variant, count(user_id) AS users, count(*) FILTER (WHERE {did}) AS conversions "
            f"FROM ({in_run(a, e)}) p GROUP BY run_id, variant")


def guardrails(a: str, e: str) -> str:
    return (f"SELECT run_id, variant, count(user_id) AS users, count(*) FILTER (WHERE bought) AS conversions, "
            f"sum(times * spent) AS revenue, count(*) FILTER (WHERE any_hit) AS clicks, "
            f"count(*) FILTER (WHERE left_early) AS bounces FROM ({in_run(a, e)}) p GROUP BY run_id, variant")


def whole(x: str) -> str:
    """Nearest whole number; noise of adding doubles (past the sixth place) first."""
    return f"cast(round(round({x}, 6), 0) AS bigint)"


def weighted(a: str, e: str) -> str:
    """Every sampled user stands for ``weight`` users; sums in doubles."""
    sums = (f"SELECT run_id, variant, sum(weight) AS people, coalesce(sum(weight) FILTER (WHERE any_hit), 0) AS hitters, "
            f"coalesce(sum(weight) FILTER (WHERE bought), 0) AS payers, sum(times * spent * weight) AS money "
            f"FROM ({in_run(a, e, ', weight')}) p GROUP BY run_id, variant")
    return (f"SELECT run_id, variant, {whole('people')} AS visitors, {whole('hitters')} AS clicks, "
            f"{whole('payers')} AS buyers, {whole('money')} AS revenue, "
            f"round(hitters / nullif(people, 0) * 100, 2) AS ctr, round(payers / nullif(people, 0) * 100, 2) AS cvr, "
            f"{whole('money / nullif(payers, 0)')} AS aov, {whole('money / nullif(people, 0)')} AS arpu FROM ({sums}) s")


def day_totals(a: str, e: str, same_day: bool, times: str = "count(*)") -> str:
    """Per assignment day: users, clickers, buyers, money, steps; what a user
    did on that day (``same_day``) or on any day."""
    keys = "user_id, cast(timestamp AS date) AS day" if same_day else "user_id"
    on = "f.user_id = m.user_id" + (" AND f.day = m.day" if same_day else "")
    return (f"SELECT m.day AS report_date, count(m.user_id) AS total_users, count(*) FILTER (WHERE f.clicked) AS click_count, "
            f"count(*) FILTER (WHERE f.bought) AS total_orders, coalesce(sum(m.times * f.spent), 0) AS total_revenue, "
            f"coalesce(sum(m.times * f.steps), 0) AS steps "
            f"FROM (SELECT user_id, cast(assigned_at AS date) AS day, {times} AS times FROM {a} GROUP BY ALL) m "
            f"LEFT JOIN ({facts(keys, e)}) f ON {on} GROUP BY m.day")


def per(x: str, n: str) -> str:
    return f"cast({x} AS double) / nullif({n}, 0)"


def mart(a: str, e: str, times: str = "count(*)") -> str:
    return (f"SELECT report_date, total_users, click_count, total_orders, total_revenue, "
            f"{per('click_count', 'total_users')} AS ctr, {per('total_orders', 'total_users')} AS cvr, "
            f"coalesce({per('total_revenue', 'total_orders')}, 0) AS aov, "
            f"coalesce({per('total_revenue', 'total_users')}, 0) AS arpu, {per('steps', 'total_users')} AS session_depth "
            f"FROM ({day_totals(a, e, True, times)}) d")


def etl(a: str, e: str) -> str:
    return (f"SELECT report_date, total_users, total_revenue, total_orders, click_count, "
            f"{per('click_count', 'total_users')} AS ctr, {per('total_orders', 'click_count')} AS cvr, "
            f"{per('total_revenue', 'total_orders')} AS aov FROM ({day_totals(a, e, False)}) d WHERE report_date IS NOT NULL")


def baseline(a: str, e: str, users: str = "true", default: float = 0.10) -> str:
    """Share of each run's users who ever clicked or bought, on any day; 0 or
    no data counts as ``default``."""
    known = (f"SELECT m.run_id, count(*) FILTER (WHERE f.clicked) AS c, count(*) FILTER (WHERE f.bought) AS b, "
             f"count(*) AS n FROM (SELECT DISTINCT run_id, user_id FROM {a} WHERE {users}) m "
             f"LEFT JOIN ({facts('user_id', e)}) f ON f.user_id = m.user_id GROUP BY m.run_id")
    one = "CASE WHEN {x} > 0 THEN cast({x} AS double) / n ELSE cast({d} AS double) END"
    return (f"SELECT run_id, {one.format(x='c', d=default)} AS ctr_baseline, "
            f"{one.format(x='b', d=default)} AS cvr_baseline FROM ({known}) k")


def customers(users: str, orders: str, as_of: str) -> str:
    """Customers scored: the label is that of the first rule that holds."""
    return f"""
SELECT user_id, order_count, total_spent, tenure_days,
       ['Window', 'Mission', 'Rational', 'Impulsive', 'Cautious'][list_position(
           [order_count = 0, order_count >= 3, total_spent > typical, tenure_days < 30, true], true)] AS segment
FROM (SELECT u.user_id, coalesce(o.n, 0) AS order_count, coalesce(o.s, 0.0) AS total_spent,
             DATE '{as_of}' - u.joined_at AS tenure_days, avg(o.s) OVER () AS typical
      FROM {users} u LEFT JOIN (SELECT user_id, count(*) AS n, sum(amount) AS s FROM {orders} GROUP BY user_id) o
        ON o.user_id = u.user_id) scored"""
