"""splitlens: experiment analytics (bucketing, KPI marts, A/B read-outs,
journeys, segments, retention, experiment reporting) as Spark jobs.

The common entry points are re-exported here; everything takes and returns
DataFrames (no action is run until the caller asks for results).
"""

__version__ = "0.1.0"

from splitlens.functions.hashing import bucket_col, variant_col  # noqa: E402,F401
from splitlens.functions.normal import two_sided_p  # noqa: E402,F401
from splitlens.operators.assignment import (  # noqa: E402,F401
    assign_once, assign_variant, assignment_state, baseline_rates, bucket_users)
from splitlens.operators.journey import user_journey  # noqa: E402,F401
from splitlens.operators.mart import build_etl_mart, build_mart  # noqa: E402,F401
from splitlens.operators.metrics import (  # noqa: E402,F401
    METRICS, MetricSpec, ab_primary, guardrail_counts, run_outcomes, user_metrics, weighted_metrics)
from splitlens.operators.monitor import (  # noqa: E402,F401
    active_runs, kpi_alerts, kpi_cards, kpi_funnel, kpi_threshold_series, live_pulse, prefix_counts,
    recent_events, run_progress)
from splitlens.operators.reporting import (  # noqa: E402,F401
    adoption_board, adoption_summary, current_baseline, experiment_record, experiment_records,
    guardrail_results, portfolio, target_list)
from splitlens.operators.segments import (  # noqa: E402,F401
    cohort_retention, persona_breakdown, segment_mix, stratified_sample_weights, user_segments)
from splitlens.operators.stats import (  # noqa: E402,F401
    ab_stats, calculate_statistics, format_delta, guardrail_verdicts, metrics_delta, retention_rate,
    sample_size, traffic_plan, variant_ci)
from splitlens.session import checkpoint_dir, get_session  # noqa: E402,F401

# Names of the modelled application's helpers, for users switching over.
get_bucket = bucket_col
calculate_sample_size = sample_size
calculate_retention_rate = retention_rate
generate_mart = build_mart
