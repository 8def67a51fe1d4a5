"""The public functions under one name: ``from clickwarden import api``."""

from clickwarden.operators.contract import (
    check_contract_batch, contract_report, parse_clicks, validate_clicks,
)
from clickwarden.operators.eda import (
    busiest_hour, busiest_ips, click_summary, clicks_per_hour, clicks_per_minute, flagged,
    fraud_rate_by, head_sample, label_balance, top_rates,
)
from clickwarden.operators.features import (
    attach_rates, click_features, conversion_snapshots, shannon_entropy, vectorize,
)
from clickwarden.operators.ingest import (
    bootstrap_labels, contiguous_slice, fraud_ips, from_time, ip_stats, labelled_bursts,
    map_clicks, normalize_clicks, order_violations, sample_metadata, union_clicks,
    velocity_cutoff,
)
from clickwarden.operators.ensembles import TreeEnsemble
from clickwarden.operators.metrics import (
    apply_threshold, average_precision, best_f1_threshold, class_weight, latency_report,
    pr_curve, ranking_metrics, roc_auc, score_histogram, single_feature_auc,
    walk_forward_metrics,
)
from clickwarden.operators.models import (
    continue_gbt, fit_and_compare, load_model, lr_gradient, retrain, save_model, score, train_gbt,
    train_lr, training_report, walk_forward_scores, warm_vs_cold,
)
from clickwarden.operators.ordering import global_index, quantiles, running
from clickwarden.operators.reconcile import (
    agreement_rate, attach_labels, disagreements, drift_over_time, false_negatives,
    flag_breakdown, layer_metrics, reconcile, reconcile_classes, reconcile_summary,
)
from clickwarden.operators.split import (
    chronological_split, fold, split_at, split_history, walk_forward_folds,
)
from clickwarden.operators.transactions import (
    filter_impact, filter_types, split_by_quantile, transaction_features, txn_key,
)
from clickwarden.operators.windows import (
    count_so_far, inter_click_gap, rolling_counts, rolling_entropy,
)
from clickwarden.runtime import configure, release
from clickwarden.sources.readers import (
    read_click_stream, read_clicks, read_raw_clicks, read_scored, read_snapshots,
    read_staging, read_table, read_transactions,
)
from clickwarden.sources.writers import (
    commit_history, load_snapshots, publish_batch_table, upsert_insert_only,
    write_click_stream, write_clicks, write_head, write_report, write_snapshots,
)
from clickwarden.streaming.labels import late_labels, live_drift
from clickwarden.streaming.scoring import (
    RunningTotals, check_contract_stream, enrich_with_history, monitor_totals, monitored, score_stream, table_sink,
    transaction_stream,
)
from clickwarden.streaming.sketches import (
    merge_sketches, read_sketches, sketch, sketch_sink, sketched_histogram, sketched_report,
)
from clickwarden.streaming.state import count_so_far_stream, enrich_stream

__all__ = [name for name in dir() if not name.startswith("_")]
