from tillscope.plans.analysis import (
    analyze_declining_customers,
    analyze_segments,
    analyze_weekly_spending,
)
from tillscope.plans.detection import detect_anomalies
from tillscope.plans.incremental import all_clean, all_rejected, preprocess_new, summary, taken_files
from tillscope.plans.preprocessing import preprocess

__all__ = [
    "all_clean",
    "all_rejected",
    "analyze_declining_customers",
    "analyze_segments",
    "analyze_weekly_spending",
    "detect_anomalies",
    "preprocess",
    "preprocess_new",
    "summary",
    "taken_files",
]
