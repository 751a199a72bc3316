"""The drift job: prediction log to report rows and stored summary."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ranklight.operators import drift
from ranklight.session import settle
from ranklight.sources.reports import with_column_results, write_drift_summary


def analyze_prediction_drift(
    predictions: DataFrame,
    report_path: str | None = None,
    time: str = "timestamp",
    tie: str = "user_id",
    reference_size: float = 0.5,
    min_rows: int = drift.MIN_ROWS,
    tests: bool = False,
) -> DataFrame:
    """One summary row with the results per column; written as JSON when a path is given.

    ``tests`` judges by the two-sample tests, status ok, which alerts listen to;
    otherwise the two rules judge, status fallback.
    """
    dataset = drift.drift_dataset(predictions, carry=[time, tie])
    flagged = drift.reference_current_split(dataset, time, tie, reference_size, min_rows)
    columns = drift.drift_tested(flagged) if tests else drift.drift_columns(flagged)
    # Many small reads follow; the few result rows are written once.
    columns = settle(columns, "drift-columns")
    rolled = drift.drift_summary(flagged, columns, min_rows, "ok" if tests else "fallback")
    summary = with_column_results(rolled, columns)
    if report_path:
        write_drift_summary(summary, report_path)
    return summary
