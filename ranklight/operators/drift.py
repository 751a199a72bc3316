"""Reference against current window: mean shift, distribution distances, report.

The split adds ``part`` (``reference`` / ``current``) to the rows; all tests aggregate
both parts in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ranklight.functions.stats import chi_square_p, finite
from ranklight.operators.ordering import add_range, bucket_offsets, running_sums

MONITORED_NUMERIC = ["latency_ms", "num_items", "request_hour", "request_dayofweek"]
MONITORED_CATEGORICAL = ["variant"]
MONITORED = ["latency_ms", "num_items", "variant", "request_hour", "request_dayofweek"]
SHIFT_LIMIT = 0.5
VARIATION_LIMIT = 0.1
SHARE_LIMIT = 0.3
MIN_ROWS = 20
_NO_TIME = 253_402_214_400_000_000  # rows without a time sort after all others
_SERIES_TERMS = 100


def drift_dataset(predictions: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The five monitored columns (and ``carry``), without rows where all five are null."""
    numbers = {c: F.col(c).cast("double") for c in MONITORED_NUMERIC}
    columns = [numbers.get(c, F.col(c).cast("string")).alias(c) for c in MONITORED]
    return predictions.select(*carry, *columns).dropna(how="all", subset=MONITORED)


def reference_current_split(
    dataset: DataFrame,
    time: str,
    tie: str,
    reference_size: float = 0.5,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Add ``part``: the earliest share of the rows is the reference.

    Only the key of the last reference row is searched for: first its hour, then its
    second, then its place among the rows of that second. Each step brings one row to
    the driver; the log itself is then labelled in one pass without sort or exchange,
    however many tests read it. Rows of one time and tie are told apart by a hash of all
    their columns; a null tie comes first.
    """
    micros = F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), F.lit(_NO_TIME))
    keyed = dataset.select(
        micros.alias("_micros"),
        F.col(tie).alias("_tie"),
        F.xxhash64(*dataset.columns).alias("_hash"),
        F.floor(micros / 1_000_000).alias("_second"),
        F.floor(micros / 3_600_000_000).alias("_hour"),
    )
    size = min(max(reference_size, 0.1), 0.9)
    n = F.col("rows_total")
    wanted = F.least(
        F.greatest(F.floor(n * F.lit(float(size))), F.lit(min_rows)), n - F.lit(min_rows)
    )
    hours = bucket_offsets(keyed, [], "_hour", {"rows": F.lit(1)}).withColumn("_wanted", wanted)
    hour = _cut(hours.filter((F.col("_wanted") > 0) & (F.col("_wanted") < n)), "_hour")
    if hour is None:
        return dataset.withColumn("part", F.lit("current"))

    in_hour = keyed.filter(F.col("_hour") == hour["at"])
    seconds = bucket_offsets(in_hour, [], "_second", {"rows": F.lit(1)})
    second = _cut(seconds.withColumn("_wanted", F.lit(hour["left"])), "_second")
    in_second = in_hour.filter(F.col("_second") == second["at"])
    place = F.row_number().over(W.partitionBy("_second").orderBy("_micros", "_tie", "_hash"))
    last = in_second.withColumn("_place", place).filter(F.col("_place") == second["left"]).first()

    earlier = micros < last["_micros"]
    kind = dataset.schema[tie].dataType
    own = F.struct(F.col(tie).alias("t"), F.xxhash64(*dataset.columns).alias("h"))
    cut = F.struct(F.lit(last["_tie"]).cast(kind).alias("t"), F.lit(last["_hash"]).alias("h"))
    tied = (micros == last["_micros"]) & (own <= cut)
    return dataset.withColumn("part", F.when(earlier | tied, "reference").otherwise("current"))


def _cut(offsets: DataFrame, bucket: str) -> Row | None:
    """The bucket in which row number ``_wanted`` lies, and what is left to count in it."""
    left = F.col("_wanted") - F.col("rows_before")
    here = offsets.filter((left > 0) & (left <= F.col("rows_here")))
    return here.select(F.col(bucket).alias("at"), left.alias("left")).first()


def _is(part: str) -> Column:
    return F.col("part") == part


def drift_numeric(flagged: DataFrame, columns: Sequence[str] = MONITORED_NUMERIC) -> DataFrame:
    """Shift of the mean in units of the reference spread (at least 1); all columns in one pass."""
    measures = []
    for c in columns:
        old = F.when(_is("reference"), finite(F.col(c).cast("double")))
        new = F.when(_is("current"), finite(F.col(c).cast("double")))
        measures.append(
            F.struct(
                F.lit(c).alias("column"),
                F.avg(old).alias("old"),
                F.avg(new).alias("new"),
                F.stddev_pop(old).alias("spread"),
            )
        )
    rows = flagged.agg(F.array(*measures).alias("rows")).select(F.inline("rows"))
    shift = F.abs(F.col("new") - F.col("old")) / F.greatest(F.col("spread"), F.lit(1.0))
    score = F.coalesce(shift, F.lit(0.0))
    return rows.select(
        "column",
        score.alias("drift_score"),
        (score > SHIFT_LIMIT).alias("drift_detected"),
        F.lit("normalized_mean_shift").alias("method"),
    )


def _value_counts(flagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit("missing")).alias(c) for c in columns]
    long = flagged.select("part", *text).unpivot(["part"], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(
        F.count_if(_is("reference")).alias("old"), F.count_if(_is("current")).alias("new")
    )


def _part_sizes(flagged: DataFrame) -> Column:
    return flagged.agg(
        F.struct(
            F.count_if(_is("reference")).alias("old"), F.count_if(_is("current")).alias("new")
        )
    ).scalar()


def drift_categorical(
    flagged: DataFrame, columns: Sequence[str] = MONITORED_CATEGORICAL
) -> DataFrame:
    """Half the summed difference of the value shares; null is its own value."""
    old, new = F.col("_sizes.old"), F.col("_sizes.new")
    share_old = F.coalesce(F.try_divide(F.col("old").cast("double"), old), F.lit(0.0))
    share_new = F.coalesce(F.try_divide(F.col("new").cast("double"), new), F.lit(0.0))
    counts = _value_counts(flagged, columns).withColumn("_sizes", _part_sizes(flagged))
    scored = counts.groupBy("column").agg(
        (0.5 * F.sum(F.abs(share_old - share_new))).alias("drift_score")
    )
    return scored.select(
        "column",
        "drift_score",
        (F.col("drift_score") > VARIATION_LIMIT).alias("drift_detected"),
        F.lit("total_variation_distance").alias("method"),
    )


def drift_columns(
    flagged: DataFrame,
    numeric: Sequence[str] = MONITORED_NUMERIC,
    categorical: Sequence[str] = MONITORED_CATEGORICAL,
) -> DataFrame:
    """One row per monitored column, score to 4 decimals."""
    rows = drift_numeric(flagged, numeric).unionByName(drift_categorical(flagged, categorical))
    return rows.withColumn("drift_score", F.round("drift_score", 4))


def drift_tested(
    flagged: DataFrame,
    numeric: Sequence[str] = MONITORED_NUMERIC,
    categorical: Sequence[str] = MONITORED_CATEGORICAL,
    level: float = 0.05,
) -> DataFrame:
    """The same rows by two-sample tests: the p value, and drift where it is below ``level``."""
    counted = drift_chi2(flagged, categorical)
    counted = counted.withColumn("p_value", chi_square_p(F.col("statistic"), F.col("degrees")))
    tests = (("ks", drift_ks(flagged, numeric)), ("chi2", counted))
    rows = [
        df.select(
            "column",
            F.round("p_value", 4).alias("drift_score"),
            F.coalesce(F.col("p_value") < level, F.lit(False)).alias("drift_detected"),
            F.lit(name).alias("method"),
        )
        for name, df in tests
    ]
    return rows[0].unionByName(rows[1])


def drift_summary(
    flagged: DataFrame, columns: DataFrame, min_rows: int = MIN_ROWS, status: str = "fallback"
) -> DataFrame:
    """One row: status, share of drifted columns, verdict, window sizes.

    ``status`` names how the columns were judged: ok for the tests, fallback for the rules.
    """
    sizes = _part_sizes(flagged)
    rolled = columns.agg(
        F.count_if("drift_detected").alias("_drifted"), F.count(F.lit(1)).alias("_all")
    ).withColumn("_sizes", sizes)
    share = F.col("_drifted") / F.greatest(F.col("_all"), F.lit(1))
    old, new = F.col("_sizes.old"), F.col("_sizes.new")
    enough = (old >= min_rows) & (new >= min_rows)
    return rolled.select(
        F.when(enough, status).otherwise("not_enough_data").alias("status"),
        F.when(enough, share > SHARE_LIMIT).alias("drift_detected"),
        F.when(enough, F.round(share, 4)).alias("drift_share"),
        old.alias("reference_rows"),
        new.alias("current_rows"),
    )


def drift_report(
    flagged: DataFrame,
    numeric: Sequence[str] = MONITORED_NUMERIC,
    categorical: Sequence[str] = MONITORED_CATEGORICAL,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """The column rows, each with the roll-up of the whole report; no rows without enough data."""
    columns = drift_columns(flagged, numeric, categorical)
    summary = drift_summary(flagged, columns, min_rows).select(F.struct("*")).scalar()
    both = columns.withColumn("_summary", summary)
    return both.filter(F.col("_summary.status") == "fallback").select(
        *columns.columns,
        F.col("_summary.drift_detected").alias("dataset_drift"),
        F.col("_summary.drift_share").alias("drift_share"),
        F.col("_summary.reference_rows").alias("reference_rows"),
        F.col("_summary.current_rows").alias("current_rows"),
    )


def _distributions(flagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per distinct value the running counts of both windows, in value order, and its range."""
    numbers = [finite(F.col(c).cast("double")).alias(c) for c in columns]
    long = flagged.select("part", *numbers).unpivot(["part"], list(columns), "column", "value")
    counts = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count_if(_is("reference")).alias("old"), F.count_if(_is("current")).alias("new")
    )
    return running_sums(
        add_range(counts, "value", "column"),
        ["column"],
        F.col("_range"),
        ["value"],
        {"old_seen": F.col("old"), "new_seen": F.col("new")},
        totals=True,
    )


def _gap() -> Column:
    old = F.try_divide(F.col("old_seen").cast("double"), F.col("old_seen_total"))
    new = F.try_divide(F.col("new_seen").cast("double"), F.col("new_seen_total"))
    return F.abs(F.coalesce(old, F.lit(0.0)) - F.coalesce(new, F.lit(0.0)))


def drift_ks(flagged: DataFrame, columns: Sequence[str] = MONITORED_NUMERIC) -> DataFrame:
    """Largest distance of the two distribution functions, with the asymptotic p."""
    rows = _distributions(flagged, columns).groupBy("column").agg(
        F.max(_gap()).alias("distance"),
        F.max("old_seen_total").alias("_old"),
        F.max("new_seen_total").alias("_new"),
    )
    size = F.col("_old").cast("double") * F.col("_new") / (F.col("_old") + F.col("_new"))
    reach = size * F.col("distance") * F.col("distance")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * reach),
    )
    # Below this reach the series has not converged and the probability is one.
    p = F.when(reach < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))
    return rows.select("column", "distance", p.alias("p_value"))


def drift_chi2(flagged: DataFrame, columns: Sequence[str] = MONITORED_CATEGORICAL) -> DataFrame:
    """Chi-squared statistic of the window-by-value table and its degrees of freedom."""
    all_old, all_new = F.col("_sizes.old"), F.col("_sizes.new")
    row = (F.col("old") + F.col("new")).cast("double")
    whole = all_old + all_new
    want_old, want_new = row * all_old / whole, row * all_new / whole
    off_old, off_new = F.col("old") - want_old, F.col("new") - want_new
    cell = F.try_divide(off_old * off_old, want_old) + F.try_divide(off_new * off_new, want_new)
    counts = _value_counts(flagged, columns).withColumn("_sizes", _part_sizes(flagged))
    return counts.groupBy("column").agg(
        F.coalesce(F.sum(cell), F.lit(0.0)).alias("statistic"),
        (F.count(F.lit(1)) - 1).alias("degrees"),
    )


def drift_wasserstein(flagged: DataFrame, columns: Sequence[str] = MONITORED_NUMERIC) -> DataFrame:
    """Area between the two distribution functions over the reference spread."""
    rows = _distributions(flagged, columns)
    firsts = rows.groupBy("column", "_range").agg(F.min("value").alias("_first"))
    along = W.partitionBy("column").orderBy("_range")
    following = firsts.select("column", "_range", F.lead("_first").over(along).alias("_next_first"))
    local = W.partitionBy("column", "_range").orderBy("value")
    stepped = rows.withColumn("_next", F.lead("value").over(local)).join(
        following, ["column", "_range"]
    )
    step = F.coalesce(F.coalesce("_next", "_next_first") - F.col("value"), F.lit(0.0))
    area = stepped.groupBy("column").agg(F.sum(_gap() * step).alias("area"))
    spreads = [
        F.struct(
            F.lit(c).alias("column"),
            F.stddev_pop(F.when(_is("reference"), finite(F.col(c).cast("double")))).alias("spread"),
        )
        for c in columns
    ]
    scale = flagged.agg(F.array(*spreads).alias("s")).select(F.inline("s"))
    return area.join(F.broadcast(scale), "column").select(
        "column", (F.col("area") / F.greatest(F.col("spread"), F.lit(0.001))).alias("distance")
    )


REPORT_SCHEMA = """
metrics array<struct<result: struct<
  dataset_drift: boolean,
  number_of_columns: bigint,
  number_of_drifted_columns: bigint,
  drift_by_columns: map<string, struct<
    drift_score: double, drift_detected: boolean, stattest_name: string>>>>>
"""


def drift_result_rows(reports: DataFrame, report: str = "report") -> DataFrame:
    """Rows ``column, score, flag, method, dataset_drift, drift_share`` from nested report JSON."""
    keys = [c for c in reports.columns if c != report]
    parsed = reports.select(*keys, F.from_json(report, REPORT_SCHEMA).alias("_r"))
    first = parsed.select(*keys, F.get(F.col("_r.metrics"), F.lit(0))["result"].alias("_result"))
    share = F.try_divide(
        F.coalesce(F.col("_result.number_of_drifted_columns"), F.lit(0)).cast("double"),
        F.col("_result.number_of_columns"),
    )
    rows = first.select(
        *keys,
        F.col("_result.dataset_drift").alias("dataset_drift"),
        share.alias("drift_share"),
        F.explode(F.map_entries("_result.drift_by_columns")).alias("_entry"),
    )
    return rows.select(
        *keys,
        F.col("_entry.key").alias("column"),
        F.col("_entry.value.drift_score").alias("drift_score"),
        F.col("_entry.value.drift_detected").alias("drift_detected"),
        F.col("_entry.value.stattest_name").alias("method"),
        "dataset_drift",
        "drift_share",
    )
