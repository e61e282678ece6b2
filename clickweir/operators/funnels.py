"""Conversion funnels: independent counts per step, compared with the next step."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir import settings
from clickweir.functions.timing import instant, tumbling, window_label
from clickweir.operators.kpis import distinct
from clickweir.schemas import FUNNEL, conform


def _step_order(steps: list[str]):
    # One lookup in a literal map; types outside the funnel are filtered before.
    pairs = [F.lit(item) for order, step in enumerate(steps, 1) for item in (step, order)]
    return F.create_map(*pairs)[F.col("event_type")]


def step_counts(df: DataFrame, window_seconds: int, steps: list[str], exact: bool) -> DataFrame:
    """Users and events per window and step. Other types are filtered out at the scan."""
    return (
        df.filter(F.col("event_type").isin(steps))
        .groupBy(tumbling("timestamp", window_seconds).alias("_window"), "event_type")
        .agg(distinct("user_id", exact).alias("unique_users"), F.count("event_id").alias("event_count"))
        .select(
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            F.col("event_type").alias("funnel_step"),
            _step_order(steps).alias("step_order"),
            "unique_users",
            "event_count",
        )
    )


def funnels(
    df: DataFrame,
    window_seconds: int = 86400,
    steps: list[str] = settings.FUNNEL_STEPS,
    exact: bool = False,
    as_of=None,
) -> DataFrame:
    """Per window and step: users, events, and conversion to the step right after it. A step whose
    successor has no events in the window gets NULLs, as the last one does."""
    in_window = Window.partitionBy("window_start").orderBy("step_order")
    follows = F.lead("step_order").over(in_window) == F.col("step_order") + 1
    counted = step_counts(df, window_seconds, steps, exact)
    return finish_funnels(
        counted.withColumn("_next", F.when(follows, F.lead("unique_users").over(in_window))), window_seconds, as_of)


def finish_funnels(counted: DataFrame, window_seconds: int, as_of=None) -> DataFrame:
    """Conversion and labels over the counts of a step, its window, and the users of the ``_next`` step."""
    users = F.col("unique_users")
    return conform(
        counted.withColumns(
            {
                "conversion_to_next": F.round(F.when(users > 0, F.col("_next") / users), 4),
                "drop_off_count": users - F.col("_next"),
                "drop_off_rate": F.round(F.when(users > 0, (users - F.col("_next")) / users), 4),
                "window_duration": F.lit(window_label(window_seconds)),
                "event_date": F.to_date("window_start").cast("string"),
                "processed_at": instant(as_of),
            }
        ),
        FUNNEL,
    )


def dashboard_funnels(
    df: DataFrame, window_seconds: int = 86400, steps: list[str] = settings.FUNNEL_STEPS
) -> DataFrame:
    """The dashboard's funnel: exact users, compared with the next step that is present; 0 where
    there is none."""
    in_window = Window.partitionBy("window_start").orderBy("step_order")
    users, following = F.col("unique_users"), F.lead("unique_users").over(in_window)
    return (
        step_counts(df, window_seconds, steps, exact=True)
        .withColumn("next_step_users", following)
        .withColumns(
            {
                "conversion_to_next": F.coalesce(
                    F.round(F.when(users > 0, F.col("next_step_users") / users), 4), F.lit(0.0)),
                "drop_off_count": F.coalesce(users - F.col("next_step_users"), F.lit(0)),
            }
        )
        .withColumn("drop_off_rate", F.coalesce(
            F.round(F.when(users > 0, F.col("drop_off_count") / users), 4), F.lit(0.0)))
        .drop("window_end")
    )
