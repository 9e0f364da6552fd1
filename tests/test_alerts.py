from helpers import rows_of, utc
from wickwork.operators.alerts import DEAD_LETTER_RULE, LAG_RULE, threshold_alert

SCHEMA = "subscription_id string, metric string, ts timestamp, value double"


def samples(spark, metric, *rows):
    return spark.createDataFrame([(s, metric, utc(2024, 1, 1, 0, m), float(v)) for s, m, v in rows], SCHEMA)


def test_lag_has_to_last(spark):
    df = samples(
        spark,
        "oldest_unacked_message_age",
        ("edge", 0, 600), ("edge", 5, 600),  # exactly at the threshold
        ("short", 1, 700), ("short", 6, 10), ("short", 11, 700),
        ("long", 1, 100), ("long", 2, 601), ("long", 8, 650), ("long", 14, 5),
    )
    got = threshold_alert(df, **LAG_RULE)
    assert [(r[0], r[1].minute, r[2]) for r in rows_of(got, "subscription_id", "window_start", "value")] == [
        ("long", 5, 650.0)
    ]


def test_one_dead_letter_alerts(spark):
    df = samples(spark, "dead_letter_message_count", ("a", 0, 0), ("b", 1, 1), ("b", 2, 2), ("b", 9, 0))
    got = threshold_alert(df, **DEAD_LETTER_RULE)
    assert [(r[0], r[1].minute, r[2]) for r in rows_of(got, "subscription_id", "window_start", "value")] == [("b", 0, 3.0)]


def test_other_metrics_are_not_counted(spark):
    df = samples(spark, "something_else", ("a", 0, 9))
    assert threshold_alert(df, **DEAD_LETTER_RULE).count() == 0


def test_longer_holds(spark):
    df = samples(spark, "oldest_unacked_message_age", *[("a", m, 700) for m in (0, 5, 10, 15)])
    got = threshold_alert(df, threshold=600, hold_periods=3)
    assert [r[0].minute for r in rows_of(got, "window_start")] == [10, 15]
