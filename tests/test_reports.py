"""Flags of reports on hand-made tables, and NOT IN semantics against SQL."""

import random
from datetime import date

import pytest

from billshift import fixed
from billshift.operators import reports

DAY = date(2000, 6, 1)
EARLY, LATE = date(2000, 1, 1), date(2001, 1, 1)
ALERTS = "asrpt_id bigint, model_id bigint, alert_creat_dt date, current_education_date date"
RESULTS = "provider_id bigint, average_difference double, t_value double, p_value double, flag string"


def results(spark, rows):
    return spark.createDataFrame([(p, 0.0, 0.0, 0.0, f) for p, f in rows], RESULTS)


def alerts(spark, rows):
    return spark.createDataFrame([(r, m, d, DAY) for r, m, d in rows], ALERTS)


def flags(df):
    return {r["asrpt_id"]: r["testing_flag"] for r in df.collect()}


def test_status_of_every_kind(spark):
    educated = spark.createDataFrame(
        [
            (1, "4000000001", date(2001, 1, 1)),
            (2, "4000000002", date(2001, 1, 1)),
            (3, "4000000003", date(2001, 12, 1)),
            (4, "4000000004", date(2000, 12, 31)),  # exactly 365 days
            (5, "4000000005", date(2000, 12, 30)),  # 366 days
            (6, "no number", None),
        ],
        "asrpt_id bigint, subj_id string, max_alert_date date",
    )
    used = spark.createDataFrame([(1,), (2,), (2,)], "asrpt_id bigint")
    tested = results(spark, [(4_000_000_001, "N")])
    status = reports.education_status(educated, used, tested, "2001-12-31")
    assert sorted(map(tuple, status.collect())) == [
        (1, "N"),
        (2, "Untestable"),
        (3, "<90days"),
        (4, "<90days"),
        (5, "N/A"),
        (6, "N/A"),
    ]
    strict = reports.education_status(educated, used, tested, "2001-12-31", strict=True)
    assert strict.where("asrpt_id = 2").count() == 2
    assert flags(reports.education_not_n(status)).keys() == {2, 3, 4, 5, 6}
    shorter = reports.education_status(educated, used, tested, "2001-12-31", recent_days=90)
    assert flags(shorter)[4] == "N/A"


def test_n_reports_and_their_alerts(spark):
    education = spark.createDataFrame([(1, DAY), (2, DAY)], "asrpt_id bigint, current_education_date date")
    subjects = spark.createDataFrame(
        [(1, "4000000001"), (2, "4000000002"), (3, "4000000001")], "asrpt_id bigint, subj_id string"
    )
    tested = results(spark, [(4_000_000_001, "N"), (4_000_000_002, "Y")])
    flagged = reports.n_reports(education, subjects, tested)
    assert [tuple(r) for r in flagged.collect()] == [(1, DAY, "N", "4000000001")]

    links = spark.createDataFrame(
        [(1, 10), (1, 10), (1, 11), (1, 12), (1, 13), (2, 10)], "asrpt_id bigint, alert_id bigint"
    )
    raised = spark.createDataFrame(
        [(10, 100, EARLY), (11, 101, LATE), (12, 102, LATE), (13, None, LATE)],
        "alert_id bigint, model_id bigint, alert_creat_dt date",
    )
    models = spark.createDataFrame(
        [(100, "Active"), (101, "Inactive"), (102, "Retired")],
        "model_id bigint, model_actvty_stus string",
    )
    found = reports.n_report_alerts(flagged, links, raised, models)
    assert sorted((r["asrpt_id"], r["alert_id"]) for r in found.collect()) == [(1, 10), (1, 11)]
    assert [r["alert_id"] for r in reports.alerts_before(found).collect()] == [10]
    assert [r["alert_id"] for r in reports.alerts_after(found).collect()] == [11]


def test_alert_on_the_education_day_is_in_neither_set(spark):
    df = alerts(spark, [(1, 5, DAY)])
    assert reports.alerts_before(df).isEmpty() and reports.alerts_after(df).isEmpty()
    assert reports.n_flags(df).isEmpty()


@pytest.mark.parametrize(
    "rows, flag",
    [
        ([(5, EARLY), (5, LATE)], "N"),
        ([(5, EARLY), (6, LATE)], "New Model"),
        ([(5, EARLY), (5, LATE), (6, LATE)], "New Model"),
        ([(5, EARLY)], "N"),
        ([(6, LATE)], "New Model"),  # nothing earlier: anything is new
        ([(None, LATE)], "New Model"),
        ([(5, EARLY), (None, LATE)], "N"),  # null decides nothing
        ([(None, EARLY), (6, LATE)], "N"),
        ([(5, EARLY), (None, EARLY), (6, LATE)], "N"),
        ([(5, DAY), (5, LATE)], "New Model"),  # the day itself is not earlier
    ],
)
def test_new_model_rule(spark, rows, flag):
    df = alerts(spark, [(1, m, d) for m, d in rows])
    assert flags(reports.n_flags(df)) == {1: flag}
    assert flags(reports.new_model_reports(df)) == ({1: flag} if flag == "New Model" else {})
    assert flags(reports.unchanged_reports(df)) == ({1: flag} if flag == "N" else {})


def test_new_model_rule_equals_not_in(spark):
    """Random histories: the aggregate against the two NOT INs it stands for."""
    rng = random.Random(7)
    rows = [
        (r, rng.choice([None, 1, 2, 3, 4]) if r % 3 == 0 else rng.randint(1, 6), rng.choice([EARLY, DAY, LATE]))
        for r in range(120)
        for _ in range(rng.randint(1, 6))
    ]
    df = alerts(spark, rows)
    df.createOrReplaceTempView("history")
    want = spark.sql(
        """
        WITH earlier AS (SELECT * FROM history WHERE alert_creat_dt < current_education_date),
             later AS (SELECT * FROM history WHERE alert_creat_dt > current_education_date),
             fresh AS (SELECT DISTINCT asrpt_id FROM later WHERE model_id NOT IN
                         (SELECT model_id FROM earlier WHERE earlier.asrpt_id = later.asrpt_id))
        SELECT DISTINCT asrpt_id,
               CASE WHEN asrpt_id IN (SELECT asrpt_id FROM fresh) THEN 'New Model' ELSE 'N' END
                 AS testing_flag
        FROM history WHERE alert_creat_dt <> current_education_date
        """
    )
    assert flags(reports.n_flags(df)) == flags(want)
    fresh, same = flags(reports.new_model_reports(df)), flags(reports.unchanged_reports(df))
    assert not fresh.keys() & same.keys()
    assert fresh.keys() | same.keys() == {r for r, _, d in rows if d != DAY}


def test_report_without_alerts_is_published_as_not_available(spark):
    status = spark.createDataFrame([(1, "N"), (2, "Y"), (3, "N")], "asrpt_id bigint, testing_flag string")
    df = alerts(spark, [(1, 5, EARLY), (1, 6, LATE)])
    all_flags = reports.all_flags(df, status)
    assert flags(all_flags) == {1: "New Model", 2: "Y"}
    to_publish = spark.createDataFrame([(i,) for i in (1, 2, 3, 99)], "asrpt_id bigint")
    out = reports.increment(to_publish, all_flags, "2001-12-31", flag_col="flag_90")
    assert sorted((r["asrpt_id"], r["flag_90"], r["run_date"]) for r in out.collect()) == [
        (1, "New Model", date(2001, 12, 31)),
        (2, "Y", date(2001, 12, 31)),
        (3, "N/A", date(2001, 12, 31)),
        (99, "N/A", date(2001, 12, 31)),
    ]


def test_repeated_flags_count_once_unless_strict(spark):
    known = spark.createDataFrame(
        [(1, "Y"), (1, "Y"), (2, "Y"), (2, "N")], "asrpt_id bigint, testing_flag string"
    )
    to_publish = spark.createDataFrame([(1,), (2,)], "asrpt_id bigint")
    assert reports.increment(to_publish, known, "2001-12-31").count() == 3
    assert reports.increment(to_publish, known, "2001-12-31", strict=True).count() == 4


def test_run_date_defaults_to_today(spark):
    known = spark.createDataFrame([(1, "Y")], "asrpt_id bigint, testing_flag string")
    out = reports.increment(known.select("asrpt_id"), known)
    assert out.where("run_date = current_date()").count() == 1


def test_fixed_flags():
    assert fixed.FLAG_RECENT == "<90days" and fixed.RECENT_DAYS == 365
