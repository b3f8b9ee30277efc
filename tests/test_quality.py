import pytest

from tests.conftest import values
from tripweave.operators.changes import snapshot_changes
from tripweave.operators.quality import QualityCheck, quality_by_table, quality_score
from tripweave.operators.rules import apply_expectations, expectation_report

RULES = {"positive": "a > 0", "small": "a < 10 AND b < 10"}


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(
        [(1, 1), (0, 1), (5, None), (None, 3), (20, 20)], "a int, b int"
    )


def test_drop_keeps_rows_passing_every_rule(pairs):
    assert values(apply_expectations(pairs, RULES), "a", "b") == [(1, 1)]


def test_warn_keeps_every_row(pairs):
    assert apply_expectations(pairs, RULES, "warn").count() == 5


def test_unknown_mode(pairs):
    with pytest.raises(ValueError, match="quarantine"):
        apply_expectations(pairs, RULES, "quarantine")


def test_report_counts_null_as_failed(pairs):
    report = expectation_report(pairs, RULES, "pairs")
    assert values(report, "dataset", "rule", "passed", "failed") == [
        ("pairs", "positive", 3, 2),
        ("pairs", "small", 2, 3),
    ]


def test_report_of_nothing(pairs):
    report = expectation_report(pairs.limit(0), RULES, "pairs")
    assert values(report, "passed", "failed") == [(0, 0), (0, 0)]


def test_score_loses_two_points_per_percent_of_nulls(spark):
    rows = spark.createDataFrame(
        [(None, 1.0)] + [("t", -1.0)] * 2 + [("t", 1.0)] * 7, "t string, x double"
    )
    row = quality_score(rows, QualityCheck(("t", "x"), ("x",))).first()
    assert row.asDict() == {
        "total_records": 10,
        "t_null_percentage": 10.0,
        "x_null_percentage": 0.0,
        "x_negative_count": 2,
        "quality_score": 80.0,
    }


def test_score_may_fall_below_zero_and_is_full_without_rows(spark):
    rows = spark.createDataFrame([(None, None)], "t string, x double")
    check = QualityCheck(("t", "x"))
    assert values(quality_score(rows, check), "quality_score") == [-300.0]
    assert values(quality_score(rows.limit(0), check), "quality_score") == [100.0]


def test_several_tables(spark):
    one = spark.createDataFrame([(None,), (1,)], "a int")
    two = spark.createDataFrame([(-1.0,)], "b double")
    report = quality_by_table(
        {"one": (one, QualityCheck(("a",))), "two": (two, QualityCheck((), ("b",)))}
    )
    assert values(report, "table_name", "metric", "value", "total_records", "quality_score") == [
        ("one", "a_null_percentage", 50.0, 2, 0.0),
        ("two", "b_negative_count", 1.0, 1, 100.0),
    ]


def test_a_table_without_checks_is_an_error(spark):
    with pytest.raises(ValueError, match="bare"):
        quality_by_table({"bare": (spark.range(1), QualityCheck(()))})


def test_snapshot_changes(spark):
    layout = "k int, j int, v double"
    old = spark.createDataFrame(
        [(1, 1, 1.0), (2, None, 2.0), (3, 3, None), (4, 4, 4.0), (None, 5, 5.0)], layout
    )
    new = spark.createDataFrame(
        [(1, 1, 1.0), (2, None, 2.5), (3, 3, None), (6, 6, 6.0), (None, 5, 5.0)], layout
    )
    changes = snapshot_changes(old, new, ["k", "j"])
    assert sorted(values(changes, "_change_type", "k", "v", "_row_count")) == [
        ("delete", 4, 4.0, 1),
        ("insert", 6, 6.0, 1),
        ("update_postimage", 2, 2.5, 1),
        ("update_preimage", 2, 2.0, 1),
    ]
    assert snapshot_changes(old, old, ["k", "j"]).isEmpty()


def test_repeated_rows_are_compared_by_number(spark):
    old = spark.createDataFrame([(1, 1.0)] * 3 + [(2, 2.0)], "k int, v double")
    new = spark.createDataFrame([(1, 1.0)] + [(2, 2.0)] * 5, "k int, v double")
    changes = snapshot_changes(old, new, ["k"])
    assert sorted(values(changes, "_change_type", "k", "_row_count")) == [
        ("delete", 1, 2),
        ("insert", 2, 4),
    ]
