from datetime import datetime

import pytest
from comparing import rows

from wattline.operators import checks


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [("a", "p1", "Red", -1.0), ("a", "p9", "Blue", 5.0), (None, "p9", None, None), (None, None, "Odd", 11.0)],
        "id string, parent string, color string, n double",
    )
    parent = spark.createDataFrame([("p1",), ("p1",)], "parent string")
    good = spark.createDataFrame([("a", "p1", "Red", 0.0)], child.schema)
    return {"child": child, "parent": parent, "good": good}


def test_violations(tables):
    child, parent = tables["child"], tables["parent"]
    assert checks.null_rows(child, "id").count() == 2
    assert rows(checks.repeated_values(child, "id")) == [("a", 2)]
    assert rows(checks.unaccepted_values(child, "color", ["Red", "Blue"])) == [("Odd", 1)]
    assert rows(checks.orphan_values(child, "parent", parent, "parent")) == [("p9", 2)]
    assert rows(checks.below_zero(child, "n"), "n") == [(-1.0,)]
    assert rows(checks.outside_range(child, "n", 0, 10), "n") == [(-1.0,), (11.0,)]


def all_checks(table):
    return [
        *checks.key(table, "id"),
        *checks.accepted(table, "color", ["Red", "Blue"]),
        *checks.refers(table, "parent", "parent"),
        *checks.positive(table, "n"),
        *checks.between(table, "n", 0, 10),
    ]


def test_report_counts_and_passes(tables):
    report = checks.check_report(tables, [*all_checks("child"), *all_checks("good")])
    found = {(r.table_name, r.check_name): (r.violations, r.status) for r in report.collect()}
    assert found == {
        ("child", "not_null"): (2, "fail"),
        ("child", "unique"): (1, "fail"),
        ("child", "accepted_values"): (1, "fail"),
        ("child", "relationships"): (2, "fail"),
        ("child", "positive_or_zero"): (1, "fail"),
        ("child", "value_between"): (2, "fail"),
        **{("good", r[1]): (0, "pass") for r in (("", c.kind) for c in all_checks("good"))},
    }


def test_each_check_yields_its_violations(tables):
    counts = [check.violations(tables).count() for check in all_checks("child")]
    assert counts == [2, 1, 1, 1, 1, 2]
    with pytest.raises(ValueError, match="unknown check"):
        checks.Check("odd", "child", "id").violations(tables)


def test_passing_report_does_not_stop(tables):
    checks.require_passed(checks.check_report(tables, all_checks("good")))


def test_freshness_limits(spark):
    def loaded(*values):
        return spark.createDataFrame([(v,) for v in values], "at timestamp")

    tables = {
        "day_30": loaded(datetime(2026, 1, 1), datetime(2025, 1, 1)),
        "day_31": loaded(datetime(2025, 12, 31)),
        "day_91": loaded(datetime(2025, 11, 1)),
        "empty": loaded(),
    }
    report = checks.freshness(tables, "at", datetime(2026, 1, 31))
    assert dict(rows(report, "table_name", "status")) == {
        "day_30": "pass",
        "day_31": "warn",
        "day_91": "error",
        "empty": "error",
    }


def test_counts_are_ordered_by_name(tables):
    assert [tuple(r) for r in checks.table_counts(tables).collect()] == [("child", 4), ("good", 1), ("parent", 2)]
