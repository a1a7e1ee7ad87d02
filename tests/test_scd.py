from datetime import datetime

from comparing import rows

from wattline.operators.scd import History, apply_snapshot, versioned_dimension

HISTORY = History(
    key="id", checked=("name", "area"), columns=("sk", "id", "name", "area", "note"), version_key="version_sk"
)
T1, T2, T3 = (datetime(2026, m, 1) for m in (1, 2, 3))


def state(spark, *values):
    data = [("s" + v[0], *v) for v in values]
    return spark.createDataFrame(data, "sk string, id string, name string, area string, note string")


def shown(versions):
    return rows(versions, "id", "name", "area", "note", "dbt_valid_from", "dbt_valid_to")


def test_every_case_of_a_snapshot(spark):
    first = apply_snapshot(
        None,
        state(spark, ("same", "n", "x", "1"), ("changed", "n", "x", "1"), ("gone", "n", "x", "1"), ("null", "n", None, "1")),
        HISTORY,
        T1,
    )
    now = state(
        spark, ("same", "n", "x", "2"), ("changed", "n", "y", "2"), ("null", "n", "z", "2"), ("new", "n", "x", "2")
    )
    second = apply_snapshot(first, now, HISTORY, T2)
    assert shown(second) == [
        ("changed", "n", "x", "1", T1, T2),
        ("changed", "n", "y", "2", T2, None),
        ("gone", "n", "x", "1", T1, None),
        ("new", "n", "x", "2", T2, None),
        ("null", "n", "z", "2", T2, None),
        ("null", "n", None, "1", T1, T2),
        # A change in an unchecked column opens no version.
        ("same", "n", "x", "1", T1, None),
    ]


def test_repeating_a_snapshot_changes_nothing(spark):
    now = state(spark, ("a", "n", None, "1"), ("b", "n", "x", "1"))
    once = apply_snapshot(None, now, HISTORY, T1)
    assert shown(apply_snapshot(once, now, HISTORY, T2)) == shown(once)


def test_intervals_do_not_overlap_and_one_version_is_open(spark):
    versions = None
    for time, area in ((T1, "x"), (T2, "y"), (T3, "x")):
        versions = apply_snapshot(versions, state(spark, ("a", "n", area, "1"), ("b", "n", "x", "1")), HISTORY, time)
    history = sorted((r.dbt_valid_from, r.dbt_valid_to) for r in versions.filter("id = 'a'").collect())
    assert history == [(T1, T2), (T2, T3), (T3, None)]
    assert rows(versions.filter("dbt_valid_to is null").groupBy("id").count()) == [("a", 1), ("b", 1)]
    assert versions.select("dbt_scd_id").distinct().count() == versions.count()


def test_public_form(spark):
    versions = apply_snapshot(None, state(spark, ("a", "n", "x", "1")), HISTORY, T1)
    public = versioned_dimension(versions, HISTORY, ("note",))
    assert public.columns == [
        "version_sk", "sk", "id", "name", "area", "valid_from_timestamp", "valid_to_timestamp", "is_current_record",
    ]
    assert rows(public, "valid_from_timestamp", "valid_to_timestamp", "is_current_record") == [(T1, None, True)]
