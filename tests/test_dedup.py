import random
from datetime import datetime, timedelta

import pytest
from comparing import rows

from wattline.operators.dedup import flag_duplicates, latest_rows
from wattline.operators.skew import hot_keys
from wattline.sources.tables import with_position

T0 = datetime(2026, 1, 1)
SCHEMA = "id string, at timestamp, n long"


def make(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def expected_ranks(data):
    ranks = {}
    for key in {r[0] for r in data if r[0] is not None}:
        group = [r for r in data if r[0] == key]
        group.sort(key=lambda r: (r[1] is None, -(r[1] or T0).timestamp(), r[2]))
        ranks.update({r[2]: place for place, r in enumerate(group, 1)})
    return ranks


def test_newest_row_is_kept_and_ties_follow_position(spark):
    data = [
        ("a", T0, 1),
        ("a", T0 + timedelta(hours=1), 2),
        ("b", T0, 3),
        ("b", T0, 4),
        ("c", None, 5),
        ("c", T0, 6),
    ]
    flagged = flag_duplicates(make(spark, data), "id", "dup", "at", position=("n",))
    assert rows(flagged.filter("dup"), "id", "n") == [("a", 1), ("b", 4), ("c", 5)]


def test_rows_without_key_are_never_flagged(spark):
    data = [(None, T0, n) for n in range(5)]
    flagged = flag_duplicates(make(spark, data), "id", "dup", "at", position=("n",))
    assert flagged.filter("dup").count() == 0
    assert flagged.count() == 5


@pytest.mark.parametrize("hot_rows", [1_000_000, 20, 7])
def test_hot_groups_get_the_same_ranks(spark, hot_rows):
    draw = random.Random(5)
    data = []
    for n in range(600):
        key = "hot" if n % 3 == 0 else draw.choice(["warm", None, *[f"k{i}" for i in range(120)]])
        at = None if n % 17 == 0 else T0 + timedelta(hours=draw.randrange(3))
        data.append((key, at, n))
    flagged = flag_duplicates(
        make(spark, data).repartition(5), "id", "dup", "at", "place", ("n",), hot_rows=hot_rows
    )
    assert flagged.columns == ["id", "at", "n", "place", "dup"]
    ranks = expected_ranks(data)
    found = {r.n: (r.place, r.dup) for r in flagged.collect()}
    assert len(found) == 600
    assert {n: p for n, (p, _) in found.items() if n in ranks} == ranks
    assert {n for n, (_, dup) in found.items() if dup} == {n for n, p in ranks.items() if p > 1}


def test_identical_copies_keep_exactly_one(spark, tmp_path):
    path = str(tmp_path / "copies")
    make(spark, [("x", T0, 1)] * 50 + [("y", T0, 2)]).repartition(3).write.parquet(path)
    for hot_rows in (1_000_000, 10):
        scan = with_position(spark.read.parquet(path))
        flagged = flag_duplicates(scan, "id", "dup", "at", hot_rows=hot_rows)
        assert rows(flagged.groupBy("id", "dup").count()) == [("x", False, 1), ("x", True, 49), ("y", False, 1)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 9])
def test_a_hot_group_without_positions_gets_the_ranks_of_one_window(spark, hot_rows):
    """A third of the rows on one key; times are unique within a key, so the ranks are known."""
    draw = random.Random(6)
    data = [("hot" if n % 3 == 0 else draw.choice([None, *[f"k{i}" for i in range(40)]]), T0 + timedelta(minutes=n), n) for n in range(300)]
    draw.shuffle(data)
    flagged = flag_duplicates(make(spark, data).repartition(4), "id", "dup", "at", "place", hot_rows=hot_rows)
    assert flagged.columns == ["id", "at", "n", "place", "dup"]
    ranks = expected_ranks(data)
    assert {r.n: r.place for r in flagged.collect() if r.n in ranks} == ranks
    if hot_rows == 9:
        # No window holds the hot key whole: what is sorted together is a piece of at most nine rows of one file.
        assert "_piece" in flagged._jdf.queryExecution().optimizedPlan().toString()


def test_equal_rows_of_a_hot_group_without_positions_keep_one(spark):
    df = make(spark, [("x", T0, 1)] * 50 + [("y", T0, 1)] * 2)
    plain = flag_duplicates(df, "id", "dup", "at")
    hot = flag_duplicates(df, "id", "dup", "at", hot_rows=10)
    assert plain.filter("dup").count() == hot.filter("dup").count() == 50
    assert rows(hot, "id", "_duplicate_rank") == rows(plain, "id", "_duplicate_rank")


def test_hot_keys_are_bounded(spark):
    df = spark.range(1000).selectExpr("cast(id % 10 as string) as id")
    assert hot_keys(df, ["id"], floor=200) is None
    assert hot_keys(df, ["id"], floor=50).count() == 10
    # With a limit of four no more than four keys can be hot: each must hold a quarter of the rows.
    assert hot_keys(df, ["id"], floor=1, limit=4) is None


def test_hot_keys_are_found_in_a_sample(spark):
    ids = spark.range(400_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as id")
    assert rows(hot_keys(ids, ["id"], floor=100_000)) == [("hot",)]
    assert hot_keys(ids, ["id"], floor=200_000) is None


def test_latest_rows_keep_one_per_key_and_all_without(spark):
    data = [("a", T0, 1), ("a", T0 + timedelta(1), 2), (None, T0, 3), (None, T0, 4)]
    assert rows(latest_rows(make(spark, data), "id", "at", ("n",)), "id", "n") == [("a", 2), (None, 3), (None, 4)]


def test_the_window_over_wide_rows_is_one_shuffle(spark):
    flagged = flag_duplicates(make(spark, [("a", T0, 1)]), "id", "dup", "at", position=("n",))
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
