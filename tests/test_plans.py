"""What Spark does with the plans, as on a cluster where nothing is small enough to broadcast by itself."""

import pytest

from marquee.operators.collaboration import shared_title_counts
from marquee.plans import bindings as b
from marquee.plans import queries

FOLDER = "/root/testdata/sf0.001"
BATCH = [
    "acting_credits", "title_details", "person_details", "credited_rated_titles", "person_title_best",
    "person_top3_titles", "person_title_total", "person_pages", "top10_people_by_titles",
    "top10_people_by_credits", "collaborator_pairs", "collaborator_sets", "collaborator_strength",
    "new_vote_totals", "ratings_merge", "vote_minutes", "trending_batch", "running_votes", "vote_holders",
]


@pytest.fixture
def big(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, old)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df):
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_nested_loops_and_no_unbounded_broadcast(big, name):
    plan = planned(queries.QUERIES[name](big, FOLDER))
    for node in ("Python", "Pandas", "NestedLoop", "CartesianProduct"):
        assert node not in plan
    bounded = {"top10_people_by_titles": 1, "top10_people_by_credits": 1, "running_votes": 1, "vote_holders": 1}
    assert plan.count("BroadcastExchange") == bounded.get(name, 0)


def test_filters_and_columns_reach_the_scan(big):
    plan = planned(queries.QUERIES["acting_credits"](big, FOLDER))
    assert "PushedFilters: [In(l_returnflag, [A,R])]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_returnflag:string>" in plan


def test_top_ten_is_a_bounded_heap_over_a_count_spread_by_title(big):
    plan = ran(queries.QUERIES["top10_people_by_titles"](big, FOLDER))
    assert "TakeOrderedAndProject(limit=10" in plan
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan


def test_top_three_keeps_three_rows_per_task_before_the_shuffle(big):
    plan = planned(queries.QUERIES["person_top3_titles"](big, FOLDER))
    assert "WindowGroupLimit" in plan and "row_number(), 3, Partial" in plan


def test_pages_join_credits_and_titles_once(big):
    plan = ran(queries.QUERIES["person_pages"](big, FOLDER))
    assert plan.count("l_partkey") and plan.count("FileScan") == 4


def test_both_sides_of_the_pair_join_are_one_shuffle(big):
    plan = ran(shared_title_counts(b.order_credits(big, FOLDER), b.ACTING))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning(title_id") >= 2
    assert "ReusedExchange" in plan


def test_merge_shuffles_each_side_once(big):
    plan = planned(queries.QUERIES["ratings_merge"](big, FOLDER))
    assert plan.count("Exchange hashpartitioning") == 2
