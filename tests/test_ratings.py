import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marquee.functions import one_decimal_text
from marquee.operators.ratings import merge_ratings, vote_totals

STORED = "title_id string, mean double, votes long"
VOTES = "title_id string, rating long"
QUICK = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def merged(stored, votes):
    return {r.title_id: (r.mean, r.votes) for r in merge_ratings(stored, vote_totals(votes)).collect()}


def test_merge_keeps_unvoted_titles_and_drops_unknown_ones(spark):
    stored = spark.createDataFrame([("a", 7.0, 2), ("b", 5.5, 4), ("c", 0.0, 0), ("d", None, 0)], STORED)
    votes = spark.createDataFrame([("a", 10), ("a", 3), ("x", 1), ("d", 8)], VOTES)
    assert merged(stored, votes) == {"a": (6.75, 4), "b": (5.5, 4), "c": (None, 0), "d": (8.0, 1)}


def test_one_decimal_is_half_up(spark):
    values = [(7.25, "7.3"), (7.249999999999999, "7.3"), (7.24, "7.2"), (6.0, "6.0"), (0.05, "0.1"), (9.95, "10.0")]
    df = spark.createDataFrame(values, "x double, want string")
    assert all(r.got == r.want for r in df.withColumn("got", one_decimal_text(df.x)).collect())


stored_rows = st.dictionaries(st.sampled_from("abcd"), st.tuples(st.integers(10, 100), st.integers(1, 50)), min_size=1)
vote_rows = st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 10)), max_size=12)


@QUICK
@given(stored_rows, vote_rows, vote_rows)
def test_merging_in_two_steps_is_merging_at_once(spark, stored, first, second):
    base = spark.createDataFrame([(t, m / 10, n) for t, (m, n) in stored.items()], STORED)
    one, two, both = (spark.createDataFrame(v, VOTES) for v in (first, second, first + second))
    steps = merged(merge_ratings(base, vote_totals(one)), two)
    at_once = merged(base, both)
    assert steps.keys() == at_once.keys()
    for title, (mean, votes) in at_once.items():
        assert votes == steps[title][1] and math.isclose(mean, steps[title][0], rel_tol=1e-9)


@QUICK
@given(stored_rows)
def test_no_new_votes_change_nothing(spark, stored):
    base = spark.createDataFrame([(t, m / 10, n) for t, (m, n) in stored.items()], STORED)
    assert merged(base, spark.createDataFrame([], VOTES)) == {t: (m / 10, n) for t, (m, n) in stored.items()}
