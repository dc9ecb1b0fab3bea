from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marquee.operators import credits, details, ranking

CREDIT = "title_id string, person_id string, category string"


def make(spark, credit_rows, title_rows, rating_rows):
    return (
        spark.createDataFrame(credit_rows, CREDIT),
        spark.createDataFrame(title_rows, "title_id string, original_title string"),
        spark.createDataFrame(rating_rows, "title_id string, mean double, votes long"),
    )


def test_only_acting_credits_of_named_rated_titles(spark, rows):
    parts = make(
        spark,
        [("t1", "p", "actor"), ("t1", "q", "director"), ("t2", "p", "actress"), ("t3", "p", "actor"),
         ("t4", "p", "actor"), ("t5", "p", "actor"), ("t6", "p", "self")],
        [("t1", "5€ \"film\""), ("t2", "zero"), ("t3", None), ("t4", ""), ("t5", "unrated"), ("t6", "x")],
        [("t1", 6.0, 1), ("t2", 0.0, 1), ("t3", 5.0, 1), ("t4", 5.0, 1), ("t6", 5.0, 1)],
    )
    assert rows(credits.credited_rated_titles(*parts)) == [("t1", "p", "5€ \"film\"", 6.0)]


def test_repeated_credits_fan_out_but_do_not_change_the_summary(spark, rows):
    parts = make(spark, [("t1", "p", "actor"), ("t1", "p", "actress")], [("t1", "A")], [("t1", 6.0, 1)])
    assert credits.credited_rated_titles(*parts).count() == 2
    assert rows(credits.title_totals(credits.person_title_best(*parts))) == [("p", 1)]


def test_same_name_counts_once_with_best_rating(spark, rows):
    parts = make(
        spark, [("t1", "p", "actor"), ("t2", "p", "actor")], [("t1", "A"), ("t2", "A")],
        [("t1", 5.0, 1), ("t2", 9.0, 1)])
    best = credits.person_title_best(*parts)
    assert rows(best) == [("p", "A", 9.0)]
    assert rows(credits.title_summary(best)) == [("p", 1, "A", None, None)]


def test_ties_in_rating_go_by_name(spark, rows):
    parts = make(
        spark, [(f"t{n}", "p", "actor") for n in range(4)],
        [("t0", "D"), ("t1", "B"), ("t2", "A"), ("t3", "C")],
        [("t0", 9.0, 1), ("t1", 5.0, 1), ("t2", 5.0, 1), ("t3", 5.0, 1)])
    assert rows(credits.title_summary(credits.person_title_best(*parts))) == [("p", 4, "D", "A", "B")]


def test_pages_keep_people_on_either_side(spark, rows):
    people = spark.createDataFrame(
        [("p", "Pat", 1950, None), ("q", "Quinn", None, 1999)], "person_id string, name string, birth int, death int")
    summary = spark.createDataFrame(
        [("p", 2, "A", "B", None), ("r", 1, "A", None, None)],
        "person_id string, total long, top1 string, top2 string, top3 string")
    pages = credits.person_pages(people, summary)
    assert rows(pages) == [
        ("p", "Pat", 1950, None, 2, "A", "B", None),
        ("q", "Quinn", None, 1999, 0, None, None, None),
        ("r", None, None, None, 1, "A", None, None),
    ]
    lines = [r.line for r in details.page_lines(pages.where("person_id = 'p'")).orderBy("line_no").collect()]
    assert lines == ["Name: Pat", "Birth: 1950", "Death: ----", "Number of movies: 2", "#1 => A", "#2 => B"]


def test_genres_are_numbered_from_one(spark, rows):
    df = spark.createDataFrame(
        [("t1", "A", ["Drama", "War"]), ("t2", "B", None)], "title_id string, original_title string, genres array<string>")
    assert rows(details.numbered_genres(df)) == [
        ("t1", "A", 1, "Drama"), ("t1", "A", 2, "War"), ("t2", "B", None, None)]


def test_top_people_counts_titles_or_credits_and_breaks_ties_by_id(spark, rows):
    repeated = [("t0", "p00", "actor")] * 3
    listed = [(f"t{n}", f"p{p:02}", "actor") for p in range(1, 12) for n in range(2)]
    df = spark.createDataFrame(repeated + listed + [("t9", "p11", "writer")], CREDIT)
    people = spark.createDataFrame([(f"p{p:02}", f"N{p}") for p in range(9)], "person_id string, name string")
    by_titles = ranking.top_people(ranking.titles_per_person(df), people)
    assert rows(by_titles, "rank", "person_id", "name", "n") == sorted(
        [(r, f"p{r:02}", f"N{r}" if r < 9 else None, 2) for r in range(1, 11)], key=repr)
    by_credits = ranking.top_people(ranking.credits_per_person(df), people, k=1)
    assert rows(by_credits) == [(1, "p00", "N0", 3)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("pq"), st.integers(0, 5)), min_size=1, max_size=20),
       st.lists(st.tuples(st.sampled_from(["A", "B", "C", "D", ""]), st.integers(0, 3)), min_size=6, max_size=6))
def test_summaries_equal_brute_force(spark, listed, catalog):
    best = {}
    for person, title in listed:
        name, rating = catalog[title]
        if name and rating:
            names = best.setdefault(person, {})
            names[name] = max(rating, names.get(name, 0))
    want = {}
    for person, names in best.items():
        top = sorted(names, key=lambda n: (-names[n], n))[:3]
        want[person] = (len(names), *top, *[None] * (3 - len(top)))
    parts = make(
        spark, [(f"t{t}", p, "actor") for p, t in listed], [(f"t{n}", name) for n, (name, _) in enumerate(catalog)],
        [(f"t{n}", float(r), 1) for n, (_, r) in enumerate(catalog)])
    found = credits.title_summary(credits.person_title_best(*parts)).collect()
    assert {r.person_id: tuple(r)[1:] for r in found} == want
