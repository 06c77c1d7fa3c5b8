import random

import pytest
from pyspark.sql import functions as F

from silverloom.plans import analytics
from silverloom.plans import (
    actor_topk,
    career_history,
    genre_revenue,
    team_consistency,
    year_revenue,
)

def rows(df):
    return [tuple(r) for r in df.collect()]


def test_actor_topk_orders_nulls_last_and_breaks_ties(spark):
    movies = spark.createDataFrame(
        [("1", "A", 5.0), ("2", "B", None), ("3", "C", 9.0), ("4", "D", 9.0)],
        "movie_id string, title string, revenue double",
    )
    cast = spark.createDataFrame(
        [(m, n) for m in "1234" for n in ("Tom Cruise", "tom cruise jr", "Other")],
        "movie_id string, name string",
    )
    assert rows(actor_topk(movies, cast, "Tom Cruise", 3)) == [
        ("C", 9.0, "Tom Cruise"),
        ("D", 9.0, "Tom Cruise"),
        ("A", 5.0, "Tom Cruise"),
    ]
    every = actor_topk(movies, cast, "TOM CRUISE", 20, ignore_case=True)
    assert every.count() == 8
    assert rows(every)[-1] == ("B", None, "tom cruise jr")


def test_text_to_find_is_not_a_pattern(spark):
    movies = spark.sql("SELECT '1' AS movie_id, 'A' AS title, 1D AS revenue")
    cast = spark.createDataFrame([("1", "100% Tom"), ("1", "100 Tom")], "movie_id string, name string")
    assert rows(actor_topk(movies, cast, "100%")) == [("A", 1.0, "100% Tom")]


def test_genre_revenue_counts_repeated_rows_like_the_join(spark):
    rng = random.Random(3)
    movies = [(rng.choice("abcd"), float(rng.randrange(-2, 9))) for _ in range(60)]
    genres = [(rng.choice("abcde"), rng.choice(["x", "y", None])) for _ in range(50)]
    m = spark.createDataFrame(movies, "movie_id string, revenue double")
    g = spark.createDataFrame(genres, "movie_id string, name string")
    plain = (
        m.join(g, "movie_id")
        .where("revenue > 0")
        .groupBy(F.col("name").alias("genre"))
        .agg(F.avg("revenue").alias("avg"), F.count("*").alias("n"))
    )
    wanted = {r.genre: (pytest.approx(r.avg), r.n) for r in plain.collect()}
    got = {r[0]: (r[1], r[2]) for r in rows(genre_revenue(m, g))}
    assert got == wanted
    assert len(got) == 3


def test_year_revenue(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (DATE'2001-02-03', 2D), (DATE'2001-12-31', 4D), (DATE'1999-01-01', 1D),"
        " (NULL, 8D), (DATE'2002-01-01', 0D), (DATE'2003-01-01', NULL) AS t(release_date, revenue)"
    )
    got = year_revenue(df)
    assert rows(got) == [(2001, 3.0, 2), (1999, 1.0, 1)]
    assert got.schema["year"].dataType.simpleString() == "int"


def brute_team(crew, min_movies=2):
    """The self-join, row by row."""
    seen = {}
    for movie, name, job in crew:
        if job != "Director" or movie is None:
            continue
        movies, members, positions = seen.setdefault(name, (set(), set(), [0]))
        movies.add(movie)
        for other, member, _ in crew:
            if other == movie and member is not None:
                members.add(member)
                positions[0] += 1
    return {
        name: (len(movies), len(members), positions[0])
        for name, (movies, members, positions) in seen.items()
        if len(movies) >= min_movies
    }


CREW = "movie_id int, name string, job string"


@pytest.mark.parametrize("large,bits,dense", [(1, 4, 1), (5, 3, 2), (9, 32_768, 3), (256, 32_768, 64)])
@pytest.mark.parametrize("seed", range(3))
def test_team_consistency_against_brute_force(spark, monkeypatch, seed, large, bits, dense):
    """Every name in a bitmap, few of them, none."""
    monkeypatch.setattr(analytics, "_LARGE", large)
    monkeypatch.setattr(analytics, "_BITS", bits)
    monkeypatch.setattr(analytics, "_DENSE", dense)
    rng = random.Random(seed)
    people = [None, *"abcdefgh"]
    crew = [
        (rng.choice([None, 1, 1, 1, 2, 3, 4, 5, 6]), rng.choice(people), rng.choice(["Director", "Editor"]))
        for _ in range(70)
    ]
    got = team_consistency(spark.createDataFrame(crew, CREW), F.col("job") == "Director", k=100)
    assert {r[0]: tuple(r[1:]) for r in rows(got)} == brute_team(crew)


def test_team_consistency_with_one_movie_holding_a_third_of_the_rows(spark):
    crew = [(0, f"p{i}", "Director") for i in range(300)]
    crew += [(1 + i % 200, f"p{i % 450}", "Director" if i % 3 else "Editor") for i in range(600)]
    df = spark.createDataFrame(crew, CREW)
    wanted = brute_team(crew)
    got = team_consistency(df, F.col("job") == "Director", k=1000)
    assert {r[0]: tuple(r[1:]) for r in rows(got)} == wanted


def test_team_consistency_forms_no_pairs_of_large_movies(spark):
    """1,500 leads in 8 movies of 1,000 names, each lead in movies of its own choice."""
    rng = random.Random(5)
    crew = [(m, f"p{i}", "Director" if (i >> m) % 2 else "Editor") for m in range(8) for i in rng.sample(range(1500), 1000)]
    got = team_consistency(spark.createDataFrame(crew, CREW), F.col("job") == "Director", k=5000)
    members, led = {}, {}
    for movie, name, job in crew:
        members.setdefault(movie, set()).add(name)
        if job == "Director":
            led.setdefault(name, []).append(movie)
    wanted = {
        lead: (len(ms), len(set().union(*(members[m] for m in ms))), 1000 * len(ms))
        for lead, ms in led.items()
        if len(ms) > 1
    }
    assert {r[0]: tuple(r[1:]) for r in rows(got)} == wanted
    # The self-join has some four million pairs; no operator of the plan that ran comes near.
    counts = [m.value() for m in _row_metrics(got._jdf.queryExecution().executedPlan())]
    assert counts and max(counts) < 400_000


def test_team_consistency_does_not_pair_leads_with_loose_names(spark):
    """Thirty names are in the smaller of two teams alone, too few for a bitmap of its own: they are
    counted once for all of the thousand leads with the same teams."""
    both = [(m, f"p{i}", "Director") for m in (0, 1) for i in range(1000)]
    crew = [*both, *((0, f"o{i}", "Editor") for i in range(100)), *((1, f"q{i}", "Editor") for i in range(30))]
    crew += [(2, "p0", "Director"), (2, "q1", "Editor"), (2, "new", "Editor")]
    got = team_consistency(spark.createDataFrame(crew, CREW), F.col("job") == "Director", k=2000)
    found = {r[0]: tuple(r[1:]) for r in rows(got)}
    assert found == {f"p{i}": (2, 1130, 2130) for i in range(1, 1000)} | {"p0": (3, 1131, 2133)}
    counts = [m.value() for m in _row_metrics(got._jdf.queryExecution().executedPlan())]
    assert counts and max(counts) < 10_000


def _row_metrics(plan):
    """``number of output rows`` of every operator, through stages that ran apart."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        yield from _row_metrics(plan.plan())
        return
    found = plan.metrics().get("numOutputRows")
    if found.isDefined():
        yield found.get()
    children = plan.children()
    for i in range(children.size()):
        yield from _row_metrics(children.apply(i))


def test_team_ranking_ties(spark):
    crew = [(m, n, "Director") for m in (1, 2) for n in "cab"] + [(3, "b", "Director")]
    got = team_consistency(spark.createDataFrame(crew, CREW), F.col("job") == "Director", k=2)
    assert [r.lead for r in got.collect()] == ["b", "a"]


def test_career_history(spark):
    crew = spark.createDataFrame(
        [
            ("1", "Ahmet", "Editor"),
            ("2", "Ahmet", "Director"),
            ("2", "Else", "Writer"),
            ("3", "Ahmet", "Gaffer"),
        ],
        "movie_id string, name string, job string",
    )
    movies = spark.sql(
        "SELECT * FROM VALUES ('1','A',DATE'2005-01-01'),('2','B',DATE'1999-01-01'),('3','C',NULL)"
        " AS t(movie_id,title,release_date)"
    )
    assert [(r.title, r.role) for r in career_history(crew, movies, "Ahmet").collect()] == [
        ("B", "Director"),
        ("A", "Editor"),
        ("C", "Gaffer"),
    ]
