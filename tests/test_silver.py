import datetime

import pytest
from pyspark.sql import types as T

from silverloom.operators import explode_objects
from silverloom.plans import build_silver, genre_revenue, write_silver
from silverloom.schemas import BRONZE_COLUMNS, MOVIES, OBJECT_TABLES, SILVER_TABLES, TARGETS
from silverloom.sources import land_bronze, read_bronze, read_table


def quoted(value):
    return "" if value is None else '"' + value.replace('"', '""') + '"'


def write_csv(path, header, rows):
    lines = [",".join(header)] + [",".join(quoted(v) for v in row) for row in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


MOVIE = {
    "id": "19995",
    "title": "Avatar",
    "budget": "237000000",
    "homepage": "http://www.example.com/",
    "original_language": "en",
    "original_title": "Avatar",
    "overview": 'In the 22nd century, a "paraplegic" Marine\nis dispatched, to a moon.',
    "popularity": "150.437577",
    "release_date": "2009-12-10",
    "revenue": "2787965087",
    "runtime": "162.0",
    "status": "Released",
    "tagline": None,
    "vote_average": "7.2",
    "vote_count": "11800",
    "genres": '[{"id": 28, "name": "Action"}, {"id": 12, "name": "Adventure"}]',
    "keywords": '[{"id": 1463, "name": "culture clash"}, {"name": "no id"}]',
    "production_companies": "[{'name': 'Dune Entertainment', 'id': 444}]",
    "production_countries": '[{"iso_3166_1": "US", "name": "United States of America"}, {"name": "?"}]',
    "spoken_languages": '[{"iso_639_1": "es", "name": "Espa\\u00f1ol"}]',
}
BROKEN = dict.fromkeys(MOVIE) | {
    "id": "7",
    "title": "Broken",
    "budget": "lots",
    "release_date": "2020-13-45",
    "revenue": "10",
    "runtime": "99999999999",
    "genres": '[{"id": 28, "na',
    "keywords": "[]",
    "production_companies": '[{"id": "abc", "name": "O\'Brien"}]',
}
CAST = (
    '[{"cast_id": 242, "character": "Jake \\"Sully\\"", "credit_id": "5602a8a7c3a3685532001c9a", '
    '"gender": 2, "id": 65731, "name": "Sam Worthington", "order": 0}, '
    '{"cast_id": 3, "character": "Neytiri", "gender": 1, "id": 8691, "name": "Zoe Saldana"}]'
)
CREW = (
    '[{"credit_id": null, "department": "Editing", "gender": 0, "id": 1721, "job": "Editor", '
    '"name": "Stephen E. Rivkin"}]'
)


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("bronze")
    for entity in ("credits", "movies"):
        (root / entity).mkdir()
    extra = ["popularity_note", *MOVIE]
    write_csv(root / "movies" / "part_001.csv", extra, [["n", *MOVIE.values()]])
    write_csv(root / "movies" / "part_002.csv", extra, [["n", *[BROKEN[k] for k in MOVIE]]])
    write_csv(
        root / "credits" / "part_001.csv",
        ["movie_id", "title", "cast", "crew"],
        [["19995", "Avatar", CAST, CREW], ["7", "Broken", None, "oops"]],
    )
    return {e: read_bronze(spark, str(root / e), e) for e in ("credits", "movies")}


@pytest.fixture(scope="module")
def silver(bronze):
    return build_silver(bronze["credits"], bronze["movies"])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bronze_is_text_and_keeps_line_breaks(bronze):
    movies = bronze["movies"]
    assert movies.columns == list(BRONZE_COLUMNS["movies"])
    assert {f.dataType for f in movies.schema} == {T.StringType()}
    avatar = movies.where("id = '19995'").first()
    assert avatar.overview == MOVIE["overview"]
    assert avatar.tagline is None


def test_missing_column_is_named(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ["movie_id", "title"], [["1", "x"]])
    with pytest.raises(ValueError, match="cast, crew"):
        read_bronze(spark, str(tmp_path), "credits")


def test_schemas(silver):
    assert tuple(silver) == ("movies", *OBJECT_TABLES)

    def named(schema):
        return [(f.name, f.dataType) for f in schema]

    assert named(silver["movies"].schema) == named(MOVIES)
    for name, spec in OBJECT_TABLES.items():
        assert named(silver[name].schema) == named(spec.schema)


def test_movies(silver):
    avatar = silver["movies"].where("movie_id = '19995'").first()
    assert avatar.runtime == 162
    assert avatar.budget == 237000000.0
    assert avatar.release_date == datetime.date(2009, 12, 10)
    assert avatar.vote_count == 11800
    broken = silver["movies"].where("movie_id = '7'").first()
    assert (broken.budget, broken.release_date, broken.runtime) == (None, None, None)
    assert broken.revenue == 10.0


def test_cast_and_crew(silver):
    assert rows(silver["cast"]) == [
        ("19995", "Avatar", "242", 'Jake "Sully"', "5602a8a7c3a3685532001c9a", "2", "65731",
         "Sam Worthington"),
        ("19995", "Avatar", "3", "Neytiri", "0000000000", "1", "8691", "Zoe Saldana"),
    ]
    assert rows(silver["crew"]) == [
        ("19995", "Avatar", "0000000000", "Editing", "0", "1721", "Editor", "Stephen E. Rivkin")
    ]


def test_movie_cells(silver):
    assert rows(silver["genres"]) == [("19995", 12, "Adventure"), ("19995", 28, "Action")]
    assert rows(silver["keywords"]) == [
        ("19995", -9999, "no id"),
        ("19995", 1463, "culture clash"),
    ]
    assert rows(silver["production_companies"]) == [
        ("19995", 444, "Dune Entertainment"),
        ("7", -9999, "O'Brien"),
    ]
    assert rows(silver["production_countries"]) == [
        ("19995", "US", "United States of America"),
        ("19995", "XX", "?"),
    ]
    assert rows(silver["spoken_languages"]) == [("19995", "es", "Español")]


def test_replace_mode_loses_cells_with_apostrophes(bronze):
    tables = build_silver(bronze["credits"], bronze["movies"], quote_mode="replace")
    assert rows(tables["production_companies"]) == [("19995", 444, "Dune Entertainment")]


def test_write_and_answer(spark, silver, tmp_path):
    report = write_silver(spark, silver, str(tmp_path))
    assert {(r.table_name, r.status) for r in report.collect()} == {
        (name, "success") for name in SILVER_TABLES
    }
    stored = {name: read_table(spark, str(tmp_path / name)) for name in SILVER_TABLES}
    got = genre_revenue(stored["movies"], stored["genres"]).collect()
    assert [tuple(r) for r in got] == [("Action", 2787965087.0, 1), ("Adventure", 2787965087.0, 1)]


def test_landed_bronze_gives_the_same_tables(bronze, silver, tmp_path):
    credits = land_bronze(bronze["credits"], str(tmp_path / "credits"))
    movies = land_bronze(bronze["movies"], str(tmp_path / "movies"))
    for name, df in build_silver(credits, movies).items():
        assert rows(df) == rows(silver[name])


def test_unknown_keep_column_fails(bronze):
    with pytest.raises(Exception, match="no_such"):
        explode_objects(bronze["movies"], "genres", {"x": "no_such"}, ["id"]).collect()


def test_targets_cover_the_silver_tables():
    assert set(TARGETS) == set(SILVER_TABLES)
    for name, target in TARGETS.items():
        assert set(target.primary_key) <= set(target.schema.names)
        assert set(target.lengths) <= set(target.schema.names)
        assert (target.foreign_key is None) == (name == "movies")
