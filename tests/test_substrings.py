import pytest

from silverloom.operators import substring_index, texts_containing
from silverloom.plans import actor_topk

NAMES = [
    "Tom Hanks", "Tom Hanks", "tom tom", "Tomás", "aaaa", "aaa", "aba", "a", "100%_x", "", None,
    "日本語の名前", "😀 mot", "x" * 3000,
]


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "movie_id long, name string")


@pytest.mark.parametrize("ignore_case", [False, True])
def test_every_pattern_finds_what_contains_finds(spark, names, tmp_path, ignore_case):
    path = str(tmp_path / "index")
    substring_index(names, "name", ignore_case).write.parquet(path)
    index = spark.read.parquet(path)
    for pattern in ["a", "To", "tom", "TOM ", "m t", "aaaa", "aaaaa", "%_", "本語の名", "😀", "zzzz", "mto"]:
        low = str.lower if ignore_case else str
        want = sorted({n for n in NAMES if n and low(pattern) in low(n)})
        got = sorted(r.text for r in texts_containing(index, pattern, ignore_case).collect())
        assert got == want, pattern
    with pytest.raises(ValueError):
        texts_containing(index, "")
    assert substring_index(names.where("movie_id < 0"), "name").isEmpty()


def test_ranking_by_index_equals_ranking_by_search(spark, names):
    movies = names.selectExpr("movie_id", "concat('t', movie_id) AS title", "movie_id AS revenue")
    index = substring_index(names, "name")
    for pattern in ("om", "Tom Hanks", "aa"):
        plain = actor_topk(movies, names, pattern, 20).collect()
        assert actor_topk(movies, names, pattern, 20, index=index).collect() == plain
        assert plain
