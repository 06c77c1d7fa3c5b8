"""The five questions asked of the silver tables.

Column names are parameters, so the same plans run over any tables of that shape. Every
ranking ends in a tie-break and puts NULLs last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.operators.skew import common_type, exchanged, key_of
from silverloom.operators.substrings import texts_containing


def actor_topk(
    movies: DataFrame,
    cast: DataFrame,
    name_contains: str,
    k: int = 5,
    *,
    movie_id: str = "movie_id",
    title: str = "title",
    revenue: str = "revenue",
    name: str = "name",
    ignore_case: bool = False,
    index: DataFrame | None = None,
) -> DataFrame:
    """Highest-grossing movies of the players whose name contains a text.

    The name test reaches the scan of ``cast``, the few rows left are joined to the movies,
    and the ranking keeps ``k`` rows per task. With a stored ``index`` of the names
    (:func:`silverloom.operators.substring_index`, made with the same ``ignore_case``) the names
    are looked up there and no name of ``cast`` is searched.
    """
    if index is not None:
        names = texts_containing(index, name_contains, ignore_case)
        same = exchanged([key_of(cast, name, "__c")], [key_of(names, "text", "__n")])
        players = cast.alias("__c").join(names.alias("__n"), same, "left_semi")
    elif ignore_case:
        players = cast.where(F.lower(F.col(name)).contains(name_contains.lower()))
    else:
        players = cast.where(F.col(name).contains(name_contains))
    players = players.select(movie_id, F.col(name).alias("name"))
    films = movies.select(movie_id, F.col(title).alias("title"), F.col(revenue).alias("revenue"))
    return (
        films.join(players, movie_id)
        .select("title", "revenue", "name", movie_id)
        .orderBy(F.desc_nulls_last("revenue"), F.asc("title"), F.asc("name"), F.asc(movie_id))
        .limit(k)
        .select("title", "revenue", "name")
    )


def genre_revenue(
    movies: DataFrame,
    genres: DataFrame,
    k: int = 10,
    *,
    movie_id: str = "movie_id",
    revenue: str = "revenue",
    name: str = "name",
) -> DataFrame:
    """Mean revenue and number of movies per genre, for movies that earned something.

    The scans are joined as they are and the pairs are summed where they arise, before the
    shuffle by genre. Both sides have an exchange of their own, so a hot key can be split.
    ``movie_id`` is the key of the movies; a key that both sides repeat counts once for each
    pair, as in SQL. Keys may differ in type as far as they widen.
    """
    earned = movies.where(F.col(revenue) > 0).select(movie_id, F.col(revenue).alias("revenue"))
    tagged = genres.select(movie_id, F.col(name).alias("genre"))
    to = common_type(earned.schema[movie_id].dataType, tagged.schema[movie_id].dataType)
    earned, tagged = (df.withColumn(movie_id, F.col(movie_id).cast(to)) for df in (earned, tagged))
    return (
        earned.join(tagged, movie_id)
        .groupBy("genre")
        .agg(F.avg("revenue").alias("avg_revenue"), F.count(F.lit(1)).alias("movie_count"))
        .orderBy(F.desc_nulls_last("avg_revenue"), F.asc("genre"))
        .limit(k)
    )


def year_revenue(
    movies: DataFrame,
    k: int = 20,
    *,
    released: str = "release_date",
    revenue: str = "revenue",
) -> DataFrame:
    """Mean revenue and number of movies per release year, latest years first."""
    return (
        movies.where((F.col(revenue) > 0) & F.col(released).isNotNull())
        .groupBy(F.year(released).cast("int").alias("year"))
        .agg(F.avg(revenue).alias("avg_revenue"), F.count(F.lit(1)).alias("movie_count"))
        .orderBy(F.desc_nulls_last("year"))
        .limit(k)
    )


def team_consistency(
    crew: DataFrame,
    is_lead: Column,
    k: int = 10,
    *,
    movie_id: str = "movie_id",
    name: str = "name",
    min_movies: int = 2,
) -> DataFrame:
    """Per lead (say, director): movies led, distinct crew names in them, crew positions.

    The answer of the self-join of lead rows with all crew rows of the same movie, where a
    position counts once per lead row; NULL leads are one lead, NULL names no members. A movie
    of L lead rows and R rows would give L * R pairs. Positions are a sum over (lead, movie).
    Distinct names are the union of sets, one per movie: below ``_LARGE`` rows a movie is one
    row with its names, from which its pairs are made; above that its names are numbered and
    become bitmaps, see :func:`_large_members`. ``crew`` is read several times: store it first if
    it is costly to make.
    """
    rows = crew.where(F.col(movie_id).isNotNull()).select(
        F.col(movie_id).alias("movie"), F.col(name).alias("name"), is_lead.alias("is_lead")
    )
    large = (
        rows.groupBy("movie")
        .agg(F.count(F.lit(1)).alias("rows"), F.count("name").alias("positions"))
        .where(F.col("rows") >= _LARGE)
        .select("movie", "positions")
    )
    by_movie = _on(rows, large, "movie")

    lead = F.when(F.col("is_lead"), F.struct("name"))  # a NULL name leads, no row does not
    teams = (
        rows.alias("a")
        .join(large.alias("b"), by_movie, "left_anti")
        .groupBy("movie")
        .agg(F.collect_list(lead).alias("leads"), F.collect_list("name").alias("names"))
        .select("leads.name", F.explode(F.array_distinct("leads.name")).alias("lead"), "names")
    )
    times = F.size(F.filter("name", lambda x: x.eqNullSafe(F.col("lead"))))
    one = F.lit(1).cast("bigint").alias("movies")
    small_led = teams.select("lead", one, (times * F.size("names")).cast("bigint").alias("positions"))
    pairs = teams.select("lead", F.explode(F.array_distinct("names")).alias("name"))

    crowded = rows.alias("a").join(large.alias("b"), by_movie).select("a.*", "positions")
    large_led = (
        crowded.where("is_lead")
        .groupBy("movie", F.col("name").alias("lead"))
        .agg((F.count(F.lit(1)) * F.max("positions")).alias("positions"))
    )
    credits = (
        crowded.where(F.col("name").isNotNull()).groupBy("movie", "name").agg(F.max("positions").alias("positions"))
    )
    members = _large_members(pairs, large_led, credits)
    led = small_led.unionByName(large_led.select("lead", one, "positions"))
    zero = F.lit(0).cast("bigint")
    return (
        led.select("*", zero.alias("members"))
        .unionByName(members.select("lead", zero.alias("movies"), zero.alias("positions"), "members"))
        .groupBy("lead")
        .agg(
            F.sum("movies").alias("movie_count"),
            F.sum("members").alias("unique_crew_members"),
            F.sum("positions").alias("total_crew_positions"),
        )
        .where(F.col("movie_count") >= min_movies)
        .orderBy(F.desc("movie_count"), F.asc_nulls_last("lead"))
        .limit(k)
    )


#: Rows from which a movie is large; bits of one of Spark's bitmaps; names of a movie in a cell
#: from which a bitmap, which leads may share, is worth its pairs.
_LARGE, _BITS, _DENSE = 256, 32_768, 64


def _on(left: DataFrame, right: DataFrame, *columns: str, null_safe: bool = False) -> Column:
    """Equality of columns of two frames named ``a`` and ``b``, open to skew splitting."""
    ours, theirs = ([key_of(df, c, x) for c in columns] for df, x in ((left, "a"), (right, "b")))
    return exchanged(ours, theirs, null_safe)


def _large_members(pairs: DataFrame, led: DataFrame, credits: DataFrame) -> DataFrame:
    """``lead, members``, to be summed: ``pairs`` of small movies united with large movies' names.

    A name's home is the largest of its movies; the names of a home are cut into cells of at most
    ``_BITS``, as few as they need, so that the names of a large movie share few cells. Where a
    movie has ``_DENSE`` names of a cell, they are one bitmap; its other names are loose. Leads with
    the same set of large movies share the union of its bitmaps and its loose names whose bit is not
    set there; both are counted once per set, so no lead meets a bitmap or a name of a large movie.
    A lead's pairs of small movies count unless the union of its set has the name. The windows see
    one cell at a time.
    """
    homes = credits.groupBy("name").agg(F.max(F.struct("positions", "movie"))["movie"].alias("home"))
    sizes = homes.groupBy("home").agg(F.count(F.lit(1)).alias("size"))
    part = F.pmod(F.xxhash64("name"), F.ceil(F.col("size") / _BITS))
    in_part = Window.partitionBy("home", "part").orderBy("name")
    numbers = (
        homes.alias("a")
        .join(sizes.alias("b"), _on(homes, sizes, "home"))
        .select("name", "a.home", part.alias("part"))
        .withColumn("place", F.row_number().over(in_part) - 1)
        .select(
            "name",
            "home",
            (F.col("part") * _BITS + F.floor(F.col("place") / _BITS)).alias("cell"),
            (F.col("place") % _BITS).alias("bit"),
        )
    )
    in_cell = Window.partitionBy("home", "cell", "movie")
    bits = (
        credits.alias("a")
        .join(numbers.alias("b"), _on(credits, numbers, "name"))
        .select("movie", "b.*")
        .withColumn("names", F.count(F.lit(1)).over(in_cell))
    )
    thin = bits.where(F.col("names") < _DENSE).select("movie", "name", "home", "cell", "bit")
    dense = (
        bits.where(F.col("names") >= _DENSE)
        .groupBy("movie", "home", "cell")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )
    choices = led.groupBy("lead").agg(F.sort_array(F.collect_set("movie")).alias("movies"))
    sets = choices.select("movies").distinct().select("movies", F.explode("movies").alias("movie"))
    united = (
        sets.join(dense, "movie")
        .groupBy("movies", "home", "cell")
        .agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    )
    octet = F.conv(F.hex(F.substring("bitmap", F.expr("int(bit div 8) + 1"), F.lit(1))), 16, 10).cast("int")
    is_set = octet.bitwiseAND(F.expr("shiftleft(1, int(bit % 8))")) != 0
    loose = (
        sets.alias("a").join(thin.alias("b"), _on(sets, thin, "movie")).select("movies", "name", "home", "cell", "bit")
    ).distinct()
    loose = (
        loose.alias("a")
        .join(united.alias("b"), _on(loose, united, "movies", "home", "cell"), "left")
        .where(F.col("bitmap").isNull() | ~is_set)
        .select("a.movies", "a.name")
    )

    count = lambda n: F.lit(n).cast("bigint").alias("members")
    of_set = (
        united.select("movies", F.bitmap_count("bitmap").alias("members"))
        .unionByName(loose.select("movies", count(1)))
        .groupBy("movies")
        .agg(F.sum("members").alias("members"))
    )
    shared = choices.alias("a").join(of_set.alias("b"), _on(choices, of_set, "movies")).select("lead", "members")

    pairs = pairs.distinct()
    numbered = (
        pairs.alias("a")
        .join(choices.alias("b"), _on(pairs, choices, "lead", null_safe=True))
        .select("a.lead", "name", "movies")
    )
    told = numbered.alias("a").join(loose.alias("b"), _on(numbered, loose, "movies", "name")).select("lead")
    numbered = (
        numbered.alias("a")
        .join(numbers.alias("b"), _on(numbered, numbers, "name"))
        .select("lead", "movies", "home", "cell", "bit")
    )
    again = (
        numbered.alias("a")
        .join(united.alias("b"), _on(numbered, united, "movies", "home", "cell"))
        .where(is_set)
        .select("lead")
    )
    return (
        pairs.select("lead", count(1))
        .unionByName(again.union(told).select("lead", count(-1)))
        .unionByName(shared)
    )


def career_history(
    crew: DataFrame,
    movies: DataFrame,
    person: str,
    *,
    movie_id: str = "movie_id",
    name: str = "name",
    role: str = "job",
    title: str = "title",
    released: str = "release_date",
) -> DataFrame:
    """Movies and roles of one crew member over time."""
    films = movies.select(
        movie_id, F.col(title).alias("title"), F.col(released).alias("release_date")
    )
    return (
        crew.where(F.col(name) == person)
        .select(movie_id, F.col(name).alias("name"), F.col(role).alias("role"))
        .join(films, movie_id)
        .select("name", "release_date", "title", "role")
        .orderBy(F.asc_nulls_last("release_date"), "title", "role")
    )
