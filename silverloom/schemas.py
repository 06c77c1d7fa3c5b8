"""Table definitions: bronze JSON cells, silver tables, load targets."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

STRING = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
FLOAT = T.FloatType()
DATE = T.DateType()
BOOLEAN = T.BooleanType()


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


@dataclass(frozen=True)
class ObjectTable:
    """A silver table with one row per object of a JSON cell.

    ``keep`` maps output names to bronze columns carried beside each object, ``fields`` lists
    the object keys in output order, ``casts`` the non-text ones, ``fills`` the sentinel that
    replaces NULL after the cast.
    """

    source: str
    cell: str
    keep: dict[str, str]
    fields: tuple[str, ...]
    casts: dict[str, T.DataType] = field(default_factory=dict)
    fills: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        columns = {name: STRING for name in self.keep}
        columns.update({name: self.casts.get(name, STRING) for name in self.fields})
        return struct(**columns)


# Names, types and sentinels of the silver layer.
NO_CREDIT_ID = "0000000000"
NO_ID = -9999
NO_CODE = "XX"

_CREDIT_KEEP = {"movie_id": "movie_id", "title": "title"}
_MOVIE_KEEP = {"movie_id": "id"}


def _id_name(cell: str) -> ObjectTable:
    return ObjectTable("movies", cell, _MOVIE_KEEP, ("id", "name"), {"id": INT}, {"id": NO_ID})


def _code_name(cell: str, code: str) -> ObjectTable:
    return ObjectTable("movies", cell, _MOVIE_KEEP, (code, "name"), fills={code: NO_CODE})


OBJECT_TABLES: dict[str, ObjectTable] = {
    "cast": ObjectTable(
        "credits",
        "cast",
        _CREDIT_KEEP,
        ("cast_id", "character", "credit_id", "gender", "id", "name"),
        fills={"credit_id": NO_CREDIT_ID},
    ),
    "crew": ObjectTable(
        "credits",
        "crew",
        _CREDIT_KEEP,
        ("credit_id", "department", "gender", "id", "job", "name"),
        fills={"credit_id": NO_CREDIT_ID},
    ),
    "genres": _id_name("genres"),
    "keywords": _id_name("keywords"),
    "production_companies": _id_name("production_companies"),
    "production_countries": _code_name("production_countries", "iso_3166_1"),
    "spoken_languages": _code_name("spoken_languages", "iso_639_1"),
}

MOVIES = struct(
    movie_id=STRING,
    title=STRING,
    budget=DOUBLE,
    homepage=STRING,
    original_language=STRING,
    original_title=STRING,
    overview=STRING,
    popularity=FLOAT,
    release_date=DATE,
    revenue=DOUBLE,
    runtime=INT,
    status=STRING,
    tagline=STRING,
    vote_average=FLOAT,
    vote_count=INT,
)

SILVER_TABLES: tuple[str, ...] = ("movies", *OBJECT_TABLES)

BRONZE_COLUMNS: dict[str, tuple[str, ...]] = {
    "credits": ("movie_id", "title", "cast", "crew"),
    "movies": tuple("id" if n == "movie_id" else n for n in MOVIES.names)
    + tuple(t.cell for t in OBJECT_TABLES.values() if t.source == "movies"),
}


@dataclass(frozen=True)
class TargetTable:
    """A relational load target: column types plus the rules a database would enforce."""

    schema: T.StructType
    primary_key: tuple[str, ...]
    foreign_key: str | None = None
    lengths: dict[str, int] = field(default_factory=dict)
    cascade: bool = True


def _child(key: tuple[str, ...], lengths: dict[str, int], **columns: T.DataType) -> TargetTable:
    return TargetTable(struct(movie_id=INT, **columns), key, "movie_id", lengths)


# Target column types, keys and VARCHAR limits.
TARGETS: dict[str, TargetTable] = {
    "movies": TargetTable(
        T.StructType([T.StructField("movie_id", INT), *MOVIES.fields[1:]]),
        ("movie_id",),
        lengths={"title": 255, "original_language": 10, "original_title": 255, "status": 50},
    ),
    "cast": _child(
        ("movie_id", "cast_id"),
        {"credit_id": 255, "name": 255},
        cast_id=INT,
        character=STRING,
        credit_id=STRING,
        gender=INT,
        id=INT,
        name=STRING,
    ),
    "crew": _child(
        ("credit_id",),
        {"credit_id": 255, "department": 100, "job": 255, "name": 255},
        credit_id=STRING,
        department=STRING,
        gender=INT,
        id=INT,
        job=STRING,
        name=STRING,
    ),
    "genres": _child(("movie_id", "id"), {"name": 100}, id=INT, name=STRING),
    "keywords": _child(("movie_id", "id"), {"name": 255}, id=INT, name=STRING),
    "production_companies": _child(("movie_id", "id"), {"name": 255}, id=INT, name=STRING),
    "production_countries": _child(
        ("movie_id", "iso_3166_1"),
        {"iso_3166_1": 10, "name": 255},
        iso_3166_1=STRING,
        name=STRING,
    ),
    "spoken_languages": _child(
        ("movie_id", "iso_639_1"),
        {"iso_639_1": 10, "name": 100},
        iso_639_1=STRING,
        name=STRING,
    ),
}

#: The tables that each target refers to.
PARENTS: dict[str, tuple[str, ...]] = {
    name: ("movies",) for name, target in TARGETS.items() if target.foreign_key is not None
}

# The stricter limits of the earlier loader, which also did not cascade deletes.
STRICT_LENGTHS: dict[str, dict[str, int]] = {
    "movies": {**TARGETS["movies"].lengths, "homepage": 255, "status": 20, "tagline": 255},
    "cast": {**TARGETS["cast"].lengths, "character": 255},
    "crew": {**TARGETS["crew"].lengths, "job": 100},
    "keywords": {"name": 100},
}

STRICT_TARGETS: dict[str, TargetTable] = {
    name: replace(target, lengths=STRICT_LENGTHS.get(name, target.lengths), cascade=False)
    for name, target in TARGETS.items()
}

# One record of a paged listing; ``id`` is the insert-if-absent key.
LISTING = T.StructType(
    [
        T.StructField("adult", BOOLEAN),
        T.StructField("backdrop_path", STRING),
        T.StructField("genre_ids", T.ArrayType(INT)),
        T.StructField("id", LONG),
        T.StructField("original_language", STRING),
        T.StructField("original_title", STRING),
        T.StructField("overview", STRING),
        T.StructField("popularity", DOUBLE),
        T.StructField("poster_path", STRING),
        T.StructField("release_date", STRING),
        T.StructField("title", STRING),
        T.StructField("video", BOOLEAN),
        T.StructField("vote_average", DOUBLE),
        T.StructField("vote_count", INT),
    ]
)
