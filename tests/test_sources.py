import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from silverloom.schemas import LISTING, TARGETS
from silverloom.session import scratch_path
from silverloom.sources import load, tables
from silverloom.sources import (
    concat_pages,
    failed_tables,
    literal_table,
    load_tables,
    preview,
    read_pages,
    read_table,
    sequence_table,
    sql_over_path,
    to_search_docs,
    write_json,
    write_parts,
    write_search_docs,
    write_search_index,
    write_table,
    read_bronze,
)
from silverloom.sources.bronze import CSV_OPTIONS
from silverloom.sources.jdbc import column_types, jdbc_write_options, read_jdbc
from silverloom.sources.tables import APPEND, CREATE
from silverloom.workloads import files


def test_create_append_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(sequence_table(spark, 0, 50_000), path, CREATE)
    write_table(sequence_table(spark, 50_000, 100_000), path, APPEND)
    assert read_table(spark, path).count() == 100_000
    with pytest.raises(AnalysisException):
        write_table(sequence_table(spark, 0, 1), path, CREATE)
    write_table(sequence_table(spark, 0, 3), path)
    assert read_table(spark, path).count() == 3
    assert sql_over_path(spark, "SELECT sum(id) AS s FROM {t}", t=path).first().s == 3


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = sequence_table(spark, 0, 100).withColumn("p", F.col("id") % 4)
    write_table(rows, path, partition_by=["p"])
    found = read_table(spark, path).where("p = 1")
    assert found.count() == 25
    assert "PartitionFilters: [isnotnull(p" in found._jdf.queryExecution().executedPlan().toString()


def test_literal_table_and_preview(spark):
    df = literal_table(spark, [(1, True, None)], "id bigint, flag boolean, note string")
    assert preview(df) == [{"id": 1, "flag": True, "note": None}]


def test_write_json_holds_dates(spark, tmp_path):
    write_json(spark.sql("SELECT 1 AS a, DATE'2001-02-03' AS d"), str(tmp_path / "j"))
    text = "".join(p.read_text() for p in (tmp_path / "j").glob("part-*.json"))
    assert json.loads(text) == {"a": 1, "d": "2001-02-03"}


def test_search_docs(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "movie_id int, title string")
    write_search_docs(to_search_docs(df, "movies", "movie_id"), str(tmp_path / "d"))
    lines = [
        json.loads(line)
        for p in (tmp_path / "d").glob("part-*.json")
        for line in p.read_text().splitlines()
    ]
    docs = {d["_id"]: json.loads(d["_source"]) for d in lines}
    assert docs == {"1": {"movie_id": 1, "title": "a"}, "2": {"movie_id": 2}}
    assert {d["_index"] for d in lines} == {"movies"}
    assert to_search_docs(df, "cast").where("_id IS NOT NULL").isEmpty()


def test_search_connector_is_optional(spark):
    with pytest.raises(Exception, match="org.elasticsearch.spark.sql"):
        write_search_index(spark.range(1), "movies", "id")


def test_pages_keep_order_and_cut(spark, tmp_path):
    for page in range(1, 31):
        results = [{"id": page * 100 + i, "genre_ids": [i, page], "title": f"t{i}"} for i in range(20)]
        (tmp_path / f"page{page}.json").write_text(json.dumps({"page": page, "results": results}))
    got = concat_pages(read_pages(spark, str(tmp_path)), 500).collect()
    assert [(r.page, r.pos, r.id) for r in got] == [
        (p, i, p * 100 + i) for p in range(1, 26) for i in range(20)
    ]
    assert got[21].genre_ids == [1, 2]
    assert [f for f in LISTING.names if f not in got[0].asDict()] == []


def test_write_parts_keeps_multi_line_records_whole(spark, tmp_path):
    rows = [(i, f'line "{i}"\nsecond, line') for i in range(23)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(4)
    path = str(tmp_path / "parts")
    write_parts(df, path, ["id"], 5)
    back = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    assert sorted((int(r.id), r.text) for r in back.collect()) == rows
    per_part = {r.part: r.ids for r in back.groupBy("part").agg(F.collect_list("id").alias("ids")).collect()}
    assert [len(per_part[i]) for i in range(1, 6)] == [4, 4, 4, 4, 7]
    for part in range(1, 6):
        ids = []
        for f in sorted((tmp_path / "parts" / f"part={part}").glob("*.csv")):
            one = spark.read.options(header=True, multiLine=True, escape='"').csv(str(f))
            ids += [int(r.id) for r in one.coalesce(1).collect()]
        assert ids == list(range((part - 1) * 4, (part - 1) * 4 + len(ids)))


def test_load_report(spark, tmp_path):
    targets = {n: str(tmp_path / n) for n in ("one", "empty", "absent", "late")}

    def read(name):
        if name == "absent":
            return spark.read.parquet("/no/such/path")
        if name == "late":
            return spark.range(3).selectExpr("raise_error('late') AS x")
        return spark.range(10 if name == "one" else 0)

    report = load_tables(spark, targets, read, write_table)
    found = {r.table_name: (r.status, r.row_count) for r in report.collect()}
    assert found == {
        "one": ("success", 10),
        "empty": ("success", 0),
        "absent": ("failed", None),
        "late": ("failed", None),
    }
    assert failed_tables(report) == ["absent", "late"]
    assert read_table(spark, targets["one"]).count() == 10


def test_jdbc_options():
    assert jdbc_write_options("jdbc:x:y", "t")["cascadeTruncate"] == "false"
    assert jdbc_write_options("jdbc:x:y", "t", cascade=True)["cascadeTruncate"] == "true"
    options = jdbc_write_options("jdbc:x:y", "t", {"driver": "d", "batchsize": "5"})
    assert options["truncate"] == "true"
    assert options["batchsize"] == "5"
    assert (options["url"], options["dbtable"], options["driver"]) == ("jdbc:x:y", "t", "d")


def test_jdbc_column_types():
    assert column_types(TARGETS["genres"]) == "`name` VARCHAR(100)"


def test_jdbc_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        read_jdbc(spark, "jdbc:x:y", "t", partition_column="id")


def test_targets_drop_what_the_database_lacks():
    assert "title" not in TARGETS["cast"].schema.names
    assert TARGETS["crew"].primary_key == ("credit_id",)


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def _csv(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


@pytest.mark.parametrize(
    "header", ["title,movie_id,cast,crew", "movie_id,title,cast,crew,note", "movie_id,title,cast"]
)
def test_parts_with_another_header_are_refused(spark, tmp_path, header):
    folder = tmp_path / "credits"
    _csv(folder, "part-1.csv", "movie_id,title,cast,crew\n1,a,[],[]\n")
    _csv(folder, "part-2.csv", header + "\n" + ",".join("x" for _ in header.split(",")) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_bronze(spark, str(folder), "credits").collect()


def test_part_sets_are_put_together_by_name(spark, tmp_path):
    _csv(tmp_path / "a", "p.csv", "movie_id,title,cast,crew\n1,a,c1,w1\n")
    _csv(tmp_path / "b", "p.csv", "crew,cast,title,movie_id\nw2,c2,b,2\n")
    got = read_bronze(spark, [str(tmp_path / "a"), str(tmp_path / "b")], "credits")
    found = {(r.movie_id, r.title, r["cast"], r.crew) for r in got.collect()}
    assert found == {("1", "a", "c1", "w1"), ("2", "b", "c2", "w2")}


def test_a_broken_page_fails_the_read(spark, tmp_path):
    (tmp_path / "pages.json").write_text('{"page": 1, "results": [{"id": 1}]}\n{"page": 2, "resu\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_pages(spark, str(tmp_path)).collect()


def test_a_write_without_an_action_is_a_failure(spark, monkeypatch):
    monkeypatch.setattr(load, "COUNT_WITHIN", 1)
    report = load.load_tables(spark, {"a": "b"}, lambda t: spark.range(3), lambda df, target: None)
    assert report.first().status == "failed"


def test_tables_start_after_their_parents(spark):
    parents = {"c": ("b",), "b": ("a",), "d": ("d", "elsewhere"), "f": ("e",), "g": ("f", "a")}
    finished = []

    def write(df, target):
        if target == "E":
            raise OSError("disk full")
        df.collect()
        finished.append(target)

    names = "gfcbade"
    report = load.load_tables(
        spark, {n: n.upper() for n in names}, lambda t: spark.range(ord(t)), write, parents
    ).collect()
    assert [r.table_name for r in report] == list(names)
    by_name = {r.table_name: (r.status, r.row_count, r.error) for r in report}
    assert by_name["e"] == ("failed", None, "OSError: disk full")
    assert by_name["f"] == ("skipped", None, "not loaded: e")
    assert by_name["g"] == ("skipped", None, "not loaded: f")
    assert {n: by_name[n][:2] for n in "abcd"} == {n: ("success", ord(n)) for n in "abcd"}
    assert finished.index("A") < finished.index("B") < finished.index("C")
    with pytest.raises(ValueError, match="circle: a, b"):
        load.load_tables(spark, {"a": "A", "b": "B"}, spark.table, write, {"a": ("b",), "b": ("a",)})


def test_a_written_table_whose_count_is_late_is_loaded(spark, monkeypatch):
    monkeypatch.setattr(load, "_count", lambda seen: None)
    report = load.load_tables(spark, {"a": "b"}, lambda t: spark.range(3), lambda df, t: df.collect())
    assert tuple(report.first()) == ("a", "b", "success", None, None)


def test_multi_line_csv_is_written_in_files_of_bounded_records(spark, tmp_path, monkeypatch):
    """One task reads a multi-line file whole, so its size must not follow the table's."""
    for module in (files, tables):
        monkeypatch.setattr(module, "FILE_RECORDS", 10)
    rows = spark.range(0, 35, 1, 1).select("id", F.lit('two\n"lines"').alias("note"))
    files._write_csv(rows, str(tmp_path / "csv"))
    write_parts(rows, str(tmp_path / "parts"), ["id"], 1)
    for name in ("csv", "parts"):
        found = spark.read.options(**CSV_OPTIONS).csv(str(tmp_path / name))
        records = found.groupBy(F.input_file_name()).agg(F.count(F.lit(1)), F.max("note")).collect()
        assert len(records) >= 4 and max(r[1] for r in records) <= 10
        assert {r[2] for r in records} == {'two\n"lines"'}
        assert sorted(int(r.id) for r in found.collect()) == list(range(35))
