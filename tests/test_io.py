"""Readers and writers on files with awkward content."""

import datetime
import json
import os

import pytest
from pyspark.sql import types as T

from hemeroteca import schemas
from hemeroteca.operators import cleaning, dedupe, quality
from hemeroteca.plans import workflows
from hemeroteca.session import scratch_path
from hemeroteca.sources import readers, writers

BODY = '  hi "q", \\ back\n\nx  '
RAGGED = [{"url": "u", "title": "T", "page": 1}, {"url": "v", "body": '  hi "q"\n\nx', "author": None}]


def dump(path, value):
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)
    return str(path)


def text_of(folder):
    names = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    return [open(os.path.join(folder, n), encoding="utf-8", newline="").read() for n in names]


def listing(n=3):
    when = datetime.datetime(2025, 11, 25, 9, 8)
    return [
        {"title": f"Título {i}", "url": f"u{i}", "description": "", "date": None, "search_query": "q", "page": i,
         "scraped_at": when.isoformat()}
        for i in range(n)
    ]


def test_json_array_keeps_positions(spark, tmp_path):
    dump(tmp_path / "a.json", listing(3))
    dump(tmp_path / "b.json", listing(2))
    dump(tmp_path / "c.json", [])
    got = readers.read_json_array(spark, str(tmp_path), schemas.LISTING)
    assert sorted((os.path.basename(r.file), r.idx, r.url) for r in got.collect()) == [
        ("a.json", 0, "u0"), ("a.json", 1, "u1"), ("a.json", 2, "u2"), ("b.json", 0, "u0"), ("b.json", 1, "u1"),
    ]
    assert got.first().scraped_at == datetime.datetime(2025, 11, 25, 9, 8)


def test_folder_without_checkpoints(spark, tmp_path):
    dump(tmp_path / "titulos.json", listing(2))
    dump(tmp_path / "checkpoint_x.json", listing(5))
    dump(tmp_path / "my_checkpoint.json", listing(5))
    (tmp_path / "notes.txt").write_text("x")
    assert readers.read_json_folder(spark, str(tmp_path), schemas.LISTING).count() == 2
    assert readers.read_json_folder(spark, str(tmp_path)).columns == sorted(schemas.LISTING.names)
    assert readers.read_json_folder(spark, str(tmp_path / "missing"), schemas.LISTING).count() == 0


def test_checkpoints(spark, tmp_path):
    good = dump(tmp_path / "good.json", {"page": 7, "articles": listing(3), "timestamp": "2025-11-25T09:00:00"})
    got = readers.read_checkpoint(spark, good, schemas.CHECKPOINT_LISTING)
    assert {(r.checkpoint_page, r.url) for r in got.collect()} == {(7, "u0"), (7, "u1"), (7, "u2")}
    assert readers.read_checkpoint(spark, str(tmp_path / "none.json"), schemas.CHECKPOINT_LISTING).count() == 0
    (tmp_path / "bad.json").write_text('{"page": 3, "articles": [{"tit')
    assert readers.read_checkpoint(spark, str(tmp_path / "bad.json"), schemas.CHECKPOINT_LISTING).count() == 0
    bodies = dump(tmp_path / "b.json", {"articles": [{"url": "u", "body": "b"}], "last_index": 9})
    (r,) = readers.read_checkpoint(spark, bodies, schemas.CHECKPOINT_BODIES).collect()
    assert (r.checkpoint_last_index, r.url, r.body, r.section) == (9, "u", "b", None)


def test_records_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("ñ", BODY, None), ("", "a", 1)], "t string, body string, n int")
    path = str(tmp_path / "out")
    writers.write_records(rows, path)
    lines = [json.loads(x) for t in text_of(path) for x in t.splitlines()]
    assert all(set(x) == {"t", "body", "n"} for x in lines), "missing values keep their key"
    assert any("ñ" in t for t in text_of(path))
    assert readers.read_records(spark, path, rows.schema).exceptAll(rows).count() == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        writers.write_records(rows, path)


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("ñ,", BODY, 1), ("", None, None)], "t string, body string, n int")
    path = str(tmp_path / "csv")
    writers.write_csv(rows.coalesce(1), path, ["body", "t", "n"])
    (text,) = text_of(path)
    assert text == 'body,t,n\n"  hi ""q"", \\ back\n\nx  ","ñ,",1\n,,\n'
    schema = T.StructType([rows.schema[c] for c in ("body", "t", "n")])
    got = sorted(map(tuple, readers.read_csv(spark, path, schema).collect()), key=str)
    assert got == sorted([(BODY, "ñ,", 1), (None, None, None)], key=str)


def test_json_to_csv(spark, tmp_path):
    source = dump(tmp_path / "r.json", RAGGED)
    path, records, columns = writers.json_to_csv(spark, source)
    assert (path, records, columns) == (source.replace(".json", ".csv"), 2, 5)
    assert "".join(text_of(path)) == 'author,body,page,title,url\n,,1,T,u\n,"  hi ""q""\n\nx",,,v\n'
    assert writers.json_to_csv(spark, dump(tmp_path / "empty.json", [])) is None


def test_folder_to_csv(spark, tmp_path):
    for name in ("one.json", "two.json", "checkpoint.json"):
        dump(tmp_path / name, RAGGED)
    dump(tmp_path / "zero.json", [])
    got = writers.json_folder_to_csv(spark, str(tmp_path))
    assert list(got) == ["one.json", "two.json", "zero.json"]
    assert [r and (os.path.basename(r[0]), r[1], r[2]) for r in got.values()] == [("one.csv", 2, 5), ("two.csv", 2, 5), None]
    assert not writers.write_csv(spark.createDataFrame([], "a int"), str(tmp_path / "none"), skip_empty=True)
    assert not os.path.exists(tmp_path / "none")


def test_report_only_when_there_are_issues(spark, tmp_path):
    df = spark.createDataFrame([(0, "t", "u", "presidenteJavier")], "idx long, title string, url string, body string")
    report = quality.glued_report(df)
    assert report.columns == schemas.ISSUE.names
    assert writers.write_report(report, str(tmp_path / "yes"))
    assert readers.read_records(spark, str(tmp_path / "yes"), schemas.ISSUE).first().merged_words == ["presidenteJavier"]
    assert not writers.write_report(report.where("index > 0"), str(tmp_path / "no"))
    assert not os.path.exists(tmp_path / "no")


def test_snapshots(spark, tmp_path):
    rows = spark.range(450).selectExpr("id as idx", "concat('b', id) as body")
    writers.write_snapshots(rows, str(tmp_path / "s"), 200)
    folders = sorted(n for n in os.listdir(tmp_path / "s") if n.startswith("snapshot="))
    assert folders == ["snapshot=1", "snapshot=2", "snapshot=3"]
    schema = T.StructType(list(rows.schema.fields) + [T.StructField("snapshot", T.IntegerType())])
    back = readers.read_csv(spark, str(tmp_path / "s"), schema)
    assert [(r.snapshot, r["count"]) for r in back.groupBy("snapshot").count().orderBy("snapshot").collect()] == [
        (1, 200), (2, 200), (3, 50),
    ]


def test_rewriting_makes_versions(spark, tmp_path):
    path = str(tmp_path / "articles")
    schema = "url string, date string"
    spark.createDataFrame([("/2024/01/02/", ""), ("/x/", None)], schema).write.parquet(path)
    assert writers.current_version(spark, path) == path
    targets = []
    for _ in range(2):
        stored = spark.read.parquet(writers.current_version(spark, path))
        targets.append(writers.rewrite(spark, cleaning.fill_dates(stored).drop("date_filled"), path))
        assert writers.current_version(spark, path) == targets[-1]
    assert len(set(targets)) == 2 and targets == sorted(targets)
    assert {r.date for r in spark.read.parquet(targets[-1]).collect()} == {"2024-01-02", None}
    assert {r.date for r in spark.read.parquet(path).collect()} == {"", None}
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):  # a rewrite that fails changes nothing
        writers.rewrite(spark, spark.range(3).selectExpr("1 div (id - 2) AS broken"), path)
    assert writers.current_version(spark, path) == targets[-1]


def test_finished_output_is_append_only(spark, tmp_path):
    path = str(tmp_path / "done")
    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("scraped_at", T.IntegerType())])
    work = spark.createDataFrame([(f"u{i}", i) for i in range(10)], schema)
    assert readers.read_finished(spark, path, schema).count() == 0
    for limit in (4, 10, 10):
        done = readers.read_finished(spark, path, schema)
        writers.append_finished(dedupe.resume_backlog(work.where(f"scraped_at < {limit}"), done), path)
    assert spark.read.parquet(path).count() == 10


def test_scratch_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base)


class _Session:
    """Only what ``scratch_path`` asks a session for."""

    def __init__(self, **settings):
        self.conf = settings


def test_scratch_folder_needs_the_setting_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(_Session(**{"spark.master": "local-cluster[3,2,1000]"}), "x")
    assert scratch_path(_Session(**{"spark.master": "local[2]"}), "x")
    assert scratch_path(_Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "s3://b/c/"}), "x").startswith("s3://b/c/x-")


def test_clean_and_report(spark):
    df = spark.createDataFrame(
        [
            (0, "https://h/economia/a/", "2024-01-02", "empresaPrivada"),
            (1, "https://h/politica/b/", "2023-05-06", "b"),
            (2, "https://h/deportes/c/", "2023-05-06", "c"),
            (3, "https://h/politica/d/", "", "d"),
        ],
        "idx long, url string, date string, body string",
    )
    out = workflows.clean_and_report(df)
    assert {r.idx: r.body for r in out["articles"].collect()} == {0: "empresa Privada", 1: "b", 3: "d"}
    assert [(r.section, r.n) for r in out["sections"].collect()] == [("politica", 2), ("economia", 1)]
    assert [(r.year, r.n) for r in out["years"].collect()] == [("2024", 1), ("2023", 1)]


def test_broken_input_is_an_error_unless_asked_for(spark, tmp_path):
    schema = T.StructType.fromDDL("a int, b string")
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "x.json").write_text('{"a": 1, "b": "x"}\n{"a": 2, "b": \n\n{"a": 3}\n')
    lines = str(tmp_path / "lines")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_records(spark, lines, schema).collect()
    rows, rejects = readers.split_records(spark, lines, schema)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "x"), (3, None)]
    assert [r.line for r in rejects.collect()] == ['{"a": 2, "b": ']
    (tmp_path / "arrays").mkdir()
    (tmp_path / "arrays" / "good.json").write_text('[{"a": 1, "b": "x"}]')
    (tmp_path / "arrays" / "bad.json").write_text('[{"a": 2, "b": "y"}, {"a": 3, ')
    arrays = str(tmp_path / "arrays")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.read_json_array(spark, arrays, schema).collect()
    rows, rejects = readers.split_json_arrays(spark, arrays, schema)
    assert [(r.idx, r.a) for r in rows.collect()] == [(0, 1)]
    assert [os.path.basename(r.file) for r in rejects.collect()] == ["bad.json"]
    (tmp_path / "bad.csv").write_text("a,b\n1,x\ntwo,y\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv(spark, str(tmp_path / "bad.csv"), schema).collect()


def test_lists_in_csv_read_like_published_reports(spark):
    words = [["aB", "cD"], ["it's", 'say "x"', "both ' and \""], [], None, ["a\\b\nc", None]]
    rows = spark.createDataFrame([(w, [1, 2]) for w in words], "w array<string>, n array<int>")
    got = [r[0] for r in rows.select(writers.as_csv_text("w", rows.schema["w"].dataType)).collect()]
    assert got == [None if w is None else str(w) for w in words]
    assert rows.select(writers.as_csv_text("n", rows.schema["n"].dataType)).first()[0] == "[1, 2]"


def test_a_run_with_one_url_twice_reads_back_the_same_row(spark, tmp_path):
    schema = T.StructType.fromDDL("url string, scraped_at int, body string")
    writers.append_finished(spark.createDataFrame([("u", 1, f"b{i}") for i in range(50)], schema).repartition(7), str(tmp_path / "f"))
    found = {readers.read_finished(spark, str(tmp_path / "f"), schema).repartition(n).first().body for n in range(1, 6)}
    assert len(found) == 1
