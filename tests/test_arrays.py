"""JSON array files in many splits against the standard library's parser."""

import json
import random

import pytest
from pyspark.sql import types as T

from hemeroteca.sources import arrays, readers, writers

INNER = T.StructType([T.StructField("a", T.ArrayType(T.StringType())), T.StructField("b", T.MapType(T.StringType(), T.LongType()))])
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType()), T.StructField("inner", INNER)])


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def records(seed, n):
    rnd = random.Random(seed)
    text = ['"', "\\", "}", "{", "[", "]", ",", "a", "é", "\n", "\\\\", '\\"', "},{", "\U0001f600", " "]
    word = lambda: "".join(rnd.choice(text) for _ in range(rnd.randrange(12)))
    return [
        {"id": i, "s": word() * rnd.choice([1, 1, 1, 30]), "inner": {"a": [word() for _ in range(rnd.randrange(4))], "b": {word(): 1 for _ in range(rnd.randrange(3))}}}
        for i in range(n)
    ]


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize("form", [{}, {"indent": 2}, {"ensure_ascii": False}, {"separators": (",", ":")}])
def test_records_and_places(spark, tmp_path, small_splits, form):
    made = {f"f{k}.json": records(k, n) for k, n in enumerate((30, 1, 0, 9))}
    for name, rows in made.items():
        folder = write(tmp_path / "in", name, json.dumps(rows, **form))
    chunks = arrays._chunks(spark, folder)
    assert chunks.select("file", "start").distinct().count() > 30
    got = readers.read_json_array(spark, folder, SCHEMA).collect()
    assert sorted((r.file.split("/")[-1], r.idx, r.id, r.s) for r in got) == sorted(
        (name, i, r["id"], r["s"]) for name, rows in made.items() for i, r in enumerate(rows)
    )
    assert {(r.id, tuple(r.inner.a), frozenset(r.inner.b.items())) for r in got if r.file.endswith("f0.json")} == {
        (r["id"], tuple(r["inner"]["a"]), frozenset(r["inner"]["b"].items())) for r in made["f0.json"]
    }


FAULTS = [
    "", " ", "[", '[{"id": 1}', '[{"id": 1}, ', '[{"id": 1', '[{"id": 1}]]', '[{"id": 1}]}', '[{"id": 1} {"id": 2}]', '{"id": 1}', '[1, {"id": 2}]',
    '[{"id": 1}, "x"]', '[{"id": 1}, {"id": 2]', '[{"s": "open}]', '[{"id": 1}], {"id": 2}', "[,]", '[{"id": 1},]', "x[]", '[{"id": 1}][{"id": 2}]',
]


def test_files_that_are_no_arrays(spark, tmp_path):
    for k, text in enumerate(FAULTS):
        folder = write(tmp_path / "in", f"bad{k:02d}.json", text)
    write(tmp_path / "in", "good.json", ' \n[ {"id": 7} , {"id": 8}\n]\n')
    write(tmp_path / "in", "none.json", "[ ]")
    rows, rejects = readers.split_json_arrays(spark, folder, SCHEMA)
    assert sorted((r.idx, r.id) for r in rows.collect()) == [(0, 7), (1, 8)]
    told = rejects.collect()
    assert sorted(r.file.split("/")[-1] for r in told) == [f"bad{k:02d}.json" for k in range(len(FAULTS))]
    assert all(r.idx is None and r.text for r in told)
    for k in range(len(FAULTS)):
        with pytest.raises(Exception, match="not an array of records"):
            readers.read_json_array(spark, f"{folder}/bad{k:02d}.json", SCHEMA).collect()


def test_records_of_the_wrong_type(spark, tmp_path):
    folder = write(tmp_path / "in", "a.json", '[{"id":1},{"id":"bad","s":"y"},{"id":3, "s": 4, "more": {}},{"id" 5}]')
    rows, rejects = readers.split_json_arrays(spark, folder, SCHEMA)
    assert sorted((r.idx, r.id, r.s) for r in rows.collect()) == [(0, 1, None), (2, 3, "4")]
    assert sorted((r.idx, r.text) for r in rejects.collect()) == [(1, '{"id":"bad","s":"y"}'), (3, '{"id" 5}')]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_json_array(spark, folder, SCHEMA).collect()


def test_a_folder_is_read_strictly(spark, tmp_path):
    folder = write(tmp_path / "in", "a.json", '[{"id": 1}, {"id": 2}]')
    write(tmp_path / "in", "checkpoint_b.json", '[{"id"')
    assert sorted(r.id for r in readers.read_json_folder(spark, folder, SCHEMA).collect()) == [1, 2]
    write(tmp_path / "cut", "a.json", '[{"id": 1}, {"id": ')
    with pytest.raises(Exception, match="MALFORMED_RECORD|parse"):
        readers.read_json_folder(spark, str(tmp_path / "cut"), SCHEMA).collect()
    write(tmp_path / "lines", "a.json", '{"id": 1}\n{"id": 2}\n')
    with pytest.raises(Exception, match="multi_line=False"):
        readers.read_json_folder(spark, str(tmp_path / "lines"), SCHEMA).collect()
    assert readers.read_json_folder(spark, str(tmp_path / "lines"), SCHEMA, multi_line=False).count() == 2
    write(tmp_path / "badlines", "a.json", '{"id": 1}\n{"id": "x"}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_json_folder(spark, str(tmp_path / "badlines"), SCHEMA, multi_line=False).collect()


def test_an_array_is_written_as_one_file(spark, tmp_path):
    rows = [(i, f'quo"te {i}\n}}', None if i % 3 else ["x", None]) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, s string, l array<string>").repartition(7)
    path = str(tmp_path / "all.json")
    writers.write_json_array(df, path, "id")
    text = (tmp_path / "all.json").read_text(encoding="utf-8")
    assert json.loads(text) == [{"id": i, "s": s, "l": v} for i, s, v in rows]
    assert sorted(readers.read_json_array(spark, path, df.schema).select("idx", "id").collect()) == [(i, i) for i in range(500)]
    with pytest.raises(FileExistsError):
        writers.write_json_array(df, path, "id")
    writers.write_json_array(df.where("id < 1"), f"{path}.one", "id")
    assert json.loads((tmp_path / "all.json.one").read_text()) == [{"id": 0, "s": rows[0][1], "l": ["x", None]}]
    writers.write_json_array(df.where("id < 0"), f"{path}.none", "id")
    assert json.loads((tmp_path / "all.json.none").read_text()) == []
    twice = df.where("id = 4").union(df.where("id = 4"))
    writers.write_json_array(twice, f"{path}.twice", "id")
    assert [r["id"] for r in json.loads((tmp_path / "all.json.twice").read_text())] == [4, 4]
