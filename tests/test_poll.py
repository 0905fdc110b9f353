"""A folder whose files are seen while they are written."""

import datetime
import json
import time

from pyspark.sql import Row
from pyspark.sql import types as T

from hemeroteca.sources import readers
from hemeroteca.streaming import harvest, poll

SCHEMA = T.StructType([T.StructField("id", T.LongType())])


def test_ticks(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    text = json.dumps([{"id": i} for i in range(50)])

    def tick(n):
        poll.look(spark, str(folder), SCHEMA, out, n)
        return sorted((r.file.split("/")[-1], r.state, r.n) if r.file else (None, r.state, r.n) for r in poll.states(spark, out).where(f"tick = {n}").collect())

    assert tick(0) == [(None, "waiting", None)]
    folder.mkdir()
    assert tick(1) == []
    (folder / "a.json").write_text(text[:200])
    (folder / "b.json").write_text("[]")
    assert tick(2) == [("a.json", "growing", None), ("b.json", "growing", None)]
    (folder / "a.json").write_text(text[:300])
    assert tick(3) == [("a.json", "growing", None), ("b.json", "read", 0)]
    assert tick(4)[0] == ("a.json", "half written", None)
    assert tick(4)[0] == ("a.json", "half written", None)  # repeated
    (folder / "a.json").write_text(text)
    assert tick(5)[0] == ("a.json", "growing", None)
    assert tick(6)[0] == ("a.json", "read", 50)
    assert tick(7)[0] == ("a.json", "taken", None)
    (folder / "a.json").write_text('[{"id": 7}]')
    assert tick(8)[0][1] == "growing" and tick(9)[0] == ("a.json", "read", 1)
    assert [r.id for r in poll.records(spark, out, SCHEMA).collect()] == [7]


def test_first_rows_replaced_by_earlier_ones_and_forgotten(spark, tmp_path):
    folder, out, state = (str(tmp_path / k) for k in ("in", "out", "state"))
    schema = "url string, page int, pos int, scraped_at timestamp, n int"

    def arrive(rows):
        made = [(u, p, q, day, n) for u, p, q, day, n in rows]
        df = spark.createDataFrame(made, "url string, page int, pos int, day int, n int").repartition(1)
        df.selectExpr("url", "page", "pos", "timestamp_seconds(day * 86400L) AS scraped_at", "n").write.mode("append").parquet(folder)
        read = spark.readStream.schema(schema).parquet(folder)
        harvest.run_to_end(harvest.first_row_stream(read, out, state, every=None, horizon_days=30))
        return sorted((r.url, r.page, r.pos, r.n) for r in harvest.first_rows(spark, out).collect())

    assert arrive([("a", 5, 1, 100, 0), ("a", 4, 9, 100, 1), ("b", 1, 1, 100, 2), (None, 1, 1, 100, 3), ("c", None, 1, 100, 4)]) == [("a", 4, 9, 1), ("b", 1, 1, 2)]
    assert arrive([("a", 4, 10, 101, 5), ("a", 2, 3, 101, 6), ("b", 1, 1, 101, 7)]) == [("a", 2, 3, 6), ("b", 1, 1, 2)]
    assert arrive([("a", 1, 1, 102, 8), ("d", 9, 9, 500, 9)])[0] == ("a", 1, 1, 8)
    # 30 days behind day 500, the places of a and b are forgotten: a later row of theirs passes again.
    again = arrive([("b", 3, 3, 500, 10)])
    assert ("b", 3, 3, 10) in again and ("b", 1, 1, 2) in again
    assert not readers.exists(spark, f"{out}/none")


def test_first_rows_of_many_urls_cost_no_frames():
    class Handle:
        def __init__(self):
            self.state, self.timers = None, []
            self.exists, self.get = lambda: self.state is not None, lambda: self.state
            self.registerTimer, self.deleteTimer = self.timers.append, self.timers.remove

        def getValueState(self, name, schema):  # noqa: N802
            return self

        def update(self, value):
            self.state = value

    def at(day):
        return datetime.datetime(1970, 1, 1 + day, tzinfo=datetime.UTC)

    def look(keeper, *rows):
        found = keeper.handleInputRows(("a",), (Row(url="a", page=p, pos=q, scraped_at=t, n=n) for p, q, t, n in rows), None)
        return [(r.n, r.replaced_page, r.replaced_pos) for r in found]

    day = 86_400_000
    keeper, handle = harvest.LeastRow(("page", "pos"), "scraped_at", 30 * day), Handle()
    keeper.init(handle)
    assert look(keeper, (5, 1, at(1), 0), (4, 9, at(2), 1), (4, 9, at(3), 2)) == [(1, None, None)], "the first of a tie"
    assert look(keeper, (4, 9, at(3), 3)) == [] and handle.timers == [32 * day]
    assert look(keeper, (2, 7, at(4).replace(tzinfo=None), 4)) == [(4, 4, 9)] and handle.timers == [34 * day]
    began = time.process_time()
    for n in range(10_000):
        handle.state = None
        look(keeper, (n, 1, at(1), n))
    assert time.process_time() - began < 1
