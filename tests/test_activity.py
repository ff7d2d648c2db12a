import json
import random
from datetime import datetime, timedelta

import pytest

from dealreports.streaming import activity

DAY = datetime(2024, 3, 1)
SCHEMA = "key string, moment timestamp, amount long"


def at(minutes):
    return None if minutes is None else DAY + timedelta(minutes=minutes)


class Arrivals:
    """Files that arrive one after another, each read by a run of its own."""

    def __init__(self, spark, folder, result):
        self.spark, self.source, self.out, self.checkpoint = spark, str(folder / "in"), str(folder / "out"), str(folder / "check")
        self.result, self.late = result, 0

    def run(self, *rows):
        data = self.spark.createDataFrame([(k, at(m), a) for k, m, a in rows], SCHEMA)
        data.coalesce(1).write.mode("append").parquet(self.source)
        stream = self.spark.readStream.schema(SCHEMA).parquet(self.source)
        query = activity.write_closed(self.result(stream), self.out, self.checkpoint)
        query.awaitTermination()
        self.late += activity.too_late(query)

    def rows(self):
        written = self.spark.read.parquet(self.out).collect()
        return sorted((r["key"] or "", r["start"], r["end"], r["n"]) for r in written)


def by_hand_windows(rows, size, slide):
    out = {}
    for key, m, _ in rows:
        if m is None:
            continue
        start = m // slide * slide
        while start > m - size:
            out[key or "", start] = out.get((key or "", start), 0) + 1
            start -= slide
    return [(k, at(s), at(s + size), n) for (k, s), n in sorted(out.items())]


def by_hand_sessions(rows, gap):
    out = []
    for key, m, _ in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] or "", r[1])):
        if out and out[-1][0] == (key or "") and m <= out[-1][2] + gap:
            out[-1][2], out[-1][3] = m, out[-1][3] + 1
        else:
            out.append([key or "", m, m, 1])
    return sorted((k, at(a), at(b + gap), n) for k, a, b, n in out)


def some(n=400, seed=3):
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]), rng.choice([None, *[rng.randrange(3000)] * 30]), 1) for _ in range(n)]


def plain(df):
    return sorted((r["key"] or "", r["start"], r["end"], r["n"]) for r in df.collect())


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(k, at(m), a) for k, m, a in rows], SCHEMA)


def test_windows_of_a_table(table):
    rows = some()
    assert plain(activity.windows(table(rows), "moment", ["key"], "60 minutes", "20 minutes")) == by_hand_windows(rows, 60, 20)


def test_sessions_of_a_table(table):
    rows = some()
    assert plain(activity.sessions(table(rows).repartition(5), "moment", ["key"], "15 minutes")) == by_hand_sessions(rows, 15)
    with pytest.raises(ValueError, match="key"):
        activity.sessions(table(rows), "moment", [], "15 minutes")


def test_late_rows_count_and_too_late_rows_do_not(spark, tmp_path):
    result = lambda s: activity.windows(s, "moment", ["key"], "60 minutes", "60 minutes", "30 minutes")
    runs = Arrivals(spark, tmp_path, result)
    runs.run(("a", 10, 1), ("a", 50, 1), ("a", 80, 1))
    assert runs.rows() == []  # the watermark is at 50, before the end of the first window
    runs.run(("a", 55, 1), ("b", 59, 1), ("a", 130, 1))  # late, but in time
    assert runs.rows() == [("a", at(0), at(60), 3), ("b", at(0), at(60), 1)]
    runs.run(("a", 20, 1), ("a", 70, 1), ("a", 240, 1))  # the first of them too late
    assert runs.late == 1
    runs.run(("a", 400, 1))
    assert runs.rows() == [
        ("a", at(0), at(60), 3), ("a", at(60), at(120), 2), ("a", at(120), at(180), 1), ("a", at(240), at(300), 1), ("b", at(0), at(60), 1),
    ]


def test_a_late_row_joins_two_open_sessions(spark, tmp_path):
    runs = Arrivals(spark, tmp_path, lambda s: activity.sessions(s, "moment", ["key"], "10 minutes", "60 minutes"))
    runs.run(("a", 0, 1), ("a", 18, 1), ("b", 3, 1))
    runs.run(("a", 9, 1), ("a", 60, 1))  # 0, 9 and 18 are one session now
    runs.run(("a", 200, 1))
    assert runs.rows() == [("a", at(0), at(28), 3), ("a", at(60), at(70), 1), ("b", at(3), at(13), 1)]
    assert runs.late == 0


def test_written_windows_are_those_of_a_batch_job(spark, tmp_path):
    """Rows up to 200 minutes out of order, in eight runs: every closed window counts every row."""
    rng = random.Random(5)
    rows = sorted((r for r in some(600, 8) if r[1] is not None), key=lambda r: r[1] + rng.randrange(200))
    runs = Arrivals(spark, tmp_path, lambda s: activity.windows(s, "moment", ["key"], "60 minutes", "30 minutes", "200 minutes"))
    for i in range(0, 600, 75):
        runs.run(*rows[i : i + 75])
    mark = at(max(m for _, m, _ in rows) - 200)
    assert runs.late == 0
    assert runs.rows() == [w for w in by_hand_windows(rows, 60, 30) if w[2] <= mark]


def test_changes_of_pages(spark, tmp_path):
    """Moments that cannot be read belong to no window."""
    pages = tmp_path / "pages"
    pages.mkdir()
    times = ["2024-03-01 00:05:00", "2024-03-01 00:40:00", "2024-03-01 05:00:00", "no moment", None]
    records = [{"id": i, "team_name": "T", "updated": t} for i, t in enumerate(times, 1)]
    (pages / "1.json").write_text("\n".join(map(json.dumps, records)))
    changes = activity.page_changes(spark, str(pages))
    counts = activity.windows(changes, "moment", ["team_name"], "1 hour")
    activity.write_closed(counts, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).selectExpr("team_name", "hour(start) AS h", "n").collect()
    assert list(map(tuple, found)) == [("T", 0, 2)]
