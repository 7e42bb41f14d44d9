"""The blacklist in one stateful operator: as the two queries, replayed and restarted."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clicklens.session import shared_dir
from clicklens.sources import read_lines
from clicklens.streaming import AdJobs, StatefulGuard, StateOptions
from clicklens.streaming.retention import committed
from clicklens.streaming.stateful import UserJudge
from test_streaming import DAY, NEXT, forget_commit, line


class Guarded:
    def __init__(self, spark, threshold, **state):
        self.spark, self.threshold, self.state = spark, threshold, StateOptions(2, **state)
        self.place = shared_dir(spark, "guarded")
        self.open()

    def open(self):
        self.guard = StatefulGuard(self.spark, f"{self.place}/guard", self.threshold, self.state)

    def lines(self, **options):
        return read_lines(self.spark, "text", path=f"{self.place}/lines", **options)

    def run(self, *lines):
        frame = self.spark.createDataFrame([(text,) for text in lines], "value string")
        frame.coalesce(1).write.mode("append").text(f"{self.place}/lines")
        self.guard.run_available(self.lines())

    def found(self):
        clean = sorted(row.user_id for row in self.guard.clean_clicks().collect())
        listed = sorted(row.user_id for row in self.guard.listed().collect())
        counts = {(r.user_id, r.day, r.ads_id): r.clicks for r in self.guard.user_clicks().collect()}
        return clean, listed, counts


@pytest.fixture
def guarded(spark):
    return lambda threshold=3, **state: Guarded(spark, threshold, **state)


def test_dropped_from_the_next_batch_on(guarded):
    g = guarded()
    g.run(*[line("u")] * 4, "no click", line("w", ts=DAY), line("w", ts=NEXT), line(""))
    day, other = "2019-03-20", "2019-03-21"
    counts = {("u", day, "1"): 4, ("w", day, "1"): 1, ("w", other, "1"): 1, ("", day, "1"): 1}
    assert g.found() == (["", *"uuuu", "w", "w"], ["u"], counts)
    g.open()
    g.run(line("u"), line("v"), line("w", ts=DAY), line("w", ts=NEXT))
    counts |= {("v", day, "1"): 1, ("w", day, "1"): 2, ("w", other, "1"): 2}
    assert g.found() == (["", *"uuuuv", *"wwww"], ["u"], counts)
    g.run(line("w"), "x")
    assert g.found()[1] == ["u", "w"]
    g.run(line("w"), line("u"))
    assert g.found()[0] == ["", *"uuuuv", *"wwwww"]
    assert sorted(row.value for row in g.guard.rejected().collect()) == ["no click", "x"]


def test_a_batch_run_again_changes_nothing(spark, guarded):
    g = guarded()
    g.run(*[line("u")] * 2, line("v"))
    g.run(*[line("u")] * 2, line("v"))
    before = g.found()
    forget_commit(spark, g.guard.checkpoint, committed(spark, g.guard.checkpoint))
    g.open()
    g.guard.run_available(g.lines())
    assert g.found() == before
    g.run(line("v"), line("u"))
    clean, listed, counts = g.found()
    assert listed == ["u", "v"] and counts["v", "2019-03-20", "1"] == 3
    assert clean == ["u"] * 4 + ["v"] * 3


def test_equals_the_two_queries(spark, guarded, rows):
    g = guarded(5)
    jobs = AdJobs(spark, f"{g.place}/jobs", 5, StateOptions(2))
    for batch in range(3):
        g.run(*(line(f"u{i * i % 23}", ad=str(i % 3), ts=DAY + batch * 86400000 * (i % 2) + i)
                for i in range(90)))
        jobs.filter_available(g.lines())
        assert rows(g.guard.listed()) == rows(jobs.guard.listed())
        assert rows(g.guard.clean_clicks()) == rows(jobs.guard.clean_clicks())
        assert rows(g.guard.user_clicks()) == rows(jobs.guard.user_clicks())
    assert 0 < g.guard.listed().count() < 23


def test_one_call_for_all_rows_of_a_user(spark, guarded):
    """However many Arrow batches a user's clicks take, all of the first batch pass."""
    g = guarded(3, keep_days=30)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        g.run(*[line("hot", ts=DAY + i) for i in range(25)], line("v"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    clean, listed, counts = g.found()
    assert clean == ["hot"] * 25 + ["v"] and listed == ["hot"]
    assert counts["hot", "2019-03-20", "1"] == 25
    plan = g.guard.judged(g.lines())
    assert plan.isStreaming and plan.columns[0] == "kind"
    assert g.guard.clean_clicks().agg(F.countDistinct("ts")).first()[0] == 25


class HeldState:
    """A user's state in memory, with what it is asked."""

    def __init__(self):
        self.value, self.counts, self.asked = None, {}, []

    def getValueState(self, *args):
        return self

    def getMapState(self, *args):
        return HeldCounts(self)

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value


class HeldCounts:
    def __init__(self, state):
        self.state = state

    def exists(self):
        return bool(self.state.counts)

    def getValue(self, ad):
        self.state.asked.append(ad)
        return self.state.counts.get(ad)

    def updateValue(self, ad, clicks):
        self.state.counts[ad] = clicks

    def clear(self):
        self.state.counts.clear()


def test_one_frame_for_a_user_of_few_clicks():
    """Frames and questions about state are what a user costs: one frame, no needless question."""
    def clicks(*ads):
        return pd.DataFrame({"ts": range(len(ads)), "area": "a", "city": "c", "user_id": "u",
                             "ads_id": list(ads), "day": "2019-03-20"})

    state, judge = HeldState(), UserJudge(3)
    judge.init(state)
    frames = list(judge.handleInputRows(("u",), iter([clicks("1", "2", "2")]), None))
    assert len(frames) == 1 and state.asked == []
    assert frames[0]["kind"].tolist() == ["click"] * 3 + ["count"] * 2
    assert frames[0]["clicks"].tolist() == [None, None, None, 1, 2]
    assert state.counts == {("2019-03-20", "1"): (1,), ("2019-03-20", "2"): (2,)}
    # Of many clicks the frames go on as they come.
    frames = judge.handleInputRows(("u",), iter([clicks("1"), clicks("2"), clicks("3")]), None)
    assert next(frames)["kind"].tolist() == ["click"]
    assert [frame["kind"].tolist() for frame in frames] == [
        ["click"], ["click", "count", "count", "count", "listed"]]
    assert state.value == (0,) and state.counts == {}
    assert list(judge.handleInputRows(("u",), iter([clicks("1")]), None)) == []
