import json

import pytest
from pyspark.sql import functions as F

from clicklens.plans import ad_clicks_per_area_city, ad_totals_per_area, area_top_ads
from clicklens.session import shared_dir
from clicklens.sinks import SharedFolder
from clicklens.sources import parse_clicks, read_lines
from clicklens.streaming import AdJobs, CityCounts, StateOptions
from clicklens.streaming.retention import committed
from clicklens.streaming.running import running_counts

DAY = 1553040000000  # 2019-03-20 00:00 UTC
NEXT = DAY + 86400000


def line(user, ad="1", ts=DAY, area="n", city="c"):
    return f"{ts},{area},{city},{user},{ad}"


class Stream:
    """Lines that arrive batch by batch, and the jobs that work on them."""

    def __init__(self, spark, threshold):
        self.spark = spark
        self.place = shared_dir(spark, "stream")
        self.threshold = threshold
        self.jobs = self.new_jobs()

    def new_jobs(self):
        return AdJobs(self.spark, f"{self.place}/jobs", self.threshold)

    def arrive(self, *lines):
        frame = self.spark.createDataFrame([(text,) for text in lines], "value string")
        frame.coalesce(1).write.mode("append").text(f"{self.place}/lines")

    def lines(self, **options):
        return read_lines(self.spark, "text", path=f"{self.place}/lines", **options)

    def run(self, *lines, counters=True):
        self.arrive(*lines)
        self.jobs.run_available(self.lines(), counters)

    def clean_users(self):
        return sorted(row.user_id for row in self.jobs.guard.clean_clicks().collect())

    def listed(self):
        return sorted(row.user_id for row in self.jobs.guard.listed().collect())


@pytest.fixture
def stream(spark):
    return lambda threshold=10000: Stream(spark, threshold)


def test_listed_users_are_dropped_from_the_next_batch_on(stream):
    s = stream(3)
    s.run(*[line("u")] * 4, "no click", counters=False)
    assert s.clean_users() == ["u"] * 4 and s.listed() == ["u"]
    s.run(line("u"), line("v"), counters=False)
    assert s.clean_users() == ["u"] * 4 + ["v"] and s.listed() == ["u"]
    counts = {row.user_id: row.clicks for row in s.jobs.guard.user_clicks().collect()}
    assert counts == {"u": 4, "v": 1}
    assert [row.value for row in s.jobs.guard.rejected().collect()] == ["no click"]


def test_counts_go_on_over_batches_and_restarts(stream):
    s = stream(3)
    s.run(line("u"), line("v"), line("w", ts=DAY), line("w", ts=NEXT), counters=False)
    assert s.listed() == [] and s.jobs.guard.rejected().count() == 0
    s.jobs = s.new_jobs()
    s.run(line("u"), line("u"), line("v", ad="2"), line("v", ad="2"),
          line("w", ts=DAY), line("w", ts=NEXT), counters=False)
    # u: three clicks on one ad on one day; v: on two ads; w: on two days.
    assert s.listed() == ["u"]
    s.jobs = s.new_jobs()
    s.run(line("u"), line("v"), counters=False)
    assert s.clean_users() == ["u"] * 3 + ["v"] * 4 + ["w"] * 4
    # The third click of v on ad 1 is only the second one.
    assert s.listed() == ["u"]


def test_one_file_per_batch_gives_the_same_as_single_runs(stream):
    s = stream(2)
    for user in ("a", "b", "a"):
        s.arrive(line(user), line(user))
    growth = s.jobs.guard.start_growth()
    s.jobs.guard.start_filter(
        s.lines(maxFilesPerTrigger="1"), growth, availableNow=True).awaitTermination()
    growth.processAllAvailable()
    growth.stop()
    assert s.listed() == ["a", "b"]
    assert s.clean_users() == ["a", "a", "b", "b"]


def test_counters_equal_the_batch_answer(stream, rows):
    s = stream()
    first = [line(f"u{i % 7}", ad=str(i % 5), ts=DAY + i, area="ns"[i % 2], city="cd"[i % 3 % 2])
             for i in range(60)]
    late = [line("u1", ad="4", ts=DAY, area="n")] * 9 + [line("u2", ad="9", ts=NEXT, area="s")] * 2
    for lines in (first, late, [line("u3", ad="4", ts=DAY, area="n")]):
        s.run(*lines)
        clean = s.jobs.guard.clean_clicks()
        per_city = ad_clicks_per_area_city(clean)
        top = area_top_ads(ad_totals_per_area(per_city))
        assert rows(s.jobs.city_counts.read()) == rows(per_city)
        assert rows(s.jobs.area_top.read()) == rows(top.select("day", "area", "top3_json"))
    assert clean.count() == 72
    north = s.jobs.area_top.read().where("day = '2019-03-20' AND area = 'n'").first()
    assert list(json.loads(north.top3_json)[0]) == ["4"]


def test_complete_mode_stores_every_key(stream, rows):
    s = stream()
    counts = CityCounts(s.spark, f"{s.place}/complete")
    for lines in ([line("u")] * 3, [line("v", ad="2")]):
        s.run(*lines, counters=False)
        query = counts.start(s.jobs.guard.clean_stream(), "complete", availableNow=True)
        query.awaitTermination()
    assert rows(counts.read()) == [("2019-03-20", "n", "c", "1", 3), ("2019-03-20", "n", "c", "2", 1)]
    newest = s.spark.read.parquet(f"{s.place}/complete/counts/changes/batch_id=1")
    assert newest.count() == 2


def forget_commit(spark, checkpoint, batch_id):
    """Make a query believe that it failed after storing a batch, before committing it."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{batch_id}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.delete(path, False)


def test_a_batch_run_again_changes_nothing(spark, stream, rows):
    s = stream(3)
    s.run(*[line("u")] * 2, line("v"))
    s.run(*[line("u")] * 2, line("v"))
    before = (s.clean_users(), s.listed(), rows(s.jobs.guard.user_clicks()),
              rows(s.jobs.city_counts.read()), rows(s.jobs.area_top.read()))
    jobs = f"{s.place}/jobs"
    for query in ("guard/checkpoints/filter", "guard/checkpoints/growth",
                  "city/checkpoints/counts", "area/checkpoints/top"):
        forget_commit(spark, f"{jobs}/{query}", 1)
    s.jobs = s.new_jobs()
    s.jobs.run_available(s.lines())
    assert before == (s.clean_users(), s.listed(), rows(s.jobs.guard.user_clicks()),
                      rows(s.jobs.city_counts.read()), rows(s.jobs.area_top.read()))
    # And the state went on from there: one more click counts once.
    s.run(line("v"))
    assert s.listed() == ["u", "v"]
    assert s.jobs.city_counts.read().agg(F.sum("clicks")).first()[0] == 7


def test_jobs_run_side_by_side(stream, rows):
    s = stream(3)
    s.arrive(*[line("u")] * 4)
    queries = s.jobs.start(s.lines(), interval="200 milliseconds")
    try:
        queries[1].processAllAvailable()
        s.arrive(line("u"), line("v"))
        for query in (queries[1], queries[0], queries[2], queries[3]):
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert s.listed() == ["u"] and s.clean_users() == ["u"] * 4 + ["v"]
    assert rows(s.jobs.city_counts.read()) == [("2019-03-20", "n", "c", "1", 5)]
    assert rows(s.jobs.area_top.read()) == [("2019-03-20", "n", '[{"1":5}]')]


def test_late_clicks_add_to_their_day(spark, stream):
    s = stream()
    counts = CityCounts(spark, f"{s.place}/late", StateOptions(partitions=2))
    for ts in (DAY, DAY + 5 * 86400000, DAY):
        s.run(line("u", ts=ts), counters=False)
        counts.start(s.jobs.guard.clean_stream(), availableNow=True).awaitTermination()
    by_day = {row.day: row.clicks for row in counts.read().collect()}
    assert by_day == {"2019-03-20": 2, "2019-03-25": 1}
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    plan = counts.read()._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def day_line(day, n=0, **more):
    return line("u", ts=DAY + day * 86400000 + n, **more)


class Kept:
    """Counts with a state of two days, over lines that arrive batch by batch."""

    def __init__(self, stream):
        self.s = stream()
        self.place = f"{self.s.place}/kept"
        self.open()

    def open(self):
        self.counts = CityCounts(self.s.spark, self.place, StateOptions(keep_days=2))

    def run(self):
        query = self.counts.start(parse_clicks(self.s.lines()), availableNow=True)
        query.awaitTermination()
        return query

    def arrive(self, *lines):
        self.s.arrive(*lines)
        return self.run()

    def batch_answer(self):
        lines = self.s.spark.read.text(f"{self.s.place}/lines")
        return ad_clicks_per_area_city(parse_clicks(lines))


def test_state_keeps_some_days_and_late_clicks_still_count(stream, rows):
    kept, totals = Kept(stream), []
    for day in range(8):
        # Every batch: a new day with two ads, the day before, and one that is long closed.
        query = kept.arrive(
            day_line(day), day_line(day, ad="2"), day_line(day - 1, 5), day_line(day - 6, 7),
            day_line(0, 9, city="far"))
        totals.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        dropped = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress]
        assert not any(dropped)
        assert rows(kept.counts.read()) == rows(kept.batch_answer())
    # Four days of at most four keys each: the newest, two kept, and one behind the watermark.
    assert max(totals) <= 16 and totals[-1] <= max(totals[:4])
    assert kept.counts._late.read().count() > 5


def test_late_clicks_count_once_when_batches_run_again(spark, stream, rows):
    kept = Kept(stream)
    kept.arrive(day_line(0), day_line(9))
    kept.arrive(day_line(0), day_line(1), day_line(9))
    for query in ("parting", "counts"):
        last = committed(spark, f"{kept.place}/checkpoints/{query}")
        forget_commit(spark, f"{kept.place}/checkpoints/{query}", last)
    kept.open()
    kept.run()
    assert rows(kept.counts.read()) == rows(kept.batch_answer())
    kept.arrive(day_line(0), day_line(30), "99999999999999,n,c,u,1")
    kept.arrive(day_line(30), day_line(9))
    assert rows(kept.counts.read()) == rows(kept.batch_answer())


def test_stored_clicks_go_once_all_have_read_them(spark, stream, rows):
    s = stream()
    clean = SharedFolder(spark, f"{s.place}/jobs/guard/clean")
    s.jobs.drop_clean_read()
    for batch in range(6):
        s.run(line("u"), line(f"v{batch}", ts=NEXT))
        if batch == 2:
            # One reader lags behind: what it has not read stays.
            s.run(line("u"), counters=False)
        s.jobs.drop_clean_read()
        assert len(clean.numbers()) <= 2
        s.jobs = s.new_jobs()
    forget_commit(spark, f"{s.place}/jobs/city/checkpoints/counts", 5)
    forget_commit(spark, f"{s.place}/jobs/guard/checkpoints/filter", 6)
    s.jobs = s.new_jobs()
    s.run(line("u"))
    s.jobs.drop_clean_read()
    assert s.jobs.city_counts.read().agg(F.sum("clicks")).first()[0] == 14
    counts = {(r.user_id, r.day): r.clicks for r in s.jobs.guard.user_clicks().collect()}
    assert counts["u", "2019-03-20"] == 8


def test_old_clean_clicks_can_be_dropped(stream):
    s = stream()
    s.run(line("u"))
    s.run(line("v"))
    s.jobs.guard.drop_clean_before(1)
    assert s.clean_users() == ["v"]
    s.run(line("w"))
    assert s.jobs.city_counts.read().agg(F.sum("clicks")).first()[0] == 3


def test_counts_are_combined_before_they_are_shuffled(spark, stream):
    s = stream()
    s.arrive(line("u"))
    clicks = s.jobs.guard.clean_clicks()
    plan = running_counts(clicks, ["day", "ads_id"])._jdf.queryExecution().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
