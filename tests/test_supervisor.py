import threading

import pytest
from pyspark.sql import functions as F

from clicklens.session import shared_dir
from clicklens.streaming import AdJobs, JobFailed, Supervisor
from clicklens.sources import read_lines

DAY = 1553040000000  # 2019-03-20 00:00 UTC


@pytest.fixture
def place(spark):
    root = shared_dir(spark, "supervised")
    for part in range(4):
        spark.range(100).select(
            F.format_string(f"{DAY},n,c,u%d,1", F.col("id") % 7).alias("value")
        ).coalesce(1).write.mode("append").text(f"{root}/lines")
    return root


def lines_of(spark, place):
    return read_lines(spark, "text", path=f"{place}/lines", maxFilesPerTrigger="1")


def counting(spark, place, name, fail=lambda batch_id: False, trigger=None):
    """A query that stores each batch's number of rows; ``fail`` makes a batch fail."""

    def store(batch, batch_id):
        if fail(batch_id):
            raise ValueError("planted")
        batch.agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{place}/{name}/b={batch_id}")

    return (
        lines_of(spark, place).writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{place}/{name}-checkpoint")
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def total(spark, place, name):
    return spark.read.parquet(f"{place}/{name}").agg(F.sum("n")).first()[0]


def test_a_failing_batch_ends_in_the_right_totals(spark, place):
    left = [1]

    def fail(batch_id):
        return batch_id == 2 and bool(left) and left.pop()

    supervisor = Supervisor(spark, lambda: {
        "a": counting(spark, place, "a", fail), "b": counting(spark, place, "b")}, pause=0.1)
    report = supervisor.run(120)
    assert (total(spark, place, "a"), total(spark, place, "b")) == (400, 400)
    assert report.restarts == 1 and [f.query for f in report.failures] == ["a"]
    assert "planted" in report.failures[0].reason
    assert not spark.streams.active


def test_failures_are_bounded_and_stop_the_others(spark, place):
    started = []

    def start():
        endless = counting(spark, place, "b", trigger={"processingTime": "1 second"})
        started.append(endless)
        return {"a": counting(spark, place, "a", lambda batch_id: True), "b": endless}

    with pytest.raises(JobFailed) as failed:
        Supervisor(spark, start, max_restarts=2, pause=0.1).run(120)
    assert failed.value.report.restarts == 2 and len(failed.value.report.failures) == 3
    assert len(started) == 3 and not any(query.isActive for query in started)


def test_queries_that_cannot_start_leave_none_behind(spark, place):
    def start():
        counting(spark, place, "b", trigger={"processingTime": "1 second"})
        raise ValueError("no broker")

    with pytest.raises(JobFailed, match="no broker"):
        Supervisor(spark, start, max_restarts=1, pause=0.1).run(60)
    assert not spark.streams.active


def test_progress_is_reported_and_stop_ends_the_run(spark, place):
    supervisor = Supervisor(spark, lambda: {
        "a": counting(spark, place, "a", trigger={"processingTime": "200 milliseconds"})})
    thread = threading.Thread(target=supervisor.run, args=(120,))
    thread.start()
    for _ in range(600):
        if supervisor.report.progress.get("a") and supervisor.report.progress["a"].rows == 400:
            break
        thread.join(0.1)
    supervisor.stop()
    thread.join(60)
    assert not thread.is_alive() and not spark.streams.active
    progress = supervisor.report.progress["a"]
    assert progress.rows == 400 and progress.batches >= 4 and progress.rows_per_second >= 0


def test_the_jobs_go_on_after_a_failed_batch(spark, place, monkeypatch):
    jobs, left = AdJobs(spark, f"{place}/jobs"), [1]
    put = jobs.city_counts._table.put

    def put_or_fail(rows, batch_id):
        if left and batch_id == 1:
            left.pop()
            raise ValueError("planted")
        put(rows, batch_id)

    monkeypatch.setattr(jobs.city_counts._table, "put", put_or_fail)
    supervisor = jobs.supervisor(lines_of(spark, place), "1 second", pause=0.1)
    thread = threading.Thread(target=supervisor.run, args=(150,))
    thread.start()

    def counted():
        try:
            return jobs.city_counts.read().agg(F.sum("clicks")).first()[0]
        except Exception:  # the table may be read while it is written first
            return None

    for _ in range(100):
        if counted() == 400 or not thread.is_alive():
            break
        thread.join(1)
    supervisor.stop()
    thread.join(60)
    assert not left and counted() == 400
    assert supervisor.report.restarts == 1 and supervisor.report.failures[0].query == "city"
