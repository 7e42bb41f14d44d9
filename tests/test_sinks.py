from unittest.mock import MagicMock

import pytest
from pyspark.sql import types as T

from clicklens.plans import run_reports
from clicklens.plans.daily import REPORTS
from clicklens.session import shared_dir
from clicklens.sinks import (
    KeyedTable,
    SharedFolder,
    SummedTable,
    replace_jdbc_table,
    save_table,
    staged_load,
    swap_table,
    truncate_and_load,
)
from clicklens.sinks.keyed import values_of, with_values
from clicklens.sources import Condition, load_tables
from clicklens.sources.schemas import CITY_INFO, PRODUCT_INFO, USER_INFO


def frame(spark, *rows):
    return spark.createDataFrame(rows, "k string, n bigint")


def test_shared_folder_keeps_the_first_version(spark, rows):
    folder = SharedFolder(spark, shared_dir(spark, "folder"))
    folder.publish(frame(spark, ("a", 1)), 4)
    folder.publish(frame(spark, ("b", 2)), 10)
    folder.publish(frame(spark, ("c", 3)), 4)
    assert folder.numbers() == [4, 10] and folder.has(4) and not folder.has(5)
    assert rows(spark.read.parquet(folder.part(4))) == [("a", 1)]
    folder.drop(4)
    assert folder.numbers() == [10]


def test_unfinished_write_is_invisible_and_replaced(spark, rows):
    folder = SharedFolder(spark, shared_dir(spark, "folder"))
    frame(spark, ("half", 0)).write.parquet(f"{folder.path}.staging/batch_id=0")
    assert folder.numbers() == []
    folder.publish(frame(spark, ("a", 1)), 0)
    assert rows(spark.read.parquet(folder.part(0))) == [("a", 1)]


@pytest.fixture
def keyed(spark):
    schema = T.StructType().add("k", "string").add("n", "long")

    def make(path, compact_every=None):
        return KeyedTable(spark, path, schema, ["k"], compact_every)

    return make


@pytest.mark.parametrize("compact_every", [None, 1, 2, 3])
def test_newest_value_per_key(spark, rows, keyed, compact_every):
    path = shared_dir(spark, "keyed")
    table = keyed(path, compact_every=compact_every)
    assert rows(table.read()) == []
    expected = {}
    for batch_id in range(8):
        changed = {f"k{batch_id % 3}": batch_id, f"k{batch_id}": -batch_id}
        expected.update(changed)
        table.put(frame(spark, *changed.items()), batch_id)
        # A batch that is run again is not stored again.
        table.put(frame(spark, ("k0", 99)), batch_id)
        assert rows(table.read()) == sorted(expected.items())
    assert rows(keyed(path).read()) == sorted(expected.items())


def test_compaction_drops_what_is_folded(spark, rows, keyed):
    path = shared_dir(spark, "keyed")
    table = keyed(path)
    for batch_id in range(3):
        table.put(frame(spark, ("a", batch_id)), batch_id)
    table.compact()
    table.compact()
    table.put(frame(spark, ("b", 5)), 3)
    table.compact()
    assert SharedFolder(spark, f"{path}/changes").numbers() == [3]
    assert SharedFolder(spark, f"{path}/folded").numbers() == [2, 3]
    assert rows(table.read()) == [("a", 2), ("b", 5)]
    assert table.has(1) and table.has(3) and not table.has(4)


def test_keys_alone_are_a_set(spark, rows):
    table = KeyedTable(
        spark, shared_dir(spark, "set"), T.StructType().add("k", "string"), ["k"], 2)
    for batch_id, names in enumerate(["ab", "b", "c", "a"]):
        table.put(spark.createDataFrame([(n,) for n in names], "k string"), batch_id)
    assert rows(table.read()) == [("a",), ("b",), ("c",)]


DAYS = T.StructType().add("day", "string").add("k", "string").add("n", "long")


def by_day(spark, *rows):
    return spark.createDataFrame(rows, DAYS)


@pytest.mark.parametrize("compact_every", [None, 1, 3])
def test_tables_by_day_equal_those_without(spark, rows, compact_every):
    """Newest values and sums, with days that come back, null days and odd names."""
    place = shared_dir(spark, "days")
    newest = KeyedTable(spark, f"{place}/k", DAYS, ["day", "k"], compact_every, "day")
    sums = SummedTable(spark, f"{place}/s", DAYS, ["day", "k"], compact_every, "day")
    last, total = {}, {}
    for batch_id in range(6):
        keys = [(day, f"k{batch_id % 2}") for day in (f"d{batch_id // 3}", "a/b=c %1", None)]
        changed = {key: batch_id for key in keys + [("d0", "k")] * (batch_id % 4 == 3)}
        last |= changed
        total = {key: total.get(key, 0) + changed.get(key, 0) for key in {*total, *changed}}
        for table in (newest, sums):
            for _ in range(2):  # a batch that is run again is not stored again
                table.put(by_day(spark, *((*key, n) for key, n in changed.items())), batch_id)
        assert rows(newest.read()) == sorted(((*k, n) for k, n in last.items()), key=repr)
        assert rows(sums.read()) == sorted(((*k, n) for k, n in total.items()), key=repr)


def test_only_touched_days_are_read_and_folded(spark, rows):
    place = shared_dir(spark, "days")
    table = KeyedTable(spark, place, DAYS, ["day", "k"], partition_by="day")
    folded = SharedFolder(spark, f"{place}/folded")
    for batch_id, days in enumerate(["ab", "b", "b", "bc"]):
        table.put(by_day(spark, *((day, "k", batch_id) for day in days)), batch_id)
        before = table.read()
        table.compact()
        assert sorted(folded.parts(batch_id)) == [f"day={day}" for day in days]
        # A reader that began before the fold still finds its files.
        assert rows(before) == rows(table.read())
    # Day a stays in the first fold; later ones have b anew, of which two are kept.
    assert {n: sorted(folded.parts(n)) for n in folded.numbers()} == {
        0: ["day=a"], 2: ["day=b"], 3: ["day=b", "day=c"]}
    assert rows(table.read()) == [("a", "k", 0), ("b", "k", 3), ("c", "k", 3)]
    one = with_values(table.read(), "day", ["a"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan
    assert {name.split("/")[-2] for name in one.inputFiles()} <= {"day=a", "day=b", "day=c"}
    scanned = [line for line in plan.splitlines() if "PartitionFilters" in line and "= a)" in line]
    assert scanned
    assert values_of(table.read(), "day", 2) is None and len(values_of(table.read(), "day", 3)) == 3


def test_folds_have_bloom_filters_on_keys(spark):
    import pyarrow.parquet as pq

    place = shared_dir(spark, "bloom")
    table = KeyedTable(spark, place, DAYS, ["day", "k"], partition_by="day")
    table.put(by_day(spark, *(("d", f"key-{i}", i) for i in range(5000))), 0)
    table.compact()
    found = table.read().where("day = 'd' AND k = 'key-77'")
    assert [tuple(r) for r in found.collect()] == [("d", "key-77", 77)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,key-77)" in plan
    name = next(f for f in found.inputFiles() if "folded" in f)
    hadoop = spark._jvm.org.apache.parquet.hadoop
    file = hadoop.util.HadoopInputFile.fromPath(
        spark._jvm.org.apache.hadoop.fs.Path(name), spark._jsc.hadoopConfiguration())
    columns = hadoop.ParquetFileReader.open(file).getFooter().getBlocks().get(0).getColumns()
    where = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in columns}
    assert where["k"] > 0


def test_saved_tables_are_replaced_and_found(spark, make_actions, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    days = ["2019-03-20", "2019-03-21"]
    log = make_actions([{"date": d, "page_id": p} for d in days for p in range(3)])
    save_table(log.limit(1), "shop.user_visit_action")
    save_table(log, "shop.user_visit_action", partition_by=["date"])
    users = spark.createDataFrame([(1, "u", "n", 30, "x", "F")], USER_INFO)
    save_table(users, "shop.user_info", bucket_by="user_id", buckets=4)
    save_table(spark.createDataFrame([], CITY_INFO), "shop.city_info")
    save_table(spark.createDataFrame([], PRODUCT_INFO), "shop.product_info")
    found = load_tables(spark, database="shop")
    assert rows(found["user_visit_action"]) == rows(log)
    assert rows(spark.table("user_info")) == rows(users)
    plan = found["user_visit_action"].where("date >= '2019-03-21'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_bucketed_join_needs_no_shuffle(spark, make_actions):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    save_table(make_actions([{"user_id": u} for u in range(50)]), "bucketed.log",
               bucket_by="user_id", buckets=4)
    users = spark.createDataFrame([(u, "u", "n", 30, "x", "F") for u in range(50)], USER_INFO)
    save_table(users, "bucketed.users", bucket_by="user_id", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed.log").join(spark.table("bucketed.users"), "user_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_from_a_folder(spark, make_actions, rows):
    place = shared_dir(spark, "tables")
    log = make_actions([{"page_id": 4}])
    log.write.partitionBy("date").parquet(f"{place}/user_visit_action")
    for name, schema in (("user_info", USER_INFO), ("city_info", CITY_INFO),
                         ("product_info", PRODUCT_INFO)):
        spark.createDataFrame([], schema).write.parquet(f"{place}/{name}")
    found = load_tables(spark, folder=place, register=False)
    assert rows(found["user_visit_action"]) == rows(log)


def test_jdbc_writers_replace_or_truncate():
    # No database may be started here, so this checks only what Spark is asked to do.
    for write, truncates in ((replace_jdbc_table, False), (truncate_and_load, True)):
        rows = MagicMock()
        write(rows, "jdbc:x", "t", {"user": "me"})
        rows.write.mode.assert_called_once_with("overwrite")
        writer = rows.write.mode.return_value
        if truncates:
            writer.option.assert_called_once_with("truncate", "true")
            writer = writer.option.return_value
        writer.jdbc.assert_called_once_with("jdbc:x", "t", properties={"user": "me"})


@pytest.mark.parametrize("url, swap", [
    ("jdbc:mysql://x/d", ["RENAME TABLE d.t TO d.t_old, d.t_staged TO d.t"]),
    ("jdbc:postgresql://x/d", [
        "ALTER TABLE d.t RENAME TO t_old", "ALTER TABLE d.t_staged RENAME TO t"]),
])
def test_staged_load_swaps_after_all_rows_are_there(url, swap):
    # No database may be started here, so this checks only what is asked for, and in what order.
    calls, rows = [], MagicMock()
    rows.write.mode.return_value.jdbc.side_effect = lambda *given, **_: calls.append(given)
    staged_load(rows, url, "d.t", {"user": "me"}, calls.append)
    assert calls == [
        (url, "d.t_staged"), ["DROP TABLE IF EXISTS d.t_old", *swap, "DROP TABLE d.t_old"]]
    rows.write.mode.return_value.jdbc.side_effect = OSError("no rows")
    with pytest.raises(OSError):
        staged_load(rows, url, "d.t", execute=calls.append)
    assert len(calls) == 2


def test_swapped_table_is_there_at_any_time(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS swapped")
    path, name = shared_dir(spark, "swapped"), "swapped.t"
    swap_table(frame(spark, ("a", 1)), name, path)
    reader = spark.table(name)
    swap_table(frame(spark, ("b", 2), ("c", 3)), name, path)
    # A reader that began before finishes on what it saw.
    assert rows(reader) == [("a", 1)] and rows(spark.table(name)) == [("b", 2), ("c", 3)]
    broken = frame(spark, ("d", 4)).selectExpr("k", "raise_error('broken') AS n")
    with pytest.raises(Exception, match="broken"):
        swap_table(broken.selectExpr("k", "CAST(n AS BIGINT) AS n"), name, path)
    assert rows(spark.table(name)) == [("b", 2), ("c", 3)]
    for n in range(3):
        swap_table(frame(spark, ("e", n)), name, path)
    assert rows(spark.table(name)) == [("e", 2)]
    assert len(SharedFolder(spark, path, "version").numbers()) == 2
    # Other columns and partitions give a new definition.
    swap_table(frame(spark, ("e", 1), ("f", 2)), name, path, ["k"])
    assert spark.table(name).columns == ["n", "k"]
    swap_table(frame(spark, ("g", 3), ("h", 4)), name, path, ["k"])
    found = spark.table(name).where("k = 'h'")
    assert rows(found) == [(4, "h")] and rows(spark.table(name)) == [(3, "g"), (4, "h")]
    assert "PartitionFilters: [isnotnull(k" in found._jdf.queryExecution().toString()


def test_run_reports_hands_over_every_report(spark, make_actions):
    tables = {
        "user_visit_action": make_actions([
            {"click_category_id": 1, "click_product_id": 1, "page_id": p,
             "action_time": f"2019-03-20 10:00:0{p}"} for p in (1, 2, 3)]),
        "user_info": spark.createDataFrame([(1, "u", "n", 30, "x", "F")], USER_INFO),
        "city_info": spark.createDataFrame([(1, "Aa", "north")], CITY_INFO),
        "product_info": spark.createDataFrame([(1, "p1", "")], PRODUCT_INFO),
    }
    stored = {}
    task = run_reports(
        spark, tables, Condition(targetPageFlow="1,2,3"),
        lambda frame, name: stored.update({name: [tuple(r) for r in frame.collect()]}))
    assert tuple(stored) == REPORTS
    assert stored["category_top10"] == [(task, "1", 3, 0, 0)]
    assert stored["category_top10_session_count"] == [(task, "1", "s", 3)]
    assert sorted(stored["page_conversion_rate"]) == [
        (task, "1-2", "100.00%"), (task, "2-3", "100.00%")]
    assert stored["area_click_top10"] == [("north", "p1", 3, "Aa:100.00%, 其他:0.00%", 1)]


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one.startswith(root) and one != two
