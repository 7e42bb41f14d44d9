import pytest
from pyspark.sql import functions as F

from clicklens.functions import (
    day_of_millis,
    pairs_json,
    percent,
    register_sql_functions,
    split_list,
)


@pytest.mark.parametrize("text, pieces", [
    ("1,2", ["1", "2"]),
    ("7,8,,", ["7", "8"]),
    (",7", ["", "7"]),
    ("7", ["7"]),
    ("", [""]),
    (",", []),
    (",,", []),
    (None, None),
])
def test_split_list(spark, text, pieces):
    frame = spark.createDataFrame([(text,)], "t string").select(split_list(F.col("t")).alias("p"))
    assert frame.first().p == pieces


@pytest.mark.parametrize("part, whole, pattern, text", [
    (1, 1, "0.00%", "100.00%"),
    (0, 7, "0.00%", "0.00%"),
    (1, 3, "0.00%", "33.33%"),
    (1, 200, ".00%", ".50%"),
    (1, 200, "0.00%", "0.50%"),
    (15558, 100000, ".00%", "15.56%"),
    (7, 7, ".00%", "100.00%"),
])
def test_percent(spark, part, whole, pattern, text):
    frame = spark.createDataFrame([(part, whole)], "a bigint, b bigint")
    assert frame.select(percent(F.col("a"), F.col("b"), pattern)).first()[0] == text


def test_day_of_millis(spark):
    frame = spark.createDataFrame([(1553126399999,), (1553126400000,)], "ts bigint")
    days = [row[0] for row in frame.select(day_of_millis(F.col("ts"))).collect()]
    assert days == ["2019-03-20", "2019-03-21"]


def test_pairs_json(spark):
    frame = spark.sql("SELECT array(struct('1' AS a, 200L AS n), struct('2' AS a, 100L AS n)) AS p")
    text = frame.select(pairs_json(F.col("p"), "a", "n")).first()[0]
    assert text == '[{"1":200},{"2":100}]'


def test_city_remark_in_sql(spark):
    register_sql_functions(spark)
    row = spark.sql("""
        SELECT city_remark(array(struct('A', 1L)), 1L) AS one,
               city_remark(array(struct('B', 1L), struct('A', 4L)), 5L) AS two,
               city_remark(array(struct('C', 1L), struct('B', 1L), struct('A', 2L)), 4L) AS three,
               city_remark(array(struct('B', 1L), struct(CAST(NULL AS STRING), 1L)), 4L) AS missing,
               city_remark(array(struct('A', 2L), struct('A', 1L)), 4L) AS twice
    """).first()
    assert row.one == "A:100.00%, 其他:0.00%"
    assert row.two == "A:80.00%, B:20.00%, 其他:0.00%"
    assert row.three == "A:50.00%, B:25.00%, 其他:25.00%"
    assert row.missing == "null:25.00%, B:25.00%, 其他:50.00%"
    assert row.twice == "A:50.00%, A:25.00%, 其他:25.00%"
