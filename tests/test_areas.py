import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clicklens.operators import rank_within, top_share_remark, top_within
from clicklens.plans import area_product_top
from clicklens.sources.schemas import CITY_INFO, PRODUCT_INFO


@pytest.mark.parametrize("counts, remark", [
    ({"A": 1}, "A:100.00%, 其他:0.00%"),
    ({"A": 4, "B": 1}, "A:80.00%, B:20.00%, 其他:0.00%"),
    ({"A": 8, "B": 2}, "A:80.00%, B:20.00%, 其他:0.00%"),
    ({"C": 1, "B": 1, "A": 2}, "A:50.00%, B:25.00%, 其他:25.00%"),
    ({None: 3, "A": 1}, "null:75.00%, A:25.00%, 其他:0.00%"),
])
def test_remark(spark, counts, remark):
    single = [("g", city) for city, n in counts.items() for _ in range(n)]
    frame = spark.createDataFrame(single, "g string, city string")
    assert top_share_remark(frame, ["g"], "city").first().remark == remark
    summed = spark.createDataFrame(
        [("g", c, n) for c, n in counts.items()], "g string, city string, n bigint")
    row = top_share_remark(summed, ["g"], "city", weight="n").first()
    assert (row.total, row.remark) == (sum(counts.values()), remark)


def test_remark_with_more_items_and_other_label(spark):
    frame = spark.createDataFrame([(c,) for c in "AAABBC"], "city string").withColumn("g", F.lit(1))
    row = top_share_remark(frame, ["g"], "city", k=3, other="rest").first()
    assert row.remark == "A:50.00%, B:33.33%, C:16.67%, rest:0.00%"


def test_remark_shares_descend(spark):
    draw = random.Random(5)
    data = [(draw.randint(1, 5), draw.choice("ABCDEFG")) for _ in range(400)]
    frame = spark.createDataFrame(data, "g int, city string")
    for row in top_share_remark(frame, ["g"], "city").collect():
        counts = Counter(city for g, city in data if g == row.g)
        assert row.total == sum(counts.values())
        top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
        assert [part.split(":")[0] for part in row.remark.split(", ")] == [top[0][0], top[1][0], "其他"]


def test_ties_share_a_rank_but_not_a_number(spark):
    frame = spark.createDataFrame(
        [("a", i, n) for i, n in enumerate((5, 4, 3, 3, 2))], "area string, id int, n int")
    ranked = rank_within(frame, ["area"], [F.desc("n")], 3)
    assert sorted(r["rank"] for r in ranked.collect()) == [1, 2, 3, 3]
    numbered = top_within(frame, ["area"], [F.desc("n"), F.asc("id")], 3)
    assert sorted(r.id for r in numbered.collect()) == [0, 1, 2]


@pytest.fixture
def cities(spark):
    return spark.createDataFrame(
        [(1, "Aa", "north"), (2, "Bb", "north"), (3, "Cc", "south"), (4, "Aa", "north")], CITY_INFO)


def test_area_top(spark, make_actions, cities, rows):
    products = spark.createDataFrame([(p, f"p{p}", "") for p in (1, 3, 4, 5)], PRODUCT_INFO)
    clicks = {(1, 1): 4, (2, 1): 1, (1, 2): 4, (4, 3): 2, (2, 3): 1, (1, 4): 2, (1, 5): 1, (3, 5): 1,
              (9, 1): 7}
    log = make_actions(
        [{"city_id": c, "click_product_id": p} for (c, p), n in clicks.items() for _ in range(n)]
        + [{"city_id": 1, "click_product_id": -1}] * 9
    )
    # Product 2 has rank 2 in the north, but is no product: the rank is missing.
    # City 4 shares its name with city 1; city 9 is no city.
    assert rows(area_product_top(log, cities, products)) == [
        ("north", "p1", 5, "Aa:80.00%, Bb:20.00%, 其他:0.00%", 1),
        ("north", "p3", 3, "Aa:66.67%, Bb:33.33%, 其他:0.00%", 3),
        ("south", "p5", 1, "Cc:100.00%, 其他:0.00%", 1),
    ]
