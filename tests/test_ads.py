import json
import random
from collections import Counter
from unittest.mock import MagicMock

import pytest

from clicklens.plans import (
    ad_clicks_per_area_city,
    ad_totals_per_area,
    area_top_ads,
    count_fields,
    user_ad_clicks,
    users_to_list,
)
from clicklens.sources import parse_clicks, read_kafka_lines, rejected_lines

DAY = 1553040000000  # 2019-03-20 00:00 UTC


@pytest.fixture
def lines(spark):
    return lambda *texts: spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse(lines, rows):
    good = [f"{DAY},north,Aa,100,1", f"{DAY + 1},north,Aa,100,1,more", f"+{DAY},n,c,u,,x"]
    bad = [f"{DAY},north,Aa,100", f"{DAY},north,Aa,100,", f"t{DAY},n,c,u,1", f" {DAY},n,c,u,1",
           "99999999999999999999,n,c,u,1", ",,,,", "", None]
    text = lines(*good, *bad)
    assert rows(parse_clicks(text)) == sorted([
        (DAY, "north", "Aa", "100", "1", "2019-03-20"),
        (DAY + 1, "north", "Aa", "100", "1", "2019-03-20"),
        (DAY, "n", "c", "u", "", "2019-03-20"),
    ], key=repr)
    assert rows(rejected_lines(text)) == sorted([(t,) for t in bad], key=repr)


def test_counts(lines, rows):
    draw = random.Random(3)
    clicks = [
        (DAY + draw.randint(0, 2) * 86400000, draw.choice(["n", "s"]), draw.choice(["A", "B:x"]),
         str(draw.randint(1, 3)), str(draw.randint(1, 5)))
        for _ in range(200)
    ]
    days = {DAY: "2019-03-20", DAY + 86400000: "2019-03-21", DAY + 2 * 86400000: "2019-03-22"}
    parsed = parse_clicks(lines(*[",".join(map(str, c)) for c in clicks]))

    per_city = Counter((days[ts], area, city, ad) for ts, area, city, _, ad in clicks)
    per_area = Counter((days[ts], area, ad) for ts, area, _, _, ad in clicks)
    per_user = Counter((user, days[ts], ad) for ts, _, _, user, ad in clicks)
    counted = ad_clicks_per_area_city(parsed)
    totals = ad_totals_per_area(counted)
    assert rows(counted) == sorted([(*k, n) for k, n in per_city.items()], key=repr)
    assert rows(totals) == sorted([(*k, n) for k, n in per_area.items()], key=repr)
    assert rows(user_ad_clicks(parsed)) == sorted([(*k, n) for k, n in per_user.items()], key=repr)
    assert rows(users_to_list(user_ad_clicks(parsed), 9)) == sorted(
        {(k[0],) for k, n in per_user.items() if n >= 9}, key=repr)
    assert rows(count_fields(counted)) == sorted(
        [(":".join(k), str(n)) for k, n in per_city.items()], key=repr)
    assert rows(count_fields(user_ad_clicks(parsed), ["user_id", "day", "ads_id"])) == sorted(
        [(":".join(k), str(n)) for k, n in per_user.items()], key=repr)

    for row in area_top_ads(totals).collect():
        ranked = sorted(((ad, n) for (day, area, ad), n in per_area.items()
                         if (day, area) == (row.day, row.area)), key=lambda an: (-an[1], an[0]))
        assert json.loads(row.top3_json) == [{ad: n} for ad, n in ranked[:3]]
        assert [tuple(pair) for pair in row.top] == ranked[:3]


def test_exactly_three_of_equals(spark):
    counts = spark.createDataFrame(
        [("d", "a", ad, n) for ad, n in (("4", 3), ("3", 3), ("2", 4), ("1", 5))],
        "day string, area string, ads_id string, clicks bigint")
    assert area_top_ads(counts).first().top3_json == '[{"1":5},{"2":4},{"3":3}]'


def test_clicks_over_days_do_not_add_up(lines, rows):
    two = [f"{DAY + d * 86400000},n,c,u,1" for d in (0, 0, 1, 1)]
    assert rows(users_to_list(user_ad_clicks(parse_clicks(lines(*two))), 3)) == []


def test_kafka_source_asks_for_the_topic(spark):
    # The connector is no part of Spark's own jars, so this checks only the options.
    session = MagicMock()
    read_kafka_lines(session, "broker:9092", maxOffsetsPerTrigger="10")
    session.readStream.format.assert_called_once_with("kafka")
    session.readStream.format.return_value.options.assert_called_once_with(**{
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "ads_log",
        "groupIdPrefix": "commerce-consumer-group", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10"})
