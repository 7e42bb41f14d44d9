import pytest

from clicklens.operators import clicks_only, filtered_actions, without_listed
from clicklens.sources import Condition
from clicklens.sources.schemas import USER_INFO


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [(i, f"u{i}", f"n{i}", age, job, sex)
         for i, age, job, sex in [(1, 20, "teacher", "F"), (2, 35, "student", "M"),
                                  (3, 50, "teacher", "M"), (4, 51, "manager", "F")]],
        USER_INFO,
    )


@pytest.fixture
def actions(make_actions):
    return make_actions(
        [{"user_id": u, "date": d, "city_id": u, "click_category_id": u}
         for u in (1, 2, 3, 4, 5) for d in ("2019-03-19", "2019-03-20", "2019-03-25", "2019-03-26")]
    )


def kept(frame):
    return sorted((row.user_id, row.date[-2:]) for row in frame.collect())


def test_bounds_are_inclusive(actions, users):
    condition = Condition(startDate="2019-03-20", endDate="2019-03-25", startAge=20, endAge=50)
    found = filtered_actions(actions, users, condition)
    assert kept(found) == [(u, d) for u in (1, 2, 3) for d in ("20", "25")]
    assert found.columns == actions.columns


def test_unset_is_no_bound_but_users_must_exist(actions, users):
    assert len(kept(filtered_actions(actions, users, Condition()))) == 4 * 4
    only_start = filtered_actions(actions, users, Condition(startAge=50))
    assert {u for u, _ in kept(only_start)} == {3, 4}


def test_repeated_user_repeats_actions(actions, users):
    assert len(kept(filtered_actions(actions, users.union(users), Condition()))) == 2 * 4 * 4


def test_lists_count_only_when_asked(actions, users):
    condition = Condition(professionals="teacher,manager", gender="M", city="3,4", categoryIds="3")
    assert len(kept(filtered_actions(actions, users, condition))) == 16
    assert {u for u, _ in kept(filtered_actions(actions, users, condition, extra=True))} == {3}


def test_clicks_only(make_actions):
    log = make_actions([{"click_product_id": p} for p in (-1, 0, 7, None)])
    assert sorted(r.click_product_id for r in clicks_only(log).collect()) == [0, 7]


def test_without_listed(spark, rows):
    clicks = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "user_id string, n int")
    listed = spark.createDataFrame([("b",), ("x",)], "user_id string")
    assert rows(without_listed(clicks, listed)) == [("a", 1), ("c", 3)]


def test_condition_from_values(spark, tmp_path):
    condition = Condition.from_dict({"startAge": "20", "endAge": 50, "gender": None, "cities": 3})
    assert (condition.startAge, condition.endAge, condition.gender) == (20, 50, "")
    assert Condition.from_dict({"startAge": ""}).startAge == 0
    assert condition.city == "3"
    with pytest.raises(ValueError, match="town"):
        Condition.from_dict({"town": "3"})
    assert Condition.from_json('{"startDate": "2019-03-20"}').startDate == "2019-03-20"

    path = tmp_path / "condition.json"
    path.write_text('{startDate: "2020-01-01", startAge: "18",\n "endAge": 40, gender: "", '
                    'targetPageFlow: "3,2,1"}')
    assert Condition.from_file(spark, str(path)) == Condition(
        startDate="2020-01-01", startAge=18, endAge=40, targetPageFlow="3,2,1")


def test_condition_of_a_properties_file(spark, tmp_path):
    path = tmp_path / "conditions.properties"
    path.write_text("""# a comment
other.name=1
condition.params.json={startDate:"2019-03-20", \\
  startAge: "20", \\
  endAge: 50, \\
  keywords:"\u706b\u9505", \\
  targetPageFlow:"1,2,3"}
""", encoding="utf-8")
    assert Condition.from_properties(spark, str(path)) == Condition(
        startDate="2019-03-20", startAge=20, endAge=50, keywords="\u706b\u9505",
        targetPageFlow="1,2,3")
    with pytest.raises(ValueError):
        Condition.from_properties(spark, str(path), "another.name")
