from clicklens.operators import category_action_counts, tag_actions
from clicklens.plans import category_session_counts, category_top, category_top_sessions


def test_precedence_and_lists(make_actions, rows):
    log = make_actions([
        {"click_category_id": 3, "order_category_ids": "4,5"},
        {"order_category_ids": "4,5", "pay_category_ids": "6"},
        {"pay_category_ids": "6"},
        {},
        {"order_category_ids": "7,8,,"},
        {"order_category_ids": ""},
        {"order_category_ids": ","},
        {"order_category_ids": "9,9"},
    ])
    assert rows(tag_actions(log)) == [
        ("click", "3"), ("order", ""), ("order", "4"), ("order", "5"), ("order", "7"),
        ("order", "8"), ("order", "9"), ("order", "9"), ("pay", "6"),
    ]
    counts = {r.categoryId: tuple(r)[1:] for r in category_action_counts(log).collect()}
    assert counts["3"] == (1, 0, 0) and counts["6"] == (0, 0, 1) and counts["9"] == (0, 2, 0)


def test_top_orders_by_clicks_then_orders_then_payments(make_actions):
    log = make_actions(
        [{"click_category_id": 1}] * 2
        + [{"click_category_id": 2}] * 2 + [{"order_category_ids": "2"}]
        + [{"click_category_id": 3}] * 2 + [{"order_category_ids": "3"}, {"pay_category_ids": "3"}]
        + [{"click_category_id": c} for c in (10, 11, 12)]
    )
    top = category_top(log, "t", 5).collect()
    assert [row.categoryId for row in top] == ["3", "2", "1", "10", "11"]
    assert tuple(top[0]) == ("t", "3", 2, 1, 1)


def test_sessions_of_top_categories(spark, make_actions, rows):
    log = make_actions(
        [{"click_category_id": 1, "session_id": f"s{i:02}"} for i in range(12)]
        + [{"click_category_id": 1, "session_id": "s05"}] * 3
        + [{"click_category_id": 2, "session_id": "s00"}]
        + [{"order_category_ids": "1", "session_id": "s11"}] * 9
    )
    top = spark.createDataFrame([("1",)], "categoryId string")
    assert len(rows(category_session_counts(log, top))) == 12
    found = category_top_sessions(log, top, "t").collect()
    # Ten of twelve sessions: the one with most clicks, then equals by session.
    assert len(found) == 10
    assert [(r.sessionId, r.clickCount) for r in sorted(found, key=lambda r: -r.clickCount)][0] == ("s05", 4)
    assert {r.sessionId for r in found} == {f"s{i:02}" for i in range(10)}
    assert {r.taskId for r in found} == {"t"}
