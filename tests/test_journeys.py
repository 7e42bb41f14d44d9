import random
from collections import Counter
from itertools import groupby

import pytest

from clicklens.operators import (
    flow_pages,
    flow_pairs,
    flow_steps,
    page_jumps,
    page_visits,
)
from clicklens.plans import page_conversion


def visits(session, pages):
    return [
        {"session_id": session, "page_id": page, "action_time": f"2019-03-20 10:00:{i:02}"}
        for i, page in enumerate(pages)
    ]


def expected_steps(actions, flow):
    """By hand: order each session, pair neighbours, keep the flow's pairs."""
    pages, pairs = flow_pages(flow), set(flow_pairs(flow))

    def session(action):
        return str(action["session_id"])

    steps = Counter()
    for _, group in groupby(sorted(actions, key=session), key=session):
        ordered = [a["page_id"] for a in sorted(group, key=lambda a: (a["action_time"], a["page_id"]))]
        for page, following in zip(ordered, [*ordered[1:], None]):
            if page in pages:
                steps[page, following if (page, following) in pairs else None] += 1
    return dict(steps)


def found_steps(frame):
    return {(row.page_id, row.next_page): row.n for row in frame.collect()}


def test_flow_texts():
    assert flow_pages("1,2,x, 3,02,-4,2") == [1, 2, -4]
    assert flow_pairs("1,2,x,3,4,1,2") == [(1, 2), (3, 4), (4, 1)]
    assert flow_pairs("1") == []


def test_conversion(make_actions, rows):
    log = make_actions(visits("x", [1, 2, 9, 3]) + visits("y", [1]) + visits("z", [2, 3]))
    assert rows(page_conversion(log, "1,2,3", "t")) == [
        ("t", "1-2", "50.00%"), ("t", "2-3", "50.00%")]


def test_small_rate_and_pair_without_jump(make_actions, rows):
    log = make_actions(visits("a", [1, 2]) + [v for i in range(199) for v in visits(f"s{i}", [1])])
    assert rows(page_conversion(log, "1,2,3", "t")) == [("t", "1-2", ".50%")]


def test_visits_and_jumps(make_actions, rows):
    log = make_actions(visits("x", [1, 2, 1, 2, 5]) + visits("y", [2, 1]))
    assert rows(page_visits(log, "1,2,3")) == [(1, 3), (2, 3)]
    assert rows(page_jumps(log, "1,2,1")) == [(1, 2, 2), (2, 1, 2)]


def test_flow_of_one_page_has_no_jumps(make_actions):
    log = make_actions(visits("x", [1, 2, 1]))
    assert found_steps(flow_steps(log, "1")) == {(1, None): 2}


@pytest.mark.parametrize("slice_by", [10, 13, 19, 21])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_slicing_changes_nothing(make_actions, slice_by, seed):
    # Few seconds and few pages, so that equal times, equal rows, slices of one
    # row and pairs across slices all occur; a third of the rows has no session.
    draw = random.Random(seed)
    log = [
        {"session_id": draw.choice([None, None, *"abcd"]), "page_id": draw.randint(1, 4),
         "action_time": f"2019-03-20 10:00:0{draw.randint(0, 3)}.{draw.randint(0, 2)}"}
        for _ in range(120)
    ] + visits("single", [2])
    flow = "1,2,2,3,1"
    assert found_steps(flow_steps(make_actions(log), flow, slice_by=slice_by)) == expected_steps(
        log, flow)


def test_a_session_over_many_days(make_actions):
    log = [
        {"session_id": "x", "page_id": 1 + i % 3, "action_time": f"2019-03-{20 + i // 4} 1{i % 4}:00:00"}
        for i in range(32)
    ]
    assert found_steps(flow_steps(make_actions(log), "1,2,3")) == expected_steps(log, "1,2,3")
