import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clicklens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    place = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        warehouse_dir=str(place / "warehouse"),
        settings={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "100000",
            "spark.checkpoint.dir": str(place / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda frame: sorted((tuple(row) for row in frame.collect()), key=repr)


ACTION_DEFAULTS = {
    "date": "2019-03-20", "user_id": 1, "session_id": "s", "page_id": 1,
    "action_time": "2019-03-20 10:00:00", "search_keyword": None, "click_category_id": -1,
    "click_product_id": -1, "order_category_ids": None, "order_product_ids": None,
    "pay_category_ids": None, "pay_product_ids": None, "city_id": 1,
}


@pytest.fixture
def make_actions(spark):
    """An action log from dictionaries of what differs from a search."""
    from clicklens.sources.schemas import USER_VISIT_ACTION

    def make(actions):
        full = [{**ACTION_DEFAULTS, **action} for action in actions]
        return spark.createDataFrame(
            [tuple(action[name] for name in USER_VISIT_ACTION.names) for action in full],
            USER_VISIT_ACTION,
        )

    return make
