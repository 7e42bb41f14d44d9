"""spark-submit ad_clicks.py --servers HOST:PORT --folder SHARED_FOLDER

The three ad-click jobs over a Kafka topic, started again together if one of them fails.
"""

from __future__ import annotations

import argparse

from clicklens.functions.fixed import BATCH_INTERVAL, CLICK_TOPIC
from clicklens.session import build_session
from clicklens.sources import read_kafka_lines
from clicklens.streaming import AdJobs, StateOptions


def main(argv: list[str] | None = None) -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--servers", required=True)
    options.add_argument("--folder", required=True, help="for tables and checkpoints")
    options.add_argument("--topic", default=CLICK_TOPIC)
    options.add_argument("--interval", default=BATCH_INTERVAL)
    options.add_argument("--state-partitions", type=int)
    options.add_argument("--max-restarts", type=int, default=3, help="in a row without a batch")
    given = options.parse_args(argv)
    spark = build_session("ad clicks")
    jobs = AdJobs(spark, given.folder, state=StateOptions(partitions=given.state_partitions))
    lines = read_kafka_lines(spark, given.servers, given.topic)
    jobs.supervisor(lines, given.interval, given.max_restarts).run()


if __name__ == "__main__":
    main()
