"""spark-submit daily_reports.py --condition FILE --database NAME --url JDBC_URL [--extra]

All batch reports of one condition file (JSON, or a properties file that holds it), from catalog tables into database tables.
"""

from __future__ import annotations

import argparse

from clicklens.plans import run_reports
from clicklens.session import build_session
from clicklens.sinks import truncate_and_load
from clicklens.sources import Condition, load_tables


def main(argv: list[str] | None = None) -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--condition", required=True)
    options.add_argument("--database", required=True)
    options.add_argument("--url", required=True)
    options.add_argument("--property", action="append", default=[], help="name=value of the connection")
    options.add_argument("--extra", action="store_true", help="use all lists of the condition")
    given = options.parse_args(argv)
    spark = build_session("daily reports", hive=True)
    properties = dict(item.split("=", 1) for item in given.property)
    properties_file = given.condition.endswith(".properties")
    read = Condition.from_properties if properties_file else Condition.from_file
    run_reports(
        spark, load_tables(spark, database=given.database), read(spark, given.condition),
        lambda rows, name: truncate_and_load(rows, given.url, name, properties),
        extra=given.extra,
    )


if __name__ == "__main__":
    main()
