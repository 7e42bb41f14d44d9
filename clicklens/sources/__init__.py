from clicklens.sources.condition import Condition
from clicklens.sources.streams import (
    parse_clicks,
    read_clicks,
    read_kafka_lines,
    read_lines,
    rejected_lines,
)
from clicklens.sources.tables import load_tables

__all__ = [
    "Condition",
    "load_tables",
    "parse_clicks",
    "read_clicks",
    "read_kafka_lines",
    "read_lines",
    "rejected_lines",
]
