from clicklens.functions.text import (
    day_of_millis,
    pairs_json,
    percent,
    register_sql_functions,
    remark_text,
    split_list,
)

__all__ = [
    "day_of_millis",
    "pairs_json",
    "percent",
    "register_sql_functions",
    "remark_text",
    "split_list",
]
