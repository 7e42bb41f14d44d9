from clicklens.sinks.jdbc import replace_jdbc_table, staged_load, truncate_and_load
from clicklens.sinks.keyed import KeyedTable, SummedTable
from clicklens.sinks.shared import SharedFolder
from clicklens.sinks.tables import save_table, swap_table

__all__ = [
    "KeyedTable",
    "SharedFolder",
    "SummedTable",
    "replace_jdbc_table",
    "save_table",
    "staged_load",
    "swap_table",
    "truncate_and_load",
]
