from rowloom.functions.hashing import hash32, unit_interval
from rowloom.functions.lineage import cut_lineage, rows_within, scratch_path
from rowloom.functions.ranking import hash_rank, order_index

__all__ = [
    "cut_lineage",
    "hash32",
    "hash_rank",
    "order_index",
    "rows_within",
    "scratch_path",
    "unit_interval",
]
