"""Readers and writers: snapshot trees, run history, and the warehouse."""

from .snapshots import chosen_runs, load_snapshots, read_run_history, scan_snapshots
from .warehouse import CsvWarehouse, JdbcWarehouse, ParquetWarehouse

__all__ = [
    "CsvWarehouse",
    "JdbcWarehouse",
    "ParquetWarehouse",
    "chosen_runs",
    "load_snapshots",
    "read_run_history",
    "scan_snapshots",
]
