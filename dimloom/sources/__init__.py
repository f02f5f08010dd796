"""Where tables come from and where they go."""

from dimloom.sources.flat import FLAT_COLUMNS, cell_rejects, land_flat, read_flat
from dimloom.sources.tables import read_csv_table, read_model, write_csv, write_parquet

__all__ = [
    "FLAT_COLUMNS",
    "cell_rejects",
    "land_flat",
    "read_csv_table",
    "read_flat",
    "read_model",
    "write_csv",
    "write_parquet",
]
