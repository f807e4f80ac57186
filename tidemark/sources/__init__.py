from .files import read_csv_from_files, read_parquet
from .increments import append_new_files
from .tables import Buckets, TableStore, read_delta, write_delta

__all__ = ["Buckets", "TableStore", "append_new_files", "read_csv_from_files", "read_delta", "read_parquet", "write_delta"]
