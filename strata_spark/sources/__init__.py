from .files import read_circuits, read_codes, read_columns, read_projections, read_tables, read_tract_codes, read_tract_reference, run_manifest, write_manifest, write_named_csv, write_named_tables, write_sample, write_tables
from .publish import write_by_year, write_named_files

__all__ = ["read_circuits", "read_codes", "read_columns", "read_projections", "read_tables", "read_tract_codes", "read_tract_reference", "run_manifest", "write_by_year", "write_manifest", "write_named_csv", "write_named_files", "write_named_tables", "write_sample", "write_tables"]
