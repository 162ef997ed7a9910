"""Files as streams, and tables."""

from terrace.sources.files import read_new_files, register_source
from terrace.sources.tables import overwrite_table, read_table, register

__all__ = ["overwrite_table", "read_new_files", "read_table", "register", "register_source"]
