from silverloom.sources.bronze import land_bronze, read_bronze
from silverloom.sources.documents import to_search_docs, write_search_docs, write_search_index
from silverloom.sources.jdbc import read_jdbc, write_jdbc
from silverloom.sources.load import failed_tables, load_tables
from silverloom.sources.pages import concat_pages, read_pages
from silverloom.sources.tables import (
    literal_table,
    preview,
    read_table,
    sequence_table,
    sql_over_path,
    write_json,
    write_parts,
    write_table,
)

__all__ = [
    "concat_pages",
    "failed_tables",
    "land_bronze",
    "literal_table",
    "load_tables",
    "preview",
    "read_bronze",
    "read_jdbc",
    "read_pages",
    "read_table",
    "sequence_table",
    "sql_over_path",
    "to_search_docs",
    "write_jdbc",
    "write_json",
    "write_parts",
    "write_search_docs",
    "write_search_index",
    "write_table",
]
