from tessera.sources.files import (
    read_csv, read_csv_raw, read_headerless_csv, read_kv_lines, read_lines,
    read_parquet, read_mixed, union_by_name, read_lookup, table_of,
    read_parts, read_table,
)
from tessera.sources.sinks import (
    write_json, save_table, write_parquet, write_csv, write_tsv,
)
from tessera.sources.html import extract_html_tables, pick_table, link_value_pairs, extract_links

__all__ = [
    "read_csv", "read_csv_raw", "read_headerless_csv", "read_kv_lines", "read_lines",
    "read_parquet", "read_mixed", "union_by_name", "read_lookup", "table_of",
    "read_parts", "read_table",
    "write_json", "save_table", "write_parquet", "write_csv", "write_tsv",
    "extract_html_tables", "pick_table", "link_value_pairs", "extract_links",
]
