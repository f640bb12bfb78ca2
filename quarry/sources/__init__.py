"""File sources and sinks."""

from quarry.sources.files import (
    load_model,
    parse_delimited,
    read_binary,
    read_csv,
    read_delimited,
    read_headerless_routes,
    read_images,
    read_json,
    read_parquet,
    read_yearly,
    read_yearly_mixed,
    rows,
    save_model,
    sequence,
    write_table,
)

__all__ = [
    "load_model",
    "parse_delimited",
    "read_binary",
    "read_csv",
    "read_delimited",
    "read_headerless_routes",
    "read_images",
    "read_json",
    "read_parquet",
    "read_yearly",
    "read_yearly_mixed",
    "rows",
    "save_model",
    "sequence",
    "write_table",
]
