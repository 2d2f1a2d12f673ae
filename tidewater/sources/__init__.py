from tidewater.sources.tables import load_table, stream_table
from tidewater.sources.files import (
    read_text,
    read_text_stream,
    read_delimited,
    read_json,
    read_edge_list,
    read_vertices,
    read_rides,
    RIDE_SCHEMA,
)
from tidewater.sources.sinks import write_text, write_tsv, read_tsv

__all__ = [
    "load_table", "stream_table", "read_text", "read_text_stream", "read_delimited",
    "read_json", "read_edge_list", "read_vertices", "read_rides", "RIDE_SCHEMA",
    "write_text", "write_tsv", "read_tsv",
]
