from .files import count_files, read_bars_csv, read_bars_parquet, typed_bars
from .messages import decode_messages
from .streams import stream_files

__all__ = [
    "count_files", "decode_messages", "read_bars_csv", "read_bars_parquet", "stream_files",
    "typed_bars",
]
