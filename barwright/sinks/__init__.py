from .catalog import register_tables
from .files import write_partitioned

__all__ = ["register_tables", "write_partitioned"]
