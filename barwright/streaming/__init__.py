from .alerts import ordered_alerts, start_price_alerts
from .bars import compact_live_bars, read_live_bars, start_live_bars, stream_bars
from .ingest import start_ingest

__all__ = [
    "compact_live_bars", "ordered_alerts", "read_live_bars", "start_ingest", "start_live_bars", "start_price_alerts",
    "stream_bars",
]
