from .alerts import price_alerts
from .bars import bar_states, bars, finished_bars, merged_states, rebar
from .conform import conform, dated, numbers_as_doubles, of_year, undated, years
from .fill import fill_gaps, fill_gaps_within
from .indicators import add_indicators, ema, gold, macd, rsi, sma
from .profile import missing_profile
from .recursive import recursive_ema, wilder_rsi
from .report import market_report
from .select import head_bars, last_n_bars, tail_bars
from .trend import trend_flags

__all__ = [
    "add_indicators", "bar_states", "bars", "conform", "dated", "ema", "fill_gaps", "fill_gaps_within", "finished_bars", "gold", "head_bars",
    "last_n_bars", "macd", "market_report", "merged_states", "missing_profile", "numbers_as_doubles", "of_year",
    "price_alerts", "rebar", "recursive_ema", "rsi", "sma", "tail_bars", "trend_flags", "undated", "wilder_rsi",
    "years",
]
