from .intervals import DAY_MICROS, INTERVALS, bar_start, epoch_micros, width_divides
from .ranking import sort_rank
from .symbols import canonical_symbol, exchange_of, file_safe, symbol_list, ticker_of
from .values import finite, missing, number, number_or_zero, without_nan

__all__ = [
    "DAY_MICROS", "INTERVALS", "bar_start", "canonical_symbol", "epoch_micros", "exchange_of",
    "file_safe", "finite", "missing", "number", "number_or_zero", "sort_rank", "symbol_list",
    "ticker_of", "width_divides", "without_nan",
]
