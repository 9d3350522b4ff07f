"""Exchange-qualified symbols such as `NSE:NIFTY` and `NSE:NIFTY1!`."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_symbol(symbol, exchange, contract=None) -> Column:
    """`EXCHANGE:SYMBOL`, or `EXCHANGE:SYMBOL<n>!` for futures contract n.

    A symbol that already names its exchange is kept. A contract that is not a whole number,
    whatever its type, fails the query.
    """
    symbol, exchange = _col(symbol), _col(exchange)
    qualified = F.concat(exchange, F.lit(":"), symbol)
    if contract is None:
        return F.when(symbol.contains(":"), symbol).otherwise(qualified)
    contract = _col(contract)
    number = contract.try_cast("bigint")
    # A fraction would be cut off silently by the cast alone.
    whole = number.isNotNull() & (number.try_cast("double") == contract.try_cast("double"))
    return (
        F.when(symbol.contains(":"), symbol)
        .when(contract.isNull(), qualified)
        .when(~F.coalesce(whole, F.lit(False)),
              F.raise_error(F.lit("not a valid contract")).cast("string"))
        .otherwise(F.concat(qualified, number.cast("string"), F.lit("!")))
    )


def _part(symbol, n: int) -> Column:
    parts = F.split(_col(symbol), ":")
    return F.when(F.size(parts) == 2, F.get(parts, F.lit(n)))


def exchange_of(symbol) -> Column:
    """The exchange of `EXCHANGE:TICKER`; NULL for anything that does not have these two parts."""
    return _part(symbol, 0)


def ticker_of(symbol) -> Column:
    """The ticker of `EXCHANGE:TICKER`; NULL for anything that does not have these two parts."""
    return _part(symbol, 1)


def file_safe(symbol) -> Column:
    """The symbol without the colon, for use in file and directory names."""
    return F.translate(_col(symbol), ":", "")


def symbol_list(text) -> Column:
    """The symbols of a comma-separated list such as `CRYPTO:BTCUSD, CRYPTO:BTCEUR`."""
    return F.split(_col(text), ", ")
