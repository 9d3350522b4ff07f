"""Market-bar analytics on Spark: sources, cleaning, bars, indicators, reports and streams.

Every operator takes a DataFrame and returns a lazy DataFrame. Functions that write, measure or
start a stream say so in their name or first line; nothing else runs a Spark action.
"""
