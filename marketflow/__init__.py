"""marketflow: a PySpark library for daily market data.

Typed parsing of bar, ticker-master and news messages; master clean-up;
enrichment of bars in batch or as a stream; a year/month Parquet lake;
high-water-mark loads into a warehouse; news flattening; and sentiment
against price returns. Transforms are ``DataFrame -> DataFrame``.
"""

__version__ = "0.1.0"
