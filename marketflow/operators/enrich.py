"""Bar enrichment with the ticker master: one function for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.dates import after
from marketflow.functions.json import parse_with_text
from marketflow.schemas import BAR_MESSAGE, BAR_RENAMES, MASTER_ATTRIBUTES


def bars_from_messages(parsed: DataFrame) -> DataFrame:
    """Short message names -> typed bar columns."""
    return parsed.select(*[F.col(src).alias(dst) for src, dst in BAR_RENAMES.items()])


def enrich(bars: DataFrame, master: DataFrame, cut=None, date_col: str = "transaction_date",
           with_partitions: bool = True) -> DataFrame:
    """Bars strictly after ``cut`` joined (inner) to the master on ticker.

    The cut filter sits on the bar side before the join, so in batch it is
    pushed into the scan; only the master columns used are selected. Bars of
    unknown tickers drop. The master should hold one row per ticker
    (``latest_per_ticker``), else bars multiply. No broadcast is hinted: Spark
    picks one from file sizes under its own threshold, which AQE checks again at
    run time; above it the join shuffles and AQE splits skewed tickers.
    """
    if cut is not None:
        bars = bars.where(after(date_col, cut))
    side = master.select(F.col("ticker").alias("m_ticker"), *MASTER_ATTRIBUTES)
    joined = bars.join(side, bars["ticker"] == side["m_ticker"], "inner")
    out = joined.select(
        *[side[c] for c in MASTER_ATTRIBUTES],
        bars["ticker"], bars["volume"], bars["volume_weighted"], bars["open_price"],
        bars["close_price"], bars["high_price"], bars["low_price"],
        bars["number_of_transaction"], bars[date_col].alias("transaction_date"),
    )
    if with_partitions:
        out = (out.withColumn("year", F.year("transaction_date"))
                  .withColumn("month", F.month("transaction_date")))
    return out


# Where a message goes: into the lake, to the rejected texts, to the bars without a master row, or nowhere.
TO_LAKE, TO_REJECTS, TO_UNMATCHED, BEFORE_CUT = "lake", "rejected", "unmatched", "before_cut"


def typed_bars(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages -> typed bar columns, ``value`` (only of unusable messages) and ``reason`` (null for usable ones).

    A message is unusable without a ticker or a day: ``malformed`` if its text is
    broken, else ``no_ticker`` or ``no_day``. A null or empty text is malformed.
    A broken field beside a good ticker and day is null and the bar usable.
    """
    parsed = parse_with_text(messages, BAR_MESSAGE, value_col)
    # ``T`` and a field ``t`` of some messages differ only in case, so names are resolved here, on typed columns.
    bars = parsed.select(*[parsed[src].alias(dst) for src, dst in BAR_RENAMES.items()], "value", "_broken")
    missing = F.col("ticker").isNull() | F.col("transaction_date").isNull()
    reason = F.when(missing, F.when(F.col("_broken"), "malformed").when(F.col("ticker").isNull(), "no_ticker")
                    .otherwise("no_day"))
    return bars.select(*BAR_RENAMES.values(), F.when(missing, F.col("value")).alias("value"), reason.alias("reason"))


def route_bars(bars: DataFrame, master: DataFrame, cut=None) -> DataFrame:
    """Typed bars (see ``typed_bars``) -> enriched lake columns with ``year``, ``month``, ``route``, ``reason``, ``value``.

    The join keeps bars without a master row, so every row that comes in leaves
    by exactly one route. Messages without a ticker, of which there may be many, get
    a key each that no ticker meets: nulls would all be hashed to one task of a
    shuffled join. Of bars before the cut, which are only counted, nothing but the
    ticker and the day goes through the join.
    """
    side = master.select(F.col("ticker").alias("m_ticker"), *MASTER_ATTRIBUTES)
    number = F.monotonically_increasing_id().cast("string")
    keyed = bars.withColumn("_key", F.when(F.col("ticker").isNull(), number).otherwise(F.col("ticker")))
    late = F.lit(False) if cut is None else F.col("reason").isNull() & ~after("transaction_date", cut)
    counted_only = [c for c in BAR_RENAMES.values() if c not in ("ticker", "transaction_date")]
    keyed = keyed.withColumn("_late", late).withColumns({c: F.when(F.col("_late"), None).otherwise(F.col(c)) for c in counted_only})
    joined = keyed.join(side, (F.col("_key") == F.col("m_ticker")) & F.col("ticker").isNotNull(), "left")
    route = (F.when(F.col("reason").isNotNull(), TO_REJECTS).when(F.col("_late"), BEFORE_CUT)
             .when(F.col("m_ticker").isNull(), TO_UNMATCHED).otherwise(TO_LAKE))
    return joined.select(*MASTER_ATTRIBUTES, *BAR_RENAMES.values(), F.year("transaction_date").alias("year"),
                         F.month("transaction_date").alias("month"), route.alias("route"), "reason", "value")
