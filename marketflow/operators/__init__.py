"""Table operators: master, enrichment, news, calendars, loads, contracts, signals."""

from marketflow.operators.calendar import calendar_gaps, day_calendar, month_calendar  # noqa: F401
from marketflow.operators.contracts import (  # noqa: F401
    ARTICLES_CONTRACT, MARKET_DATA_CONTRACT, Rule, contract_report,
    split_by_contract,
)
from marketflow.operators.enrich import bars_from_messages, enrich  # noqa: F401
from marketflow.operators.incremental import (  # noqa: F401
    JdbcWarehouse, ParquetWarehouse, Warehouse, lake_cut, load_increment, new_rows, read_cut,
)
from marketflow.operators.master import clean_master, latest_per_ticker  # noqa: F401
from marketflow.operators.news import flatten_articles, keep_tickers, zip_explode  # noqa: F401
from marketflow.operators.rows import count_rows, dedupe_rows, union_to_schema  # noqa: F401
from marketflow.operators.signals import (  # noqa: F401
    daily_return, daily_sentiment, guarded_pearson, next_trading_day, sentiment_price_corr,
)
from marketflow.operators.sizing import spread  # noqa: F401
