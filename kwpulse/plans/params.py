"""Parameters of the registered queries (shared by the Spark side and the oracle)."""

from __future__ import annotations

import datetime as _dt

from kwpulse.functions import dims

# The driver tables span 2024-01-01 .. 2024-01-30; "now" is pinned after them.
AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)
EARLIER = _dt.datetime(2024, 1, 20, 15, 30, 0)
DEMO_LIMIT = 25

# The scheduler's growth parameters (likes / comments / shares / views minimums).
SCHEDULED_MINIMUMS = dict(min_likes=50, min_comments=5, min_shares=2, min_views=1000)

GROWTH = {
    # The scheduled job as configured: hourly, threshold 0.5, minimums, top 20.
    "growth_scheduled": dict(time_window="hourly", threshold=0.5, limit=20, **SCHEDULED_MINIMUMS),
    # Threshold 0 admits single new mentions, so the CASE branches all meet data.
    "growth_hourly": dict(time_window="hourly", threshold=0.0, limit=20),
    "growth_daily": dict(time_window="daily", threshold=0.5, limit=20),
    "growth_weekly": dict(time_window="weekly", threshold=0.5, limit=50, **SCHEDULED_MINIMUMS),
    "growth_filtered": dict(time_window="weekly", threshold=0.0, region="CN", category="BUILDING",
                            limit=20),
}
# The scheduled runs of a period, caught up in one pass.
CATCH_UP = {
    "growth_catch_up": dict(first=_dt.datetime(2024, 1, 2), last=AS_OF, time_window="hourly", threshold=0.5, limit=20),
    "growth_catch_up_daily": dict(first=_dt.datetime(2024, 1, 3), last=AS_OF, time_window="daily", threshold=0.5, limit=20,
                                  **SCHEDULED_MINIMUMS),
}
GROWTH_ROWS = dict(time_window="daily", threshold=0.5, limit=20)

BACKTEST_DAYS_BACK = 7
BACKTEST_HORIZON = 3

# API / dashboard selections.
REGIONS = ["US", "CN", "BR", "UK"]
CATEGORIES = ["BUILDING", "MACHINERY", "HOUSEHOLD"]
MODALITIES = ["click", "view", "purchase"]
START = _dt.datetime(2024, 1, 10)
END = _dt.datetime(2024, 1, 20)
API_TOP_N = 50
DASH_TOP_N = 20

# The collector's grid; some of its cells have no data.
GRID_REGIONS = ["US", "CN", "BR", "DE", "FR", "JP", "UK", "KR", "XX"]
GRID_CATEGORIES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "memes"]
STOPWORD_SHARE = 0.3

# Workbook sheets; each selection leaves some members of the driver data out.
WB_TOP_N = 10
WB_MIN_TOTAL = 10_000  # drops rows at sf0.01
WB_MAX_TOTAL = 125_000  # drops rows at sf0.1
WB_SCATTER_TOP_N = 30
WB_CATEGORIES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
WB_MODALITIES = ["click", "purchase", "signup", "view"]
WB_EXCLUDED_REGIONS = dims.WORKBOOK_EXCLUDED_REGIONS + ["CN"]
WB_REGION_SET = dims.WORKBOOK_REGION_SET + ["JP"]

SAMPLE_N = 200
SAMPLE_SEED = 42
TOP_K = 20
