"""tickflow — market-tick analytics on Spark (DataFrame, SQL, Structured Streaming).

Every operator takes and returns a DataFrame (or Column); nothing holds a
hidden session. Main entry points:

    from tickflow import enrich, with_alerts, bars, staging, hourly_kpis, run_checks
"""

from tickflow.functions import (  # noqa: F401
    alert_severity, price_alert, price_round, ratio, risk_level, rnd, since,
)
from tickflow.operators.alerts import alert_messages, route, with_alerts  # noqa: F401
from tickflow.operators.bars import bars, bollinger, ohlc_valid, round_bars  # noqa: F401
from tickflow.operators.history import over_history  # noqa: F401
from tickflow.operators.indicators import (  # noqa: F401
    enrich, with_quote, with_realized_vol, with_returns, with_rolling_ohlc, with_signal, with_sma,
    with_tick_anomaly, with_tick_number,
)
from tickflow.operators.market import (  # noqa: F401
    assets_by_type, latest_ticks, market_snapshot, market_summary, price_board, tick_totals, top_movers,
)
from tickflow.operators.quality import gate, not_null, report, run_checks, unknown_symbols  # noqa: F401
from tickflow.operators.versions import latest_version  # noqa: F401
from tickflow.plans.jobs import JobPaths, hourly_job  # noqa: F401
from tickflow.plans.marts import daily_anomalies, hourly_kpis, hourly_kpis_window_form  # noqa: F401
from tickflow.plans.staging import stamp, staging  # noqa: F401
from tickflow.sinks import (  # noqa: F401
    materialize, sink_alerts, sink_bars, sink_raw, write_bars, write_report,
)
from tickflow.sources import (  # noqa: F401
    decode_snapshot, decode_ticks, encode_ticks, read_bars, read_topic, split_bad,
)
from tickflow.streaming.runner import start, stream_alerts, stream_bars, stream_job, stream_raw  # noqa: F401
from tickflow.streaming.stateful import dedup, hourly_rollup, stream_indicators  # noqa: F401
