"""Column-level helpers: every function takes and returns a Column."""

from tickflow.functions.numeric import (  # noqa: F401
    rnd, ratio, price_round, price_decimals, since, trunc_ts, exact_mean_gt,
)
from tickflow.functions.alerts import (  # noqa: F401
    price_alert, alert_severity, risk_level, anomaly_type,
)
