"""Column functions: great-circle geometry (``geo``), zone-free time
conversions (``timefn``) and the exact ``(timestamp, seq)`` key (``ordering``).
"""

from groundtrack.functions.geo import haversine_km, haversine_sql  # noqa: F401
from groundtrack.functions.timefn import epoch_seconds, to_event_time, ts_to_epoch  # noqa: F401
from groundtrack.functions.ordering import order_key  # noqa: F401
