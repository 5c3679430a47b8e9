from kerbside.functions.derive import (
    dropoff_time,
    pickup_hour,
    pickup_time,
    pickup_weekday,
    tip_ratio,
    trip_minutes,
    trip_seconds,
    trip_speed,
    with_calendar,
    with_duration,
    with_length_class,
    with_peak_hour,
    with_speed,
    with_times,
    with_tip_ratio,
)
from kerbside.functions.rules import RULE_SETS, anomaly_flags, clean, outlier_flags
