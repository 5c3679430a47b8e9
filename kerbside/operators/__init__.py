from kerbside.operators.carpool import carpool_gains, carpool_groups, carpool_summary, slot_groups
from kerbside.operators.core import (
    Tally,
    count_all,
    count_by,
    count_flags,
    lookup_zone,
    mean_by,
    numeric_stats,
    tally,
    top_k,
)
from kerbside.operators.fare_model import (
    day_index,
    fare_model_checks,
    fare_model_metrics,
    fare_prediction_sample,
    fare_predictions,
    fare_sample_rows,
    fit_fare_model,
    ml_dataset,
    split,
    split_counts,
)
from kerbside.operators.features import (
    anomaly_counts,
    feature_table,
    feature_trips_by_hour,
    revenue_by_hour,
    with_zone_frequency,
    zone_frequency,
)
from kerbside.operators.heatmap import (
    heatmap,
    heatmap_hourly,
    heatmap_kpis,
    heatmap_pivot,
    heatmap_top_zones,
    keep_busiest,
)
from kerbside.operators.payments import (
    payment_comparison,
    payment_distribution,
    tip_stats,
    tips_by_day,
    tips_by_hour,
)
from kerbside.operators.profile import null_profile, outlier_counts, profile_row, profile_summary
from kerbside.operators.quality import (
    described_columns,
    distance_duration_stats,
    enrich_trips,
    speed_by_day,
    speed_by_hour,
    trip_category_dist,
)
from kerbside.operators.spatial import hotspots, od_flows, top_zones, trips_by_day, trips_by_hour
