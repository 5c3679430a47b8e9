from kerbside.sources.mapped import (
    mapped_trips,
    mapped_zones,
    trips_table,
    zones_table,
)
from kerbside.sources.readers import conform_trips, read_heatmap, read_trips, read_zone_lookup
from kerbside.sources.schema import HEATMAP_SCHEMA, TRIP_COLUMNS, TRIP_SCHEMA
from kerbside.sources.shared import (
    fresh_path,
    refresh,
    release,
    release_stored,
    session_for_shuffle,
    shared_folder,
    stored,
    written_once,
)
from kerbside.sources.sinks import write_csv, write_heatmap, write_results
