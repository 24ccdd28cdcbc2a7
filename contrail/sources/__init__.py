"""Sources and sinks: CSV/Parquet/catalog readers, writers, and the test views."""

from contrail.sources.files import (  # noqa: F401
    literal_table, lookup_keys, read_airlines, read_airports, read_flights, read_table,
    rewrite_in_place, save_as_table, use_catalog, write_table,
)
from contrail.sources.fixtures import flight_views  # noqa: F401
