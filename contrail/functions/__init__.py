"""Column-level helpers: each returns a ``pyspark.sql.Column`` built from
built-in Spark functions, so it stays inside whole-stage codegen."""

from contrail.functions.calendar import (  # noqa: F401
    date_from_numbers, daypart, flight_date, is_peak_hour, is_weekend, iso_week, iso_year, season,
)
from contrail.functions.flags import (  # noqa: F401
    as_int, distance_category, flag_eq, flag_gt, rate,
)
from contrail.functions.hhmm import (  # noqa: F401
    hhmm_normalise, hhmm_string, hour_from_hhmm, is_hhmm, zfill,
)
from contrail.functions.risk import recommended_action, risk_level  # noqa: F401
from contrail.functions.text import (  # noqa: F401
    has_control_chars, is_blank, is_digits_only, special_char_count,
)
