"""Table schemas and fixed domain values.

Every table the library reads has a declared schema; :func:`conform` checks a
DataFrame against one at the boundary instead of letting a bad input turn into
an empty result further down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_SECONDS = 1800
PERIOD_SHIFT_HOURS = 11

PORT_KEYS = ["evse_id", "evse_port_id"]

# ---------------------------------------------------------------------------
# The names, ranges and formulas a result must agree with.
# ---------------------------------------------------------------------------
MISSING = "Missing"
UNKNOWN = "Unknown"
TOTAL = "Total"
NOT_FUNDED = "not_funded"
OVERALL = "Overall"

# Statuses a port can report, and the derived one for an operator outage.
REPORTED_STATUSES = [
    "Charging",
    "Finishing",
    "Reserved",
    "Available",
    "Unavailable",
    "Out of order",
    "Unknown",
]
# Reported by some networks only.
RARE_STATUSES = ["Inoperative", "Blocked"]
STATUSES = REPORTED_STATUSES + RARE_STATUSES + [MISSING]

METRICS = ["Utilisation", "Uptime", "Unavailability"]
UTILISATION_PARTS = ["Charging", "Finishing", "Reserved"]
UNAVAILABILITY_PARTS_REPORT = ["Unavailable", "Out of order"]
UNAVAILABILITY_PARTS_DASHBOARD = UNAVAILABILITY_PARTS_REPORT + RARE_STATUSES

# Variables that get a mean and standard-error label.
LABELLED_VARIABLES = [
    "Utilisation",
    "Uptime",
    "Unavailability",
    "Charging",
    "Finishing",
    "Reserved",
    "Available",
    "Unavailable",
    "Out of order",
    "Unknown",
    "Missing",
]

# Inclusive postcode ranges per state.
STATE_POSTCODES = [
    ("NSW", 2000, 2599),
    ("NSW", 2619, 2899),
    ("NSW", 2921, 2999),
    ("ACT", 2600, 2618),
    ("ACT", 2900, 2920),
    ("VIC", 3000, 3996),
    ("QLD", 4000, 4999),
    ("SA", 5000, 5799),
    ("WA", 6000, 6797),
    ("TAS", 7000, 7799),
    ("NT", 800, 899),
]

# Local time zone of each state; any other state stays on UTC.
STATE_TIMEZONES = {
    "NSW": "Australia/Sydney",
    "VIC": "Australia/Melbourne",
    "QLD": "Australia/Brisbane",
    "SA": "Australia/Adelaide",
    "WA": "Australia/Perth",
    "TAS": "Australia/Hobart",
    "NT": "Australia/Darwin",
    "ACT": "Australia/Sydney",
}

# Localities that count as the unincorporated capital territory.
ACT_LOCALITIES = [
    "Dickson",
    "Mitchell",
    "Fyshwick",
    "Phillip",
    "Canberra",
    "Bruce",
    "Braddon",
    "Turner",
    "Calwell",
    "Kingston",
    "Beard",
    "Weston",
    "Strathnairn",
    "Kambah",
    "Symonston",
]
UNINCORPORATED_ACT = "Unincorporated ACT"

# ---------------------------------------------------------------------------

# One charger as the dashboard groups it (plus evse_id and the interval).
EVSE_KEYS = [
    "cpo_name",
    "address",
    "suburb",
    "postcode",
    "lga_name",
    "latitude",
    "longitude",
    "power",
    "government_funded",
    "evse_id",
]
# One site as the report groups it.
SITE_KEYS = [
    "cpo_name",
    "address",
    "suburb",
    "postcode",
    "lga_name",
    "state",
    "government_funded",
]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _I, _L, _D, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampNTZType(),
)

STATUS_LOG = _struct(
    ("evse_id", _S),
    ("evse_port_id", _S),
    ("cpo_name", _S),
    ("status", _S),
    ("update_time", _TS),
)
LOCATION = _struct(
    ("evse_id", _S),
    ("evse_port_id", _S),
    ("cpo_name", _S),
    ("address", _S),
    ("suburb", _S),
    ("postcode", _I),
    ("lga_name", _S),
    ("state", _S),
    ("latitude", _D),
    ("longitude", _D),
    ("power", _D),
)
OFFLINE = _struct(
    ("cpo_name", _S), ("offline_timestamp", _TS), ("online_timestamp", _TS)
)
AREA_CENTROIDS = _struct(("lga_code", _I), ("lat", _D), ("lon", _D), ("lga_name", _S))
AREA_LOOKUP = _struct(("google_lga_name", _S), ("lga_name", _S))
REQUIRED_STATES = _struct(("state", _S))
STATUS_DURATIONS = _struct(
    ("evse_id", _S),
    ("evse_port_id", _S),
    ("update_time", _TS),
    ("status", _S),
    ("status_duration", _L),
)

# The normalized operational tables the batch job reads.
NORMALIZED = {
    "charge_point_operators": _struct(("id", _L), ("name", _S)),
    "charge_locations": _struct(
        ("id", _L),
        ("cpo_id", _L),
        ("address_street_1", _S),
        ("address_suburb_town", _S),
        ("address_postcode", _I),
        ("lga_name", _S),
        ("address_state", _S),
        ("latitude", _D),
        ("longitude", _D),
    ),
    "charge_points": _struct(("id", _L), ("location_id", _L), ("evse_id", _S)),
    "charge_point_ports": _struct(
        ("id", _L), ("charge_point_id", _L), ("evse_port_id", _S), ("power_kilowatts", _D)
    ),
    "port_status_history": _struct(
        ("port_id", _L), ("status_type_id", _L), ("updated_timestamp", _TS)
    ),
    "port_status_types": _struct(("id", _L), ("name", _S)),
    "charge_point_operators_offline": _struct(
        ("cpo_id", _L), ("offline_timestamp", _TS), ("online_timestamp", _TS)
    ),
}


def conform(df: DataFrame, schema: T.StructType, table: str = "input") -> DataFrame:
    """Select ``schema``'s columns from ``df``, cast to its types.

    A missing column is an error here, at the boundary, rather than an empty
    table later.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks the columns {missing}; it has {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
