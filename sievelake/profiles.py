"""What to check, declared as data.

A profile names the columns a source must have, how they are renamed, and the
rules rows are held to. A rule is a SQL predicate over canonical column names,
so a new table needs a new profile and no new code.
"""

from __future__ import annotations

from dataclasses import dataclass

VALID = "VALID"
WARNING = "WARNING"
QUARANTINE = "QUARANTINE"


@dataclass(frozen=True)
class Rule:
    """`code` is reported for rows where the SQL text `fires_when` is true; null means it does not fire."""

    code: str
    severity: str
    fires_when: str


@dataclass(frozen=True)
class Profile:
    name: str
    renames: dict[str, str]
    required: tuple[str, ...]
    rules: tuple[Rule, ...]
    columns: tuple[tuple[str, str], ...]

    @property
    def curated_ddl(self) -> str:
        """Column list of the curated table, without its partition columns."""
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns + ADDED_COLUMNS)

    def rules_of(self, severity: str) -> list[Rule]:
        return [rule for rule in self.rules if rule.severity == severity]


# Source column names and their canonical names.
TRIP_RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_forward_flag",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "Airport_fee": "airport_fee",
    "cbd_congestion_fee": "cbd_congestion_fee",
}

# Source columns without which a batch is refused.
TRIP_REQUIRED = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
    "total_amount",
)

# Reason codes, their order and their severities. The day limit
# compares whole seconds on each side, as results depend on it.
TRIP_RULES = (
    Rule("MISSING_PICKUP_DATETIME", QUARANTINE, "pickup_datetime IS NULL"),
    Rule("MISSING_DROPOFF_DATETIME", QUARANTINE, "dropoff_datetime IS NULL"),
    Rule("INVALID_TIME_RANGE", QUARANTINE, "dropoff_datetime < pickup_datetime"),
    Rule("NEGATIVE_TRIP_DISTANCE", QUARANTINE, "trip_distance < 0"),
    Rule("MISSING_PICKUP_LOCATION", QUARANTINE, "pickup_location_id IS NULL"),
    Rule("MISSING_DROPOFF_LOCATION", QUARANTINE, "dropoff_location_id IS NULL"),
    Rule("ZERO_TRIP_DISTANCE", WARNING, "trip_distance = 0"),
    Rule("NEGATIVE_FARE_AMOUNT", WARNING, "fare_amount < 0"),
    Rule("NEGATIVE_TOTAL_AMOUNT", WARNING, "total_amount < 0"),
    Rule(
        "TRIP_OVER_24_HOURS",
        WARNING,
        "unix_timestamp(dropoff_datetime) - unix_timestamp(pickup_datetime) > 86400",
    ),
)

# Canonical columns and their types, in table order.
TRIP_COLUMNS = (
    ("vendor_id", "INT"),
    ("pickup_datetime", "TIMESTAMP"),
    ("dropoff_datetime", "TIMESTAMP"),
    ("passenger_count", "BIGINT"),
    ("trip_distance", "DOUBLE"),
    ("rate_code_id", "BIGINT"),
    ("store_and_forward_flag", "STRING"),
    ("pickup_location_id", "INT"),
    ("dropoff_location_id", "INT"),
    ("payment_type", "BIGINT"),
    ("fare_amount", "DOUBLE"),
    ("extra", "DOUBLE"),
    ("mta_tax", "DOUBLE"),
    ("tip_amount", "DOUBLE"),
    ("tolls_amount", "DOUBLE"),
    ("improvement_surcharge", "DOUBLE"),
    ("total_amount", "DOUBLE"),
    ("congestion_surcharge", "DOUBLE"),
    ("airport_fee", "DOUBLE"),
    ("cbd_congestion_fee", "DOUBLE"),
)

# Columns the checks and the lineage stamp add after the canonical ones.
ADDED_COLUMNS = (
    ("quarantine_reasons", "ARRAY<STRING>"),
    ("warning_reasons", "ARRAY<STRING>"),
    ("validation_status", "STRING"),
    ("source_file", "STRING"),
    ("batch_id", "STRING"),
    ("schema_version", "STRING"),
    ("ingested_at", "STRING"),
)

TRIPS = Profile(
    name="trips",
    renames=TRIP_RENAMES,
    required=TRIP_REQUIRED,
    rules=TRIP_RULES,
    columns=TRIP_COLUMNS,
)
