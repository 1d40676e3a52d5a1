"""Entity registry: one spec per source table drives every job.

The spec says how the wire record is typed (``fields``), which keys must be
present (``required``), how the latest change is chosen (``order_col`` plus
``tiebreak``), and which columns open a new SCD2 version (``check_cols``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Field kinds: how a wire value becomes a staged value.
#   string   - text
#   int      - integer
#   lower    - text, lower-cased
#   ts_us    - integer microseconds since 1970 -> TIMESTAMP_NTZ
#   days     - integer day count from the spec's date base -> DATE
#   fee      - double -> scale-0 numeric (rounded, see functions.types)


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: str
    required: tuple[str, ...]
    order_col: str
    fields: tuple[tuple[str, str], ...]
    check_cols: tuple[str, ...]
    load_timestamp: bool = True
    wire_types: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [n for n, _ in self.fields]

    def kind(self, name: str) -> str:
        return dict(self.fields)[name]


# Fixed values that must equal the reference's for right results:
# entity keys, required keys, ranking columns, tracked (check) columns and
# the staged column order of the four source tables.
APPOINTMENT_EVENTS = EntitySpec(
    name="appointment_events",
    key="appointment_id",
    required=("appointment_id", "patient_id"),
    order_col="event_timestamp",
    fields=(
        ("appointment_id", "string"),
        ("patient_id", "string"),
        ("doctor_id", "string"),
        ("hospital_id", "string"),
        ("event_type", "lower"),
        ("appointment_time", "ts_us"),
        ("event_timestamp", "ts_us"),
        ("consultation_fee", "fee"),
    ),
    check_cols=(),
    load_timestamp=False,
)

DOCTOR = EntitySpec(
    name="doctor",
    key="doctor_id",
    required=("doctor_id", "hospital_id"),
    order_col="created_at",
    fields=(
        ("doctor_id", "string"),
        ("hospital_id", "string"),
        ("doctor_name", "string"),
        ("specialty", "string"),
        ("experience_years", "int"),
        ("created_at", "ts_us"),
    ),
    check_cols=("doctor_name", "specialty", "experience_years"),
)

HOSPITAL = EntitySpec(
    name="hospital",
    key="hospital_id",
    required=("hospital_id",),
    order_col="created_at",
    fields=(
        ("hospital_id", "string"),
        ("hospital_name", "string"),
        ("city", "string"),
        ("country", "string"),
        ("bed_capacity", "int"),
        ("created_at", "ts_us"),
    ),
    check_cols=("hospital_name", "city", "country", "bed_capacity"),
)

PATIENT = EntitySpec(
    name="patient",
    key="patient_id",
    required=("patient_id",),
    order_col="created_at",
    fields=(
        ("patient_id", "string"),
        ("patient_name", "string"),
        ("gender", "string"),
        ("date_of_birth", "days"),
        ("city", "string"),
        ("created_at", "ts_us"),
    ),
    check_cols=("patient_name", "gender", "date_of_birth", "city"),
)

ENTITIES = {s.name: s for s in (PATIENT, DOCTOR, HOSPITAL, APPOINTMENT_EVENTS)}

# Routing order when a file is matched to a table by its name prefix.
PREFIX_ROUTING_ORDER = ("patient", "doctor", "hospital", "appointment_events")

# Wire (change-event) types of the source rows.
WIRE_TYPES = {
    "appointment_events": [
        ("event_id", "string"), ("appointment_id", "string"), ("patient_id", "string"),
        ("doctor_id", "string"), ("hospital_id", "string"), ("event_type", "string"),
        ("appointment_time", "bigint"), ("event_timestamp", "bigint"),
        ("consultation_fee", "double"),
    ],
    "patient": [
        ("patient_id", "string"), ("patient_name", "string"), ("gender", "string"),
        ("date_of_birth", "int"), ("city", "string"), ("created_at", "bigint"),
    ],
    "doctor": [
        ("doctor_id", "string"), ("hospital_id", "string"), ("doctor_name", "string"),
        ("specialty", "string"), ("experience_years", "int"), ("created_at", "bigint"),
    ],
    "hospital": [
        ("hospital_id", "string"), ("hospital_name", "string"), ("city", "string"),
        ("country", "string"), ("bed_capacity", "int"), ("created_at", "bigint"),
    ],
}


def wire_ddl(table: str) -> str:
    return ", ".join(f"{n} {t}" for n, t in WIRE_TYPES[table])


# Fixed values that must equal the reference's for right results:
# the domains its entry forms enforce.
EVENT_TYPES = ("BOOKED", "CONFIRMED", "CANCELLED", "COMPLETED")
SPECIALTIES = ("Cardiology", "Neurology", "Oncology", "Orthopedics", "Emergency")
GENDERS = ("Male", "Female", "Other")
EXPERIENCE_YEARS_RANGE = (0, 60)
MIN_BED_CAPACITY = 1
MIN_FEE = 0
