"""Typing helpers: wire values (variant paths, epoch integers) -> SQL types.

All are built-in Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's for right results.
PATIENT_DATE_BASE = "2000-01-01"   # day-number base of the patient staging model
UNIX_DATE_BASE = "1970-01-01"      # change-capture date convention (documented alternative)
PARITY_FEE_TYPE = "decimal(38,0)"  # fee cast to scale-0 numeric, rounds half-up



def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ts_lit(text: str) -> Column:
    """A TIMESTAMP_NTZ literal (wall-clock, no zone)."""
    return F.lit(text).cast("timestamp_ntz")


def micros_to_ts(c) -> Column:
    """Integer microseconds since 1970 -> TIMESTAMP_NTZ, exact and zone-free."""
    return F.timestamp_add("MICROSECOND", _c(c), _epoch())


def ts_to_micros(c) -> Column:
    """TIMESTAMP_NTZ -> integer microseconds since 1970 (inverse of above)."""
    return F.timestamp_diff("MICROSECOND", _epoch(), _c(c).cast("timestamp_ntz"))


def days_to_date(c, base: str = PATIENT_DATE_BASE) -> Column:
    """Day count -> DATE counted from ``base``."""
    return F.date_add(F.lit(base).cast("date"), _c(c).cast("int"))


def to_fee(c, fee_type: str = PARITY_FEE_TYPE) -> Column:
    return _c(c).cast(fee_type)


def id_number(c) -> Column:
    """Numeric suffix of an id like ``E000123`` (compares correctly past 999999); NULL if it is no number."""
    return F.substring(_c(c), 2, 1 << 30).try_cast("bigint")


def wire_value(df_cols: list[str], name: str, wire_type: str) -> Column:
    """A wire field either from a variant column ``v`` or a typed column.

    ``try_variant_get`` treats JSON null, a missing key and a bad value alike
    (SQL NULL), which is what the required-key filters need.
    """
    if "v" in df_cols and name not in df_cols:
        return F.try_variant_get(F.col("v"), f"$.{name}", wire_type)
    return F.col(name).cast(wire_type)
