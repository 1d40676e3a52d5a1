"""Presentation-level derivations the dashboard pages compute per row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed values that must equal the reference's for right results:
# status badge classes, gender classes, the label separator and suffix.
STATUS_CLASSES = ("BOOKED", "CONFIRMED", "CANCELLED")   # anything else -> completed
GENDER_CLASSES = ("Male", "Female")                     # anything else -> Other
LABEL_SEPARATOR = " — "                            # id — name
YEARS_FORMAT = "%d yrs"


def status_class(c) -> Column:
    u = F.upper(_c(c))
    out = F.lit("completed")
    for s in reversed(STATUS_CLASSES):
        out = F.when(u == s, F.lit(s.lower())).otherwise(out)
    return out


def gender_class(c) -> Column:
    g = _c(c)
    return (F.when(g == GENDER_CLASSES[0], F.lit(GENDER_CLASSES[0]))
             .when(g == GENDER_CLASSES[1], F.lit(GENDER_CLASSES[1]))
             .otherwise(F.lit("Other")))


def fee_text(c) -> Column:
    """``$`` + two decimals; rounds the exact binary value half-even like printf."""
    return F.concat(F.lit("$"), F.regexp_replace(F.format_number(_c(c).cast("double"), 2), ",", ""))


def minute_text(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm")


def id_name_label(id_col, name_col) -> Column:
    return F.concat(_c(id_col), F.lit(LABEL_SEPARATOR), _c(name_col))


def years_label(c) -> Column:
    return F.format_string(YEARS_FORMAT, _c(c))


def no_show_flag(c) -> Column:
    return F.when(F.lower(_c(c)) == "no_show", F.lit(1)).otherwise(F.lit(0))
