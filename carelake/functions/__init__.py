from .types import (  # noqa: F401
    PATIENT_DATE_BASE, UNIX_DATE_BASE, PARITY_FEE_TYPE,
    micros_to_ts, ts_to_micros, days_to_date, to_fee, ts_lit, id_number,
    wire_value,
)
from .display import (  # noqa: F401
    status_class, gender_class, fee_text, minute_text, id_name_label, years_label,
    no_show_flag,
)
