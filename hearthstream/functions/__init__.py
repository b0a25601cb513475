"""Column helpers: scalar functions and schemaless-JSON functions."""

from hearthstream.functions.scalars import (  # noqa: F401
    confidence_percent,
    day_windows,
    epoch_to_timestamp,
    equal_fold,
    first_matching,
    integer_or_zero,
    millis_to_seconds,
    nullif_empty,
    nullif_zero,
    numeric_text,
    parse_timestamp,
    record_date,
    sanitize_name,
    sha256_hex,
    start_of_week,
    strip_suffix,
    text_before,
    valid_window,
)
from hearthstream.functions.documents import (  # noqa: F401
    as_number,
    as_text,
    enveloped,
    field,
    is_json_null,
    is_kind,
    merge_json,
    only_value,
    parse_json_value,
    tag_type,
    value_kind,
)
