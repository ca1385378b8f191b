from salesdw.functions.columns import (
    date_text,
    fill_from_date,
    fiscal_label,
    lenient_double,
    lenient_int,
    normalise_status,
    parse_date,
    replace_missing_category,
    strip_commas,
    strip_quotes,
    total_amount,
)

__all__ = [
    "date_text",
    "fill_from_date",
    "fiscal_label",
    "lenient_double",
    "lenient_int",
    "normalise_status",
    "parse_date",
    "replace_missing_category",
    "strip_commas",
    "strip_quotes",
    "total_amount",
]
