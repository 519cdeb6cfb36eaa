"""Column expressions. All built-in Spark functions: no Python UDFs, so every
expression stays inside whole-stage code generation."""

from .keys import fold, null_safe_match
from .nested import first_location_code, first_location_country, last_manager_email
from .paths import parse_watermark, path_part
from .people import age, age_band, as_of_column, on_day

__all__ = [
    "age",
    "age_band",
    "as_of_column",
    "first_location_code",
    "first_location_country",
    "fold",
    "last_manager_email",
    "null_safe_match",
    "on_day",
    "parse_watermark",
    "path_part",
]
