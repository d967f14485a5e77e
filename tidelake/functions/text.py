"""String and parsing functions, ``Column`` in and ``Column`` out, all inside code generation."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns and formats that define what counts as clean.
SPECIAL_CHARACTERS = r"[^\w\s-]"
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
NOT_NUMERIC = r"[^\d.-]"
NOT_LOCATION_CODE = r"[^A-Z0-9]"
COUNTRY_CODE = "+1"
DATE_FORMAT = "%Y-%m-%d"
DATETIME_FORMAT = "%Y-%m-%d %H:%M:%S"

# strftime directive -> Java date-time pattern.
_STRFTIME = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "p": "a",
             "j": "DDD", "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "f": "SSSSSS", "z": "xx", "%": "%"}


def java_pattern(fmt: str) -> str:
    """Translate a strftime format; text that Java would read as pattern letters is quoted."""
    out, i = [], 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            directive = fmt[i + 1]
            if directive not in _STRFTIME:
                raise ValueError(f"unsupported date directive %{directive}")
            out.append(_STRFTIME[directive])
            i += 2
        else:
            out.append(f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i])
            i += 1
    return "".join(out)


def strip_whitespace(c: Column) -> Column:
    """Strip every kind of white space (``trim`` removes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def standardize(c: Column, uppercase: bool = True, strip: bool = True, remove_special: bool = False,
                pattern: str = SPECIAL_CHARACTERS) -> Column:
    """Trim, upper-case, then drop special characters; ``\\w`` covers Unicode letters."""
    if strip:
        c = strip_whitespace(c)
    if uppercase:
        c = F.upper(c)
    if remove_special:
        c = F.regexp_replace(c, f"(?U){pattern}", "")
    return c


def clean_phone(c: Column, country_code: str = COUNTRY_CODE) -> Column:
    """Country code and the last ten digits; NULL when there are fewer than ten."""
    digits = F.regexp_replace(c, r"[^0-9]", "")
    return F.when(F.length(digits) >= 10, F.concat(F.lit(country_code), F.right(digits, F.lit(10))))


def clean_email(c: Column) -> Column:
    """Lower-cased and trimmed address; NULL when it is not an address."""
    tidy = strip_whitespace(F.lower(c))
    return F.when(tidy.rlike(EMAIL), tidy)


def location_code(c: Column) -> Column:
    return F.regexp_replace(F.upper(strip_whitespace(c)), NOT_LOCATION_CODE, "")


def parse_date(c: Column, fmt: str = DATE_FORMAT, strict: bool = False) -> Column:
    pattern = java_pattern(fmt)
    return F.to_date(c, pattern) if strict else F.try_to_date(c, pattern)


def parse_datetime(c: Column, fmt: str = DATETIME_FORMAT, strict: bool = False) -> Column:
    pattern = F.lit(java_pattern(fmt))
    parsed = F.to_timestamp_ntz(c, pattern) if strict else F.try_to_timestamp(c, pattern)
    return parsed.cast("timestamp_ntz")


def parse_number(c: Column, dtype: str = "double") -> Column:
    """Drop everything but digits, points and minus signs, then cast leniently."""
    return F.regexp_replace(c.cast("string"), NOT_NUMERIC, "").try_cast(dtype)


def row_hash(columns: Sequence[str | Column]) -> Column:
    """MD5 over the ``|``-joined text of the columns; NULL counts as the empty string."""
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *texts))


def json_path(c: Column, path: str, dtype: str = "string") -> Column:
    """Value at a dotted path inside a JSON text; NULL when absent or not castable."""
    return F.get_json_object(c, "$." + path).try_cast(dtype)


def horizontal_sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
