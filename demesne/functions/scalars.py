"""Column expressions for catalog values: packed dates, codes, sizes, names, text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: job-history and schedule codes and their labels ---
RUN_STATUS = {0: "Failed", 1: "Succeeded", 2: "Retry", 3: "Canceled", 4: "In Progress"}
STEP_ACTION = {
    1: "Quit With Success",
    2: "Quit With Failure",
    3: "Go To Next Step",
    4: "Go To Step",
}
NOTIFY_LEVEL = {0: "Never", 1: "Always", 2: "On Failure", 3: "On Success"}
SCHEDULE_TYPE = {
    1: "Once",
    4: "Daily",
    8: "Weekly",
    16: "Monthly",
    32: "Monthly Relative",
    64: "Start Automatically When SQL Server Agent Starts",
    128: "Start Whenever CPU Is Idle",
}
SCHEDULE_TYPES_WITH_INTERVAL = (4, 8, 16)
REDACTED = "***REDACTED***"

LINE_BREAK = r"\r\n|[\n\r\u000B\f\u001C-\u001E\u0085\u2028\u2029]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- dates and times packed into integers ---


def decode_int_date(c: Column | str) -> Column:
    """20240615 -> '2024-06-15'; 0 and NULL mean no date."""
    c = _col(c)
    digits = F.lpad(c.cast("string"), 8, "0")
    parts = [F.substring(digits, start, size) for start, size in ((1, 4), (5, 2), (7, 2))]
    return F.when(c != 0, F.concat_ws("-", *parts))


def decode_int_time(c: Column | str) -> Column:
    """91530 -> '09:15:30'; 0 is midnight, only NULL is missing."""
    c = _col(c)
    digits = F.lpad(c.cast("string"), 6, "0")
    parts = [F.substring(digits, start, 2) for start in (1, 3, 5)]
    return F.when(c.isNotNull(), F.concat_ws(":", *parts))


def combine_date_time(day: Column, time: Column) -> Column:
    """ISO instant from the two decoded halves; a missing time is midnight."""
    return F.when(day.isNotNull(), F.concat_ws("T", day, F.coalesce(time, F.lit("00:00:00"))))


def iso_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss")


def latest_of(*cols: Column | str) -> Column:
    """Latest of several nullable instants, NULL only when all are."""
    return F.greatest(*[_col(c) for c in cols])


# --- codes and flags ---


def map_code(c: Column | str, labels: dict[int, str], default: str | None = None) -> Column:
    """Label of a code; unknown codes give the default (NULL unless stated)."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    label = F.try_element_at(F.create_map(*pairs), _col(c).cast("int"))
    return label if default is None else F.coalesce(label, F.lit(default))


def schedule_label(kind: Column | str, interval: Column | str) -> Column:
    kind, interval = _col(kind), _col(interval)
    label = map_code(kind, SCHEDULE_TYPE, "Unknown")
    shown = kind.isin(*SCHEDULE_TYPES_WITH_INTERVAL) & (interval != 0)
    return F.when(shown, F.concat(label, F.lit(" (interval="), interval.cast("string"), F.lit(")"))).otherwise(label)


def tri_state(c: Column | str) -> Column:
    """0/1 to a flag; NULL means not known and stays NULL."""
    return _col(c).cast("boolean")


def state_is(c: Column | str, on: str = "ON") -> Column:
    return _col(c) == on


def inverted(c: Column | str) -> Column:
    """Flag stored the other way round; unknown counts as unset before inverting."""
    return ~F.coalesce(_col(c).cast("boolean"), F.lit(False))


def choose(flag: Column | str, yes: str, no: str) -> Column:
    """Two-way category label; anything but a true flag is the second."""
    return F.when(_col(flag), yes).otherwise(no)


def or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0)).cast("bigint")


def or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.array().cast("array<string>"))


def null_if(c: Column | str, sentinel) -> Column:
    return F.nullif(_col(c), F.lit(sentinel))


# --- sizes and shares ---


def pages_to_mb(pages: Column | str) -> Column:
    """8 KB pages to MB, two decimals, halves to even as floats of 1/128 round."""
    exact = _col(pages).cast("decimal(20,0)") * F.lit("0.0078125").cast("decimal(8,7)")
    return F.bround(exact, 2).cast("double")


def growth_value(growth: Column | str, is_percent: Column | str) -> Column:
    """Growth setting in percent or MB, as the flag says."""
    return F.when(_col(is_percent), F.round(_col(growth).cast("double"), 2)).otherwise(pages_to_mb(growth))


def cents(c: Column | str) -> Column:
    """Two-decimal amount as an exact whole number."""
    return F.round(_col(c) * 100).cast("bigint")


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """part/whole in percent to two decimals on whole numbers, halves to even.

    NULL when the whole is NULL or 0. All steps are integral, so the result
    does not depend on the order in which the sums were formed.
    """
    part, whole = _col(part).cast("decimal(38,0)"), _col(whole).cast("decimal(38,0)")
    scaled = part * F.lit(10000).cast("decimal(5,0)")
    quotient = F.call_function("div", scaled, F.nullif(whole, F.lit(0)))
    rest = scaled - quotient.cast("decimal(38,0)") * whole
    twice = rest * F.lit(2).cast("decimal(1,0)")
    up = (twice > whole) | ((twice == whole) & (quotient % 2 == 1))
    return (quotient + F.when(up, 1).otherwise(0)) / F.lit(100.0)


# --- names ---


def qualify(*parts: Column | str) -> Column:
    """Dotted name; missing and empty parts are left out."""
    return F.concat_ws(".", *[F.nullif(_col(p), F.lit("")) for p in parts])


def name_key(c: Column | str) -> Column:
    """Comparison key of a name: no brackets, no outer blanks, lower case."""
    return F.lower(F.regexp_replace(F.trim(_col(c)), r"[\[\]]", ""))


def bare_name(c: Column | str) -> Column:
    """Last part of a dotted name."""
    return F.regexp_extract(_col(c), r"([^.]*)$", 1)


def type_key(c: Column | str) -> Column:
    """Bare lower-case type name out of free text such as 'NVARCHAR(200)'."""
    return F.lower(F.regexp_extract(_col(c), r"^\s*\[?(\w+)", 1))


def drop_suffix(c: Column | str, suffix: str) -> Column:
    c = _col(c)
    ends = F.lower(c).endswith(suffix.lower())
    return F.when(ends, F.left(c, F.length(c) - len(suffix))).otherwise(c)


def last_path_part(c: Column | str, separator: str = "\\") -> Column:
    return F.substring_index(_col(c), separator, -1)


# --- text ---


def redact(c: Column | str) -> Column:
    """Blank the secret in a connection string up to the next semicolon."""
    return F.regexp_replace(_col(c), r"(?i)(password|pwd)\s*=\s*[^;]*", "$1=" + REDACTED)


def line_count(c: Column | str) -> Column:
    """Number of lines; a final line break opens no further line."""
    c = F.regexp_replace(_col(c), LINE_BREAK, "\n")
    breaks = F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))
    open_line = (F.length(c) > 0) & ~c.endswith("\n")
    return (breaks + open_line.cast("int")).cast("bigint")


def fingerprint(*cols: Column | str) -> Column:
    """SHA-256 over columns joined by ':'; NULL counts as the empty text."""
    texts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws(":", *texts), 256)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
