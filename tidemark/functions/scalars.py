"""Column expressions: dates, text, JSON, safe arithmetic, hashing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"

# Words removed from a culture name, matched anywhere and in any case.
CULTURE_NOISE = "(?i)(Western|Eastern|North(ern)?|Central|Upper|probably)|,.*"
# Fixed value: first "{" to last "}".
JSON_BLOCK = r"\{[\s\S]*\}"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Exact decimal, so that sums do not depend on the order of the rows."""
    return col(c).cast(MONEY)


def mean_of(total: Column, n: Column) -> Column:
    """Mean as double from an exact total; NULL for an empty group."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def dates_array(dates: Sequence[date | str]) -> Column:
    return F.array(*[F.lit(str(d)).cast("date") for d in dates])


def timestamps_array(stamps: Sequence[datetime | str]) -> Column:
    return F.array(*[F.lit(str(s)).cast("timestamp_ntz") for s in stamps])


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(col(ts))


def day_of_week(ts: Column | str) -> Column:
    """1 is Sunday."""
    return F.dayofweek(col(ts))


def month_key(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def run_day(run_ts: Column, tz: str) -> Column:
    """The day before the run, on the calendar of ``tz``; ``run_ts`` is a UTC wall time.

    Wall times are used throughout, so the session's own zone plays no part.
    """
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), run_ts.cast("timestamp_ntz"))
    return F.date_sub(F.to_date(local), 1)


def clip_low(c: Column | str, floor: float = 0.0) -> Column:
    """``greatest(floor, c)`` that stays NULL for NULL (Spark's own skips NULLs)."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(floor), c))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def to_whole(c: Column | str) -> Column:
    """Number to bigint with rounding (a plain cast would truncate)."""
    return F.round(col(c)).cast("bigint")


def first_part(c: Column | str, separator: str) -> Column:
    """Text before the first literal ``separator``."""
    return F.split_part(col(c), F.lit(separator), F.lit(1))


def last_path_segment(c: Column | str) -> Column:
    """Text after the last slash."""
    return F.element_at(F.split(col(c), "/"), -1)


def normalize_culture(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(first_part(c, " ("), CULTURE_NOISE, ""))


def century_of(year: Column | str) -> Column:
    """``floor(year / 100) + 1`` as double; 1900 counts as century 20."""
    return (F.floor(col(year) / F.lit(100)) + 1).cast("double")


def json_block(c: Column | str) -> Column:
    """From the first ``{`` to the last ``}``; NULL without a match."""
    return F.regexp_substr(col(c), F.lit(JSON_BLOCK))


def parse_json_safe(c: Column | str) -> Column:
    """VARIANT, or NULL for text that is not JSON."""
    return F.try_parse_json(col(c))


def json_value(variant: Column | str, path: str) -> Column:
    """Scalar at ``path`` as text; NULL for a missing path, an object or an array."""
    variant = col(variant)
    text = F.try_variant_get(variant, path, "string")
    kind = F.schema_of_variant(F.try_variant_get(variant, path, "variant"))
    # The kind is only looked up for text that could be an object or array.
    return F.when(~(text.startswith("{") | text.startswith("[")), text).when(
        ~(kind.startswith("OBJECT") | kind.startswith("ARRAY")), text
    )


def json_double(variant: Column | str, path: str, strict: bool = True) -> Column:
    """Scalar at ``path`` as double; text that is no number raises unless not ``strict``."""
    text = json_value(variant, path)
    return text.cast("double") if strict else text.try_cast("double")


def stable_hash(*cols: Column | str) -> Column:
    """Non-negative bigint from the md5 of the text form; other engines can repeat it.

    NULL is text of its own, so that it keeps its place among the columns.
    """
    text = F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("\\N")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def unit_draw(*cols: Column | str) -> Column:
    """Repeatable number in [0, 1) with six decimals, a function of ``cols`` alone."""
    return (stable_hash(*cols) % F.lit(1_000_000)).cast("double") / F.lit(1_000_000.0)


def fill_template(template: str, markers: dict[str, Column | str]) -> Column:
    """Replace each marker in turn.

    Later markers also match inside texts put in earlier; NULL text gives NULL.
    """
    out = F.lit(template)
    for marker, c in markers.items():
        out = F.replace(out, F.lit(marker), col(c))
    return out


def words(c: Column | str) -> Column:
    """Tokens between white space; NULL and blank text give an empty array."""
    return F.filter(F.split(F.coalesce(col(c), F.lit("")), r"\s+"), lambda w: w != "")
