"""Number parsing, rounding and number-to-text expressions."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cropspark.fixed_values import MISSING_MARKS
from cropspark.functions.text import bound, strip

# Text is matched before it is cast: a failed cast costs an exception per row, and the
# JVM would also read "12d", "NaN" or "Infinity".
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_SPACED_DECIMAL = r"^ *[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)? *$"
_SPACED_YEAR = r"^ *[+-]?[0-9]{1,9} *\z"
_WHOLE = r"^[+-]?[0-9]+(\.0*)?$"
_POWER = r"^[+-]?[0-9]+(\.[0-9]*)?[eE][+]?[0-9]+$"
_DATE = r"^\s*[+-]?[0-9]{4,7}(-(0?[1-9]|1[0-2])(-(0?[1-9]|[12][0-9]|3[01])([ T].*)?)?)?\s*$"


def _decimal_or_null(text: Column) -> Column:
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def _whole_or_null(text: Column) -> Column:
    def whole(number: Column) -> Column:
        power = text.rlike(_POWER) & (number == F.floor(number))
        return F.when(text.rlike(_WHOLE) | power, number.try_cast("int"))

    return bound(text.try_cast("double"), whole)


def to_number(col: Column) -> Column:
    """Text or number to double; anything that is not a number becomes NULL."""
    text = col.cast("string")
    usual = F.when(text.rlike(_SPACED_DECIMAL), text.try_cast("double"))  # a cast trims spaces
    return usual.otherwise(bound(strip(text), _decimal_or_null))


def to_year(col: Column) -> Column:
    """Text or number to a nullable whole year ("2023", "2023.0" and "2.023e3" are all 2023).

    Whether a year is possible is for the range check of the caller to say; only what is not
    whole or doesn't fit an integer is NULL.
    """
    text = col.cast("string")
    usual = F.when(text.rlike(_SPACED_YEAR), text.try_cast("int"))  # a cast trims spaces
    return usual.otherwise(bound(strip(text), _whole_or_null))


def to_timestamp(col: Column) -> Column:
    """Text to a timestamp without zone; bad text becomes NULL."""
    text = col.cast("string")
    return F.when(text.rlike(_DATE), text.try_cast("timestamp_ntz"))


def parse_locale_number(
    col: Column, mode: str = "pt_BR", missing: Sequence[str] = MISSING_MARKS
) -> Column:
    """Parse a payload value; missing marks and bad text become NULL.

    ``pt_BR`` drops every "." and reads "," as the decimal point, so
    "1.234,56" is 1234.56 and "1234.5" is 12345. ``plain`` reads "1234.5" as is.
    """
    if mode not in ("pt_BR", "plain"):
        raise ValueError(f"unknown number mode {mode!r}")
    text = strip(col)
    digits = text
    if mode == "pt_BR":
        digits = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(~text.isin(*missing), _decimal_or_null(digits))


def round_half_even(col: Column, places: int = 2) -> Column:
    """Scale, round to the even neighbour, scale back, as array libraries do on doubles."""
    scale = float(10**places)
    return F.rint(col * scale) / scale


def null_if_negative(col: Column) -> Column:
    return F.when(col >= 0, col)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio, or 0 where the denominator is not positive (or is NULL)."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator)).otherwise(F.lit(0.0))


def yield_per_area(quantity: Column, area: Column) -> Column:
    """Quantity x 1000 / area; NULL where the area is 0."""
    return F.try_divide(quantity * 1000, area)


def percent_change(current: Column, previous: Column) -> Column:
    return F.try_divide((current - previous) * 100, previous)


def fixed_text(col: Column, places: int) -> Column:
    """Fixed-point text, ties to even on the exact value, without grouping."""
    return F.replace(F.format_number(col, places), F.lit(","), F.lit(""))


def card_number(col: Column) -> Column:
    """1234567 -> "1.2M", 1234 -> "1.2K"; negative numbers stay plain."""
    return (
        F.when(col >= 1e6, F.concat(fixed_text(col / 1e6, 1), F.lit("M")))
        .when(col >= 1e3, F.concat(fixed_text(col / 1e3, 1), F.lit("K")))
        .when(col.isNotNull(), fixed_text(col, 0))
    )


def axis_number(col: Column) -> Column:
    """1.5e9 -> "1.5B", 2e6 -> "2M", 3000 -> "3K", sign kept."""
    size = F.abs(col)
    return (
        F.when(size >= 1e9, F.concat(fixed_text(col / 1e9, 1), F.lit("B")))
        .when(size >= 1e6, F.concat(fixed_text(col / 1e6, 0), F.lit("M")))
        .when(size >= 1e3, F.concat(fixed_text(col / 1e3, 0), F.lit("K")))
        .when(col.isNotNull(), fixed_text(col, 0))
    )


def thousands(col: Column, places: int = 2, missing: str | None = None) -> Column:
    """1696001.0 -> "1,696,001.00"; NULL -> `missing`."""
    text = F.format_number(col, places)
    return text if missing is None else F.coalesce(text, F.lit(missing))
