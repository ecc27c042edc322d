"""Text clean-up and lookup expressions."""

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


# The blanks a text is trimmed of (Unicode white space and separators)
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body names it.

    Catalyst writes a column out at each place that names it, and the JVM doesn't compile a method
    that grows too long by that.
    """
    return F.transform(F.array(value), body)[0]


def strip(col: Column) -> Column:
    """Trim every Unicode blank, not only spaces."""
    trimmed = F.trim(col)
    first, last = F.ascii(trimmed), F.ascii(F.right(trimmed, F.lit(1)))
    plain = first.between(33, 126) & last.between(33, 126)  # the usual case, and cheap to see
    return F.when(plain, trimmed).otherwise(F.btrim(col, F.lit(BLANKS)))


def title_case(col: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    Where runs are parted by spaces alone, or by signs that no letter follows, `initcap` does that in
    one pass; only other texts are cut into runs.
    """
    runs = F.regexp_extract_all(col, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    cut = F.array_join(F.transform(runs, F.initcap), "")
    return F.when(col.rlike(r"[^\p{L} ]\p{L}"), cut).otherwise(F.initcap(col))


def lookup(col: Column, table: Mapping[str, str]) -> Column:
    """Value for a key of a small constant table, NULL for any other key."""
    constant = F.from_json(F.lit(json.dumps(table)), "map<string,string>")  # folded once
    return F.try_element_at(constant, col)


def lookup_or(col: Column, table: Mapping[str, str], default: Column) -> Column:
    return F.coalesce(lookup(col, table), default)


def canonical_name(col: Column, table: Mapping[str, str]) -> Column:
    """Canonical name by the trimmed lower-case key, else the name in title case."""
    return lookup_or(F.lower(strip(col)), table, title_case(strip(col)))


def is_digits(col: Column) -> Column:
    return col.rlike("^[0-9]+$")
