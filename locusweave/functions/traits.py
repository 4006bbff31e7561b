"""Lists of trait names as one text field, without losing a name that holds the separator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ","
# The escape sign first, so that decoding in the opposite order gives every name back.
ESCAPES = (("%", "%25"), (SEPARATOR, "%2C"))


def _replaced(name: Column, pairs) -> Column:
    for old, new in pairs:
        name = F.replace(name, F.lit(old), F.lit(new))
    return name


def encode_traits(traits: Column) -> Column:
    """Array of names to comma-separated text; a comma or percent sign inside a name is escaped."""
    return F.concat_ws(SEPARATOR, F.transform(traits, lambda t: _replaced(t, ESCAPES)))


def decode_traits(text: Column) -> Column:
    """The array of names that ``encode_traits`` wrote."""
    back = [(new, old) for old, new in reversed(ESCAPES)]
    return F.transform(F.split(text, SEPARATOR), lambda t: _replaced(t, back))
