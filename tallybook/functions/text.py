"""Text rules shared by all jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a trim removes at both ends: space and all control characters below it.
EDGE_CHARACTERS = "".join(chr(code) for code in range(0x21))


def trim_field(text: Column) -> Column:
    """Trim blanks and control characters, also those a quoted CSV field keeps.

    Most fields have none; the first and last character tell.
    """
    edged = (text < "!") | (F.right(text, F.lit(1)) < "!")
    return F.when(edged, F.btrim(text, F.lit(EDGE_CHARACTERS))).otherwise(text)


def canon(text: Column) -> Column:
    """The stored form of a type name: trimmed, lower case."""
    return F.lower(trim_field(text))


def is_blank(text: Column) -> Column:
    """Null, empty or white space only, with control characters at the ends.

    The pattern only runs on text that does not start with a printable ASCII character.
    """
    plain = F.ascii(text).between(0x21, 0x7E)
    return text.isNull() | (~plain & text.rlike(r"^[\x00-\x20]*\p{javaWhitespace}*[\x00-\x20]*$"))
