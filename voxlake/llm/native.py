"""Column expressions over the words of a text, evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

GAPS = "\t\n\x0b\x0c\r"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with `value` evaluated once however often `use` refers to it."""
    return F.transform(F.array(value), use)[0]


def word_list(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text."""
    return F.array_remove(F.split(F.translate(text, GAPS, " " * len(GAPS)), " "), "")


def count_of(text: Column, characters: str) -> Column:
    """How many code points of a text are among `characters`."""
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")
