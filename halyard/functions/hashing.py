"""Record hashes and masks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: stands between the parts of a record hash.
SEPARATOR = "||"


def _text(c: Column | str) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def record_hash(columns: Iterable[Column | str]) -> Column:
    """SHA-256 of the columns as text. Null and the empty text hash alike, and a separator
    inside a value isn't escaped: both are kept, so that hashes agree with existing ones."""
    return F.sha2(F.concat_ws(SEPARATOR, *[_text(c) for c in columns]), 256)


def mask_ssn(c: Column | str) -> Column:
    """SHA-256 of the value; null hashes as the empty text."""
    return F.sha2(_text(c), 256)


def mask_name(c: Column | str) -> Column:
    """First character and three stars; null stays null."""
    name = F.col(c) if isinstance(c, str) else c
    return F.concat(F.left(name, F.lit(1)), F.lit("***"))
