"""String rules."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col

# Characters removed, characters treated as blank, missing markers.
CONTROL_CHARS = r"[\x00-\x08\x0E-\x1F\x7F]"
BLANK_CHARS = r"[ \t\n\x0B\x0C\r]+"
MISSING_MARKERS = ("", "NA")


def clean_text(c: Column | str) -> Column:
    """Drop control characters, squeeze blanks, trim; '' and 'NA' become NULL.

    The cleaning routine the surveyed flows call is not part of their source,
    so this contract is ours: it follows its description ("strip extra
    whitespace, invalid strings become missing").
    """
    c = F.regexp_replace(as_col(c), CONTROL_CHARS, "")
    c = F.trim(F.regexp_replace(c, BLANK_CHARS, " "))
    return F.when(~c.isin(*MISSING_MARKERS), c)


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def snake_name(name: str) -> str:
    """``MemorySize`` and ``Order No`` become ``memory_size`` and ``order_no``."""
    name = re.sub(r"[^0-9A-Za-z]+", "_", name.strip())
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub(r"_+", "_", name).strip("_").lower()


def strip_last_token(c: Column | str, sep: str = "_") -> Column:
    """Remove the trailing ``_token`` of a name."""
    s = re.escape(sep)
    return F.regexp_replace(as_col(c), f"{s}[^{s}]*$", "")
