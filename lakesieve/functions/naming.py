"""Snake-case names, for column names and for text values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where one word of a name ends and the next begins: blanks and hyphens, or a capital after
#: a small letter or digit. Understood alike by Python and by Spark.
SEAM = r"[\s-]+|(?<=[a-z0-9])(?=[A-Z])"


def snake_case(name: str) -> str:
    """``Unit Price``, ``unit-price`` and ``unitPrice`` all become ``unit_price``."""
    return "_".join(re.split(SEAM, name.strip())).lower()


def snake_case_text(value: Column) -> Column:
    """The same rule on a text column, inside whole-stage codegen."""
    stripped = F.regexp_replace(value, r"^\s+|\s+$", "")
    return F.lower(F.regexp_replace(stripped, SEAM, "_"))
