"""Dates and times."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from airlens import config as C


#: what a pattern's letters can match, as a regular expression
_LETTERS = {
    "yyyy": r"\+?\d{4,}", "dd": r"(?:0[1-9]|[12]\d|3[01])", "MM": r"(?:0[1-9]|1[0-2])",
    "d": r"0*(?:[1-9]|[12]\d|3[01])", "M": r"0*(?:[1-9]|1[0-2])",
}


def _shape(pattern: str) -> str:
    parts = re.split("(yyyy|dd|MM|d|M)", pattern)
    return "^" + "".join(_LETTERS.get(p, re.escape(p)) for p in parts) + "$"


def parse_ts(text: Column, patterns: Sequence[str] = tuple(C.DATE_PATTERNS)) -> Column:
    """First pattern that fits, else Spark's own reading of the text, else NULL (never an error).

    Patterns may use ``d, dd, M, MM, yyyy`` and punctuation. A pattern is tried only on text of its
    shape: a failed parse is an exception inside Spark, and costs far more than the test.
    """
    attempts, seen = [], set()
    for p in patterns:
        lenient = p.replace("dd", "d").replace("MM", "M")     # reads all that the padded form reads
        if lenient not in seen:
            attempts.append(F.when(text.rlike(_shape(p)), F.try_to_timestamp(text, F.lit(p))))
        seen.add(p)
    return F.coalesce(*attempts, text.try_cast("timestamp"))
