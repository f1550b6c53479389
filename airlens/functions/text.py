"""Text clean-up."""

from pyspark.sql import Column, functions as F


def squeeze(text: Column) -> Column:
    """Trim, and fold every run of blanks into one."""
    return F.regexp_replace(F.trim(text), r"\s+", " ")


def norm_city(text: Column) -> Column:
    """``"  neW   york"`` -> ``"New York"``."""
    return F.initcap(squeeze(text))


def norm_country(text: Column, code_length: int = 3) -> Column:
    """Like :func:`norm_city`, but codes of up to ``code_length`` letters become upper case."""
    tidy = squeeze(text)
    return F.when(F.length(tidy) <= code_length, F.upper(tidy)).otherwise(F.initcap(tidy))
