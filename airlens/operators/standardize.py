"""Names, dates, places and numbers in one shape, whatever the source wrote."""

import re
import unicodedata
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from airlens import config as C
from airlens.functions import clean_number, norm_city, norm_country, parse_ts, to_double

def fold_header(name: str) -> str:
    """Spelling-independent form of a header: compatible forms as one, a degree sign as "deg", only words, lower case."""
    plain = unicodedata.normalize("NFKC", name.replace("°", " deg")).replace("μ", "u")
    return " ".join(re.findall(r"[^\W_]+(?:\.\d+)?", plain)).lower()


def canonicalize_headers(df: DataFrame, aliases: Mapping[str, str] = C.HEADER_ALIASES) -> DataFrame:
    """Rename known header spellings; a column that already has the target name is never replaced."""
    taken, renames = set(df.columns), {}
    for name in df.columns:
        target = aliases.get(fold_header(name))
        if target and target not in taken:
            renames[name] = target
            taken.add(target)
    return df.withColumnsRenamed(renames)


def ensure_corrupt(df: DataFrame) -> DataFrame:
    """Add an empty corrupt-line column where the source has none. Call after the header renames."""
    if C.CORRUPT in df.columns:
        return df
    return df.withColumn(C.CORRUPT, F.lit(None).cast("string"))


def snake_names(df: DataFrame) -> DataFrame:
    """Unit-suffixed headers -> snake case names."""
    return df.withColumnsRenamed({
        raw: snake for raw, (snake, _) in C.HEADERS.items() if snake not in df.columns
    })


def short_names(df: DataFrame) -> DataFrame:
    """Unit-suffixed headers -> short names of the live preview."""
    return df.withColumnsRenamed({raw: brief for raw, (_, brief) in C.HEADERS.items()})


def _double(df: DataFrame, name: str):
    column = F.col(f"`{name}`")
    return to_double(column) if isinstance(df.schema[name].dataType, StringType) else column.try_cast("double")


def cast_numbers(df: DataFrame, columns=tuple(C.MEASUREMENTS)) -> DataFrame:
    """Measurements as doubles; text that is no number becomes NULL."""
    return df.withColumns({c: _double(df, c) for c in columns if c in df.columns})


def clean_numbers(df: DataFrame, columns) -> DataFrame:
    """Like :func:`cast_numbers`, but strips units and other symbols from the text first."""
    return df.withColumns({c: clean_number(F.col(c)) for c in columns if c in df.columns})


def standardize(df: DataFrame) -> DataFrame:
    """Any raw record -> ``ts, city, country`` first, then snake-case numbers and the rest."""
    df = df.transform(canonicalize_headers).transform(ensure_corrupt).transform(snake_names)
    derived = {
        "Date": ("ts", parse_ts),
        "City": ("city", norm_city),
        "Country": ("country", norm_country),
    }
    numbers = [c for c in C.MEASUREMENTS if c in df.columns]
    front = [build(F.col(raw)).alias(name)
             for raw, (name, build) in derived.items() if raw in df.columns]
    made = {name for raw, (name, _) in derived.items() if raw in df.columns}
    kept = [c for c in ("ts", "city", "country") if c in df.columns and c not in made]
    rest = [c for c in df.columns if c not in derived and c not in kept and c not in made]
    return df.select(
        *front, *kept,
        *[_double(df, c).alias(c) if c in numbers else F.col(f"`{c}`") for c in rest],
    )
