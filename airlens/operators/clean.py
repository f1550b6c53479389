"""Fill gaps in place and date, drop duplicate days, guard value ranges."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from airlens import config as C
from airlens.functions import norm_city
from airlens.shared import materialized, scratch_path


# ---------------------------------------------------------------------------
# City <-> country
# ---------------------------------------------------------------------------
def _literal_map(pairs: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _lookup(df: DataFrame, table: DataFrame | Mapping, key: Column, name: str) -> DataFrame:
    """Add column ``name``: the table's second column where its first equals ``key``.

    A Mapping is a literal inside the expression. A DataFrame (unique keys) is a left join with no
    hint: Spark broadcasts it while its measured size stays under the broadcast threshold, and
    shuffles, splitting skewed keys at run time, beyond that.
    """
    if isinstance(table, Mapping):
        return df.withColumn(name, F.element_at(_literal_map(table), key))
    key_col, value_col = table.columns[:2]
    side = table.select(F.col(key_col).alias("_lookup_key"), F.col(value_col).alias(name))
    return df.join(side, key == F.col("_lookup_key"), "left").drop("_lookup_key")


def fill_country(df: DataFrame, lookup: DataFrame | Mapping = C.CITY_TO_COUNTRY) -> DataFrame:
    """A missing country from its city; the city's spelling is normalised for the lookup."""
    found = _lookup(df, lookup, norm_city(F.col("city")), "_country")
    return found.withColumn("country", F.coalesce("country", "_country")).drop("_country")


def fill_city(df: DataFrame, lookup: DataFrame | Mapping = C.COUNTRY_TO_CITY) -> DataFrame:
    """A missing city from its country. Run after :func:`fill_country`."""
    found = _lookup(df, lookup, F.col("country"), "_city")
    return found.withColumn("city", F.coalesce("city", "_city")).drop("_city")


# ---------------------------------------------------------------------------
# Missing dates
# ---------------------------------------------------------------------------
#: rows of a part, about
PART_ROWS = 100_000


def date_edges(dealt: DataFrame) -> DataFrame:
    """What lies around each place's rows in each part: ``_key, _part, _offset, _carry, _ahead``.

    ``dealt`` has a row's place ``_key``, the part of the table it lies in, its position there and its ``ts``. Parts are
    consecutive ranges of (place, order), so each place and part is summed up in one row (row count, first and last
    known date with their positions), and a scan over a place's summaries sees a row per part, however many rows it has.
    """
    known_at = F.when(F.col("ts").isNotNull(), F.struct("_pos", "ts"))
    summary = dealt.groupBy("_key", "_part").agg(
        F.count("*").alias("_rows"), F.min(known_at).alias("_first"), F.max(known_at).alias("_last"))
    along = W.partitionBy("_key").orderBy("_part")
    back = W.partitionBy("_key").orderBy(F.col("_part").desc())
    before = (W.unboundedPreceding, -1)
    shifted = summary.withColumn("_offset", F.coalesce(F.sum("_rows").over(along.rowsBetween(*before)), F.lit(0)))
    return shifted.select(
        "_key", "_part", "_offset",
        F.last(_moved("_last"), ignorenulls=True).over(along.rowsBetween(*before)).alias("_carry"),
        F.last(_moved("_first"), ignorenulls=True).over(back.rowsBetween(*before)).alias("_ahead"))


def _moved(near: str) -> Column:
    """A position and its date, with the position counted from the place's first row."""
    return F.when(F.col(near).isNotNull(), F.struct((F.col("_offset") + F.col(f"{near}._pos")).alias("_pos"), F.col(f"{near}.ts").alias("ts")))


def deal_dates(df: DataFrame, order_by: Sequence[str], keys: Sequence[str], path: str, partitions: int | None = None) -> DataFrame:
    """Place, order columns and ``ts`` alone, dealt by ranges of (place, order) into parts of like size, with positions.

    The parts are written to ``path``, as ranges drawn again might differ. A part's size follows from the rows alone, whatever
    the order columns hold, and no place is larger than a part there.
    """
    spark = df.sparkSession
    narrow = df.select(F.struct(*keys).alias("_key"), *dict.fromkeys(order_by), "ts")   # a struct is never NULL, so NULL places group and join
    if partitions is not None:      # a task sorts a part or a few: as many parts as asked for may be too few for a larger table
        partitions = max(partitions, -(-narrow.count() // PART_ROWS))
    number = [] if partitions is None else [partitions]
    dealt = materialized(narrow.repartitionByRange(*number, "_key", *order_by).withColumn("_part", F.spark_partition_id()), path)
    dealt = dealt.repartition(*number, "_key", "_part")     # with a number, tasks are not put together again
    order = W.partitionBy("_key", "_part").orderBy(*order_by)
    return dealt.withColumn("_pos", F.row_number().over(order).cast("long"))


def fill_missing_date(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = ("country", "city"),
    partitions: int | None = None,
    stage: str | None = None,
) -> DataFrame:
    """Give rows without ``ts`` a date from their neighbours in the same place.

    Inside each ``keys`` group, in ``order_by`` order (unique and not NULL, of any types): the nearest earlier row with a date, plus
    one day per row in between; if there is none, the nearest later one, minus one day per row. Filled values are midnights.

    A place may hold a large share of all rows, so no task ever sees a whole place: rows are dealt by ranges (``partitions``
    of them at least, and so many that about :data:`PART_ROWS` rows are in one; by default the session's shuffle partitions), windows run inside a place and part, and dates are carried from
    part to part by :func:`date_edges`. Only places, order columns and dates are sorted; the dates found are then joined to the whole rows
    without one, and no other row is dealt for it. ``df`` is read for the ranges and again for the rows. The ranges are written under ``stage`` (default: a new folder in the shared one), which the result reads.
    """
    dealt = deal_dates(df, order_by, keys, stage or scratch_path(df.sparkSession, "dates"), partitions)
    here = F.when(F.col("ts").isNotNull(), F.struct("_pos", "ts"))
    # The later neighbour is read on the reversed order: a frame that ends at the last row would be re-evaluated for every row.
    ways = [W.partitionBy("_key", "_part").orderBy(F.col("_pos").asc()), W.partitionBy("_key", "_part").orderBy(F.col("_pos").desc())]
    near = [F.last(here, ignorenulls=True).over(way.rowsBetween(W.unboundedPreceding, W.currentRow)) for way in ways]
    gaps = (dealt.withColumns({"_prev": near[0], "_next": near[1]}).where(F.col("ts").isNull())
            .join(date_edges(dealt), ["_key", "_part"]))
    at = F.col("_offset") + F.col("_pos")
    away = lambda found: F.date_add(
        F.to_date(found.getField("ts")), (at - found.getField("_pos")).cast("int")).cast("timestamp")
    prev, later = F.coalesce(_moved("_prev"), "_carry"), F.coalesce(_moved("_next"), "_ahead")
    found = gaps.select("_key", *dict.fromkeys(order_by), F.coalesce(away(prev), away(later)).alias("_filled"))
    missing = df.where(F.col("ts").isNull()).withColumn("_key", F.struct(*keys)).join(found, ["_key", *dict.fromkeys(order_by)], "left")
    return df.where(F.col("ts").isNotNull()).unionByName(missing.withColumn("ts", F.col("_filled")).select(*df.columns))


# ---------------------------------------------------------------------------
# Duplicates
# ---------------------------------------------------------------------------
def with_event_date(df: DataFrame) -> DataFrame:
    """``event_date``: as given, else the day of ``ts``."""
    day = F.to_date("ts")
    return df.withColumn(
        "event_date", F.coalesce(F.col("event_date"), day) if "event_date" in df.columns else day)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """The first row of each key in ``order_by`` order; NULL keys form groups too.

    ``row_number() = 1`` lets Spark keep one row per key before the shuffle (WindowGroupLimit),
    so a key with very many copies costs each map task one row.
    """
    ranked = W.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn("_rank", F.row_number().over(ranked))
            .filter(F.col("_rank") == 1).drop("_rank"))


def dedup_daily(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = ("country", "city", "event_date"),
) -> DataFrame:
    """One reading per place and day: the first in ``order_by`` order."""
    return first_per_key(with_event_date(df), keys, order_by)


# ---------------------------------------------------------------------------
# Range guards
# ---------------------------------------------------------------------------
def _repair(value: Column, low: Column | None, high: Column | None, mode: str) -> Column:
    """Out-of-range value -> NULL (``nullify``) or the nearest bound (``clip``)."""
    if mode not in ("nullify", "clip"):
        raise ValueError("mode is 'nullify' or 'clip'")
    checks = [value < low] if low is not None else []
    if high is not None:
        checks.append(value > high)
    outside = checks[0] if len(checks) == 1 else checks[0] | checks[1]
    if mode == "nullify":
        return F.when(outside, F.lit(None)).otherwise(value)
    clipped = F.greatest(value, low) if low is not None else value
    return F.when(outside, F.least(clipped, high) if high is not None else clipped).otherwise(value)


def guard_temp(
    df: DataFrame,
    mode: str = "nullify",
    bounds: DataFrame | Mapping[str, tuple[float, float]] = C.GUARD_TEMP_BOUNDS,
    fallback: tuple[float, float] = C.GUARD_TEMP_FALLBACK,
) -> DataFrame:
    """Temperature inside its country's bounds; unknown or missing country: ``fallback``.

    ``bounds`` as a table has a country (unique), its lower and its upper bound (NULL: the fallback's). It is joined like other
    lookups, on a stream too, which sees the table as it is when the query starts.
    """
    if "temp_c" not in df.columns:
        return df
    if isinstance(bounds, DataFrame):
        side = bounds.select(*[F.col(c).alias(name) for c, name in zip(bounds.columns, ("_at", "_low", "_high"))])
        limit = [F.coalesce(F.col(name), F.lit(end)) for name, end in zip(("_low", "_high"), fallback)]
        return (df.join(side, F.col("country") == F.col("_at"), "left")
                .withColumn("temp_c", _repair(F.col("temp_c"), *limit, mode)).drop("_at", "_low", "_high"))
    limit = [
        F.coalesce(F.element_at(_literal_map({k: b[side] for k, b in bounds.items()}), F.col("country")),
                   F.lit(fallback[side]))
        for side in (0, 1)
    ]
    return df.withColumn("temp_c", _repair(F.col("temp_c"), *limit, mode))


def guard_humidity(df: DataFrame, mode: str = "nullify",
                   bounds: tuple[float, float] = C.HUMIDITY_BOUNDS) -> DataFrame:
    """Relative humidity inside 0..100."""
    if "humidity_pct" not in df.columns:
        return df
    low, high = map(F.lit, bounds)
    return df.withColumn("humidity_pct", _repair(F.col("humidity_pct"), low, high, mode))


def guard_nonneg(df: DataFrame, mode: str = "nullify",
                 columns: Sequence[str] = tuple(C.NON_NEGATIVE)) -> DataFrame:
    """Concentrations, AQI and wind are not negative."""
    return df.withColumns({
        c: _repair(F.col(c), F.lit(0.0), None, mode) for c in columns if c in df.columns
    })


def guard_ranges(df: DataFrame, mode: str = "nullify",
                 bounds: DataFrame | Mapping[str, tuple[float, float]] = C.GUARD_TEMP_BOUNDS) -> DataFrame:
    """All three guards; ``bounds`` are those of temperatures."""
    return (df.transform(guard_temp, mode, bounds).transform(guard_humidity, mode)
            .transform(guard_nonneg, mode))
