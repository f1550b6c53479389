"""SQL text of the checking queries, in one dialect-neutral form where possible.

Each function returns a SELECT over a source relation; :func:`chain` strings them into CTEs.
"""

from airlens import config as C
from airlens.operators.impute import LEVELS

KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
#: cities of the southern hemisphere in the test tables
SOUTHERN = [f"Supplier#{i:09d}" for i in (1, 4, 9, 16, 25, 36, 49, 64, 81)]

READINGS = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN (l_orderkey + l_partkey) % 29 = 0 THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP) END AS ts,
  CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE s_name END AS city,
  CASE WHEN l_partkey % 103 = 0 THEN NULL
       WHEN n_regionkey = 0 THEN 'USA' WHEN n_regionkey = 1 THEN 'France' WHEN n_regionkey = 2 THEN 'India'
       WHEN n_regionkey = 3 THEN 'Brazil' ELSE 'Egypt' END AS country,
  CASE WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN NULL
       WHEN l_orderkey % 97 = 0 THEN -l_quantity ELSE l_quantity * 10 END AS AQI,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_extendedprice / 200 END AS pm25_ugm3,
  CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_extendedprice / 160 END AS pm10_ugm3,
  CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE CAST(l_orderkey % 2100 AS DOUBLE) / 5 END AS no2_ppb,
  CAST((l_partkey * 7) % 1050 AS DOUBLE) AS so2_ppb,
  CAST((l_orderkey * 3) % 520 AS DOUBLE) / 10 AS co_ppm,
  CAST((l_partkey * 11) % 620 AS DOUBLE) / 2 AS o3_ppb,
  CAST(l_orderkey % 150 - 60 AS DOUBLE) AS temp_c,
  CAST(l_partkey % 121 - 10 AS DOUBLE) AS humidity_pct,
  CAST(l_suppkey % 17 - 1 AS DOUBLE) AS wind_ms
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""

PLACES = """SELECT s_name AS p_city, CASE n_regionkey WHEN 0 THEN 'USA' WHEN 1 THEN 'France'
  WHEN 2 THEN 'India' WHEN 3 THEN 'Brazil' ELSE 'Egypt' END AS p_country
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

#: corrupt-line marker of the test readings
CORRUPT = "CASE WHEN l_partkey % 211 = 0 THEN 'bad line' WHEN l_partkey % 223 = 0 THEN '' END"


def chain(*steps: tuple[str, str], last: str) -> str:
    """``WITH readings AS (...), <steps> <last>``."""
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in [("readings", READINGS), *steps])
    return f"WITH {ctes}\n{last}"


def half_up(value: str, digits: int) -> str:
    """Spark's rounding of a double: half up on its shortest decimal text."""
    return (f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)")


def stable(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def labels(column: str, cuts, names) -> str:
    quote = lambda n: f"'{n}'" if isinstance(n, str) else n
    steps = " ".join(f"WHEN {column} <= {cut} THEN {quote(name)}" for cut, name in zip(cuts, names))
    return f"CASE WHEN {column} IS NULL THEN NULL {steps} ELSE {quote(names[-1])} END"


# --- enrichment -----------------------------------------------------------
CALENDAR = ("year(event_date) AS year, month(event_date) AS month, day(event_date) AS day, "
            "strftime(event_date, '%a') AS day_of_week")
HEMISPHERE = f"CASE WHEN city IN ({', '.join(repr(c) for c in SOUTHERN)}) THEN 'S' ELSE 'N' END"
SEASON = """CASE WHEN hemisphere = 'N' THEN
    CASE WHEN month(event_date) IN (12, 1, 2) THEN 'Winter' WHEN month(event_date) IN (3, 4, 5) THEN 'Spring'
         WHEN month(event_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END
  ELSE CASE WHEN month(event_date) IN (12, 1, 2) THEN 'Summer' WHEN month(event_date) IN (3, 4, 5) THEN 'Autumn'
         WHEN month(event_date) IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END END"""
PM_RATIO = "CASE WHEN pm10_ugm3 > 0 THEN pm25_ugm3 / pm10_ugm3 END"
CATEGORY = labels("AQI", C.AQI_CUTS, C.QUALITY_LABELS)
BUCKETS = ",\n".join(f"{labels(p, cuts, C.QUALITY_LABELS)} AS aqi_bucket_{C.short(p)}"
                     for p, cuts in C.BUCKET_CUTS.items())
FLAGS = ",\n".join(f"CASE WHEN {p} > {limit} THEN 'Yes' ELSE 'No' END AS {C.short(p)}_exceeds_who"
                   for p, limit in C.WHO_LIMITS.items())
COMPLIANT = ("CASE WHEN " + " AND ".join(f"{p} <= {limit}" for p, limit in C.WHO_LIMITS.items())
             + " THEN 'Yes' ELSE 'No' END AS who_compliant_all")


def dated(source: str) -> str:
    return f"SELECT *, CAST(ts AS DATE) AS event_date FROM {source}"


def enriched(source: str) -> str:
    """``source`` has ``event_date``."""
    return f"""SELECT *, {SEASON} AS season FROM (
  SELECT *, {CALENDAR}, {HEMISPHERE} AS hemisphere, {PM_RATIO} AS pm_ratio,
    {CATEGORY} AS aqi_category,
    {BUCKETS},
    {FLAGS},
    {COMPLIANT} FROM {source}) AS e"""


ENRICHED = [("dated", dated("readings")), ("enriched", enriched("dated"))]


# --- cleaning ---------------------------------------------------------------
def filled_places(source: str) -> str:
    return f"""SELECT {KEYS}, ts, COALESCE(x.city, b.p_city) AS city, x.country, AQI, {', '.join(C.IMPUTED)}
FROM (SELECT s.* REPLACE (COALESCE(s.country, a.p_country) AS country)
      FROM {source} AS s LEFT JOIN ({PLACES}) AS a ON s.city = a.p_city) AS x
LEFT JOIN (SELECT p_country, min(p_city) AS p_city FROM ({PLACES}) AS p GROUP BY p_country) AS b
  ON x.country = b.p_country"""


def filled_dates(source: str) -> str:
    prev = f"(PARTITION BY country, city ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    later = f"(PARTITION BY country, city ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""SELECT * EXCLUDE (rn, p_ts, p_rn, n_ts, n_rn) REPLACE (CASE WHEN ts IS NOT NULL THEN ts ELSE
  CAST(COALESCE(CAST(p_ts AS DATE) + CAST(rn - p_rn AS INTEGER),
                CAST(n_ts AS DATE) - CAST(n_rn - rn AS INTEGER)) AS TIMESTAMP) END AS ts)
FROM (SELECT *, last_value(ts IGNORE NULLS) OVER {prev} AS p_ts,
        last_value(CASE WHEN ts IS NOT NULL THEN rn END IGNORE NULLS) OVER {prev} AS p_rn,
        first_value(ts IGNORE NULLS) OVER {later} AS n_ts,
        first_value(CASE WHEN ts IS NOT NULL THEN rn END IGNORE NULLS) OVER {later} AS n_rn
      FROM (SELECT *, row_number() OVER (PARTITION BY country, city ORDER BY {KEYS}) AS rn
            FROM {source}) AS numbered) AS neighbours"""


def deduped(source: str) -> str:
    return f"""SELECT * EXCLUDE (k) FROM (SELECT *, CAST(ts AS DATE) AS event_date,
  row_number() OVER (PARTITION BY country, city, CAST(ts AS DATE) ORDER BY {KEYS}) AS k FROM {source}) AS ranked
WHERE k = 1"""


def _limit(side: int) -> str:
    cases = " ".join(f"WHEN '{c}' THEN {b[side]}" for c, b in C.GUARD_TEMP_BOUNDS.items())
    return f"(CASE country {cases} ELSE {C.GUARD_TEMP_FALLBACK[side]} END)"


def guard_columns(clip: bool) -> dict[str, str]:
    low, high = _limit(0), _limit(1)
    fix = lambda value: value if clip else "NULL"
    return {
        "temp_c": f"CASE WHEN temp_c < {low} THEN {fix(low)} WHEN temp_c > {high} THEN {fix(high)} ELSE temp_c END",
        "humidity_pct": f"CASE WHEN humidity_pct < 0 THEN {fix('0')} WHEN humidity_pct > 100 THEN {fix('100')} "
                        "ELSE humidity_pct END",
        **{c: f"CASE WHEN {c} < 0 THEN {fix('0')} ELSE {c} END" for c in C.NON_NEGATIVE},
    }


def guarded(source: str, clip: bool = False) -> str:
    fixed = ", ".join(f"CAST({sql} AS DOUBLE) AS {c}" for c, sql in guard_columns(clip).items())
    return f"SELECT * REPLACE ({fixed}) FROM {source}"


def medians(source: str, level) -> str:
    keys = ", ".join(level)
    cells = ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in C.IMPUTED)
    return f"SELECT {keys + ', ' if keys else ''}{cells} FROM {source}" + (f" GROUP BY {keys}" if keys else "")


def imputed(source: str) -> str:
    by_city, by_country, overall = (medians(source, level) for level in LEVELS)
    fill = ", ".join(f"COALESCE(s.{c}, a.{c}, b.{c}, g.{c}) AS {c}" for c in C.IMPUTED)
    return f"""SELECT s.* REPLACE ({fill}) FROM {source} AS s
LEFT JOIN ({by_city}) AS a ON s.country = a.country AND s.city = a.city
LEFT JOIN ({by_country}) AS b ON s.country = b.country
CROSS JOIN ({overall}) AS g"""


def sub_index(column: str) -> str:
    segments = C.SUB_INDEX_SEGMENTS[column]
    between = " ".join(
        f"WHEN {column} >= {low} AND {column} <= {high} "
        f"THEN CAST({(ih - il) / (high - low)!r} AS DOUBLE) * ({column} - CAST({low} AS DOUBLE)) + {il}"
        for low, high, il, ih in segments)
    return (f"CASE WHEN {column} < {segments[0][0]} THEN CAST({segments[0][2]} AS DOUBLE) "
            f"WHEN {column} > {segments[-1][1]} THEN CAST({segments[-1][3]} AS DOUBLE) {between} END")


def indexed(source: str) -> str:
    worst = ", ".join(sub_index(c) for c in C.SUB_INDEX_SEGMENTS)
    return f"SELECT * REPLACE (COALESCE(AQI, greatest({worst})) AS AQI) FROM {source}"


CLEANED = [
    ("placed", filled_places("readings")), ("timed", filled_dates("placed")),
    ("single", deduped("timed")), ("ranged", guarded("single")), ("whole", imputed("ranged")),
    ("rated", indexed("whole")), ("enriched", enriched("rated")),
]


# --- validation ---------------------------------------------------------------
def _number(c: str) -> str:
    return f"{c} IS NOT NULL AND NOT isnan({c})"


TEMP_OK = "(" + " OR ".join(f"(country = '{c}' AND temp_c BETWEEN {lo} AND {hi})"
                            for c, (lo, hi) in C.VALID_TEMP_BOUNDS.items()) + ")"
CHECKS = {
    "CITY_EMPTY": "city IS NOT NULL AND length(trim(city)) > 0",
    "COUNTRY_EMPTY": "country IS NOT NULL AND length(trim(country)) > 0",
    "TEMP_OUT_OF_RANGE_OR_UNKNOWN_COUNTRY": f"{_number('temp_c')} AND {TEMP_OK}",
    "HUMIDITY_INVALID": f"{_number('humidity_pct')} AND humidity_pct BETWEEN 0 AND 100",
    "WIND_INVALID": f"{_number('wind_ms')} AND wind_ms >= 0",
    **{f"{p.upper()}_INVALID": f"{_number(p)} AND {p} >= 0" for p in C.POLLUTANTS},
    "AQI_INVALID": f"{_number('AQI')} AND AQI BETWEEN 0 AND 500",
    "CSV_CORRUPT": "_corrupt IS NULL OR _corrupt = ''",
}
IS_VALID = " AND ".join(f"({c})" for c in CHECKS.values())
ERROR_CODES = ("concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT ({c}) THEN '{code}' END" for code, c in CHECKS.items()) + ")")


def flagged(source: str, corrupt: str = CORRUPT) -> str:
    return f"""SELECT *, {IS_VALID} AS is_valid, {ERROR_CODES} AS error_codes
FROM (SELECT *, {corrupt} AS _corrupt FROM {source}) AS f"""
