"""Graph queries: node and edge tables, top cities, pollution drivers."""

from airlens import schema as S
from airlens.catalog import sql
from airlens.catalog.inputs import enriched
from airlens.catalog.registry import query
from airlens.operators import graph as G
from airlens.plans.graph import add_readings, load_graph
from airlens.shared import scratch_path, write_json
from airlens.sinks import read_graph
from airlens.sources.readings import ORDER

START, END = "1996-01-01", "1998-12-31"
_GOOD = "country IS NOT NULL AND city IS NOT NULL AND event_date IS NOT NULL AND aqi_category IS NOT NULL"
_STEPS = [*sql.ENRICHED, ("good", f"SELECT * FROM enriched WHERE {_GOOD}")]
_text = lambda columns: ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c == "event_date" else c for c in columns)


def _first(name: str) -> str:
    keys, extra = G.KEYS[name], G.ATTRIBUTES[name]
    return (f"SELECT {', '.join([*keys, *extra])} FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {sql.KEYS}) AS k FROM good) AS r WHERE k = 1")


def graph(spark, sf):
    return G.build_graph(enriched(spark, sf), ORDER)


def _table(name: str, columns, body: str):
    @query(name[0], sql.chain(*_STEPS, ("t", body), last=f"SELECT {_text(columns)} FROM t"))
    def run(spark, sf):
        return graph(spark, sf)[name[1]].select(*columns)


for _name in G.ATTRIBUTES:
    _table((f"g01_node_{_name}", _name), [*G.KEYS[_name], *G.ATTRIBUTES[_name]], _first(_name))
_table(("g01_node_category", "category"), ["aqi_category"], "SELECT DISTINCT aqi_category FROM good")
for _name in ("has_reading", "on_day", "has_category", "has_compliant"):
    _table((f"g02_edge_{_name}", _name), G.KEYS[_name],
           f"SELECT DISTINCT {', '.join(G.KEYS[_name])} FROM good")
_table(("g02_rejects", "rejects"), [*ORDER, "country", "city", "event_date", "aqi_category"],
       f"SELECT * FROM enriched WHERE NOT ({_GOOD})")

_NODES = [*_STEPS, ("reading", _first("reading")), ("compliant", _first("compliant")),
          ("known", "SELECT DISTINCT country, city FROM good")]
_WITHIN = f"event_date BETWEEN DATE '{START}' AND DATE '{END}'"


@query("g03_top_cities_by_avg_aqi", sql.chain(*_NODES, last=(
    f"SELECT city, country, {sql.stable('avg(AQI)', 2)} AS avg_aqi FROM reading WHERE {_WITHIN} "
    "GROUP BY city, country ORDER BY avg_aqi DESC NULLS LAST, city, country LIMIT 5")))
def g03(spark, sf):
    return G.top_cities_by_avg_aqi(graph(spark, sf), START, END)


_SHOWN = ["pm25", "pm10", "no2", "so2", "co", "o3"]
_COUNTS = ", ".join(f"CAST(sum(CASE WHEN c.{p}_exceeds_who = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS {p}"
                    for p in _SHOWN)
_DRIVERS = f"""SELECT *, {' + '.join(_SHOWN)} AS total_exceed FROM (
  SELECT r.country, r.city, {_COUNTS} FROM reading AS r LEFT JOIN compliant AS c
    ON r.country = c.country AND r.city = c.city AND r.event_date = c.event_date AND c.{_WITHIN}
  GROUP BY r.country, r.city) AS d"""


@query("g04_pollution_driver_per_city", sql.chain(*_NODES, ("drivers", _DRIVERS), last=(
    "SELECT * FROM drivers ORDER BY total_exceed DESC, city, country LIMIT 10")))
def g04(spark, sf):
    return G.pollution_driver_per_city(graph(spark, sf), START, END)


@query("g04_pollution_driver_all_cities", sql.chain(*_NODES, last=_DRIVERS))
def g04_all(spark, sf):
    return G.pollution_driver_per_city(graph(spark, sf), START, END, limit=None)


@query("g05_rank_pollutants", sql.chain(*_NODES, ("drivers", _DRIVERS), last=(
    "SELECT *, row_number() OVER (PARTITION BY country, city ORDER BY days DESC, list_position("
    f"['" + "', '".join(G.POLLUTANT_ORDER) + "'], pollutant)) AS pollutant_rank FROM ("
    + " UNION ALL ".join(f"SELECT country, city, '{p}' AS pollutant, {p} AS days FROM drivers"
                         for p in G.POLLUTANT_ORDER) + ") AS u")))
def g05(spark, sf):
    return G.rank_pollutants(G.pollution_driver_per_city(graph(spark, sf), START, END, limit=None))


_EARLY = "l_linenumber <= 3"
_MERGED = f"""SELECT country, city, event_date, AQI, pm25_ugm3 FROM (
  SELECT *, row_number() OVER (PARTITION BY country, city, event_date
    ORDER BY (CASE WHEN {_EARLY} THEN 0 ELSE 1 END), {sql.KEYS}) AS k FROM good) AS r WHERE k = 1"""


@query("k09_write_graph", sql.chain(*_STEPS, ("t", _MERGED), last=(
    "SELECT country, city, CAST(event_date AS VARCHAR) AS event_date, AQI, pm25_ugm3 FROM t")))
def k09(spark, sf):
    """Two loads, then the second again: stored readings keep their first values."""
    base = scratch_path(spark, "graph")
    rows = enriched(spark, sf)
    late = rows.filter(f"NOT {_EARLY}")
    for batch, part in (("1", rows.filter(_EARLY)), ("2", late), ("2", late)):
        add_readings(part, ORDER, base, batch)
    return read_graph(spark, base)["reading"].select("country", "city", "event_date", "AQI", "pm25_ugm3")


@query("k09_rejects", sql.chain(*_STEPS, last=(
    f"SELECT {sql.KEYS}, country, city, CASE WHEN {_EARLY} THEN 1 ELSE 2 END AS batch FROM enriched WHERE NOT ({_GOOD})")))
def k09_rejects(spark, sf):
    """Readings without a key are stored with the batch they came in; a repeated batch stores them once."""
    base = scratch_path(spark, "graph")
    rows = enriched(spark, sf)
    late = rows.filter(f"NOT {_EARLY}")
    for batch, part in (("1", rows.filter(_EARLY)), ("2", late), ("2", late)):
        add_readings(part, ORDER, base, batch)
    return read_graph(spark, base)["rejects"].select(*ORDER, "country", "city", "batch")


# --- queries on a stored graph, filled by two loads ----------------------------------------
_BY_COLUMNS = ", ".join(f"{c} NULLS FIRST" for c in S.CLEAN.names)
_OF_LOADS = [*_STEPS, *[(name, f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, city, event_date
  ORDER BY (CASE WHEN {_EARLY} THEN 0 ELSE 1 END), {_BY_COLUMNS}) AS k FROM good) AS r WHERE k = 1""")
                        for name in ("reading", "compliant")]]


def stored_graph(spark, sf, name, loads=("1", "2")):
    """Clean readings as JSON in two folders, loaded one after the other; read back for the months of the queries only."""
    base = scratch_path(spark, name)
    rows = enriched(spark, sf)
    write_json(rows.filter(_EARLY).select(*S.CLEAN.names), f"{base}/in/1")
    write_json(rows.filter(f"NOT {_EARLY}").select(*S.CLEAN.names), f"{base}/in/2")
    for load in loads:
        load_graph(spark, f"{base}/in/{load}", f"{base}/graph", load)
    return read_graph(spark, f"{base}/graph", START, END)


@query("k09_load_graph", sql.chain(*_OF_LOADS, last=(
    f"SELECT {', '.join(G.CITY)}, CAST(event_date AS VARCHAR) AS event_date, {', '.join(G.ATTRIBUTES['reading'])} FROM reading "
    f"WHERE {_WITHIN}")))
def k09_load(spark, sf):
    """Readings of the dates along their edges to city, day and compliance; the second load is repeated."""
    linked = G.linked_readings(stored_graph(spark, sf, "k09-load", ("1", "2", "2")), START, END)
    return linked.select(*G.READING, *G.ATTRIBUTES["reading"])


@query("g03_top_cities_stored", sql.chain(*_OF_LOADS, last=(
    f"SELECT city, country, {sql.stable('avg(AQI)', 2)} AS avg_aqi FROM reading WHERE {_WITHIN} "
    "GROUP BY city, country ORDER BY avg_aqi DESC NULLS LAST, city, country LIMIT 5")))
def g03_stored(spark, sf):
    stored = stored_graph(spark, sf, "g03-stored")
    return G.top_cities_by_avg_aqi(stored | {"reading": G.linked_readings(stored, START, END)}, START, END)


@query("g04_pollution_driver_stored", sql.chain(*_OF_LOADS, last=_DRIVERS))
def g04_stored(spark, sf):
    return G.pollution_driver_of_cities(stored_graph(spark, sf, "g04-stored"), START, END, limit=None)


@query("g05_rank_pollutants_stored", sql.chain(*_OF_LOADS, ("drivers", _DRIVERS), last=(
    "SELECT *, row_number() OVER (PARTITION BY country, city ORDER BY days DESC, list_position("
    f"['" + "', '".join(G.POLLUTANT_ORDER) + "'], pollutant)) AS pollutant_rank FROM ("
    + " UNION ALL ".join(f"SELECT country, city, '{p}' AS pollutant, {p} AS days FROM drivers"
                         for p in G.POLLUTANT_ORDER) + ") AS u")))
def g05_stored(spark, sf):
    return G.rank_pollutants(G.pollution_driver_of_cities(stored_graph(spark, sf, "g05-stored"), START, END, limit=None))
