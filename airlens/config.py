"""Presets for city air-quality readings.

Every rule the operators apply is data in this module, so a caller can pass other
names, bounds, limits or labels for another domain.
"""

# ---------------------------------------------------------------------------
# Column names and headers of the exchange formats.
# ---------------------------------------------------------------------------
POLLUTANTS = ["pm25_ugm3", "pm10_ugm3", "no2_ppb", "so2_ppb", "co_ppm", "o3_ppb"]
WEATHER = ["temp_c", "humidity_pct", "wind_ms"]
MEASUREMENTS = ["AQI", *POLLUTANTS, *WEATHER]
IMPUTED = [*POLLUTANTS, *WEATHER]
NON_NEGATIVE = [*POLLUTANTS, "AQI", "wind_ms"]

# raw header -> (name in clean readings, name in the live preview)
HEADERS = {
    "PM2.5 (µg/m³)": ("pm25_ugm3", "pm25"),
    "PM10 (µg/m³)": ("pm10_ugm3", "pm10"),
    "NO2 (ppb)": ("no2_ppb", "no2"),
    "SO2 (ppb)": ("so2_ppb", "so2"),
    "CO (ppm)": ("co_ppm", "co"),
    "O3 (ppb)": ("o3_ppb", "o3"),
    "Temperature (°C)": ("temp_c", "temp"),
    "Humidity (%)": ("humidity_pct", "humidity"),
    "Wind Speed (m/s)": ("wind_ms", "wind"),
}
RAW_COLUMNS = ["Date", "City", "Country", "AQI", *HEADERS]
CORRUPT = "_corrupt"

# folded header spelling -> raw header (see operators.standardize.fold_header)
HEADER_ALIASES = {
    "date": "Date",
    "city": "City",
    "country": "Country",
    "aqi": "AQI",
    "pm2.5 ug m3": "PM2.5 (µg/m³)",
    "pm2 5 ug m3": "PM2.5 (µg/m³)",
    "pm10 ug m3": "PM10 (µg/m³)",
    "no2 ppb": "NO2 (ppb)",
    "so2 ppb": "SO2 (ppb)",
    "co ppm": "CO (ppm)",
    "o3 ppb": "O3 (ppb)",
    "temperature degc": "Temperature (°C)",
    "humidity %": "Humidity (%)",
    "humidity": "Humidity (%)",
    "wind speed m s": "Wind Speed (m/s)",
    "corrupt record": CORRUPT,
    "columnnameofcorruptrecord": CORRUPT,
}

# cell texts that mean "no number"
NUMBER_SENTINELS = ["", "N/A", "n/a", "na", "NaN", "null", "—", "-"]

# date patterns in order of preference; ambiguous dates are day first
DATE_PATTERNS = ["d/M/yyyy", "dd/MM/yyyy", "M/d/yyyy", "MM/dd/yyyy", "yyyy-MM-dd"]

# ---------------------------------------------------------------------------
# Places.
# ---------------------------------------------------------------------------
CITY_TO_COUNTRY = {
    "New York": "USA",
    "Los Angeles": "USA",
    "Delhi": "India",
    "Paris": "France",
    "São Paulo": "Brazil",
    "Cairo": "Egypt",
}
COUNTRY_TO_CITY = {
    "USA": "New York",
    "India": "Delhi",
    "France": "Paris",
    "Brazil": "São Paulo",
    "Egypt": "Cairo",
}
SOUTHERN_CITIES = ["Sydney", "São Paulo"]

# ---------------------------------------------------------------------------
# Plausible ranges.  The guard and the validator keep separate
# temperature tables on purpose: the guard has a global fallback, the validator
# treats a country it does not know as invalid.
# ---------------------------------------------------------------------------
GUARD_TEMP_BOUNDS = {
    "USA": (-85.0, 60.0),
    "France": (-45.0, 50.0),
    "India": (-55.0, 55.0),
    "Brazil": (-15.0, 45.0),
    "Egypt": (5.0, 55.0),
}
GUARD_TEMP_FALLBACK = (-90.0, 60.0)
HUMIDITY_BOUNDS = (0.0, 100.0)

VALID_TEMP_BOUNDS = {
    "USA": (-85.0, 60.0),
    "UK": (-30.0, 45.0),
    "France": (-45.0, 50.0),
    "China": (-55.0, 55.0),
    "India": (-55.0, 55.0),
    "Japan": (-45.0, 45.0),
    "Australia": (-25.0, 55.0),
    "Brazil": (-15.0, 45.0),
    "Egypt": (5.0, 55.0),
}
VALID_AQI_BOUNDS = (0.0, 500.0)

# ---------------------------------------------------------------------------
# Sub-index breakpoints (concentration low, high, index low, high).
# ---------------------------------------------------------------------------
SUB_INDEX_SEGMENTS = {
    "pm25_ugm3": [
        (0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150),
        (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 350.4, 301, 400),
        (350.5, 500.4, 401, 500),
    ],
    "pm10_ugm3": [
        (0.0, 54.0, 0, 50), (55.0, 154.0, 51, 100), (155.0, 254.0, 101, 150),
        (255.0, 354.0, 151, 200), (355.0, 424.0, 201, 300), (425.0, 504.0, 301, 400),
        (505.0, 604.0, 401, 500),
    ],
    "o3_ppb": [
        (0.0, 54.0, 0, 50), (55.0, 70.0, 51, 100), (71.0, 85.0, 101, 150),
        (86.0, 105.0, 151, 200), (106.0, 200.0, 201, 300), (201.0, 604.0, 301, 500),
    ],
    "co_ppm": [
        (0.0, 4.4, 0, 50), (4.5, 9.4, 51, 100), (9.5, 12.4, 101, 150),
        (12.5, 15.4, 151, 200), (15.5, 30.4, 201, 300), (30.5, 40.4, 301, 400),
        (40.5, 50.4, 401, 500),
    ],
    "no2_ppb": [
        (0.0, 53.0, 0, 50), (54.0, 100.0, 51, 100), (101.0, 360.0, 101, 150),
        (361.0, 649.0, 151, 200), (650.0, 1249.0, 201, 300), (1250.0, 1649.0, 301, 400),
        (1650.0, 2049.0, 401, 500),
    ],
    "so2_ppb": [
        (0.0, 35.0, 0, 50), (36.0, 75.0, 51, 100), (76.0, 185.0, 101, 150),
        (186.0, 304.0, 151, 200), (305.0, 604.0, 201, 300), (605.0, 804.0, 301, 400),
        (805.0, 1004.0, 401, 500),
    ],
}

# ---------------------------------------------------------------------------
# Categories.  Five cut points split a value into six labels.
# ---------------------------------------------------------------------------
QUALITY_LABELS = ["Good", "Moderate", "Poor", "Unhealthy", "Severe", "Hazardous"]
AQI_CUTS = [50, 100, 150, 200, 300]
BUCKET_CUTS = {
    "pm25_ugm3": [30, 60, 90, 120, 250],
    "pm10_ugm3": [50, 100, 250, 350, 430],
    "no2_ppb": [40, 80, 180, 190, 400],
    "so2_ppb": [40, 80, 380, 800, 1600],
    "co_ppm": [4.4, 9.4, 12.4, 15.4, 30.4],
    "o3_ppb": [54, 70, 85, 105, 200],
}
WHO_LIMITS = {
    "pm25_ugm3": 15, "pm10_ugm3": 45, "no2_ppb": 21, "so2_ppb": 19, "co_ppm": 4, "o3_ppb": 51,
}
RISK_LABELS = [
    "Good", "Moderate", "Unhealthy for Sensitive", "Unhealthy", "Very Unhealthy", "Hazardous",
]

# months -> season, for the northern and the southern hemisphere; the last
# entry also takes readings without a date
SEASON_MONTHS = [(12, 1, 2), (3, 4, 5), (6, 7, 8)]
SEASONS_BY_HEMISPHERE = {
    "N": ["Winter", "Spring", "Summer", "Autumn"],
    "S": ["Summer", "Autumn", "Winter", "Spring"],
}
SEASON_ORDER = ["Winter", "Spring", "Summer", "Autumn"]

# ---------------------------------------------------------------------------
# Weather influence, sources and alerts.
# ---------------------------------------------------------------------------
# (column, comparison, threshold, weight), added up in this order
WEATHER_WEIGHTS = [
    ("wind_ms", ">", 5, -0.3),
    ("humidity_pct", ">", 70, 0.2),
    ("temp_c", ">", 30, 0.1),
    ("temp_c", "<", 10, 0.1),
]
# first match wins
WEATHER_CONDITIONS = [
    ("wind_ms", ">", 8, "Windy"),
    ("humidity_pct", ">", 80, "Humid"),
    ("temp_c", ">", 35, "Hot"),
    ("temp_c", "<", 5, "Cold"),
]
WEATHER_DEFAULT = "Normal"
POLLUTION_SOURCES = {
    "PM2.5": "Vehicle/Industrial Emissions",
    "PM10": "Construction/Dust",
    "NO2": "Traffic Emissions",
}
POLLUTION_SOURCE_DEFAULT = "Industrial Activity"
SEASONAL_FACTORS = {"Winter": 1.2, "Summer": 0.9}
SEASONAL_FACTOR_DEFAULT = 1.0
# priority -> AQI above which it holds, and the flag that must have the given value, if any; the first that holds counts
ALERT_RULES = {
    1: (300, None),
    2: (200, ("who_compliant_all", "No")),
    3: (150, ("pm25_exceeds_who", "Yes")),
    4: (100, None),
}
ALERT_CALM = 5
# priority -> text before and after the city
ALERT_TEXTS = {
    1: (" HAZARDOUS: ", " - Immediate action required!"),
    2: (" VERY UNHEALTHY: ", " - WHO standards violated"),
    3: (" UNHEALTHY: ", " - PM2.5 exceeds limits"),
    4: (" MODERATE: ", " - Monitor conditions"),
    5: (" GOOD: ", " - Air quality acceptable"),
}


def short(column: str) -> str:
    """``pm25_ugm3`` -> ``pm25``: the pollutant's name without its unit."""
    return column.rsplit("_", 1)[0]
