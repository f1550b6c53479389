"""Small helpers for tests."""

from datetime import datetime

from pyspark.sql import functions as F

#: noisy readings made for these tests, one per line of a small CSV (line 1 is the header); each breaks a rule or two
NOISE = """\
14/6/2023,pARIS,france,-12,80.5,90.2,33,21,2.5,70,21.5,-7,6.1
14/6/2023,Cairo,EGYPT,210,-61,140,50,12,1.5,80,36,20,3
14/6/2023,Delhi,India,150,70,120,40,15,-0.9,60,33,60,2
14/6/2023,São Paulo,Brazil,,40.5,66,,9,0.7,45,18,70,1.2
14/6/2023,New York,USA,88,,75,26,11,0.5,-50,24,55,2.2
15/6/2023,,France,97,55,71,28,17,1.9,66,23,44,5
15/6/2023,Cairo,,188,95,130,47,10,1.2,77,37,18,4
,Delhi,India,164,77,125,44,16,1.1,58,34,57,3
15/6/2023,São Paulo,Brazil,72,38,60,22,8,0.6,,17,72,1.4
15/6/2023,New York,USA,70,31,70,24,,0.4,64,25,52,
16/6/2023,Paris,France,101,52,-69,-27,16,1.7,63,22,58,5.5
16/6/2023,Cairo,Egypt,195,110,,49,11,1.3,79,38,19,4.5
16/6/2023,Delhi,India,158,73,119,41,-14,1.9,61,35,,2.5
16/6/2023,São Paulo,Brazil,75,41,63,31,9.5,0.8,52,900.5,74,1.6
16/6/2023,São Paulo,Brazil,75,41,63,31,9.5,0.8,52,19.5,74,1.6
16/6/2023,New York,USA,66,19,68,25,13,0.6,58,26,50,2.9
16/6/2023,,,90,60,80,30,20,1,55,20,50,3
17/6/2023,Los Angeles,USA,120,35,50,30,10,0.5,90,28,33,3
18/6/2023,Los Angeles,USA,121,36,51,31,11,0.6,91,29,34,3.1
""".splitlines()
HEADER = ("Date,City,Country,AQI,PM2.5 (µg/m³),PM10 (µg/m³),NO2 (ppb),SO2 (ppb),CO (ppm),O3 (ppb),"
          "Temperature (°C),Humidity (%),Wind Speed (m/s)")


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def one(spark, build, **values):
    """Value of the Column that ``build()`` makes, over one row of doubles and strings."""
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in values.items())
    row = tuple(float(v) if isinstance(v, int) else v for v in values.values())
    return spark.createDataFrame([row], kinds).select(build().alias("x")).first()["x"]


def many(spark, function, kind, values):
    """Values of a function of a Column over the given ones, in order."""
    expression = function(F.col("v"))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def tuples(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
