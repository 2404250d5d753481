"""Nested JSON inputs: source pages, stations, post items and weather payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import times, urls
from railtide.operators import nested

PAGE_SCHEMA = "batch string, station string, name string, source_type string, tier string, url string"
STATION_SCHEMA = "station string, code string, latitude double, longitude double"
ITEM_SCHEMA = (
    "inputUrl string, facebookUrl string, url string, topLevelUrl string, pageName string, time string, "
    "timestamp double, text string, resharedText string, sharePost struct<text:string>, "
    f"attachedPost struct<text:string>, media {nested.MEDIA_TYPE}"
)
PRIMARY_SCHEMA = (
    "current struct<time:string,temperature_2m:double,relative_humidity_2m:double,precipitation:double,"
    "wind_speed_10m:double>, daily struct<time:array<string>,temperature_2m_max:array<double>,"
    "temperature_2m_min:array<double>,precipitation_sum:array<double>,relative_humidity_2m_mean:array<double>,"
    "wind_speed_10m_max:array<double>>"
)
SECONDARY_SCHEMA = (
    "current_condition array<struct<temp_C:string,humidity:string,precipMM:string,windspeedKmph:string>>, "
    "weather array<struct<date:string,maxtempC:string,mintempC:string,hourly:array<struct<precipMM:string>>>>"
)
FORECAST_TYPE = (
    "array<struct<forecast_date:string,temp_max:double,temp_min:double,rainfall_sum_mm:double,"
    "humidity_mean:double,wind_speed_max:double>>"
)


def _ordered_list(spark: SparkSession, path: str, schema: str, seq: str) -> DataFrame:
    """A JSON list file whose order matters: the place in the list becomes a column."""
    whole = spark.read.text(path, wholetext=True)
    rows = F.from_json(F.col("value"), f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")
    return whole.select(F.posexplode(rows).alias(seq, "_r")).select("_r.*", F.col(seq).cast("bigint").alias(seq))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return _ordered_list(spark, path, PAGE_SCHEMA, "page_seq")


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return _ordered_list(spark, path, STATION_SCHEMA, "station_seq")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Post items as JSON lines."""
    return spark.read.schema(ITEM_SCHEMA).json(path)


def post_items(items: DataFrame) -> DataFrame:
    """Items with one column per meaning: asked URL, post URL, time, caption and media."""
    return items.select(
        F.coalesce(F.nullif(F.col("inputUrl"), F.lit("")), F.col("facebookUrl"), F.lit("")).alias("asked_url"),
        F.col("pageName").alias("page_name"),
        urls.post_url(F.col("url"), F.col("topLevelUrl")).alias("source_url"),
        times.post_time(F.col("time"), F.col("timestamp")).alias("posted_at"),
        nested.caption(F.col("text"), F.col("resharedText"), F.col("sharePost.text"), F.col("attachedPost.text"))
        .alias("raw_text"),
        "media",
        *[c for c in items.columns if c in ("item_seq",)],
    )


def _reading(temperature: Column, humidity: Column, rain: Column, wind: Column, observed: Column) -> Column:
    return F.struct(
        temperature.alias("temperature"), humidity.alias("humidity"), rain.alias("rainfall_mm"),
        wind.alias("wind_speed"), observed.alias("observed_at"),
    )


def _primary(p: Column, days: int) -> Column:
    now, daily = p["current"], p["daily"]
    take = F.least(F.lit(days), F.greatest(F.size(daily["time"]) - 1, F.lit(0)))
    readings = [
        F.coalesce(daily[name], F.array().cast("array<double>"))
        for name in ("temperature_2m_max", "temperature_2m_min", "precipitation_sum", "relative_humidity_2m_mean", "wind_speed_10m_max")
    ]
    zipped = F.arrays_zip(daily["time"], *readings).cast(FORECAST_TYPE)
    return F.when(
        now["time"].isNotNull() & daily["time"].isNotNull(),
        F.struct(
            _reading(now["temperature_2m"], now["relative_humidity_2m"], now["precipitation"],
                     now["wind_speed_10m"], times.with_offset(now["time"])).alias("current"),
            F.slice(zipped, F.lit(2), take).alias("forecasts"),
        ),
    )


def _secondary(p: Column, observed_at: Column, days: int) -> Column:
    def number(c: Column) -> Column:
        return c.try_cast("double")

    now = F.get(p["current_condition"], F.lit(0))
    humidity, wind = number(now["humidity"]), number(now["windspeedKmph"])
    forecasts = F.transform(
        F.slice(p["weather"], 2, days),
        lambda d: F.struct(
            d["date"].alias("forecast_date"), number(d["maxtempC"]).alias("temp_max"), number(d["mintempC"]).alias("temp_min"),
            F.coalesce(number(F.get(d["hourly"], F.lit(0))["precipMM"]), F.lit(0.0)).alias("rainfall_sum_mm"),
            humidity.alias("humidity_mean"), wind.alias("wind_speed_max"),
        ),
    )
    return F.when(
        now.isNotNull(),
        F.struct(
            _reading(number(now["temp_C"]), humidity, number(now["precipMM"]), wind, observed_at).alias("current"),
            F.coalesce(forecasts, F.array().cast(FORECAST_TYPE)).alias("forecasts"),
        ),
    )


def parse_weather(df: DataFrame, order: tuple[str, ...], observed_at: Column, days: int = vocab.FORECAST_DAYS,
                  out: str = "weather") -> DataFrame:
    """Add (current, forecasts) from the first payload column of ``order`` that can be read.

    ``primary`` holds parallel arrays whose first entry is today.  ``secondary`` holds a list of
    days; its humidity and wind come from the current reading.  Each text is parsed once.
    """
    schemas = {"primary": PRIMARY_SCHEMA, "secondary": SECONDARY_SCHEMA}
    parsed = df.withColumns({f"_{name}": F.from_json(F.col(name), schemas[name]) for name in order})
    shaped = {"primary": lambda: _primary(F.col("_primary"), days), "secondary": lambda: _secondary(F.col("_secondary"), observed_at, days)}
    return parsed.withColumn(out, F.coalesce(*[shaped[name]() for name in order])).drop(*[f"_{n}" for n in order], *order)


def local_hour(now: Column, offset_hours: int = 8) -> Column:
    """The full hour of ``now`` in local time, as ISO text with the fixed offset."""
    local = F.timestamp_seconds(F.unix_seconds(now) + offset_hours * 3600)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH"), F.lit(":00:00" + vocab.LOCAL_OFFSET))
