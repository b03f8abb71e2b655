"""Column contracts of the lake. Reads always pass one of these; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, DOUBLE, STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
TIMESTAMP, DATE, BINARY = T.TimestampType(), T.DateType(), T.BinaryType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# The shapes in which weather documents arrive. Whole measures are read as doubles, since deliveries may
# carry fractions, and cast afterwards.

# One message on a topic (the JSON inside `value`).
WEATHER_MESSAGE = struct(
    coord=struct(lon=DOUBLE, lat=DOUBLE),
    main=struct(temp=DOUBLE, humidity=DOUBLE, pressure=DOUBLE),
    wind=struct(speed=DOUBLE, deg=DOUBLE),
    clouds=struct(all=DOUBLE),
    dt=LONG,
    name=STRING,
)

MAIN_FULL = struct(
    temp=DOUBLE, temp_min=DOUBLE, temp_max=DOUBLE, feels_like=DOUBLE, pressure=DOUBLE, humidity=DOUBLE
)

# One element of a history array.
HISTORY_DOCUMENT = struct(
    dt=LONG,
    dt_iso=STRING,
    lat=DOUBLE,
    lon=DOUBLE,
    main=MAIN_FULL,
    clouds=struct(all=DOUBLE),
    wind=struct(speed=DOUBLE, deg=DOUBLE),
    uv_index=DOUBLE,
)

# One landing record of the batch connector: payload wrapped with delivery metadata.
ENVELOPE = struct(
    _airbyte_ab_id=STRING,
    _airbyte_emitted_at=LONG,
    _airbyte_data=struct(
        dt=LONG,
        coord=struct(lat=DOUBLE, lon=DOUBLE),
        main=MAIN_FULL,
        wind=struct(speed=DOUBLE, deg=DOUBLE),
        clouds=struct(all=DOUBLE),
        visibility=DOUBLE,
        weather=T.ArrayType(struct(description=STRING)),
        name=STRING,
    ),
)

# Landing table of the stream, as read back (partition columns last).
LANDING_STREAM = struct(
    dt=LONG,
    lat=DOUBLE,
    lon=DOUBLE,
    temp=DOUBLE,
    pressure=INT,
    humidity=INT,
    wind_speed=DOUBLE,
    wind_deg=INT,
    clouds=INT,
    city_name=STRING,
    ingestion_timestamp=TIMESTAMP,
    ingestion_date=DATE,
    topic=STRING,
    year=INT,
    month=INT,
    day=INT,
)

# Rows as a Kafka source delivers them, reduced to the two columns the pipeline reads.
TOPIC_ROWS = struct(value=BINARY, topic=STRING)

# Silver: one row per site and observation time.
SILVER = struct(
    dt=LONG,
    dt_iso=STRING,
    city=STRING,
    lat=DOUBLE,
    lon=DOUBLE,
    temp=DOUBLE,
    temp_min=DOUBLE,
    temp_max=DOUBLE,
    feels_like=DOUBLE,
    pressure=INT,
    humidity=INT,
    clouds=INT,
    wind_speed=DOUBLE,
    wind_deg=INT,
    uv_index=DOUBLE,
)

# Consolidated history: Silver columns, the delivery time, and the month the observation belongs to.
HISTORY_TABLE = T.StructType(SILVER.fields + struct(ingestion_timestamp=TIMESTAMP, year=INT, month=INT).fields)
HISTORY_PARTITIONS = ("year", "month")

# Micro-batches that have gone into a table: the stream's identity, its batch number, and the counts as JSON.
LEDGER = struct(report=STRING, stream=STRING, batch=LONG)

# Identity of an observation.
OBSERVATION_KEY = ("dt", "lat", "lon")

# Observation times, in seconds, that can be true: the years 1900 to 2199. Others are mistakes of unit or of clock.
EARLIEST, LATEST = -2_208_988_800, 7_258_118_399
