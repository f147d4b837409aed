"""Fixed schemas of the sensor data model (never inferred)."""

from pyspark.sql.types import (FloatType, IntegerType, LongType, StringType,
                               StructField, StructType)

# Column names and types of the raw accelerometer file, the
# realtime (stream) rows and the demographic file.  The raw file's last field
# carries a trailing ';', so it is read as a string and cleaned.
SENSOR_RAW = StructType([
    StructField("userId", IntegerType(), True),
    StructField("action", StringType(), True),
    StructField("timestamp", LongType(), True),
    StructField("x", FloatType(), True),
    StructField("y", FloatType(), True),
    StructField("z", StringType(), True),
])

REALTIME = StructType([
    StructField("userId", IntegerType(), True),
    StructField("action", StringType(), True),
    StructField("timestamp", LongType(), True),
    StructField("x", FloatType(), True),
    StructField("y", FloatType(), True),
    StructField("z", FloatType(), True),
])

DEMOGRAPHIC = StructType([
    StructField("userId", IntegerType(), True),
    StructField("height", FloatType(), True),
    StructField("sex", StringType(), True),
    StructField("age", IntegerType(), True),
    StructField("weight", FloatType(), True),
    StructField("leg_injury", IntegerType(), True),
])

PREDICTIONS = StructType([
    StructField("userId", IntegerType(), True),
    StructField("timestamp", LongType(), True),
    StructField("predicted_action", StringType(), True),
])

# The label used for rows without an activity.
UNLABELED = "No Label"


def as_text(schema: StructType) -> StructType:
    """Same field names, every field a nullable string (raw CSV parse)."""
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])
