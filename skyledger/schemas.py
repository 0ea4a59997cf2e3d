"""Fixed record layouts. All fields are nullable."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def layout(**fields: str) -> T.StructType:
    """A nullable ``StructType`` from ``name=type`` pairs."""
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields.items()])


# Field names and types of the interchange records.
TRAINING_FEATURE = layout(
    ArrDelay="double", CRSArrTime="timestamp", CRSDepTime="timestamp", Carrier="string", DayOfMonth="int",
    DayOfWeek="int", DayOfYear="int", DepDelay="double", Dest="string", Distance="double", FlightDate="date",
    FlightNum="string", Origin="string",
)

BATCH_REQUEST = layout(
    Carrier="string", DayOfMonth="int", DayOfWeek="int", DayOfYear="int", DepDelay="double", Dest="string",
    Distance="double", FlightDate="date", FlightNum="string", Origin="string", Timestamp="timestamp",
)

STREAM_REQUEST = T.StructType(BATCH_REQUEST.fields + layout(UUID="string").fields)

INDEX_FIELDS = ("Carrier_index", "Origin_index", "Dest_index", "Route_index")

# The message reader also accepts a class and indices computed by the sender.
STREAM_MESSAGE = T.StructType(
    STREAM_REQUEST.fields
    + layout(Prediction="string").fields
    + layout(**{name: "double" for name in INDEX_FIELDS}).fields
)

# A scored request as a message; its times stay text.
STREAM_RESPONSE = layout(
    UUID="string", Origin="string", Dest="string", Carrier="string", DepDelay="double", Prediction="double",
    Timestamp="string", FlightDate="string", DayOfWeek="int", DayOfYear="int", DayOfMonth="int", Distance="double",
    Route="string",
)

DISTANCE = layout(origin="string", dest="string", distance="int")

RESPONSE = layout(
    uuid="string", origin="string", dest="string", carrier="string", depdelay="double", prediction="double",
    timestamp="string", flightdate="string", dayofweek="int", dayofyear="int", dayofmonth="int", distance="double",
    route="string",
)

# Form fields, all text, and the fields of the two searches.
FORM = layout(
    DepDelay="string", Carrier="string", FlightDate="string", Dest="string", FlightNum="string", Origin="string",
)

FLIGHT_SEARCH_FIELDS = ("Carrier", "FlightDate", "Origin", "Dest", "TailNum", "FlightNum")

AIRPLANE_SEARCH_FIELDS = (
    "TailNum", "Owner", "OwnerState", "Manufacturer", "Model", "ManufacturerYear", "SerialNumber",
    "EngineManufacturer", "EngineModel",
)
