"""Declared schemas.

Fixed values: the fact-table layout and the column names below must equal the
reference's for the derived tables to line up.  The appearance table is, in
order: year int, entrantId string, constructorId string, driverId string,
tookPart boolean, testDriver boolean.
"""

from pyspark.sql import types as T

APPEARANCES = T.StructType([
    T.StructField("year", T.IntegerType(), True),
    T.StructField("entrantId", T.StringType(), True),
    T.StructField("constructorId", T.StringType(), True),
    T.StructField("driverId", T.StringType(), True),
    T.StructField("tookPart", T.BooleanType(), True),
    T.StructField("testDriver", T.BooleanType(), True),
])

# Output column orders of the four career tables.
DEBUT_COLUMNS = ["driverId", "constructorId", "debut_year"]
RETIREMENT_COLUMNS = ["driverId", "constructorId", "retirement_year"]
TRANSFER_COLUMNS = ["driverId", "const_out", "transfer_out", "const_in", "transfer_in"]
BREAK_COLUMNS = ["driverId", "const_out", "break_year", "const_in", "return_year", "gap"]

# A season entry: either inline constructorId + driver fields, or a list of
# constructors; each of those either inline driver fields or a list of drivers.
DRIVER_ENTRY = T.StructType([
    T.StructField("driverId", T.StringType(), True),
    T.StructField("rounds", T.StringType(), True),
    T.StructField("testDriver", T.BooleanType(), True),
])
CONSTRUCTOR_ENTRY = T.StructType([
    T.StructField("constructorId", T.StringType(), True),
    T.StructField("driverId", T.StringType(), True),
    T.StructField("rounds", T.StringType(), True),
    T.StructField("testDriver", T.BooleanType(), True),
    T.StructField("drivers", T.ArrayType(DRIVER_ENTRY), True),
])
SEASON_ENTRY = T.StructType([
    T.StructField("entrantId", T.StringType(), True),
    T.StructField("constructorId", T.StringType(), True),
    T.StructField("driverId", T.StringType(), True),
    T.StructField("rounds", T.StringType(), True),
    T.StructField("testDriver", T.BooleanType(), True),
    T.StructField("drivers", T.ArrayType(DRIVER_ENTRY), True),
    T.StructField("constructors", T.ArrayType(CONSTRUCTOR_ENTRY), True),
])

# Chronology element of a constructor document (rebranding chain).
CHRONOLOGY_ITEM = T.StructType([
    T.StructField("constructorId", T.StringType(), True),
    T.StructField("yearFrom", T.IntegerType(), True),
    T.StructField("yearTo", T.IntegerType(), True),
])
