"""Declared schemas for every table the engine reads or writes.

One ``StructType`` per table; readers pass them in (no inference pass) and
writers conform to them by name (``functions.columns.conform``).
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "int": T.IntegerType(),
}


def struct(fields, non_null=()) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], n not in non_null) for n, t in fields])


# ---------------------------------------------------------------------------
# The standardised listing record, field names, types and order
# as declared by the source system (44 fields, only queryDate non-nullable).
# ---------------------------------------------------------------------------
LISTING_FIELDS = [
    ("address", "string"), ("bathrooms", "long"), ("country", "string"),
    ("subTypology", "string"), ("typology", "string"), ("distance", "string"),
    ("district", "string"), ("exterior", "boolean"), ("externalReference", "string"),
    ("floor", "string"), ("has360", "boolean"), ("has3DTour", "boolean"),
    ("hasLift", "boolean"), ("hasPlan", "boolean"), ("hasStaging", "boolean"),
    ("hasVideo", "boolean"), ("latitude", "double"), ("longitude", "double"),
    ("municipality", "string"), ("neighborhood", "string"), ("newDevelopment", "boolean"),
    ("numPhotos", "long"), ("operation", "string"), ("price", "double"),
    ("priceByArea", "double"), ("propertyCode", "string"), ("propertyType", "string"),
    ("province", "string"), ("rooms", "long"), ("showAddress", "boolean"),
    ("size", "double"), ("status", "string"), ("subtitle", "string"),
    ("title", "string"), ("thumbnail", "string"), ("topNewDevelopment", "boolean"),
    ("url", "string"), ("newDevelopmentFinished", "boolean"), ("hasParkingSpace", "boolean"),
    ("isParkingSpaceIncludedInPrice", "boolean"), ("parkingSpacePrice", "double"),
    ("queryDate", "string"), ("district_id", "string"), ("neighborhood_id", "string"),
]
# The wide training table adds these after the listing fields,
# with queryDate stored as a date.
SALES_EXTRA_FIELDS = [
    ("population", "long"), ("RFD", "double"), ("move_in", "long"), ("move_out", "long"),
]

LISTING = struct(LISTING_FIELDS, non_null={"queryDate"})
SALES = struct(
    [(n, "date" if n == "queryDate" else t) for n, t in LISTING_FIELDS] + SALES_EXTRA_FIELDS,
    non_null={"queryDate"},
)

# Standardised movements (one row per origin, destination and year).
MOVES = struct([
    ("year", "long"), ("moved", "long"),
    ("neighborhood_name", "string"), ("neighborhood_id", "string"),
    ("district_name", "string"), ("district_id", "string"),
    ("dest_neighborhood_name", "string"), ("dest_neighborhood_id", "string"),
    ("dest_district_name", "string"), ("dest_district_id", "string"),
])

# Standardised income: reconciled names and ids, then the spread info fields.
INCOME_INFO = struct([("year", "long"), ("pop", "long"), ("RFD", "double")])
INCOME = struct([
    ("neighborhood_name", "string"), ("district_name", "string"),
    ("district_id", "string"), ("neighborhood_id", "string"),
    ("year", "long"), ("pop", "long"), ("RFD", "double"),
])

# Curated tables.
NEIGHBOURHOOD = struct([("moved_out", "long"), ("RFD", "double"), ("year", "long"),
                        ("district_name", "string"), ("neighbourhood_name", "string")])
REAL_ESTATE = struct([("moved_in", "long"), ("advertisements", "long"), ("year", "long"),
                      ("district_name", "string"), ("neighbourhood_name", "string")])
SALE_PRICES = struct([("price", "double"), ("RFD", "double"), ("queryDate", "timestamp_ntz"),
                      ("district_name", "string"), ("neighbourhood_name", "string")])

# ---------------------------------------------------------------------------
# Raw (landing) inputs.
# ---------------------------------------------------------------------------
# Raw movement CSV columns used (all read as text).
RAW_MOVES_COLUMNS = ["Codi_Barri", "CODI_BARRI_DEST", "Any", "Valor"]
# Raw income JSON lines; note the trailing space in the neighbourhood field name.
RAW_INCOME = T.StructType([
    T.StructField("neigh_name ", T.StringType()),
    T.StructField("district_name", T.StringType()),
    T.StructField("info", T.ArrayType(INCOME_INFO)),
])

# Lookup files (JSON lines).
RENT_DISTRICT = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("di", T.StringType()),
    T.StructField("di_n", T.StringType()), T.StructField("di_re", T.StringType()),
    T.StructField("ne_id", T.ArrayType(T.StringType())),
])
RENT_NEIGHBOURHOOD = struct([("_id", "string"), ("ne", "string"), ("ne_n", "string"),
                             ("ne_re", "string")])
INCOME_DISTRICT = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("district", T.StringType()),
    T.StructField("district_name", T.StringType()),
    T.StructField("district_reconciled", T.StringType()),
    T.StructField("neighborhood_id", T.ArrayType(T.StringType())),
])
INCOME_NEIGHBOURHOOD = struct([("_id", "string"), ("neighborhood", "string"),
                               ("neighborhood_name", "string"),
                               ("neighborhood_reconciled", "string")])
CODE_BRIDGE = struct([("codi_barri", "string"), ("nom_districte", "string"),
                      ("nom_barri", "string")])

# ---------------------------------------------------------------------------
# Bookkeeping tables (append-only).
# ---------------------------------------------------------------------------
LEDGER = struct([("pipe", "string"), ("item", "string"), ("kind", "string"),
                 ("run_id", "string"), ("ts", "timestamp")])
PUBLISH_STATUS = struct([("pipe", "string"), ("status", "string"), ("output", "string"),
                         ("database", "string"), ("ts", "timestamp")])
MODEL_METRICS = struct([("model_path", "string"), ("timestamp", "timestamp"),
                        ("mae", "double"), ("rmse", "double"), ("entries", "long")])
