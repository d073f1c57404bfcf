"""Explicit schemas for the six retail sources (no schema inference)."""

from pyspark.sql import types as T

TRAIN = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("family", T.StringType()),
    T.StructField("sales", T.DoubleType()),
    T.StructField("onpromotion", T.IntegerType()),
])

TEST = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("family", T.StringType()),
    T.StructField("onpromotion", T.IntegerType()),
])

STORES = T.StructType([
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("cluster", T.IntegerType()),
])

# Lenient numeric columns are read as text and coerced with try_cast.
OIL = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("dcoilwtico", T.StringType()),
])

HOLIDAYS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("type", T.StringType()),
    T.StructField("locale", T.StringType()),
    T.StructField("locale_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("transferred", T.StringType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("transactions", T.StringType()),
])

RAW_SCHEMAS = {
    "train": TRAIN,
    "test": TEST,
    "stores": STORES,
    "oil": OIL,
    "holidays": HOLIDAYS,
    "transactions": TRANSACTIONS,
}

TRAIN_KEY = ["date", "store_nbr", "family"]
SERIES_KEY = ["store_nbr", "family"]
