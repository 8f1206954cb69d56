"""Site dimension: the built-in list and a CSV reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from hourcast.schemas import SITES

# ---------------------------------------------------------------------------
# The 22 sites (name, id, latitude, longitude) of the current list.
# ---------------------------------------------------------------------------
SITE_LIST = [
    ("Ordway-Swisher Biological Station - Barco Lake", "BARC", 29.67647, -82.00909),
    ("Crampton Lake", "CRAM", 46.21111, -89.47825),
    ("Little Rock Lake", "LIRO", 45.998269, -89.704767),
    ("Prairie Lake at Dakota Coteau Field School", "PRLA", 47.15909, -99.11388),
    ("Prairie Pothole", "PRPO", 47.12999, -99.25055),
    ("Ordway-Swisher Biological Station - Suggs Lake", "SUGG", 29.68705, -82.01617),
    ("Toolik Lake", "TOOK", 68.630692, -149.610636),
    ("Falling Creek Reservoir", "fcre", 37.303153, -79.837217),
    ("Beaverdam Reservoir", "bvre", 37.312909, -79.815936),
    ("Carvins Cove Reservoir", "ccre", 37.370259, -79.95856),
    ("Lake Sunapee", "sunp", 43.392869, -72.058199),
    ("Lough Feeagh", "feea", 53.948889, -9.575556),
    ("Lake Alexandrina", "ALEX", -35.436808, 139.168997),
    ("Canning River", "CANN", -32.0283348, 115.9339206),
    ("Lake Monger", "MONG", -31.9343092, 115.8280955),
    ("Yellagonga", "YELL", -31.7406592, 115.7880325),
    ("Sau reservoir", "SAUR", 41.97253, 2.390048),
    ("Sparkling Lake", "SPLK", 46.00682222, -89.70101667),
    ("Trout Lake", "TRLK", 46.028646, -89.668446),
    ("Trout Bog", "TRBG", 46.041137, -89.686181),
    ("Lake Mendota", "LKME", 43.106860, -89.415224),
    ("Upper Yarra", "YARR", -37.687278, 145.914415),
]
# ---------------------------------------------------------------------------


def builtin_sites(spark: SparkSession) -> DataFrame:
    """The site list as a DataFrame (22 rows)."""
    return spark.createDataFrame(SITE_LIST, SITES)


#: Faults that a refused site list names one by one.
NAMED_FAULTS = 20


def _site_rows(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed rows of a site CSV; ``record`` is the line of a row that does not fit the schema."""
    df = (spark.read
          .option("header", True)
          .option("ignoreLeadingWhiteSpace", True)
          .option("ignoreTrailingWhiteSpace", True)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "record")
          .schema(T.StructType([*SITES.fields, T.StructField("record", T.StringType())]))
          .csv(path))
    return df.select(F.trim("site_name").alias("site_name"), F.trim("site_id").alias("site_id"), "latitude", "longitude", "record")


def site_faults(spark: SparkSession, path: str) -> DataFrame:
    """(site_id, fault, record) of every row that a site list must not have.

    ``unreadable``: a number that is none, or too many fields (``record`` is the line); ``no id``; ``no place``: a coordinate is
    missing, not a number or off the globe; ``repeated``: another row has the id. A row may have several faults.
    """
    rows = _site_rows(spark, path)
    count = rows.groupBy("site_id").agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.join(count.withColumnRenamed("site_id", "_id"), F.col("site_id").eqNullSafe(F.col("_id")), "left")
    no_id = F.col("site_id").isNull() | (F.col("site_id") == "")
    off = lambda c, most: F.col(c).isNull() | F.isnan(c) | (F.abs(c) > most)
    faults = F.array_compact(F.array(
        F.when(F.col("record").isNotNull(), "unreadable"), F.when(no_id, "no id"),
        F.when(F.col("record").isNull() & (off("latitude", 90) | off("longitude", 360)), "no place"),
        F.when(~no_id & (F.col("_n") > 1), "repeated")))
    return rows.select("site_id", F.explode(faults).alias("fault"), "record")


def read_sites(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """IO-04: read a site CSV (header site_name,site_id,latitude,longitude).

    Fields are trimmed: some ids carry a leading blank (`' ALEX'`), which would
    silently miss every join on site_id. A list with faults is refused, and the faults are
    named: a bad number would empty all shortwave of its site, a repeated id multiply its rows. With
    ``strict=False`` the rows without fault are read, and those with any left out.
    """
    rows, faults = _site_rows(spark, path), site_faults(spark, path)
    if strict:
        found = faults.limit(NAMED_FAULTS + 1).collect()
        if found:
            named = sorted(f"{r['site_id']}: {r['fault']}" + (f" ({r['record']})" if r["record"] else "") for r in found[:NAMED_FAULTS])
            raise ValueError("site list refused: " + "; ".join(named) + (" and more" if len(found) > NAMED_FAULTS else ""))
    else:
        bad = faults.select(F.col("site_id").alias("_bad")).distinct()
        rows = rows.join(bad, F.col("site_id").eqNullSafe(F.col("_bad")), "left_anti")
    return rows.drop("record")
