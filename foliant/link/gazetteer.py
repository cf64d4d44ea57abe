"""Places looked up in and checked against a gazetteer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.place import city_key, split_place, uncertainty
from foliant.operators.firsts import first_row_by

PLACE = ("tgn_id", "publication_place", "publication_country", "longitude", "latitude")


def locate(df: DataFrame, place: str, places: DataFrame, countries: DataFrame, order: str = "_row_id") -> DataFrame:
    """df with the place's flags and PLACE columns: by city key, and the country by name where it is still empty.

    places: city_harmonised and PLACE; countries: country, country_harmonised; of repeated keys the first row counts.
    """
    city, country = split_place(place)
    flags = uncertainty(city)
    d = df.withColumn("_city", city_key(city)).withColumn("_country", country)
    d = d.withColumns({f"place_uncertainty_{k}": c for k, c in flags.items()})
    p = first_row_by(places, ["city_harmonised"], order).drop(order) if order in places.columns else places.dropDuplicates(["city_harmonised"])
    c = first_row_by(countries, ["country"], order).drop(order) if order in countries.columns else countries.dropDuplicates(["country"])
    j = d.join(p, d["_city"] == p["city_harmonised"], "left").drop("city_harmonised")
    c = c.select(F.col("country").alias("_c"), F.col("country_harmonised").alias("_h"))
    j = j.join(c, F.col("_country") == F.col("_c"), "left")
    return j.withColumn("publication_country", F.coalesce("publication_country", "_h")).drop("_city", "_country", "_c", "_h")


def verify(table: DataFrame, gazetteer: DataFrame, degrees: float = 0.5) -> DataFrame:
    """table with flags: id_unknown, country_differs, label_differs, far_off, homonyms (other ids of that label).

    gazetteer: tgn_id, label, country, longitude, latitude.
    """
    g = gazetteer.select(F.col("tgn_id").alias("_id"), F.col("label").alias("_label"), F.col("country").alias("_country"), F.col("longitude").alias("_lon"), F.col("latitude").alias("_lat"))
    same = gazetteer.groupBy(F.lower("label").alias("_l")).agg(F.count_distinct("tgn_id").alias("_n"))
    j = table.join(g, table["tgn_id"] == F.col("_id"), "left").join(same, F.lower("publication_place") == F.col("_l"), "left")
    off = (F.abs(F.col("longitude").try_cast("double") - F.col("_lon")) > degrees) | (F.abs(F.col("latitude").try_cast("double") - F.col("_lat")) > degrees)
    return j.select(
        *table.columns,
        F.col("_id").isNull().alias("id_unknown"),
        F.coalesce(F.col("publication_country") != F.col("_country"), F.lit(False)).alias("country_differs"),
        F.coalesce(F.lower("publication_place") != F.lower("_label"), F.lit(False)).alias("label_differs"),
        F.coalesce(off, F.lit(False)).alias("far_off"),
        F.greatest(F.coalesce("_n", F.lit(0)) - 1, F.lit(0)).cast("long").alias("homonyms"),
    )
