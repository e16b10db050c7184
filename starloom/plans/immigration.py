"""Immigration records with the temperature of the port's city."""

from pyspark.sql import DataFrame, functions as F

from starloom.operators.clean import drop_missing, first_per_key
from starloom.operators.joins import contains_lookup, keep_ids
from starloom.operators.writes import write_partitioned

# Column names of the tables.
IMMIGRATION_COLUMNS = ["i94yr", "i94mon", "i94cit", "i94port", "arrdate", "i94mode", "depdate", "i94visa"]
TEMPERATURE_COLUMNS = ["AverageTemperature", "City", "Country", "Latitude", "Longitude", "i94port"]


def valid_immigration(immigration: DataFrame, ports: DataFrame) -> DataFrame:
    """Records of known ports."""
    return keep_ids(immigration, ports.select(F.col("code").alias("i94port")), "i94port").select(*IMMIGRATION_COLUMNS)


def port_temperature(temperature: DataFrame, ports: DataFrame, tiebreak) -> DataFrame:
    """One measured row per city and country, with the first port whose label contains the city.

    ``ports`` has ``code, label, line_no``. The row kept per city is the first by ``tiebreak``.
    """
    measured = drop_missing(temperature, not_nan_text=["AverageTemperature"])
    cities = first_per_key(measured, ["City", "Country"], tiebreak)
    located = contains_lookup(cities, "City", ports, "label", "code", "line_no")
    return located.where("code is not null").withColumnRenamed("code", "i94port").select(*TEMPERATURE_COLUMNS)


def immigration_fact(immigration: DataFrame, temperature: DataFrame) -> DataFrame:
    return immigration.join(temperature, "i94port").select(
        F.col("i94yr").alias("year"),
        F.col("i94mon").alias("month"),
        F.col("i94cit").alias("city"),
        "i94port",
        F.col("arrdate").alias("arrival_date"),
        F.col("depdate").alias("departure_date"),
        F.col("i94visa").alias("reason"),
        F.col("AverageTemperature").alias("temperature"),
        F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
    )


def write_tables(immigration, temperature, ports, folder, tiebreak, mode="overwrite") -> None:
    """All three tables below a folder, partitioned by port."""
    records = valid_immigration(immigration, ports)
    cities = port_temperature(temperature, ports, tiebreak)
    write_partitioned(records, f"{folder}/immigration", "i94port", mode=mode)
    write_partitioned(cities, f"{folder}/temperature", "i94port", mode=mode)
    write_partitioned(immigration_fact(records, cities), f"{folder}/fact", "i94port", mode=mode)
