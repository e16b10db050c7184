"""Rental database to star schema. Load dates are arguments."""

from pyspark.sql import DataFrame, functions as F

from starloom.functions import dates
from starloom.functions.keys import add_dense_keys


def dim_date(days: DataFrame, ts: str) -> DataFrame:
    """One row per day that occurs in a time column."""
    day = days.select(F.to_date(ts).alias("date")).distinct()
    return day.select(
        dates.date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.weekofyear("date").alias("week"),
        dates.is_weekend("date").alias("is_weekend"),
    )


def dim_customer(customer, address, city, country, load_date) -> DataFrame:
    place = address.join(city.select("city_id", "city", "country_id"), "city_id").join(
        country.select("country_id", "country"), "country_id"
    )
    return customer.join(place.drop("last_update"), "address_id").select(
        F.col("customer_id").alias("customer_key"),
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "address",
        "address2",
        "district",
        "city",
        "country",
        "postal_code",
        "phone",
        "active",
        "create_date",
        F.lit(load_date).cast("date").alias("start_date"),
        F.lit(load_date).cast("date").alias("end_date"),
    )


def dim_movie(film, language) -> DataFrame:
    """Films with both language names; the original language may be missing."""
    spoken = language.select("language_id", F.col("name").alias("language"))
    original = language.select(
        F.col("language_id").alias("original_language_id"), F.col("name").alias("original_language")
    )
    return (
        film.join(spoken, "language_id")
        .join(original, "original_language_id", "left")
        .select(
            F.col("film_id").alias("movie_key"),
            "film_id",
            "title",
            "description",
            "release_year",
            "language",
            "original_language",
            "rental_duration",
            "length",
            "rating",
            "special_features",
        )
    )


def dim_store(store, staff, address, city, country, load_date) -> DataFrame:
    place = address.join(city.select("city_id", "city", "country_id"), "city_id").join(
        country.select("country_id", "country"), "country_id"
    )
    manager = staff.select(
        F.col("staff_id").alias("manager_staff_id"),
        F.col("first_name").alias("manager_first_name"),
        F.col("last_name").alias("manager_last_name"),
    )
    return (
        store.join(place.drop("last_update"), "address_id")
        .join(manager, "manager_staff_id")
        .select(
            F.col("store_id").alias("store_key"),
            "store_id",
            "address",
            "address2",
            "district",
            "city",
            "country",
            "postal_code",
            "manager_first_name",
            "manager_last_name",
            F.lit(load_date).cast("date").alias("start_date"),
            F.lit(load_date).cast("date").alias("end_date"),
        )
    )


def fact_sales(payment: DataFrame, rental: DataFrame, inventory: DataFrame, payment_key=None) -> DataFrame:
    """One row per payment. With ``payment_key`` the rows get a stable ``sales_key``: the payment's number."""
    if payment_key:
        payment = add_dense_keys(payment, payment_key, "sales_key")
    return (
        payment.join(rental.select("rental_id", "inventory_id"), "rental_id")
        .join(inventory.select("inventory_id", "film_id", "store_id"), "inventory_id")
        .select(
            *(["sales_key"] if payment_key else []),
            dates.date_key("payment_date").alias("date_key"),
            F.col("customer_id").alias("customer_key"),
            F.col("film_id").alias("movie_key"),
            F.col("store_id").alias("store_key"),
            F.col("amount").alias("sales_amount"),
        )
    )
