"""Business queries on the rental database (tables as in ``schemas.SCHEMAS``).

Where a fact is joined on the one key it can be summed by, it is summed first:
the join then reuses the shuffle of the sum, and a popular key arrives as one
row per task. Sums over several keys that would hardly shrink are left to the
end, and Spark splits the skewed joins on the way.
"""

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions import dates, text
from starloom.operators.aggregate import concat_by, having_totals, top_k
from starloom.operators.joins import join_chain, keep_ids


# Stock

def in_stock(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Every item with ``in_stock``: true unless a rental of it is open."""
    rented = rental.groupBy("inventory_id").agg(F.count_if(F.col("return_date").isNull()).alias("_open"))
    return inventory.join(rented, "inventory_id", "left").withColumn(
        "in_stock", F.coalesce(F.col("_open"), F.lit(0)) == 0
    ).drop("_open")


def film_in_stock(inventory: DataFrame, rental: DataFrame, film_id, store_id, available=True) -> DataFrame:
    """Items of a film in a store that are (or are not) in stock."""
    wanted = inventory.where((F.col("film_id") == film_id) & (F.col("store_id") == store_id))
    stock = in_stock(wanted, rental)
    return stock.where(F.col("in_stock") if available else ~F.col("in_stock")).select("inventory_id")


def held_by_customer(rental: DataFrame) -> DataFrame:
    """Customer of every open rental."""
    return rental.where(F.col("return_date").isNull()).select("inventory_id", "customer_id")


# Customers

def _late_days() -> Column:
    """Whole days beyond the film's rental duration; NULL for open rentals."""
    late = F.greatest(F.date_diff("return_date", "rental_date") - F.col("rental_duration"), F.lit(0))
    return F.when(F.col("return_date").isNotNull(), late).cast("long")


def balances(customer: DataFrame, moves: DataFrame, as_of) -> DataFrame:
    """Per customer: rental fees plus one unit per day late minus payments, up to a date.

    ``moves`` has ``customer_id`` and, as far as known, ``rental_date,
    return_date, rental_rate, rental_duration`` of a rental and ``payment_date,
    amount`` of a payment; a row may be both. One aggregation takes all three sums.
    Open rentals are not late yet. Customers without rentals or payments have 0.
    """
    as_of = F.lit(as_of).cast("timestamp")
    rented = F.col("rental_date") <= as_of
    due = F.when(rented, F.col("rental_rate")), F.when(rented, _late_days())
    paid = F.when(F.col("payment_date") <= as_of, F.col("amount"))
    sums = moves.groupBy("customer_id").agg(F.sum(due[0]).alias("_fees"), F.sum(due[1]).alias("_late"), F.sum(paid).alias("_paid"))
    none = F.lit(0)
    total = F.coalesce("_fees", none) + F.coalesce("_late", none) - F.coalesce("_paid", none)
    return customer.select("customer_id").join(sums, "customer_id", "left").select("customer_id", total.alias("balance"))


def customer_balance(
    customer: DataFrame, rental: DataFrame, inventory: DataFrame, film: DataFrame, payment: DataFrame, as_of
) -> DataFrame:
    """``balances`` from the tables of the database."""
    fees = (
        rental.select("customer_id", "inventory_id", "rental_date", "return_date")
        .join(inventory.select("inventory_id", "film_id"), "inventory_id")
        .join(film.select("film_id", "rental_rate", "rental_duration"), "film_id")
    )
    moves = fees.unionByName(payment.select("customer_id", "payment_date", "amount"), allowMissingColumns=True)
    return balances(customer, moves, as_of)


def rewards_report(customer: DataFrame, payment: DataFrame, min_purchases, min_amount, as_of) -> DataFrame:
    """Customers above both thresholds in the month that lies three months before ``as_of``."""
    if min_purchases <= 0:
        raise ValueError("minimum monthly purchases must be > 0")
    if min_amount <= 0:
        raise ValueError("minimum monthly amount must be > 0")
    first = dates.month_start_before(F.lit(as_of).cast("date"), 3)
    month = payment.where(
        (F.col("payment_date") >= first) & (F.col("payment_date") < F.date_add(F.last_day(first), 1))
    )
    return keep_ids(customer, having_totals(month, "customer_id", "amount", min_purchases, min_amount), "customer_id")


# Lists

def _place(address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    return join_chain(
        address.drop("last_update"), (city.drop("last_update"), "city_id"), (country.drop("last_update"), "country_id")
    )


def _people(people: DataFrame, key, place: DataFrame, *extra: Column) -> DataFrame:
    return people.join(place, "address_id").select(
        F.col(key).alias("id"),
        text.full_name(F.col("first_name"), F.col("last_name")).alias("name"),
        "address",
        F.col("postal_code").alias("zip code"),
        "phone",
        "city",
        "country",
        *extra,
        F.col("store_id").alias("sid"),
    )


def customer_list(customer, address, city, country) -> DataFrame:
    return _people(
        customer, "customer_id", _place(address, city, country), text.active_note(F.col("activebool")).alias("notes")
    )


def staff_list(staff, address, city, country) -> DataFrame:
    return _people(staff, "staff_id", _place(address, city, country))


def film_list(category, film_category, film, film_actor, actor, nicer=False) -> DataFrame:
    """Films with category and actors; ``nicer`` capitalises the names and joins them without a space."""
    first, last = F.col("first_name"), F.col("last_name")
    if nicer:
        name = text.full_name(text.capitalised(first), text.capitalised(last), sep="")
    else:
        name = text.full_name(first, last)
    cast = concat_by(
        film_actor.select("film_id", "actor_id").join(actor.select("actor_id", "first_name", "last_name"), "actor_id"),
        ["film_id"],
        name,
        "actors",
    )
    return (
        film.join(film_category.select("film_id", "category_id"), "film_id")
        .join(category.select("category_id", F.col("name").alias("category")), "category_id")
        .join(cast, "film_id")
        .select(
            F.col("film_id").alias("fid"),
            "title",
            "description",
            "category",
            F.col("rental_rate").alias("price"),
            "length",
            "rating",
            "actors",
        )
    )


def actor_info(actor, film_actor, film_category, category, film) -> DataFrame:
    """Every actor with ``category: films`` for each category, in name order; actors without films have NULL."""
    played = (
        film_actor.select("actor_id", "film_id")
        .join(film.select("film_id", "title"), "film_id")
        .join(film_category.select("film_id", "category_id"), "film_id")
        .join(category.select("category_id", "name"), "category_id")
    )
    films = concat_by(played, ["actor_id", "name"], F.col("title"), "titles")
    lists = concat_by(films, ["actor_id"], F.concat("name", F.lit(": "), "titles"), "film_info")
    return actor.select("actor_id", "first_name", "last_name").join(lists, "actor_id", "left")


# Sales

def sales_by_film(payment: DataFrame, rental: DataFrame, inventory: DataFrame) -> DataFrame:
    """Amount per film and store."""
    per_rental = payment.groupBy("rental_id").agg(F.sum("amount").alias("amount"))
    per_item = (
        per_rental.join(rental.select("rental_id", "inventory_id"), "rental_id")
        .groupBy("inventory_id")
        .agg(F.sum("amount").alias("amount"))
    )
    return (
        per_item.join(inventory.select("inventory_id", "film_id", "store_id"), "inventory_id")
        .groupBy("film_id", "store_id")
        .agg(F.sum("amount").alias("amount"))
    )


def revenue_by_title(payment, rental, inventory, film) -> DataFrame:
    return (
        sales_by_film(payment, rental, inventory)
        .join(film.select("film_id", "title"), "film_id")
        .groupBy("title")
        .agg(F.sum("amount").alias("revenue"))
    )


def sales_by_film_category(payment, rental, inventory, film_category, category) -> DataFrame:
    return (
        sales_by_film(payment, rental, inventory)
        .join(film_category.select("film_id", "category_id"), "film_id")
        .groupBy("category_id")
        .agg(F.sum("amount").alias("amount"))
        .join(category.select("category_id", F.col("name").alias("category")), "category_id")
        .groupBy("category")
        .agg(F.sum("amount").alias("total_sales"))
        .orderBy(F.desc("total_sales"), "category")
    )


def sales_by_store(payment, rental, inventory, store, address, city, country, staff) -> DataFrame:
    sales = sales_by_film(payment, rental, inventory).groupBy("store_id").agg(F.sum("amount").alias("total_sales"))
    manager = staff.select(
        F.col("staff_id").alias("manager_staff_id"),
        text.full_name(F.col("first_name"), F.col("last_name")).alias("manager"),
    )
    return (
        sales.join(store.select("store_id", "manager_staff_id", "address_id"), "store_id")
        .join(_place(address, city, country).select("address_id", "city", "country"), "address_id")
        .join(manager, "manager_staff_id")
        .orderBy("country", "city", "store_id")
        .select(text.full_name(F.col("city"), F.col("country"), ",").alias("store"), "manager", "total_sales")
    )


def revenue_by_city(payment, customer, address, city) -> DataFrame:
    paid = payment.groupBy("customer_id").agg(F.sum("amount").alias("amount"))
    return (
        paid.join(customer.select("customer_id", "address_id"), "customer_id")
        .join(address.select("address_id", "city_id"), "address_id")
        .join(city.select("city_id", "city"), "city_id")
        .groupBy("city")
        .agg(F.sum("amount").alias("revenue"))
    )


def revenue_by_month(payment: DataFrame) -> DataFrame:
    return payment.groupBy(F.month("payment_date").alias("month")).agg(F.sum("amount").alias("revenue"))


def revenue_by_title_city_month(payment, rental, inventory, film, customer, address, city) -> DataFrame:
    """The finest cells: title, customer's city and month."""
    titled = (
        payment.select("rental_id", "customer_id", F.month("payment_date").alias("month"), "amount")
        .join(rental.select("rental_id", "inventory_id"), "rental_id")
        .join(inventory.select("inventory_id", "film_id"), "inventory_id")
        .join(film.select("film_id", "title"), "film_id")
        .groupBy("title", "customer_id", "month")
        .agg(F.sum("amount").alias("amount"))
    )
    return (
        titled.join(customer.select("customer_id", "address_id"), "customer_id")
        .join(address.select("address_id", "city_id"), "address_id")
        .join(city.select("city_id", "city"), "city_id")
        .groupBy("title", "city", "month")
        .agg(F.sum("amount").alias("revenue"))
    )


def top_districts(address: DataFrame, k=10) -> DataFrame:
    """Districts with the most addresses."""
    return top_k(address.groupBy("district").agg(F.count("*").alias("n")), "n", k, "district")
