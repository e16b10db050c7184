"""Small store star, album tables and sales tables."""

from pyspark.sql import DataFrame, functions as F

from starloom.operators.joins import join_chain


def large_purchases(transactions, items, stores, customers, above) -> DataFrame:
    """Who spent more than a limit, on what, where."""
    return join_chain(
        transactions.where(F.col("spent") > above),
        (customers, "customer_id"),
        (items, "customer_id"),
        (stores, "store_id"),
    ).select("name", "rewards", "item_name", "spent", "state", "store_id")


def sales_per_store(transactions) -> DataFrame:
    return transactions.groupBy("store_id").agg(F.sum("spent").alias("spent"))


def spend_of_customer(transactions, customer_id) -> DataFrame:
    return transactions.where(F.col("customer_id") == customer_id).select("customer_id", "store_id", "spent")


def album_songs(albums, artists, songs, lengths) -> DataFrame:
    """Albums put together again from their normal form."""
    return join_chain(songs, (lengths, "song_id"), (albums, "album_id"), (artists, "artist_id"))


def album_lengths(album_table) -> DataFrame:
    """Total length of every album in a denormalised song table."""
    return album_table.groupBy("album_name").agg(F.sum("song_length").alias("album_length"))


def cashier_sales(cashier_table) -> DataFrame:
    """Total amount of every cashier in a denormalised sales table."""
    return cashier_table.groupBy("cashier_name").agg(F.sum("amount_spent").alias("total"))
