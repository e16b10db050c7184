"""Table schemas of the data model, and empty tables made from them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Column names and types of the data model.
SCHEMAS = {
    # Music events, as read
    "song_files": (
        "song_id string, title string, artist_id string, artist_name string, artist_location string,"
        " artist_latitude double, artist_longitude double, duration double, num_songs int, year int"
    ),
    "event_files": (
        "artist string, auth string, firstName string, gender string, itemInSession int, lastName string,"
        " length double, level string, location string, method string, page string, registration double,"
        " sessionId int, song string, status int, ts long, userAgent string, userId string"
    ),
    # Music star
    "songplays": (
        "songplay_id string, start_time timestamp, user_id string, level string, song_id string,"
        " artist_id string, session_id int, location string, user_agent string"
    ),
    "users": "user_id string, first_name string, last_name string, gender string, level string",
    "songs": "song_id string, title string, artist_id string, year int, duration double",
    "artists": "artist_id string, name string, location string, latitude double, longitude double",
    "time": "start_time timestamp, hour int, day int, week int, month int, year int, weekday int",
    # Rental database
    "customer": (
        "customer_id int, store_id short, first_name string, last_name string, email string, address_id short,"
        " activebool boolean, create_date date, last_update timestamp, active int"
    ),
    "actor": "actor_id int, first_name string, last_name string, last_update timestamp",
    "category": "category_id int, name string, last_update timestamp",
    "film": (
        "film_id int, title string, description string, release_year int, language_id short,"
        " original_language_id short, rental_duration short, rental_rate decimal(4,2), length short,"
        " replacement_cost decimal(5,2), rating string, last_update timestamp, special_features array<string>"
    ),
    "film_actor": "actor_id short, film_id short, last_update timestamp",
    "film_category": "film_id short, category_id short, last_update timestamp",
    "address": (
        "address_id int, address string, address2 string, district string, city_id short, postal_code string,"
        " phone string, last_update timestamp"
    ),
    "city": "city_id int, city string, country_id short, last_update timestamp",
    "country": "country_id int, country string, last_update timestamp",
    "inventory": "inventory_id int, film_id short, store_id short, last_update timestamp",
    "language": "language_id int, name string, last_update timestamp",
    "payment": (
        "payment_id int, customer_id short, staff_id short, rental_id int, amount decimal(5,2),"
        " payment_date timestamp"
    ),
    "rental": (
        "rental_id int, rental_date timestamp, inventory_id int, customer_id short, return_date timestamp,"
        " staff_id short, last_update timestamp"
    ),
    "staff": (
        "staff_id int, first_name string, last_name string, address_id short, email string, store_id short,"
        " active boolean, username string, password string, last_update timestamp, picture binary"
    ),
    "store": "store_id int, manager_staff_id short, address_id short, last_update timestamp",
    # Rental star
    "dim_date": (
        "date_key int, date date, year short, quarter short, month short, day short, week short,"
        " is_weekend boolean"
    ),
    "dim_customer": (
        "customer_key int, customer_id short, first_name string, last_name string, email string, address string,"
        " address2 string, district string, city string, country string, postal_code string, phone string,"
        " active short, create_date timestamp, start_date date, end_date date"
    ),
    "dim_movie": (
        "movie_key int, film_id short, title string, description string, release_year int, language string,"
        " original_language string, rental_duration short, length short, rating string,"
        " special_features array<string>"
    ),
    "dim_store": (
        "store_key int, store_id short, address string, address2 string, district string, city string,"
        " country string, postal_code string, manager_first_name string, manager_last_name string,"
        " start_date date, end_date date"
    ),
    "fact_sales": (
        "sales_key long, date_key int, customer_key int, movie_key int, store_key int,"
        " sales_amount decimal(5,2)"
    ),
    # Bike trips
    "trips": (
        "trip_id int, start_time timestamp, end_time timestamp, bikeid int, tripduration decimal(16,2),"
        " from_station_id int, from_station_name string, to_station_id int, to_station_name string,"
        " usertype string, gender string, birthyear int"
    ),
    "stations": (
        "id int, name string, city string, latitude decimal(9,6), longitude decimal(9,6), dpcapacity int,"
        " online_date timestamp"
    ),
    # Immigration and temperature
    "immigration": (
        "i94yr int, i94mon int, i94cit int, i94port string, arrdate int, i94mode int, depdate int, i94visa int"
    ),
    "temperature": (
        "dt string, AverageTemperature string, AverageTemperatureUncertainty string, City string,"
        " Country string, Latitude string, Longitude string"
    ),
    # Single tables
    "payment_csv": (
        "payment_id int, customer_id int, staff_id int, rental_id int, amount double, payment_date date"
    ),
    "reviews": (
        "customer_id string, review_date date, review_rating int, review_votes int, review_helpful_votes int,"
        " product_id string, product_title string, product_sales_rank long, product_group string,"
        " product_category string, product_subcategory string, similar_product_ids string"
    ),
    "tickets": (
        "id double, sporting_event_id double, sport_location_id double, seat_level decimal(1,0),"
        " seat_section string, seat_row string, seat string, ticketholder_id double, ticket_price decimal(8,2)"
    ),
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the data model without rows."""
    return spark.createDataFrame([], schema(name))
