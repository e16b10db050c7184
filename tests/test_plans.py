"""Business plans on small hand-made tables of the reference data model."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom.functions import sql
from starloom.operators.clean import last_per_key
from starloom.operators.query_table import rows_scanned
from starloom.operators.snapshots import newest
from starloom.plans import bikes, immigration, music, posts, rental, rental_star, rental_warehouse, shop, ssb, weblog
from starloom.schemas import SCHEMAS
from tests.conftest import rows, ts


def table(spark, name, data, columns=None):
    """A table of the data model; columns not given are NULL."""
    df = spark.createDataFrame([], SCHEMAS[name])
    if columns is None:
        return spark.createDataFrame(data, SCHEMAS[name])
    wanted = [df.schema[c] for c in columns.split()]
    given = spark.createDataFrame(data, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted))
    return df.unionByName(given, allowMissingColumns=True)


@pytest.fixture(scope="module")
def db(spark):
    t = {}
    t["country"] = table(spark, "country", [(1, "Canada")], "country_id country")
    t["city"] = table(spark, "city", [(1, "Leth", 1), (2, "Wood", 1)], "city_id city country_id")
    t["address"] = table(
        spark,
        "address",
        [(1, "1 A St", "North", 1, "100", "p1"), (2, "2 B St", "South", 2, None, "p2"), (3, "3 C St", "South", 2, "300", "p3")],
        "address_id address district city_id postal_code phone",
    )
    t["customer"] = table(
        spark,
        "customer",
        [(1, 1, "MARY", "SMITH", 1, True), (2, 2, "PAT", "JONES", 2, False), (3, 1, "NO", "PAY", 3, True)],
        "customer_id store_id first_name last_name address_id activebool",
    )
    t["staff"] = table(spark, "staff", [(1, "Mike", "H", 1, 1), (2, "Jon", "S", 2, 2)], "staff_id first_name last_name address_id store_id")
    t["store"] = table(spark, "store", [(1, 1, 1), (2, 2, 2)], "store_id manager_staff_id address_id")
    t["language"] = table(spark, "language", [(1, "English"), (2, "French")], "language_id name")
    t["film"] = table(
        spark,
        "film",
        [(1, "ALPHA", 1, 2, 3, D("0.99"), "PG"), (2, "BETA", 1, None, 5, D("4.99"), "G"), (3, "ALPHA", 1, None, 5, D("2.99"), "G")],
        "film_id title language_id original_language_id rental_duration rental_rate rating",
    )
    t["category"] = table(spark, "category", [(1, "Action"), (2, "Drama")], "category_id name")
    t["film_category"] = table(spark, "film_category", [(1, 1), (2, 2)], "film_id category_id")  # film 3 has none
    t["actor"] = table(spark, "actor", [(1, "PENELOPE", "GUINESS"), (2, "NICK", "WAHLBERG"), (3, "ED", "IDLE")], "actor_id first_name last_name")
    t["film_actor"] = table(spark, "film_actor", [(1, 1), (2, 1), (1, 2)], "actor_id film_id")
    t["inventory"] = table(spark, "inventory", [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 3, 1)], "inventory_id film_id store_id")
    t["rental"] = table(
        spark,
        "rental",
        [
            (1, ts("2007-01-01 10:00"), 1, 1, ts("2007-01-08 09:00")),  # 7 days, 4 late
            (2, ts("2007-02-01 10:00"), 1, 2, None),  # open
            (3, ts("2007-02-03 10:00"), 3, 1, ts("2007-02-04 10:00")),
            (4, ts("2007-06-01 10:00"), 3, 1, ts("2007-06-02 10:00")),  # after the balance date
        ],
        "rental_id rental_date inventory_id customer_id return_date",
    )
    t["payment"] = table(
        spark,
        "payment",
        [
            (1, 1, 1, D("0.99"), ts("2007-01-01 11:00")),
            (2, 1, 1, D("4.00"), ts("2007-01-27 11:00")),
            (3, 2, 2, D("0.99"), ts("2007-02-01 11:00")),
            (4, 1, 3, D("4.99"), ts("2007-02-28 23:59:59")),
        ],
        "payment_id customer_id rental_id amount payment_date",
    )
    return t


def test_stock(db):
    stock = rental.in_stock(db["inventory"], db["rental"])
    assert dict(rows(stock.select("inventory_id", "in_stock"))) == {1: False, 2: True, 3: True, 4: True}
    assert rows(rental.film_in_stock(db["inventory"], db["rental"], 1, 1)) == []
    assert rows(rental.film_in_stock(db["inventory"], db["rental"], 1, 1, available=False)) == [(1,)]
    assert rows(rental.held_by_customer(db["rental"])) == [(1, 2)]


def test_sql_functions(spark, db):
    sql.register_views(**{name: db[name] for name in ("inventory", "rental", "customer", "payment")})
    sql.register_functions(spark, [*sql.SCALAR_FUNCTIONS, *sql.TABLE_FUNCTIONS])
    assert rows(spark.sql("select * from film_in_stock(1, 2)")) == [(2,)]
    assert rows(spark.sql("select * from film_in_stock(1, 1)")) == []
    assert rows(spark.sql("select * from film_not_in_stock(1, 1)")) == [(1,)]
    assert rows(spark.sql("select * from rewards_report(1, 4.0, date'2007-04-30')")) == [(1,)]
    pairs = "values (1, 1), (1, 2), (2, 1) as pairs(film, store)"
    each = spark.sql(f"select film, store, inventory_id from {pairs}, lateral film_in_stock(film, store)")
    one_by_one = [(f, s, r[0]) for f, s in ((1, 1), (1, 2), (2, 1)) for r in rows(spark.sql(f"select * from film_in_stock({f}, {s})"))]
    assert rows(each) == one_by_one
    got = spark.sql("select get_hour(1541105830796), day_key(date'2018-11-04'), days_late(date'2020-01-01', date'2020-01-09', 3)")
    assert rows(got) == [(20, 20181104, 5)]
    flag = sql.page_flag("Home")
    pages = spark.createDataFrame([("Home",), ("Help",), (None,)], "page string")
    assert rows(pages.select(flag("page"))) == [(0,), (0,), (1,)]
    spark.udf.register("is_home", flag)
    assert pages.selectExpr("sum(is_home(page))").first()[0] == 1


def test_balance(db):
    got = rental.customer_balance(db["customer"], db["rental"], db["inventory"], db["film"], db["payment"], "2007-03-01")
    # customer 1: 0.99 + 4.99 fees + 4 days late - 9.98 paid; 2: open rental; 3: nothing
    assert {c: float(b) for c, b in rows(got)} == {1: 0.0, 2: 0.0, 3: 0.0}
    early = rental.customer_balance(db["customer"], db["rental"], db["inventory"], db["film"], db["payment"], "2007-01-02")
    assert {c: float(b) for c, b in rows(early)} == {1: 4.0, 2: 0.0, 3: 0.0}


def test_rewards(db):
    args = (db["customer"], db["payment"])
    got = rental.rewards_report(*args, 1, D("4.00"), "2007-04-30")
    assert rows(got.select("customer_id")) == [(1,)]  # two payments of 4.99 in January
    assert rows(rental.rewards_report(*args, 1, D("4.99"), "2007-04-01").select("customer_id")) == []
    for bad in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            rental.rewards_report(*args, *bad, "2007-04-30")


def test_lists(db):
    place = (db["address"], db["city"], db["country"])
    assert rows(rental.customer_list(db["customer"], *place))[1] == (2, "PAT JONES", "2 B St", None, "p2", "Wood", "Canada", "", 2)
    assert rows(rental.staff_list(db["staff"], *place))[0] == (1, "Mike H", "1 A St", "100", "p1", "Leth", "Canada", 1)
    films = (db["category"], db["film_category"], db["film"], db["film_actor"], db["actor"])
    assert rows(rental.film_list(*films).select("title", "category", "actors")) == [
        ("ALPHA", "Action", "NICK WAHLBERG, PENELOPE GUINESS"),
        ("BETA", "Drama", "PENELOPE GUINESS"),
    ]
    nicer = rental.film_list(*films, nicer=True).where("fid = 2").select("actors")
    assert rows(nicer) == [("PenelopeGuiness",)]
    info = rental.actor_info(db["actor"], db["film_actor"], db["film_category"], db["category"], db["film"])
    assert dict(rows(info.select("actor_id", "film_info"))) == {1: "Action: ALPHA, Drama: BETA", 2: "Action: ALPHA", 3: None}


def test_sales(db):
    chain = (db["payment"], db["rental"], db["inventory"])
    assert rows(rental.revenue_by_title(*chain, db["film"])) == [("ALPHA", D("5.98")), ("BETA", D("4.99"))]
    assert rows(rental.sales_by_film_category(*chain, db["film_category"], db["category"])) == [("Action", D("5.98")), ("Drama", D("4.99"))]
    by_store = rental.sales_by_store(*chain, db["store"], db["address"], db["city"], db["country"], db["staff"])
    assert rows(by_store) == [("Leth,Canada", "Mike H", D("10.97"))]
    buyers = (db["customer"], db["address"], db["city"])
    assert rows(rental.revenue_by_city(db["payment"], *buyers)) == [("Leth", D("9.98")), ("Wood", D("0.99"))]
    assert rows(rental.revenue_by_month(db["payment"])) == [(1, D("4.99")), (2, D("5.98"))]
    assert rows(rental.revenue_by_title_city_month(*chain, db["film"], *buyers)) == [
        ("ALPHA", "Leth", 1, D("4.99")),
        ("ALPHA", "Wood", 2, D("0.99")),
        ("BETA", "Leth", 2, D("4.99")),
    ]
    assert rows(rental.top_districts(db["address"], 1)) == [("South", 2)]


def test_rental_star(db):
    days = rental_star.dim_date(db["payment"], "payment_date")
    assert rows(days)[1] == (20070127, dt.date(2007, 1, 27), 2007, 1, 1, 27, 4, True)
    movies = rental_star.dim_movie(db["film"], db["language"])
    assert dict(rows(movies.select("movie_key", "original_language"))) == {1: "French", 2: None, 3: None}
    place = (db["address"], db["city"], db["country"])
    people = rental_star.dim_customer(db["customer"], *place, "2020-01-01")
    assert people.count() == 3 and [c for c, _ in people.dtypes] == [c.split()[0] for c in SCHEMAS["dim_customer"].split(", ")]
    stores = rental_star.dim_store(db["store"], db["staff"].drop("address_id", "store_id"), *place, "2020-01-01")
    assert rows(stores.select("store_key", "city", "manager_first_name")) == [(1, "Leth", "Mike"), (2, "Wood", "Jon")]
    fact = rental_star.fact_sales(db["payment"], db["rental"], db["inventory"], "payment_id")
    assert sorted(r.sales_key for r in fact.collect()) == [1, 2, 3, 4]
    assert rows(fact.drop("sales_key"))[0] == (20070101, 1, 1, 1, D("0.99"))
    assert rental_star.fact_sales(db["payment"], db["rental"], db["inventory"]).count() == 4


# Music


@pytest.fixture(scope="module")
def songs(spark):
    data = [
        ("S1", "Setanta", "AR1", "Elena", "Dubai", None, None, 269.58, 1, 0),
        ("S2", "Same", "AR1", "Elena", "Dubai", None, None, 100.0, 1, 1999),
        ("S3", "Same", "AR2", "Other", None, 1.0, 2.0, 100.0, 1, 1999),
        ("S4", "Setanta", "AR1", "Elena", "Oslo", None, None, 269.58, 1, 0),  # a second match
    ]
    return table(spark, "song_files", data)


@pytest.fixture(scope="module")
def log(spark):
    def event(page, ts_, user, level, song, artist, length, item=0, session=1):
        first = None if user == "" else "F" + str(item)
        return (artist, "a", first, "F", item, "L", length, level, "here", "PUT", page, None, session, song, 200, ts_, "UA", user)

    data = [
        event("NextSong", 1541105830796, "10", "free", "Setanta", "Elena", 269.58),
        event("NextSong", 1541105830796, "11", "free", "Same", "Other", 100.2, 1, 2),
        event("NextSong", 1541105830900, "10", "paid", "Same", "Nobody", 100.0, 2),
        event("NextSong", 1541192230000, "10", "paid", "Same", "Elena", 100.0, 3),
        event("Home", 1541192230001, "10", "free", None, None, None, 4),
        event("Home", 1541192230002, "", "free", None, None, None, 5),
    ]
    return table(spark, "event_files", data)


def matches(plays):
    return rows(plays.select("user_id", "song_id"))


def test_four_kinds_of_songplays(log, songs):
    assert matches(music.songplays(log, songs, "relational")) == [("10", "S1"), ("10", "S2"), ("10", None), ("11", None)]
    assert matches(music.songplays(log, songs, "warehouse")) == [("10", "S1"), ("10", "S2"), ("10", "S4"), ("11", "S3")]
    assert matches(music.songplays(log, songs, "lake")) == [("10", "S1"), ("10", "S2"), ("10", "S4"), ("11", "S3")]
    scheduled = music.songplays(log, songs, "scheduled")
    assert matches(scheduled) == [("10", "S1"), ("10", "S2"), ("10", "S4"), ("10", None), ("11", "S3")]
    assert all(r.start_time.microsecond == 0 for r in scheduled.collect())


def test_users_songs_artists_time(spark, log, songs):
    assert music.users(log).where("user_id = '10'").count() == 3
    known = table(spark, "users", [("11", "Old", "L", "F", "paid")])
    assert rows(music.users_current(log, known)) == [("10", "F0", "L", "F", "paid"), ("11", "Old", "L", "F", "free")]
    assert music.songs_table(songs).count() == 4
    known_songs = table(spark, "songs", [("S1", "Kept", "AR1", 1, 1.0)])
    assert rows(music.songs_first(songs, known_songs, ["song_id"]).select("song_id", "title"))[0] == ("S1", "Kept")
    assert music.artists_table(songs).count() == 3  # one artist with two locations
    assert rows(music.artists_first(songs).select("artist_id", "location")) == [("AR1", "Dubai"), ("AR2", None)]
    times = music.time_table(music.songplays(log, songs, "relational"))
    assert times.count() == 3
    assert rows(times)[0] == (ts("2018-11-01 20:57:10.796"), 20, 1, 44, 11, 2018, 3)


def test_write_lake(spark, tmp_path, log, songs):
    for _ in range(2):
        music.write_lake(log, songs, str(tmp_path))
    read = {n: music.lake_table(spark, str(tmp_path), n) for n in ("songs", "artists", "users", "time", "songplays")}
    assert {n: df.count() for n, df in read.items()} == {"songs": 4, "artists": 3, "users": 4, "time": 3, "songplays": 4}
    assert {"year", "artist_id"} <= set(read["songs"].columns)
    assert rows(read["time"].select("weekday").distinct()) == [("Fri",), ("Thu",)]
    assert rows(read["songplays"].select("year", "month").distinct()) == [(2018, 11)]


@pytest.mark.parametrize("artists", [50, 1500])
def test_lake_folders_do_not_grow_with_artists(spark, tmp_path, log, artists):
    songs = table(spark, "song_files", []).limit(0)
    n = F.col("id")
    made = {"song_id": F.format_string("S%d", n), "title": F.lit("t"), "artist_id": F.format_string("A%d", n % artists), "year": F.lit(2000), "duration": F.lit(1.0)}
    songs = spark.range(3000).select("id").withColumns(made).select(
        *[F.col(c) if c in made else F.lit(None).cast(songs.schema[c].dataType).alias(c) for c in songs.columns]
    )
    music.write_lake(log, songs, str(tmp_path), artist_rows=500)
    stored = newest(spark, str(tmp_path / "songs"))
    folders = list((tmp_path / "songs" / next(iter(stored.parts.values()))).glob("year=*/artist_bucket=*"))
    assert stored.notes["buckets"] == 6 and len(folders) <= 6
    found = music.artist_songs(spark, str(tmp_path), "A7")
    assert found.count() == 3000 // artists
    buckets = music.lake_table(spark, str(tmp_path), "songs").groupBy("artist_bucket").count().collect()
    assert rows_scanned(found) <= max(r["count"] for r in buckets) < 1500


# Other plans


def test_immigration(spark, tmp_path):
    ports = spark.createDataFrame([(1, "NYC", "NEW YORK, NY"), (2, "YRK", "YORK, PA"), (3, "BOS", "BOSTON")], "line_no int, code string, label string")
    arrivals = table(spark, "immigration", [(2016, 7, 5, "NYC", 20636, 1, None, 2), (2016, 7, 5, "XXX", 20636, 1, 20640, 2)])
    temps = spark.createDataFrame(
        [(1, "NaN", "York", "UK"), (2, None, "York", "UK"), (3, "7.5", "York", "UK"), (4, "9", "York", "UK"), (5, "3", "Paris", "France"), (6, "1", "york", "US")],
        "n int, AverageTemperature string, City string, Country string",
    ).withColumns({"Latitude": F.lit("1N"), "Longitude": F.lit("2E")})
    cities = immigration.port_temperature(temps, ports, ["n"])
    assert rows(cities.select("City", "Country", "AverageTemperature", "i94port")) == [("York", "UK", "7.5", "NYC"), ("york", "US", "1", "NYC")]
    assert immigration.valid_immigration(arrivals, ports).count() == 1
    for _ in range(2):
        immigration.write_tables(arrivals, temps, ports, str(tmp_path), ["n"])
    fact = spark.read.parquet(str(tmp_path / "fact"))
    assert rows(fact.select("i94port", "temperature", "departure_date")) == [("NYC", "1", None), ("NYC", "7.5", None)]


def test_bikes(spark):
    data = [(1, 10, D("5.00"), 1, "one", 2, 1945), (2, 10, D("7.00"), 1, "uno", 1, None), (3, 11, D("1.00"), 3, "three", 2, 2001), (4, 11, D("2.00"), 2, "two", 1, 0)]
    trips = table(spark, "trips", data, "trip_id bikeid tripduration from_station_id from_station_name to_station_id birthyear")
    assert rows(bikes.station_traffic(trips)) == [(1, "one", 2, 2), (1, "uno", 2, 2), (2, "two", 1, 2)]
    assert rows(bikes.trip_facts(trips)) == [(10, D("7.00"), D("5.00"), D("6.000000")), (11, D("2.00"), D("1.00"), D("1.500000"))]
    assert bikes.rider_extremes(trips).first() == (1945, 2001)
    assert rows(bikes.lifetime_rides(trips)) == [(10, 2), (11, 2)]


def test_weblog(spark):
    line = 'h{0}.com - - [01/Aug/1995:00:00:0{0} -0400] "GET /{1} HTTP/1.0" 200 {2}'
    lines = [line.format(1, "a", 900), line.format(2, "b", 1000), line.format(1, "c", "-"), "junk"]
    parsed = weblog.parse_log(spark.createDataFrame([(v,) for v in lines], "value string"))
    log = weblog.log_columns(parsed)
    assert weblog.reject_count(parsed).first() == (4, 1)
    assert rows(weblog.popular(log, "host", 1)) == [("h1.com", 2)]
    assert [r.endpoint for r in weblog.largest(log).collect()] == ["/b", "/a", "/c"]
    assert [r.endpoint for r in weblog.largest(log, as_text=True).collect()] == ["/a", "/b", "/c"]
    assert log.where("endpoint = '/a'").first().time == ts("1995-08-01 04:00:01")


def test_posts(spark):
    df = spark.createDataFrame([((("big big news", "ann")),)], "data struct<title: string, author: string>")
    assert rows(posts.titles(df)) == [("big big news", "ann")]
    assert rows(posts.title_words(df)) == [("big", 2), ("news", 1)]
    pos = spark.createDataFrame(
        [([("NNP", {"word": "Rome"}), ("NN", {"word": "city"}), ("NNPS", {"word": "Alps"}), ("NNP", {"word": "Rome"})],)],
        "pos array<struct<result: string, metadata: map<string,string>>>",
    )
    assert rows(posts.proper_nouns(pos)) == [("Alps", 1), ("Rome", 2)]


def test_shop(spark):
    transactions = spark.createDataFrame([(1, 1, 20.5), (2, 1, 35.21)], "customer_id int, store_id int, spent double")
    items = spark.createDataFrame([(1, 1, "Soul"), (2, 3, "Let It Be")], "customer_id int, item_number int, item_name string")
    stores = spark.createDataFrame([(1, "CA"), (2, "WA")], "store_id int, state string")
    customers = spark.createDataFrame([(1, "Amanda", True), (2, "Toby", False)], "customer_id int, name string, rewards boolean")
    assert rows(shop.large_purchases(transactions, items, stores, customers, 30).select("name", "item_name", "rewards")) == [
        ("Toby", "Let It Be", False)
    ]
    assert rows(shop.sales_per_store(transactions)) == [(1, 55.71)]
    assert rows(shop.spend_of_customer(transactions, 2)) == [(2, 1, 35.21)]
    songs = spark.createDataFrame([(1, 1, "Wood"), (2, 1, "Think")], "song_id int, album_id int, song_name string")
    lengths = spark.createDataFrame([(1, 163), (2, 137)], "song_id int, song_length int")
    albums = spark.createDataFrame([(1, "Soul", 1)], "album_id int, album_name string, artist_id int")
    artists = spark.createDataFrame([(1, "Beatles")], "artist_id int, artist_name string")
    table_ = shop.album_songs(albums, artists, songs, lengths)
    assert table_.count() == 2 and rows(shop.album_lengths(table_)) == [("Soul", 300)]
    sales = spark.createDataFrame([("Sam", 40), ("Sam", 19), ("Bob", 45)], "cashier_name string, amount_spent int")
    assert rows(shop.cashier_sales(sales)) == [("Bob", 45), ("Sam", 59)]


def test_ssb(spark):
    days = ssb.date_table(spark.createDataFrame([(ts("1997-12-30"),), (ts("1998-01-02"),)], "t timestamp"), "t")
    assert days.count() == 4 and rows(days)[0] == (19971230, 1997, "Dec1997", 1)
    lines = spark.createDataFrame(
        [(19971230, 1, 1, 1, 10, 100, 2, 98), (19971231, 1, 1, 1, 30, 100, 2, 98), (19980101, 2, 2, 2, 10, 100, 2, 98)],
        "lo_orderdate int, lo_partkey int, lo_suppkey int, lo_custkey int, lo_quantity int, lo_extendedprice int, lo_discount int, lo_revenue int",
    )
    part = spark.createDataFrame([(1, "B1", "C")], "p_partkey int, p_brand1 string, p_category string")
    supplier = spark.createDataFrame([(1, "X", "R"), (2, "Y", "R")], "s_suppkey int, s_city string, s_region string")
    customer = spark.createDataFrame([(1, "X"), (2, "Y")], "c_custkey int, c_city string")
    assert ssb.one_dimension(lines, days, 1997, (1, 3), 24).first()[0] == 200
    assert rows(ssb.two_dimensions(lines, days, part, supplier, "C", "R")) == [(1997, "B1", 196)]
    assert rows(ssb.drill(lines, days, customer, supplier, ["X", "Y"], "Dec1997")) == [("X", "X", 1997, 196)]
    assert [tuple(r) for r in ssb.same_distribution(lines, part).collect()] == [(19971230, 200), (19971231, 200)]


def test_key_that_is_too_coarse_loses_rows(spark):
    albums = spark.createDataFrame([(1965, "Elvis", "Blue", 1), (1965, "Beatles", "Soul", 2)], "year int, artist string, album string, n int")
    assert rows(last_per_key(albums, ["year"], ["n"])) == [(1965, "Beatles", "Soul", 2)]
    assert last_per_key(albums, ["year", "artist"], ["n"]).count() == 2
