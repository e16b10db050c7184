"""Text, log-line and nested-data queries."""

from pyspark.sql import functions as F

from starloom.functions.text import map_columns, pattern_map
from starloom.operators.aggregate import group_count, top_k, word_count
from starloom.operators.joins import contains_lookup
from starloom.plans import posts, weblog
from starloom.session import read_table, work_folder
from starloom.slate import query
from starloom.sources.files import scan_text


@query(r"""
select word, count(*) as count from (select unnest(string_split_regex(text, '\s+')) as word from documents) group by 1""")
def document_words(spark, d):
    """Occurrences of every word of all documents."""
    return word_count(read_table(spark, d, "documents"), "text")


@query(r"""
select line, count(*) as count from (select unnest(string_split(text, chr(10))) as line from documents)
group by 1 order by count desc, line limit 20""")
def repeated_lines(spark, d):
    """Most frequent lines."""
    counts = word_count(read_table(spark, d, "documents"), "text", "\n", "line")
    return top_k(counts, "count", 20, "line")


_URL = r"^(\w+)://([^/?#]+)([^?#]*)\??([^#]*)#?(.*)$"
_URL_FIELDS = ["scheme", "host", "path", "query", "fragment"]


def _urls(spark, d):
    return read_table(spark, d, "pages").select("page_id", pattern_map(F.col("url"), _URL, _URL_FIELDS).alias("parsed"))


@query(
    "select page_id, "
    + ", ".join(f"regexp_extract(url, '{_URL}', {n}) as {f}" for n, f in enumerate(_URL_FIELDS, start=1))
    + f" from pages where regexp_matches(url, '{_URL}')"
)
def url_parse(spark, d):
    return _urls(spark, d).where("parsed is not null").select("page_id", *map_columns("parsed", _URL_FIELDS))


@query(f"""
select count(*) as lines, count(*) filter (where not regexp_matches(url, '{_URL}')) as rejected from pages""")
def url_rejects(spark, d):
    return weblog.reject_count(_urls(spark, d))


@query(f"""
select regexp_extract(url, '{_URL}', 2) as host, count(*) as count from pages group by 1
order by count desc, host limit 10""")
def url_top_hosts(spark, d):
    hosts = _urls(spark, d).select(F.col("parsed")["host"].alias("host"))
    return weblog.popular(hosts, "host")


def _log_lines(spark, d):
    """Access-log lines written from the events; those with a small value are broken."""
    number = F.from_json("props", "k int")["k"].cast("string")
    line = F.concat(
        F.lit("host"),
        F.col("user_id").cast("string"),
        F.lit(".example.com - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' +0000] "GET /'),
        F.col("event_type"),
        F.lit("/"),
        number,
        F.lit(' HTTP/1.0" 200 '),
        F.when(F.col("event_type") == "error", "-").otherwise(F.floor(F.col("value") * 100).cast("string")),
    )
    broken = F.col("value") < 1
    lines = F.array(F.when(broken, F.lit("broken line")).otherwise(line))
    return read_table(spark, d, "events").select(F.explode(lines).alias("value"))


def _log(spark, d):
    return weblog.log_columns(weblog.parse_log(_log_lines(spark, d)))


_LOG = """
select 'host' || user_id || '.example.com' as host, '/' || event_type || '/' || json_extract_string(props, '$.k') as endpoint,
       date_trunc('second', ts) as time, strftime(ts, '%d/%b/%Y:%H:%M:%S +0000') as date_time,
       case when event_type = 'error' then '0' else cast(cast(floor(value * 100) as bigint) as varchar) end as content_size
from events where value >= 1"""


@query(f"""
select host, 'GET' as method, endpoint, 'HTTP/1.0' as protocol, 200 as status, time,
       cast(content_size as bigint) as content_size_bytes from ({_LOG})""")
def access_log_fields(spark, d):
    parsed = _log(spark, d).select("host", "method", "endpoint", "protocol", "status", "time", "content_size_bytes")
    return parsed.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("select count(*) as lines, count(*) filter (where value < 1) as rejected from events")
def access_log_rejects(spark, d):
    return weblog.reject_count(weblog.parse_log(_log_lines(spark, d)))


@query(f"select host, count(*) as count from ({_LOG}) group by 1 order by count desc, host limit 10")
def popular_hosts_from_text(spark, d):
    """Log lines written to text files, scanned and parsed."""
    path = work_folder(spark, "access-log")
    _log_lines(spark, d).write.option("compression", "gzip").text(path)
    return weblog.popular(weblog.log_columns(weblog.parse_log(scan_text(spark, path))), "host")


@query(f"select endpoint, count(*) as count from ({_LOG}) group by 1 order by count desc, endpoint limit 10")
def popular_endpoints(spark, d):
    return weblog.popular(_log(spark, d), "endpoint")


@query(f"""
select endpoint, content_size from ({_LOG})
order by cast(content_size as bigint) desc, endpoint, host, date_time limit 10""")
def largest_files(spark, d):
    return weblog.largest(_log(spark, d))


@query(f"select endpoint, content_size from ({_LOG}) order by content_size desc, endpoint, host, date_time limit 10")
def largest_files_as_text(spark, d):
    """The order the text column gives, which is not the order of the sizes."""
    return weblog.largest(_log(spark, d), as_text=True)


@query("""
select cast(json_extract(props, '$.k') as integer) as k, count(*) as count from events group by 1""")
def props_field(spark, d):
    """Count by a nested field."""
    nested = read_table(spark, d, "events").select(F.from_json("props", "k int").alias("data"))
    return group_count(nested.select("data.k"), "k")


def _posts(spark, d):
    return read_table(spark, d, "conversations").select(
        F.struct(F.col("text").alias("title"), F.col("role").alias("author")).alias("data")
    )


@query("select text as title, role as author from conversations")
def post_titles(spark, d):
    return posts.titles(_posts(spark, d))


@query(r"""
select word, count(*) as count from (select unnest(string_split_regex(text, '\s+')) as word from conversations) group by 1""")
def post_words(spark, d):
    return posts.title_words(_posts(spark, d))


@query(r"""
select word, count(*) as count from (select unnest(string_split_regex(text, '\s+')) as word from conversations)
where regexp_matches(word, '^[A-Z]') or length(word) > 9 group by 1""")
def tagged_words(spark, d):
    """Proper nouns of an annotated column: capital first letter = NNP, long word = NNPS."""

    def annotate(word):
        tag = F.when(word.rlike("^[A-Z]"), "NNP").when(F.length(word) > 9, "NNPS").otherwise("NN")
        return F.struct(tag.alias("result"), F.create_map(F.lit("word"), word).alias("metadata"))

    talk = read_table(spark, d, "conversations")
    return posts.proper_nouns(talk.select(F.transform(F.split("text", r"\s+"), annotate).alias("pos")))


@query(r"""
with w as (select distinct word from (select unnest(string_split_regex(text, '\s+')) as word from documents)),
l as (select p_name as label, min(p_partkey) as line from part group by 1)
select word, arg_min(label, line) as found from w left join l on contains(lower(label), lower(word)) group by word""")
def label_lookup(spark, d):
    """Every distinct word with the first label that contains it."""
    found = word_count(read_table(spark, d, "documents"), "text").select("word")
    labels = read_table(spark, d, "part").groupBy(F.col("p_name").alias("label")).agg(F.min("p_partkey").alias("line"))
    return contains_lookup(found, "word", labels.withColumn("found", F.col("label")), "label", "found", "line")
