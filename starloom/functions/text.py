"""Text column functions."""

from pyspark.sql import Column, functions as F

# Access-log line pattern and the names of its groups.
ACCESS_LOG_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'
)
ACCESS_LOG_FIELDS = [
    "host",
    "client_identd",
    "user_id",
    "date_time",
    "method",
    "endpoint",
    "protocol",
    "response_code",
    "content_size",
]


_MARK = "\x1f"


def pattern_parts(line, pattern, count) -> Column:
    """The first ``count`` groups of a pattern as an array; NULL where a line does not match.

    One pass of the pattern rewrites the line to its groups between marks. Only
    a line that itself holds a mark needs a pass per group.
    """
    line = F.col(line) if isinstance(line, str) else line
    marked = "".join(f"{_MARK}${n}" for n in range(1, count + 1))
    rewritten = F.regexp_replace(line, rf"^[\s\S]*?(?:{pattern})[\s\S]*$", marked)
    # A lambda variable holds the rewritten line, so it is made once.
    groups = F.transform(
        F.array(rewritten),
        lambda r: F.when(F.startswith(r, F.lit(_MARK)), F.slice(F.split(r, _MARK), 2, count)),
    )[0]
    by_group = F.array(*[F.regexp_extract(line, pattern, n) for n in range(1, count + 1)])
    return F.when(F.contains(line, F.lit(_MARK)), F.when(F.rlike(line, F.lit(pattern)), by_group)).otherwise(groups)


def pattern_map(line, pattern, fields) -> Column:
    """Groups of a pattern as ``map<string,string>``; NULL where a line does not match."""
    return F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), pattern_parts(line, pattern, len(fields)))


def access_log_map(line) -> Column:
    """The nine fields of an access-log line; a size of ``-`` counts as 0."""
    size = ACCESS_LOG_FIELDS.index("content_size")
    parts = F.transform(
        pattern_parts(line, ACCESS_LOG_PATTERN, len(ACCESS_LOG_FIELDS)),
        lambda part, place: F.when((place == size) & (part == "-"), "0").otherwise(part),
    )
    return F.map_from_arrays(F.array(*[F.lit(f) for f in ACCESS_LOG_FIELDS]), parts)


def map_columns(parsed, fields) -> list[Column]:
    """One column per map key."""
    return [F.col(parsed)[field].alias(field) for field in fields]


def full_name(first, last, sep=" ") -> Column:
    """First and last name; NULL when either is NULL."""
    return F.concat(first, F.lit(sep), last)


def capitalised(c) -> Column:
    """First letter upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2147483647)))


def active_note(flag) -> Column:
    return F.when(flag, "active").otherwise("")


def words(c, pattern=r"\s+") -> Column:
    return F.split(c, pattern)


def md5_key(*parts) -> Column:
    """32-digit key over the text of the parts."""
    return F.md5(F.concat(*[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]))
