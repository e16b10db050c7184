"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Each text gets a vector of transformed statistics. For every ``(lang, source)``,
and for all texts together, the minimum-covariance-determinant estimate of
centre and scatter is searched from three deterministic starts (quartiles,
spatial signs, squashed correlations). A concentration step takes the nearest
half of the group under an estimate, and their mean and covariance as the next
one. After two steps the start with the least determinant goes on until the
determinant stops falling. The estimate is then reweighted: all rows inside its
97.5 % distance count. A text is rejected when its Mahalanobis distance is beyond
``CUTOFF``.

A component that is constant in the core is an exact fit. What remains of its
scatter is the counting noise of a rate over so many words or lines: the mean
noise of the group in the search, and the text's own noise in its distance, so
that a rate of a short text counts for less. Groups draw on the estimate of all
texts by their size: a group of ``SHRINK`` rows counts half.

A step is one aggregation: moments are summed per group and distance ring, so a
hot group is combined on the map side and only rings are shuffled. Vectors are
whole numbers and moments are exact sums: results do not depend on row order.

Defined results: a null or empty text has no words and fails the base rules, as
does any text under ``MIN_WORDS`` words; a null language or source counts as
''; a single row is its group's centre. Repeated rows and ids are judged one by
one, alike. Extra columns are not read.
"""

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.session import work_folder

MIN_WORDS = 50
#: Rows with which a group's estimate counts as much as that of all texts.
SHRINK = 20
#: Share of normal vectors inside the cut-off distance (4.30).
CUTOFF = 0.999
#: Variance of a count over that of single events: what is counted comes in clumps.
CLUMPS = 4

_P = 4
#: Rings of distance by which the nearest half is found: so many per e-fold.
_RINGS = 32
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_SPACES = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)
_BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint"


def repeated_words(words):
    """Number of words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number = defaultdict()
    number.default_factory = number.__len__
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    k = len(number)
    pairs = ids[:-1] * k + ids[1:]
    if k >= 2**20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * k + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    starts = np.zeros(n, bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    covered = starts.copy()
    covered[1:] |= starts[:-1]
    covered[2:] |= starts[:-2]
    return int(covered.sum())


def base_statistics(text):
    """The counts of one whole text, in the order of the columns."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode("utf-8")
    words = raw.split()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    seen = set()
    lines = repeats = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                repeats += 1
            else:
                seen.add(line)
    return (
        len(words),
        len(text) - int(counts[_SPACES].sum()),
        int(counts[_SYMBOLS].sum()),
        repeats,
        repeated_words(words),
        lines,
    )


def text_statistics(text: Column) -> Column:
    """Struct of the counts of each whole text."""
    names = [c.split()[0] for c in _BASE.split(", ")]

    @F.arrow_udf(f"struct<{', '.join(c.replace(' ', ':') for c in _BASE.split(', '))}>")
    def statistics(texts: pa.Array) -> pa.Array:
        rows = [base_statistics(t.as_py()) for t in texts]
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return statistics(text)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def vector() -> list[Column]:
    """Log word length and the roots of the symbol, repeated line and repeated word rates, in thousandths."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.rint(v * 1000).cast("bigint").alias(f"x{i}")
        for i, v in enumerate(
            (
                F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
                F.sqrt(F.col("n_symbols") / n),
                F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
                F.sqrt(F.col("n_repeat_words") / n),
            )
        )
    ]


def _chi_square(x, p):
    """Distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, p // 2):
        term *= x / 2 / i
        total += term
    return 1 - np.exp(-x / 2) * total


def _chi_square_quantile(share, p):
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, p) < share else (low, middle)
    return high


def _consistency(share):
    """Factor that makes the covariance of the nearest ``share`` of normal vectors unbiased."""
    return share / _chi_square(_chi_square_quantile(share, _P), _P + 2)


def distance() -> Column:
    """Squared Mahalanobis distance of ``x0..`` under the columns ``centre`` and ``precision``."""
    off = [F.col(f"x{i}") - F.col("centre")[i] for i in range(_P)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(_PAIRS):
        total = total + off[i] * off[j] * F.col("precision")[k] * (1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(0.0))


_NOISE = [f"v{i}" for i in range(_P)]
_MOMENTS = ["n", *[f"s{i}" for i in range(_P)], *[f"s{i}{j}" for i, j in _PAIRS]]
_ESTIMATE = "part string, start int, centre array<double>, precision array<double>, scatter array<double>, logdet double, n bigint"


def noise() -> list[Column]:
    """Counting variance of each component, in square thousandths; whole numbers, so that sums are exact."""
    n, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "n_lines"))
    return [F.rint(F.lit(CLUMPS * 250_000.0) / over).cast("bigint").alias(v) for v, over in zip(_NOISE, (n, n, lines, n))]


def _matrix(values):
    """Symmetric matrix of its upper triangle."""
    full = np.zeros((_P, _P))
    for value, (i, j) in zip(values, _PAIRS):
        full[i, j] = full[j, i] = value
    return full


def _triangle(matrix):
    return [float(matrix[i, j]) for i, j in _PAIRS]


def estimate(moments, counting, factor):
    """Centre, scatter (without noise), its inverse with noise and the logarithm of that determinant, from sums."""
    n = float(moments[0])
    centre = np.array([float(v) / n for v in moments[1 : 1 + _P]])
    scatter = (_matrix([float(v) / n for v in moments[1 + _P :]]) - np.outer(centre, centre)) * factor
    whole = scatter + np.diag(counting)
    return centre, scatter, np.linalg.inv(whole), float(np.linalg.slogdet(whole)[1])


def core_factor(share):
    """Factor for the covariance of the nearest ``share`` of a group."""
    return _consistency(share) if share < 1 else 1.0


def _solve(reweighted):
    """Moments of groups (``total`` rows, mean noise) -> estimates; works on small batches of groups."""

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                factor = _consistency(0.975) if reweighted else core_factor(float(row["n"]) / float(row["total"]))
                found = estimate([row[m] for m in _MOMENTS], [float(row[v]) for v in _NOISE], factor)
                centre, scatter, inverse, logdet = found
                out.append((row["part"], row["start"], centre.tolist(), _triangle(inverse), _triangle(scatter), logdet, int(row["total"])))
            yield pd.DataFrame(out, columns=["part", "start", "centre", "precision", "scatter", "logdet", "n"])

    return solve


def _moments():
    whole = "decimal(38,0)"
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(f"x{i}").cast("decimal(20,0)")).cast(whole).alias(f"s{i}") for i in range(_P)],
        *[
            F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(20,0)")).cast(whole).alias(f"s{i}{j}")
            for i, j in _PAIRS
        ],
    ]


def _written(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _middles(rows):
    """Per part the number of rows, mean noise, medians and quartile deviations (at least the noise)."""
    counts = (
        rows.select("part", F.posexplode(F.array(*[f"x{i}" for i in range(_P)])).alias("i", "x"))
        .groupBy("part", "i", "x")
        .count()
    )
    up = Window.partitionBy("part", "i").orderBy("x")
    ranked = counts.withColumn("upto", F.sum("count").over(up)).withColumn(
        "total", F.sum("count").over(Window.partitionBy("part", "i"))
    )
    at = [F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("x"))).alias(f"q{int(q * 4)}") for q in (0.25, 0.5, 0.75)]
    one = ranked.groupBy("part", "i").agg(*at)
    wide = one.groupBy("part").agg(
        *[F.max(F.when(F.col("i") == i, F.col("q2"))).cast("double").alias(f"m{i}") for i in range(_P)],
        *[F.max(F.when(F.col("i") == i, (F.col("q3") - F.col("q1")) / 1.349)).alias(f"d{i}") for i in range(_P)],
    )
    sizes = rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("total"), *[(F.sum(v) / F.count(F.lit(1))).alias(v) for v in _NOISE]
    )
    least = [F.greatest(F.col(f"d{i}"), F.sqrt(f"v{i}")).alias(f"d{i}") for i in range(_P)]
    return wide.join(sizes, "part").select("part", "total", *_NOISE, *[f"m{i}" for i in range(_P)], *least)


#: Sums of squashed or sign vectors are whole numbers of this fraction.
_UNIT = 1_000_000


def _starts(rows, middles):
    """Three first estimates per part: quartiles; covariances of spatial signs; correlations of squashed deviations."""
    off = [(F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"d{i}") for i in range(_P)]
    length = F.sqrt(sum((z * z for z in off), F.lit(1e-12)))
    kinds = {1: [z / length for z in off], 2: [F.tanh(z) for z in off]}
    sums = [
        F.sum(F.rint(kinds[k][i] * kinds[k][j] * _UNIT).cast("bigint").cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"k{k}{i}{j}")
        for k in kinds
        for i, j in _PAIRS
    ]
    found = rows.join(middles, "part").groupBy("part").agg(*sums).join(middles, "part")

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                scale = np.array([row[f"d{i}"] for i in range(_P)])
                shapes = [np.eye(_P)]
                for k in (1, 2):
                    shapes.append(_matrix([float(row[f"k{k}{i}{j}"]) / _UNIT / row["total"] for i, j in _PAIRS]))
                for start, scatter in enumerate(first_scatters(scale, shapes)):
                    whole = scatter + np.diag([row[v] for v in _NOISE])
                    centre = [float(row[f"m{i}"]) for i in range(_P)]
                    logdet = float(np.linalg.slogdet(whole)[1])
                    out.append((row["part"], start, centre, _triangle(np.linalg.inv(whole)), _triangle(scatter), logdet, int(row["total"])))
            yield pd.DataFrame(out, columns=["part", "start", "centre", "precision", "scatter", "logdet", "n"])

    return found.mapInPandas(solve, _ESTIMATE)


def first_scatters(scale, shapes):
    """Scatters of the starts, given the quartile deviations, and identity, sign and squashed second moments."""
    squashed = shapes[2] + 1e-3 * np.eye(_P)
    root = np.sqrt(np.diag(squashed))
    for shape in (shapes[0], _P * shapes[1], squashed / np.outer(root, root)):
        yield shape * np.outer(scale, scale)


def ring() -> Column:
    return F.floor(F.log(F.col("d") + 1e-9) * _RINGS)


def _concentrate(rows, now, middles):
    """One concentration step for every part and start in ``now``."""
    far = rows.join(now.select("part", "start", "centre", "precision"), "part").withColumn("d", distance())
    rings = far.groupBy("part", "start", ring().alias("ring")).agg(*_moments())
    upto = Window.partitionBy("part", "start").orderBy("ring").rowsBetween(Window.unboundedPreceding, -1)
    sizes = middles.select("part", "total", *_NOISE)
    # At least half of the rows: half of rows and dimensions, rounded up.
    half = F.least(F.col("total"), F.floor((F.col("total") + _P + 1) / 2))
    kept = (
        rings.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).join(sizes, "part").where(F.col("before") < half)
    )
    summed = kept.groupBy("part", "start", "total", *_NOISE).agg(*[F.sum(c).alias(c) for c in _MOMENTS])
    return summed.mapInPandas(_solve(False), _ESTIMATE)


def shrunk(own, pool, n):
    """Centre and scatter of a group of ``n`` rows, drawn towards those of all texts."""
    share = n / (n + SHRINK)
    return tuple(share * np.asarray(a) + (1 - share) * np.asarray(b) for a, b in zip(own, pool))


def with_distance(rows: DataFrame) -> DataFrame:
    """Adds ``distance`` of ``x0..`` under ``centre`` and ``scatter`` with the text's own noise ``v0..``; null without an estimate.

    The matrix is factored as lower triangle times diagonal, column by column.
    """
    entry = {(j, i): F.col("scatter")[k] for k, (i, j) in enumerate(_PAIRS)}
    rows = rows.withColumns({f"o{i}": F.col(f"x{i}") - F.col("centre")[i] for i in range(_P)})
    made = [f"o{i}" for i in range(_P)]
    for i in range(_P):
        held = [F.col(f"l{i}{k}") * F.col(f"l{i}{k}") * F.col(f"d{k}") for k in range(i)]
        step = {f"d{i}": entry[i, i] + F.col(f"v{i}") - sum(held, F.lit(0.0))}
        rows = rows.withColumns(step | {f"y{i}": F.col(f"o{i}") - sum((F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))})
        below = {
            f"l{j}{i}": (entry[j, i] - sum((F.col(f"l{j}{k}") * F.col(f"l{i}{k}") * F.col(f"d{k}") for k in range(i)), F.lit(0.0)))
            / F.col(f"d{i}")
            for j in range(i + 1, _P)
        }
        if below:
            rows = rows.withColumns(below)
        made += [*step, f"y{i}", *below]
    total = sum((F.col(f"y{i}") * F.col(f"y{i}") / F.col(f"d{i}") for i in range(_P)), F.lit(0.0))
    return rows.withColumn("distance", F.sqrt(total)).drop(*made)


def fit_scatter(table: DataFrame, folder: str) -> DataFrame:
    """``lang, source, centre, scatter`` for the groups of a written statistics table.

    ``table`` has ``lang, source`` (no nulls) and the counts; rows that fail the
    base rules are left out. The result has one row per group. On the driver are the
    number of groups that still improve, and the estimate of all texts.
    """
    good = table.where(~base_failed())
    own = F.to_json(F.struct("lang", "source"))
    # Every row counts in its group and in the part of all texts, which has no name.
    rows = _written(
        good.select("lang", "source", F.explode(F.array(own, F.lit(""))).alias("part"), *vector(), *noise()), folder, "vectors"
    )
    middles = _written(_middles(rows), folder, "middles")
    now = _written(_starts(rows, middles), folder, "starts")
    for step in range(2):
        now = _written(_concentrate(rows, now, middles), folder, f"start{step}")
    least = now.groupBy("part").agg(F.min_by(F.struct("start", "centre", "precision", "scatter", "logdet", "n"), F.struct("logdet", "start")).alias("best"))
    best = _written(least.select("part", "best.*", F.lit(True).alias("falling")), folder, "best0")
    step = 0
    while not best.where("falling").isEmpty():
        step += 1
        tried = _concentrate(rows, best.where("falling"), middles)
        new = tried.select("part", F.struct("start", "centre", "precision", "scatter", "logdet", "n").alias("new"))
        better = F.coalesce(F.col("new.logdet") < F.col("logdet") - 1e-6, F.lit(False))
        names = ["start", "centre", "precision", "scatter", "logdet", "n"]
        kept = [F.when(better, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in names]
        best = _written(best.join(new, "part", "left").select("part", *kept, better.alias("falling")), folder, f"best{step}")
    far = rows.join(best.select("part", "start", "centre", "precision"), "part").withColumn("d", distance())
    inside = far.where(F.col("d") <= _chi_square_quantile(0.975, _P)).groupBy("part", "start").agg(*_moments())
    weighted = inside.join(middles.select("part", "total", *_NOISE), "part").mapInPandas(_solve(True), _ESTIMATE)
    final = _written(weighted, folder, "final")
    pool = [(r["centre"], _matrix(r["scatter"])) for r in final.where("part = ''").collect()]

    def finish(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                centre, scatter = shrunk((row["centre"], _matrix(row["scatter"])), pool[0], row["n"])
                out.append((row["part"], centre.tolist(), _triangle(scatter)))
            yield pd.DataFrame(out, columns=["part", "centre", "scatter"])

    groups = final.where("part <> ''").select("part", "centre", "scatter", "n")
    solved = groups.mapInPandas(finish, "part string, centre array<double>, scatter array<double>")
    names = rows.where("part <> ''").select("lang", "source", "part").distinct()
    return _written(names.join(solved, "part").select("lang", "source", "centre", "scatter"), folder, "fitted")


def statistics_table(documents: DataFrame, *ids: str) -> DataFrame:
    """Ids, group and counts of each document."""
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    counts = documents.select(*ids, *keys, text_statistics(F.col("text")).alias("counts"))
    return counts.select(*ids, "lang", "source", "counts.*")


def judge(table: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds ``base_failed``, ``distance`` (null where the base rules fail) and ``kept``."""
    known = estimates.select("lang", "source", "centre", "scatter")
    judged = table.join(known, ["lang", "source"], "left").withColumn("base_failed", base_failed())
    extra = {f"x{i}": c for i, c in enumerate(vector())} | dict(zip(_NOISE, noise()))
    judged = with_distance(judged.withColumns(extra)).withColumn("distance", F.when(~F.col("base_failed"), F.col("distance")))
    limit = float(np.sqrt(_chi_square_quantile(CUTOFF, _P)))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    return judged.withColumn("kept", kept).drop("centre", "scatter", *extra)


def quality_rules(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, lang, source``, the counts, ``base_failed, distance, kept``."""
    folder = work_folder(documents.sparkSession, "outliers")
    table = _written(statistics_table(documents, "doc_id"), folder, "statistics")
    return judge(table, fit_scatter(table, folder))


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    folder = work_folder(documents.sparkSession, "outliers")
    estimates = fit_scatter(_written(statistics_table(documents), folder, "statistics"), folder)
    columns = documents.columns
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "lang", "source", "text")
    keys = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source")}
    counted = whole.withColumns(keys).withColumn("counts", text_statistics(F.col("text"))).drop("text")
    judged = judge(counted.select("row", "lang", "source", "counts.*"), estimates)
    # A filter on a generated column stays above it. Pushed down, it would count every text twice and
    # write out the distance, which then is too long to be compiled and is parsed anew by every task.
    return judged.select("row", F.explode(F.array("kept")).alias("kept")).where("kept").select("row.*")
