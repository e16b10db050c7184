"""OLAP operators over a joined star."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def cube_cells(star: DataFrame, dims, measure, name="revenue") -> DataFrame:
    """Total of the measure for every combination of the dimension values."""
    return star.groupBy(*dims).agg(F.sum(measure).alias(name))


def slice_cube(star: DataFrame, dims, measure, dim, value, name="revenue") -> DataFrame:
    """Cells with one dimension fixed to a value."""
    return cube_cells(star.where(F.col(dim) == value), dims, measure, name)


def dice_cube(star: DataFrame, dims, measure, keep: dict, name="revenue") -> DataFrame:
    """Cells with two or more dimensions cut to lists of values."""
    for dim, values in keep.items():
        star = star.where(F.col(dim).isin(list(values)))
    return cube_cells(star, dims, measure, name)


def change_level(dims, hierarchy, step) -> list:
    """The dimensions with the one of ``hierarchy`` (fine to coarse) moved ``step`` levels.

    A positive step rolls up to a coarser level, a negative one drills down.
    """
    level = next(d for d in dims if d in hierarchy)
    place = hierarchy.index(level) + step
    if not 0 <= place < len(hierarchy):
        raise ValueError(f"no level {step:+d} from {level!r} in {hierarchy}")
    return [hierarchy[place] if d == level else d for d in dims]


def roll_up(star: DataFrame, dims, hierarchy, measure, name="revenue") -> DataFrame:
    return cube_cells(star, change_level(dims, hierarchy, 1), measure, name)


def drill_down(star: DataFrame, dims, hierarchy, measure, name="revenue") -> DataFrame:
    return cube_cells(star, change_level(dims, hierarchy, -1), measure, name)


def grouping_sets(star: DataFrame, dims, sets, measure, name="revenue") -> DataFrame:
    """Totals for several groupings at once, with ``grouping_id`` to tell subtotals from NULL values.

    The rows are first reduced to the finest cells, so only cells, not rows,
    are repeated per grouping.
    """
    cells = cube_cells(star, dims, measure, name)
    return cells.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(d) for d in dims]).agg(
        F.grouping_id().cast("int").alias("grouping_id"), F.sum(name).alias(name)
    )


def cube_totals(star: DataFrame, dims, measure, name="revenue") -> DataFrame:
    """Totals for every subset of the dimensions."""
    cells = cube_cells(star, dims, measure, name)
    return cells.cube(*dims).agg(F.grouping_id().cast("int").alias("grouping_id"), F.sum(name).alias(name))


def union_totals(star: DataFrame, dims, sets, measure, name="revenue") -> DataFrame:
    """The same totals as one aggregate per grouping, put together; missing dimensions are NULL.

    All groupings start from the finest cells, whose shuffle Spark reuses.
    """
    cells = cube_cells(star, dims, measure, name)

    def one(keys) -> DataFrame:
        missing = {d: F.lit(None).cast(star.schema[d].dataType) for d in dims if d not in keys}
        bits = sum(1 << (len(dims) - 1 - n) for n, d in enumerate(dims) if d in missing)
        total = cells.groupBy(*keys).agg(F.sum(name).alias(name))
        return total.select(
            *[missing[d].alias(d) if d in missing else F.col(d) for d in dims], F.lit(bits).alias("grouping_id"), name
        )

    return reduce(DataFrame.unionByName, [one(s) for s in sets])


def partial_cells(star: DataFrame, dims, measure, name="revenue", count="sales") -> DataFrame:
    """Sum and count of the measure in every finest cell: what can be merged later."""
    return star.groupBy(*dims).agg(F.sum(measure).alias(name), F.count(measure).alias(count))


def merge_cells(cells: DataFrame, more: DataFrame, dims, name="revenue", count="sales") -> DataFrame:
    """Cells of both, cell by cell."""
    both = cells.select(*dims, name, count).unionByName(more.select(*dims, name, count))
    kinds = {c: cells.schema[c].dataType for c in (name, count)}
    return both.groupBy(*dims).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in (name, count)])


def coarser(cells: DataFrame, dims, name="revenue", count="sales", average="average_sale") -> DataFrame:
    """Sum, count and average for fewer dimensions, from stored cells instead of rows."""
    totals = cells.groupBy(*dims).agg(F.sum(name).alias(name), F.sum(count).alias(count))
    return totals.withColumn(average, F.col(name) / F.col(count))
