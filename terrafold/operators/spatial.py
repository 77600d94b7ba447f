"""Point-in-polygon assignment over grid cells, and the reports on its outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold import defaults as D
from terrafold.functions.geometry import bounding_box, odd_crossings, on_any_edge, shape_edges
from terrafold.functions.measurement import once
from terrafold.session import BROADCAST_ROWS, cut_lineage, lookup_side

# Upper bound for the broadcast cell table, counted in polygon edges (32 bytes each).
BROADCAST_EDGES = 500_000
# A cell with more edges is split, and again while that thins it out.
CELL_EDGES = 256
SPLIT_ROUNDS = 4
# So many edges at most are cut by one task.
FEW_EDGES = 2_000
# A cell with more samples is shared by several tasks of the shuffled join.
CELL_SAMPLES = 200_000
# Widening of cell borders when edges are matched to cells; covers rounding of x / grid.
BORDER = 1e-9

CELL = ["level", "cell_x", "cell_y"]


def points(samples: DataFrame) -> DataFrame:
    """Samples with a point struct (lon, lat)."""
    return samples.withColumn(
        "point", F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    )


def valid_boundaries(countries: DataFrame, boundary_col: str = "boundary") -> DataFrame:
    return countries.dropna(subset=[boundary_col])


def _steps(first: Column, last: Column) -> Column:
    """first, ..., last; null where that is empty."""
    return F.when(first <= last, F.sequence(first, last))


def _parts(boundaries: DataFrame, grid: float) -> DataFrame:
    """One row per edge of a polygon with the range of cells that its box meets. A polygon is a row of
    ``boundaries``; several may have one ``country_id``."""
    west, south, east, north = (F.floor(F.col(f"_box.{c}") / grid) for c in ("min_lon", "min_lat", "max_lon", "max_lat"))
    return (
        boundaries.withColumn("shape", F.monotonically_increasing_id())
        .select("shape", "country_id", shape_edges("rings").alias("_edges"), bounding_box("rings").alias("_box"))
        .select(
            "shape", "country_id", F.lit(0).alias("level"), west.alias("x0"), east.alias("x1"), south.alias("y0"),
            north.alias("y1"), F.explode("_edges").alias("edge"), F.lit(None).cast("double").alias("turn"),
        )
    )


def _cut(parts: DataFrame, grid: float) -> DataFrame:
    """Edges and turns of every cell.

    A ray from a point towards +x crosses edges of its own cell and edges farther east. Those farther east matter only by
    their latitudes: each is crossed from its lower end on and no more from its upper end on. Two such ends that meet
    in a vertex cancel out, so a cell keeps few of these turns, however long the outline is. Turns below the
    cell are minus infinity. All comparisons are those of the plain ray test, so results are the same bit for bit.
    """
    size = F.lit(grid) / F.pow(F.lit(2.0), F.col("level"))
    edge = F.col("edge")
    low, high = F.least(edge["y1"], edge["y2"]), F.greatest(edge["y1"], edge["y2"])
    south, north = F.col("cell_y") * size, (F.col("cell_y") + 1) * size

    def x_at(y):
        part = F.try_divide(F.least(F.greatest(y, low), high) - edge["y1"], edge["y2"] - edge["y1"])
        return edge["x1"] + (edge["x2"] - edge["x1"]) * part

    flat = edge["y1"] == edge["y2"]
    one = F.when(flat, edge["x1"]).otherwise(x_at(south - BORDER))
    other = F.when(flat, edge["x2"]).otherwise(x_at(north + BORDER))
    first = F.greatest(F.col("y0"), F.floor((low - BORDER) / size))
    last = F.least(F.col("y1"), F.floor((high + BORDER) / size))
    banded = (
        parts.where("edge is not null")
        .withColumn("cell_y", F.explode(_steps(first, last)))
        .withColumn("_from", F.floor((F.least(one, other) - BORDER) / size))
        .withColumn("_to", F.floor((F.greatest(one, other) + BORDER) / size))
    )
    names = ["shape", "country_id", *CELL, "edge", "turn"]
    near = banded.withColumn(
        "cell_x", F.explode(_steps(F.greatest("_from", "x0"), F.least("_to", "x1")))
    ).select(*names)
    row = ["shape", "country_id", "level", "x0", "cell_y"]
    ahead = (
        banded.where((F.col("_from") > F.col("x0")) & ~flat)
        .select(*row, F.least("_from", F.col("x1") + 1).alias("_end"), F.explode(F.array(low, high)).alias("turn"))
    )
    inherited = (
        parts.where("edge is null")
        .withColumn("cell_y", F.explode(_steps(F.col("y0"), F.col("y1"))))
        .select(*row, (F.col("x1") + 1).alias("_end"), "turn")
    )
    below = F.when(F.col("turn") <= south - BORDER, F.lit(float("-inf"))).otherwise(F.col("turn"))
    ends = (
        ahead.unionByName(inherited)
        .where(F.col("turn") <= north + BORDER)
        .withColumn("turn", below)
        .groupBy(*row, "turn").agg(F.sort_array(F.collect_list("_end"), asc=False).alias("_ends"))
    )
    # A turn counts in the cells west of an odd number of ends. A list has a number per edge of one polygon in one row of cells.
    spans = F.transform(
        F.sequence(F.lit(0), F.size("_ends") - 1, F.lit(2)),
        lambda i: F.coalesce(
            _steps(F.coalesce(F.get("_ends", i + 1), F.col("x0")), F.get("_ends", i) - 1), F.array().cast("array<bigint>")
        ),
    )
    turns = ends.withColumn("cell_x", F.explode(F.flatten(spans))).withColumn("edge", F.lit(None).cast(parts.schema["edge"].dataType))
    return near.unionByName(turns.select(*names))


def _winnable(rows: DataFrame) -> DataFrame:
    """Rows without the polygons that cannot win their cell.

    The highest id wins, so below the highest polygon that covers a cell nothing needs a test.
    """
    held = rows.groupBy(*CELL, "shape", "country_id").agg(
        F.count("edge").alias("_edges"), F.count("turn").alias("_turns"), F.max("turn").alias("_top")
    )
    covered = held.where("_edges = 0 and _turns = 1").where(F.col("_top") == float("-inf"))
    floors = covered.groupBy(*CELL).agg(F.max("country_id").alias("_floor"))
    return rows.join(floors, CELL, "left").where("_floor is null or country_id >= _floor").drop("_floor")


def adaptive_cells(
    boundaries: DataFrame, grid: float = D.GRID_DEGREES, max_edges: int = CELL_EDGES
) -> tuple[DataFrame, list[DataFrame]]:
    """Cells that polygons meet, and the splits that lead to them.

    Input: ``country_id`` and ``rings``. One row per polygon and cell: level, cell_x, cell_y, country_id, covered, edges,
    turns; cells of a level are ``grid`` / 2^level wide. ``covered`` marks cells wholly inside, whose points need no
    test. Cells in which more than ``max_edges`` edges meet are cut into 4^step ones by their count, round by
    round, while the edges of the parts stay within four times those of the whole. Each split is a table of level, cell_x, cell_y, step.
    """
    # Kept once: every action on the result would otherwise grid the polygons again, and shapes be numbered anew.
    parts = cut_lineage(_parts(boundaries, grid))
    few = parts.limit(FEW_EDGES + 1).count() <= FEW_EDGES
    # Few edges need no exchange: one task then cuts, groups and joins.
    rows = cut_lineage(_winnable(_cut(parts.coalesce(1) if few else parts, grid)))
    leaves, splits = [], []
    for _ in range(SPLIT_ROUNDS):
        counted = rows.groupBy(*CELL).agg(F.count("edge").alias("_n")).where(F.col("_n") > max_edges)
        cells, before = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
        if not cells:
            break
        step = F.least(F.ceil(F.log2(F.col("_n") / max_edges) / 2), F.lit(6)).cast("int")
        crowded = cut_lineage(counted.select(*CELL, step.alias("step")))
        crowded = F.broadcast(crowded) if cells <= BROADCAST_ROWS else crowded
        marked = rows.join(crowded, CELL, "left")
        parts = F.pow(F.lit(2.0), F.col("step")).cast("long")
        inner = marked.where("step is not null").select(
            "shape", "country_id", (F.col("level") + F.col("step")).alias("level"), (F.col("cell_x") * parts).alias("x0"),
            ((F.col("cell_x") + 1) * parts - 1).alias("x1"), (F.col("cell_y") * parts).alias("y0"),
            ((F.col("cell_y") + 1) * parts - 1).alias("y1"), "edge", "turn",
        )
        finer = cut_lineage(_winnable(_cut(inner, grid)))
        leaves.append(marked.where("step is null").drop("step"))
        splits.append(crowded)
        rows = finer
        if finer.where("edge is not null").count() > 4 * before:
            break
    leaves.append(rows)
    whole = leaves[0]
    for more in leaves[1:]:
        whole = whole.unionByName(more)
    cells = whole.repartition(*CELL).groupBy(*CELL, "shape", "country_id").agg(
        F.collect_list("edge").alias("edges"), F.collect_list("turn").alias("turns")
    )
    covered = (F.size("edges") == 0) & (F.array_max("turns") == float("-inf"))
    return cells.withColumn("covered", F.coalesce(covered, F.lit(False))).drop("shape"), splits


def polygon_cells(boundaries: DataFrame, grid: float = D.GRID_DEGREES, max_edges: int = CELL_EDGES) -> DataFrame:
    """The cells of ``adaptive_cells`` alone."""
    return adaptive_cells(boundaries, grid, max_edges)[0]


def _with_cell(samples: DataFrame, grid: float, splits: list[DataFrame]) -> DataFrame:
    """Samples with the level and place of the cell they lie in; null where a coordinate is unusable."""
    usable = ~F.isnan("longitude") & ~F.isnan("latitude")

    def place(column, level):
        return F.when(usable, F.floor(F.col(column) / (F.lit(grid) / F.pow(F.lit(2.0), level))))

    placed = (
        samples.withColumn("level", F.lit(0)).withColumn("cell_x", place("longitude", F.col("level")))
        .withColumn("cell_y", place("latitude", F.col("level")))
    )
    for split in splits:
        level = F.col("level") + F.coalesce("step", F.lit(0))
        placed = (
            placed.join(split, CELL, "left").withColumn("level", level)
            .withColumn("cell_x", place("longitude", F.col("level")))
            .withColumn("cell_y", place("latitude", F.col("level"))).drop("step")
        )
    return placed


def assign_polygons(
    samples: DataFrame,
    boundaries: DataFrame,
    grid: float = D.GRID_DEGREES,
    max_broadcast_edges: int = BROADCAST_EDGES,
    max_edges: int = CELL_EDGES,
    cell_samples: int = CELL_SAMPLES,
) -> DataFrame:
    """Samples with the ``country_id`` of the polygon they lie in; the highest id wins overlaps.

    The polygon side becomes one row per cell with all candidate polygons, so a sample meets one row at most and is never
    multiplied. When the measured size is within bounds the cells are broadcast. A larger table is joined by one shuffle on
    the cell; cells with more than ``cell_samples`` samples, as counted, are copied for several tasks. Ids play no
    part, so null and repeated ones are treated alike on both ways. Columns named level, cell_x, cell_y or step must not
    be among those of the samples.
    """
    samples = samples.drop("country_id")
    cells, splits = adaptive_cells(boundaries, grid, max_edges)
    shapes = F.collect_list(F.struct("country_id", "covered", "edges", "turns"))
    lookup = cells.groupBy(*CELL).agg(shapes.alias("_shapes"))
    lookup = cut_lineage(lookup)
    size = F.aggregate("_shapes", F.lit(0), lambda n, s: n + F.size(s["edges"]) + F.size(s["turns"]) + 1)
    held = lookup.agg(F.sum(size)).first()[0] or 0
    keyed = _with_cell(samples, grid, splits)
    if held <= max_broadcast_edges:
        met = keyed.join(F.broadcast(lookup), CELL, "left")
    else:
        met = _met_by_shuffle(keyed, lookup, cell_samples)
    lon, lat = F.col("longitude"), F.col("latitude")

    def inside(s):
        turned = F.size(F.filter(s["turns"], lambda t: t <= lat)) % 2 == 1
        return (odd_crossings(s["edges"], lon, lat) != turned) & ~on_any_edge(s["edges"], lon, lat)

    hits = F.filter("_shapes", lambda s: s["covered"] | inside(s))
    winner = F.array_max(F.transform(hits, lambda s: s["country_id"]))
    return met.withColumn("country_id", once(winner)).drop(*CELL, "_shapes")


def _met_by_shuffle(keyed: DataFrame, lookup: DataFrame, cell_samples: int) -> DataFrame:
    # Checkpointed, so that a repeated task deals its rows out as before.
    keyed = cut_lineage(keyed)
    busy = keyed.where("cell_x is not null and cell_y is not null").groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n"))
    busy = lookup_side(
        busy.where(F.col("_n") > cell_samples).select(*CELL, F.ceil(F.col("_n") / cell_samples).cast("int").alias("_copies"))
    )
    number = F.monotonically_increasing_id()
    nowhere = F.col("cell_x").isNull() | F.col("cell_y").isNull()
    copy = F.when(nowhere, number % 1024).otherwise(number % F.coalesce("_copies", F.lit(1))).cast("int")
    dealt = keyed.join(busy, CELL, "left").withColumn("_copy", copy).drop("_copies")
    every = F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)
    copies = lookup.join(busy, CELL, "left").withColumn("_copy", F.explode(every)).drop("_copies")
    return dealt.join(copies, [*CELL, "_copy"], "left").drop("_copy")


def points_in_polygons(samples: DataFrame, boundaries: DataFrame, **options) -> DataFrame:
    """The association itself: (id, country_id) of every matched sample."""
    located = assign_polygons(
        samples.select("id", "longitude", "latitude"), boundaries, **options
    )
    return located.where("country_id is not null").select("id", "country_id")


def unassigned_samples(samples: DataFrame, association: DataFrame) -> DataFrame:
    return samples.join(association.select("id"), "id", "left_anti")


def refresh_sample_counts(countries: DataFrame, samples: DataFrame) -> DataFrame:
    """``sample_count`` of every country, zero included."""
    counts = (
        samples.where("country_id is not null")
        .groupBy(F.col("country_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        countries.drop("sample_count")
        .join(counts, "id", "left")
        .withColumn("sample_count", F.coalesce("_n", F.lit(0)))
        .drop("_n")
    )


def countries_with_samples(countries: DataFrame) -> DataFrame:
    return (
        countries.where("sample_count > 0")
        .select("id", "name", "iso_code", "sample_count")
        .orderBy(F.desc("sample_count"), "id")
    )


def active_countries(countries: DataFrame, samples: DataFrame) -> DataFrame:
    """Countries that some sample refers to."""
    used = samples.where("country_id is not null").select(F.col("country_id").alias("id")).distinct()
    return countries.join(used, "id", "left_semi").select("id", "name", "iso_code")


def association_coverage(samples: DataFrame, countries: DataFrame) -> DataFrame:
    """One row of coverage figures for samples carrying ``country_id``."""
    per_country = samples.groupBy("country_id").agg(F.count(F.lit(1)).alias("n"))
    known = countries.select(F.col("id").alias("country_id"), F.lit(True).alias("_known"))
    totals = per_country.join(known, "country_id", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_samples"),
        F.coalesce(F.sum(F.when(F.col("country_id").isNotNull(), F.col("n"))), F.lit(0)).alias(
            "associated_samples"
        ),
        F.count_if("_known").alias("countries_with_samples"),
    )
    n_countries = countries.agg(F.count(F.lit(1)).alias("n"))
    covered = F.try_divide(F.col("associated_samples") * 100.0, F.col("total_samples"))
    return totals.select(
        "total_samples",
        "associated_samples",
        (F.col("total_samples") - F.col("associated_samples")).alias("unassigned_samples"),
        F.coalesce(covered, F.lit(0.0)).alias("coverage_percentage"),
        "countries_with_samples",
        n_countries.scalar().alias("total_countries"),
    )


def country_distribution(samples: DataFrame, countries: DataFrame) -> DataFrame:
    """Samples per country code, zero included."""
    counted = refresh_sample_counts(countries.select("id", "iso_code"), samples)
    return counted.groupBy("iso_code").agg(F.sum("sample_count").alias("n_samples"))
