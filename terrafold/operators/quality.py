"""Column descriptions, missing values, range rules and the quality report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold import defaults as D

QUARTILES = (0.25, 0.5, 0.75)
SKETCH_ACCURACY = 10_000
MAX_RANKED = 1_000_000  # rows of one bracket ranked in a task


BRACKET = "c int, q int, pos double, lo double, hi double"


def exact_quantiles(
    df: DataFrame, columns: list[str], shares: tuple[float, ...] = QUARTILES,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """(column, share, value): linearly interpolated quantiles, exact.

    The built-in exact aggregate keeps every distinct value in one task. Here an approximate sketch
    first gives, per quantile, two values that enclose it: the sketch misses a rank by at most
    rows / accuracy. A second pass counts the rows below and collapses the few rows between by
    value; only those distinct values are ranked. Where a bracket could still hold more than
    MAX_RANKED rows, it is narrowed by further sketches first. NaN counts as missing.
    """
    spark = df.sparkSession
    values = df.select(
        F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("c", "v")
    ).where("v is not null and not isnan(v)")
    margin = 2.0 / accuracy
    lows = [max(0.0, q - margin) for q in shares]
    highs = [min(1.0, q + margin) for q in shares]
    sketch = values.groupBy("c").agg(
        F.percentile_approx("v", lows, accuracy).alias("lo"),
        F.percentile_approx("v", highs, accuracy).alias("hi"),
        F.count(F.lit(1)).alias("n"),
        F.min("v").alias("v_min"),
        F.max("v").alias("v_max"),
    )
    # One row per column: len(columns) rows.
    found = {r.c: r for r in sketch.collect()}
    brackets = []
    for c, r in found.items():
        for i, q in enumerate(shares):
            # Below this size the margin is less than the two ranks interpolation needs.
            whole = r.n <= accuracy
            lo = r.v_min if whole or lows[i] == 0.0 else r.lo[i]
            hi = r.v_max if whole or highs[i] == 1.0 else r.hi[i]
            brackets.append((c, i, (r.n - 1) * q, lo, hi))
    if any(6 * r.n > MAX_RANKED * accuracy for r in found.values()):
        brackets = _narrowed(values, brackets, accuracy)
    wanted = spark.createDataFrame(brackets, BRACKET)
    near = values.join(F.broadcast(wanted), "c").where("v <= hi")
    # Rows below a bracket collapse into one entry, rows inside it into one entry per value.
    collapsed = near.groupBy(
        "c", "q", "pos", F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("v")
    ).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("c", "q").orderBy(F.asc_nulls_first("v"))
    ends = collapsed.withColumn("end", F.sum("n").over(upto))
    floor_rank, ceil_rank = F.floor("pos"), F.ceil("pos")

    def at(rank: Column) -> Column:
        holds = (F.col("end") > rank) & (F.col("end") - F.col("n") <= rank)
        return F.max(F.when(holds, F.col("v")))

    interpolated = (
        ends.groupBy("c", "q", "pos")
        .agg(at(floor_rank).alias("a"), at(ceil_rank).alias("b"))
        .select("c", "q", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - floor_rank)).alias("value"))
    )
    checked = F.when(F.col("value").isNotNull(), F.col("value")).otherwise(
        F.raise_error(F.lit("quantile outside its bracket; raise the sketch accuracy")).cast("double")
    )
    names = F.array(*[F.lit(c) for c in columns])
    qs = F.array(*[F.lit(float(q)) for q in shares])
    return interpolated.select(
        F.get(names, F.col("c")).alias("column"), F.get(qs, F.col("q")).alias("share"),
        checked.alias("value"),
    )


def _narrowed(values: DataFrame, brackets: list[tuple], accuracy: int) -> list[tuple]:
    """Brackets with at most MAX_RANKED rows each, or of a single value.

    Each round counts the rows below and inside every bracket and sketches inside the wide ones,
    which leaves about 4 / accuracy of their rows. A bracket that a round does not even halve is
    filled by copies of few values, and copies collapse before they are ranked.
    """
    spark = values.sparkSession
    before: dict = {}
    while True:
        held = spark.createDataFrame(brackets, BRACKET)
        inside = F.col("v").between(F.col("lo"), F.col("hi"))
        counts = values.join(F.broadcast(held), "c").groupBy("c", "q").agg(
            F.count_if(F.col("v") < F.col("lo")).alias("below"), F.count_if(inside).alias("rows")
        )
        found = {(r.c, r.q): r for r in counts.collect()}  # one row per bracket
        wide = [
            b for b in brackets
            if b[3] < b[4] and found[b[:2]].rows > max(MAX_RANKED, accuracy)
            and 2 * found[b[:2]].rows < before.get(b[:2], float("inf"))
        ]
        before = {key: r.rows for key, r in found.items()}
        if not wide:
            return brackets
        sketches = []
        for c, q, pos, lo, hi in wide:
            at = (pos - found[c, q].below) / found[c, q].rows
            shares = [max(0.0, at - 2 / accuracy), min(1.0, at + 2 / accuracy)]
            rows = (F.col("c") == c) & F.col("v").between(lo, hi)
            sketches.append(F.percentile_approx(F.when(rows, F.col("v")), shares, accuracy))
        narrow = dict(zip([b[:2] for b in wide], values.agg(*sketches).first()))
        brackets = [
            (c, q, pos, *narrow[c, q]) if (c, q) in narrow else (c, q, pos, lo, hi)
            for c, q, pos, lo, hi in brackets
        ]


def describe_columns(
    df: DataFrame, columns: tuple[str, ...] = ("soc_percent", "clay_fraction")
) -> DataFrame:
    """(column_name, n, mean, std, min, q25, q50, q75, max), one row per column."""
    stats = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.nanvl(c, F.lit(None).cast("double"))).alias("n"),
            F.avg(F.nanvl(c, F.lit(None).cast("double"))).alias("mean"),
            F.stddev_samp(F.nanvl(c, F.lit(None).cast("double"))).alias("std"),
            F.min(F.nanvl(c, F.lit(None).cast("double"))).alias("min"),
            F.max(F.nanvl(c, F.lit(None).cast("double"))).alias("max"),
        )
        for c in columns
    ]
    moments = df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    quartiles = (
        exact_quantiles(df, list(columns))
        .groupBy(F.col("column").alias("column_name"))
        .agg(
            *[
                F.max(F.when(F.col("share") == F.lit(q), F.col("value"))).alias(f"q{int(q * 100)}")
                for q in QUARTILES
            ]
        )
    )
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def _missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a float column."""
    empty = F.col(name).isNull()
    return empty | F.coalesce(F.isnan(name), F.lit(False)) if df.schema[name].dataType.typeName() in ("double", "float") else empty


def missing_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_missing) for every column, in one pass. NaN is missing too."""
    counts = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(_missing(df, c)).alias("n_missing"))
        for c in df.columns
    ]
    return df.agg(F.array(*counts).alias("m")).select(F.explode("m").alias("m")).select("m.*")


def _ranges(df: DataFrame, extra: list[Column] | None = None) -> DataFrame:
    """One row with the extremes all rules work on."""
    nulls = reduce(
        lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns]
    )
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        nulls.alias("missing_values"),
        F.count_if(F.col("soc_percent").isNull()).alias("soc_missing"),
        F.min("latitude").alias("lat_min"), F.max("latitude").alias("lat_max"),
        F.min("longitude").alias("lon_min"), F.max("longitude").alias("lon_max"),
        F.min("soc_percent").alias("soc_min"), F.max("soc_percent").alias("soc_max"),
        F.min("top_depth_cm").alias("top_depth_min"), F.max("top_depth_cm").alias("top_depth_max"),
        F.min("bottom_depth_cm").alias("bottom_depth_min"),
        F.max("bottom_depth_cm").alias("bottom_depth_max"),
        F.min("sampling_date").alias("sampling_date_min"),
        F.max("sampling_date").alias("sampling_date_max"),
        F.min("lab_analysis_date").alias("lab_date_min"),
        F.max("lab_analysis_date").alias("lab_date_max"),
        *(extra or []),
    )


def _outside(low: str, high: str, floor: float, ceiling: float) -> Column:
    return F.coalesce((F.col(low) < floor) | (F.col(high) > ceiling), F.lit(False))


def validate_ranges(samples: DataFrame) -> DataFrame:
    """(rule, low, high) of every failed rule; the figures are what was found."""
    rules = [
        ("missing_values", F.col("missing_values") > 0, F.lit(None), F.col("missing_values")),
        ("latitude_range", _outside("lat_min", "lat_max", -90, 90), F.col("lat_min"), F.col("lat_max")),
        ("longitude_range", _outside("lon_min", "lon_max", -180, 180), F.col("lon_min"), F.col("lon_max")),
        ("soc_range", _outside("soc_min", "soc_max", 0, 100), F.col("soc_min"), F.col("soc_max")),
        (
            "depth_range", _outside("top_depth_min", "bottom_depth_max", 0, D.MAX_DEPTH_CM),
            F.col("top_depth_min"), F.col("bottom_depth_max"),
        ),
    ]
    structs = [
        F.struct(
            F.lit(name).alias("rule"), failed.alias("failed"), low.cast("double").alias("low"),
            high.cast("double").alias("high"),
        )
        for name, failed, low, high in rules
    ]
    return (
        _ranges(samples)
        .select(F.explode(F.array(*structs)).alias("r"))
        .where("r.failed")
        .select("r.rule", "r.low", "r.high")
    )


def quality_report(samples: DataFrame, described: tuple[str, ...] = ("soc_percent", "clay_fraction")) -> DataFrame:
    """One row: totals, missing values per column, ranges, descriptions, issues and the score (100 less 10 per issue).

    ``missing`` maps every column to its missing values, ``descriptions`` the described columns that there are to count, mean,
    standard deviation, extremes and quartiles. Columns without a value have null figures.
    """
    texts = D.QUALITY_ISSUES
    issues = F.filter(
        F.array(
            F.when(F.col("soc_missing") > 0, F.concat(F.lit(texts["soc_missing"]), F.col("soc_missing").cast("string"))),
            F.when(_outside("lat_min", "lat_max", -90, 90), F.lit(texts["latitude"])),
            F.when(_outside("lon_min", "lon_max", -180, 180), F.lit(texts["longitude"])),
            F.when(_outside("soc_min", "soc_max", 0, 100), F.lit(texts["soc_range"])),
        ),
        lambda i: i.isNotNull(),
    )
    figures = F.struct("n", "mean", "std", "min", "q25", "q50", "q75", "max")
    found = describe_columns(samples, tuple(c for c in described if c in samples.columns)).agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", figures))).alias("descriptions")
    )
    pairs = [x for c in samples.columns for x in (F.lit(c), F.count_if(_missing(samples, c)))]
    return (
        _ranges(samples, [F.create_map(*pairs).alias("missing")])
        .withColumn("descriptions", found.scalar())
        .withColumn("issues", issues)
        .withColumn(
            "quality_score", F.greatest(F.lit(0), F.lit(100) - F.size("issues") * 10).cast("long")
        )
    )


def top_country(samples: DataFrame) -> DataFrame:
    """Most frequent country (lowest id on ties): (country_id, n_samples)."""
    return (
        samples.where("country_id is not null")
        .groupBy("country_id")
        .agg(F.count(F.lit(1)).alias("n_samples"))
        .orderBy(F.desc("n_samples"), "country_id")
        .limit(1)
    )


def data_imbalance(samples: DataFrame, countries: DataFrame) -> DataFrame:
    """Share of each country in all samples, largest first; ``dominant`` above 50 %."""
    counts = samples.groupBy("country_id").agg(F.count(F.lit(1)).alias("n_samples"))
    total = counts.agg(F.sum("n_samples").alias("n"))
    names = countries.select(F.col("id").alias("country_id"), F.col("name").alias("country_name"))
    percent = F.col("n_samples") * 100.0 / total.scalar()
    return (
        counts.where("country_id is not null")
        .withColumn("percentage", percent)
        .withColumn("dominant", F.col("percentage") > D.IMBALANCE_PERCENT)
        .join(names, "country_id", "left")
        .select("country_id", "country_name", "n_samples", "percentage", "dominant")
        .orderBy(F.desc("n_samples"), "country_id")
    )
