"""k-means over many (group, k, restart) models at once.

Rows are collapsed to one per distinct location and group and laid out along a space-filling curve in blocks of neighbours.
Blocks are dealt by range, never by group, so a group with most of the rows is as parallel as any other. Models are fitted in
passes of at most ``max_centers`` centres, or of one model if that has more; how they are dealt to passes does not show in the result.

A pass fits the models of groups with up to ``near_locations`` locations in one job, whatever the number of iterations: a task takes
whole models, and the blocks of a group go to every task that has models of it. Models of larger groups advance together:
an iteration is one Spark job that returns at most one row of sums per centre and task, and the new centres go back out as
a broadcast. Both ways give the same models.

The nearest centre comes from the blocks: of a model's centres only those can win in a block that are no farther from its
box than the least of all greatest distances. Where one centre is left the block's sums are added as they are; else
the points of the block are compared with the few that are left, for many models in one numpy step.
A task that fits a whole model with more than ``FOLLOWED_CENTERS`` centres keeps the nearest centre of every location instead and
follows the centres: only locations whose centre can have changed by what has moved are looked at again (``_Followed``).

Restarts begin with distance-weighted draws. A location with w rows has a seeded exponential number e per restart; the next
starting location is the one with the least e / (w * d2), d2 being the squared distance to the nearest one drawn so far. These
keys only grow as more are drawn, so a pass over the data that brings back the least few keys of each task settles all draws up to
the least key left behind. The draws for k centres are the first k of those for more.

A centre that loses its members moves to the location that is farthest from its own centre. A group with fewer
locations than wanted centres gets one centre for each.
"""

from __future__ import annotations

import hashlib
import heapq
import sys
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold import defaults as D
from terrafold.functions.measurement import once
from terrafold.session import cut_lineage

# Tasks get the functions below by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DECIMALS = 9  # centres are rounded so that the order of additions cannot show
BLOCK_POINTS = 128  # neighbouring locations that are compared with one set of centres
MODEL_CHUNK = 128  # models that are compared with a block in one step
FEW_CENTERS = 24  # up to so many are compared with every row of a labelling step
STEP_CENTERS = 200_000  # centres that one pass of an assignment step looks at
DRAWN_KEYS = 64  # least keys that a task brings back for each sequence of draws
CURVE_BITS = 20  # of each coordinate along the space-filling curve
PART_LOCATIONS = 2048  # least locations of a partition, if that leaves as many partitions as cores
MAX_PARTIAL_ROWS = 500_000  # rows a step may return without a shuffle
NEAR_POINTS = 64  # locations of a block where a task holds the whole group
NEAR_CELLS = 1 << 17  # pairs of block and centre that are looked at in one step there
FOLLOWED_CENTERS = 64  # models with more are fitted by following their centres
STEP_LOCATIONS = 16_000  # looked at in one step then, and pairs of location and centre
LISTED_PAIRS = 1 << 22  # pairs of neighbouring centres that are held at most
STEP_COST = 4000  # locations that a step without any would cost as much as
STEPS_SHRINK = 20  # a model takes half the steps if one in so many of its locations is a centre
LIST_SPARE = 0.8  # of the mean radius of a centre's members, by which its list reaches farther than now needed
TOLD_APART = 2.5  # a location is compared with centres up to so many times its distance from its own one
SURE = 1e-9  # share by which bounds are widened, far above rounding


@dataclass(frozen=True)
class KMeansSettings:
    restarts: int = D.KMEANS_RESTARTS
    max_iter: int = D.KMEANS_MAX_ITER
    tolerance: float = D.KMEANS_TOLERANCE
    seed: int = D.SEED
    max_centers: int = 200_000  # of one pass; models that come back as one number count as one
    near_locations: int = 500_000  # of a group whose models are fitted by single tasks (24 bytes each)


@dataclass
class Model:
    """One fitted (group, k): the best of its restarts, centres ordered by (latitude, longitude)."""

    group: object
    k: int
    restart: int
    inertia: float
    latitude: np.ndarray
    longitude: np.ndarray
    rows: np.ndarray  # members of each centre
    mean_latitude: np.ndarray  # mean of the members; the centre itself where there are none
    mean_longitude: np.ndarray


@dataclass
class GroupProfile:
    """Rows, distinct locations and tolerance base of a group."""

    n: int
    locations: int
    spread: float


@dataclass
class _Batch:
    """Flat centre arrays of the models fitted together."""

    groups: list
    ks: np.ndarray
    restarts: np.ndarray
    lat: np.ndarray
    lon: np.ndarray
    starts: np.ndarray = field(init=False)

    def __post_init__(self):
        self.starts = np.concatenate(([0], np.cumsum(self.ks)[:-1])).astype(np.int64)

    def by_group(self, active: np.ndarray) -> dict:
        out = defaultdict(list)
        for m in np.flatnonzero(active):
            cut = slice(self.starts[m], self.starts[m] + self.ks[m])
            out[self.groups[m]].append((int(m), self.lat[cut].copy(), self.lon[cut].copy()))
        return dict(out)


def nearest(lat: np.ndarray, lon: np.ndarray, clat: np.ndarray, clon: np.ndarray):
    """Index of the nearest centre per row (lowest on ties) and its squared distance.

    Few centres are visited one after another over whole coordinate arrays. With more, rows are taken in blocks of
    neighbours, and a block visits only the centres that can win in its box.
    """
    if len(clat) <= FEW_CENTERS or len(lat) <= FEW_CENTERS:
        return _visit(lat, lon, clat, clon, np.arange(len(clat)))
    index, best = np.zeros(len(lat), dtype=np.int64), np.zeros(len(lat))
    order = np.argsort(curve_place(lat, lon, (lat.min(), lat.max(), lon.min(), lon.max())), kind="stable")
    one = np.zeros(1, np.int64)
    for at in range(0, len(order), BLOCK_POINTS):
        rows = order[at : at + BLOCK_POINTS]
        keep = np.flatnonzero(can_win(lat[rows], lon[rows], clat, clon, one)[0])
        index[rows], best[rows] = _visit(lat[rows], lon[rows], clat, clon, keep)
    return index, best


def _visit(lat, lon, clat, clon, numbers: np.ndarray):
    index = np.full(len(lat), numbers[0], dtype=np.int64)
    best = (lat - clat[numbers[0]]) ** 2 + (lon - clon[numbers[0]]) ** 2
    d, e = np.empty_like(best), np.empty_like(best)
    for j in numbers[1:]:
        np.subtract(lat, clat[j], out=d)
        np.multiply(d, d, out=d)
        np.subtract(lon, clon[j], out=e)
        np.multiply(e, e, out=e)
        np.add(d, e, out=d)
        np.putmask(index, d < best, j)
        np.minimum(best, d, out=best)
    return index, best


def curve_place(lat: np.ndarray, lon: np.ndarray, box: tuple) -> np.ndarray:
    """Place along a space-filling curve through the box: the bits of both coordinates in turn."""
    def spread(values, low, high):
        top = (1 << CURVE_BITS) - 1
        x = np.clip((values - low) / ((high - low) or 1.0) * top, 0, top).astype(np.int64)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
                            (1, 0x5555555555555555)):
            x = (x | (x << shift)) & mask
        return x

    return spread(lat, *box[:2]) << 1 | spread(lon, *box[2:])


def can_win(lat, lon, clat, clon, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which centres can be nearest to a point of the box of the given ones, and how many that are of each model.

    ``starts`` are the places of the models' first centres. No centre that is exactly as near as another is left out.
    """
    def reach(values, centers):
        low, high = values.min(), values.max()
        inner = np.maximum(np.maximum(low - centers, centers - high), 0.0)
        outer = np.maximum(np.abs(centers - low), np.abs(centers - high))
        return inner * inner, outer * outer

    near, far = reach(lat, clat)
    near_lon, far_lon = reach(lon, clon)
    near += near_lon
    far += far_lon
    bound = np.minimum.reduceat(far, starts) * (1 + 1e-12)  # rounding must not lose a tie
    keep = near <= np.repeat(bound, np.diff(np.append(starts, len(clat))))
    return keep, np.add.reduceat(keep, starts)


def winners(lat, lon, clat, clon, first: np.ndarray, count: np.ndarray):
    """Per model and point the place among the model's candidates (lowest on ties), and the squared distance.

    Candidates of model m are ``count[m]`` centres from ``first[m]`` on; counts descend. All models have the same points, or
    each a row of its own.
    """
    lat, lon = np.atleast_2d(lat), np.atleast_2d(lon)
    best = (lat - clat[first][:, None]) ** 2 + (lon - clon[first][:, None]) ** 2
    place = np.zeros(best.shape, dtype=np.int64)
    for j in range(1, int(count[0])):
        m = int(np.searchsorted(-count, -j, side="left"))  # models with more than j candidates
        d, e = lat[:m] - clat[first[:m] + j][:, None], lon[:m] - clon[first[:m] + j][:, None]
        d *= d
        e *= e
        d += e
        np.copyto(place[:m], j, where=d < best[:m])
        np.minimum(best[:m], d, out=best[:m])
    return place, best


class _Stack:
    """The centres of a group's models, one after the other."""

    def __init__(self, models: list):
        self.numbers = np.array([m for m, _, _ in models], np.int64)
        self.lat = np.concatenate([lat for _, lat, _ in models])
        self.lon = np.concatenate([lon for _, _, lon in models])
        sizes = np.array([len(lat) for _, lat, _ in models])
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes

    def compared(self, lat, lon, alone: bool):
        """(models, first candidates, counts, candidates) in chunks with descending counts. With ``alone`` the first
        item is instead the centres that win the whole block for their models, the second one None."""
        keep, count = can_win(lat, lon, self.lat, self.lon, self.starts)
        candidates = np.flatnonzero(keep)
        first = np.cumsum(count) - count
        use = np.arange(len(count))
        if alone:
            yield candidates[first[count == 1]], None, None, candidates
            use = use[count > 1]
        use = use[np.argsort(-count[use], kind="stable")]
        for at in range(0, len(use), MODEL_CHUNK):
            part = use[at : at + MODEL_CHUNK]
            yield part, first[part], count[part], candidates


def _point_blocks(batches):
    """(group, lat, lon, w) of every block."""
    for batch in batches:
        groups = batch.column(0).to_pylist()
        lists = [batch.column(i) for i in (1, 2, 3)]
        for i, group in enumerate(groups):
            yield group, *(c[i].values.to_numpy() for c in lists)


def usable_rows(samples: DataFrame, *columns: str) -> DataFrame:
    """Rows without a null or NaN in the given columns; only floats can be NaN."""
    floats = {f.name for f in samples.schema.fields if f.dataType.typeName() in ("double", "float")}
    for c in columns:
        fine = F.col(c).isNotNull()
        samples = samples.where(fine & ~F.isnan(c) if c in floats else fine)
    return samples


def _slices(codes: np.ndarray, n: int):
    """Row numbers of each code from 0 to n - 1, sorted once."""
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(n + 1))
    return [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def location_blocks(samples: DataFrame, parts: int) -> DataFrame:
    """(grp, lat, lon, w), the last three as arrays: equal locations collapsed, neighbours together.

    The count is pre-aggregated before the shuffle, so a heavily repeated location stays one row per task. Rows are dealt by
    ranges of (group, place along the curve); a block never holds two groups. Few locations make fewer than ``parts`` partitions.
    """
    spark = samples.sparkSession
    single = (
        usable_rows(samples, "grp", "latitude", "longitude")
        .groupBy("grp", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
        .agg(F.count(F.lit(1)).cast("double").alias("w"))
    )
    single = cut_lineage(single)
    *box, n = single.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon"), F.count(F.lit(1))).first()
    parts = min(parts, max(spark.sparkContext.defaultParallelism, n // PART_LOCATIONS))
    kind = single.schema["grp"].dataType.simpleString()

    def placed(batches):
        for batch in batches:
            lat, lon = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(curve_place(lat, lon, tuple(box)))], names=["grp", "lat", "lon", "w", "place"]
            )

    def packed(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            yield from _packed(table, last=False)
            held = _open_end(table)
        if held is not None:
            yield from _packed(pa.Table.from_batches([held]), last=True)

    return (
        single.mapInArrow(placed, f"grp {kind}, lat double, lon double, w double, place long")
        .repartitionByRange(parts, "grp", "place").sortWithinPartitions("grp", "place", "lat", "lon")
        .mapInArrow(packed, f"grp {kind}, lat array<double>, lon array<double>, w array<double>")
    )


def _starts_of_blocks(table: pa.Table) -> np.ndarray:
    codes = table.column(0).combine_chunks().dictionary_encode().indices.to_numpy()
    change = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    ends = np.append(change[1:], len(codes))
    return np.concatenate([np.arange(a, b, BLOCK_POINTS) for a, b in zip(change, ends)])


def _open_end(table: pa.Table):
    """The rows of the last block, which may go on in the next batch."""
    if not table.num_rows:
        return None
    return table.slice(int(_starts_of_blocks(table)[-1])).combine_chunks().to_batches()[0]


def _packed(table: pa.Table, last: bool):
    if not table.num_rows:
        return
    starts = _starts_of_blocks(table)
    ends = np.append(starts, table.num_rows)
    if not last:  # the open end waits
        starts, ends = starts[:-1], ends[:-1]
    if not len(starts):
        return
    whole = table.slice(0, int(ends[-1])).combine_chunks()
    offsets = pa.array(ends.astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, whole.column(i).combine_chunks()) for i in (1, 2, 3)]
    yield pa.RecordBatch.from_arrays(
        [whole.column(0).combine_chunks().take(pa.array(starts)), *lists], names=["grp", "lat", "lon", "w"]
    )


def center_sums(
    blocks: DataFrame, models: dict, spark: SparkSession, tasks: int, with_cost: bool = True
) -> pd.DataFrame:
    """Per (model, centre): weight, weighted coordinate sums and weighted squared distance.

    Every task returns at most one row per centre. Up to MAX_PARTIAL_ROWS of these are added up
    where they arrive; more are added up by a shuffle first, which leaves one row per centre, and
    the centres are bounded by the caller.
    """
    shared = spark.sparkContext.broadcast(models)

    def partial(batches):
        stacks, sums = {}, {}
        for group, lat, lon, w in _point_blocks(batches):
            if group not in shared.value:
                continue
            if group not in stacks:
                stacks[group] = _Stack(shared.value[group])
                sums[group] = np.zeros((4, len(stacks[group].lat)))
            stack, total = stacks[group], sums[group]
            wlat, wlon = w * lat, w * lon
            for models_, first, count, candidates in stack.compared(lat, lon, alone=not with_cost):
                if first is None:
                    for line, values in enumerate((w, wlat, wlon)):
                        total[line][models_] += values.sum()
                    continue
                place, best = winners(lat, lon, stack.lat[candidates], stack.lon[candidates], first, count)
                own = np.cumsum(count) - count
                place += own[:, None]
                at = candidates[np.repeat(first - own, count) + np.arange(count.sum())]
                flat = place.ravel()
                for line, values in enumerate((w, wlat, wlon)):
                    total[line][at] += np.bincount(flat, np.tile(values, len(count)), len(at))
                if with_cost:
                    total[3][at] += np.bincount(flat, (best * w).ravel(), len(at))
        for group, total in sums.items():
            stack = stacks[group]
            filled = np.flatnonzero(total[0])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(stack.numbers, stack.sizes)[filled]),
                    pa.array((np.arange(len(stack.lat)) - np.repeat(stack.starts, stack.sizes))[filled]),
                    *[pa.array(line[filled]) for line in total],
                ],
                names=["model", "j", "w", "s_lat", "s_lon", "s_dist"],
            )

    schema = "model long, j long, w double, s_lat double, s_lon double, s_dist double"
    partials = blocks.mapInArrow(partial, schema)
    centers = sum(len(lat) for held in models.values() for _, lat, _ in held)
    if centers * tasks > MAX_PARTIAL_ROWS:
        partials = partials.groupBy("model", "j").agg(
            *[F.sum(c).alias(c) for c in ("w", "s_lat", "s_lon", "s_dist")]
        )
    rows = partials.toArrow().to_pandas()
    shared.destroy()
    return rows.groupby(["model", "j"], as_index=False, sort=True).sum()


def farthest_locations(blocks: DataFrame, models: dict, wanted: dict, spark: SparkSession) -> dict:
    """Model -> (lat, lon) of the ``wanted[model]`` locations farthest from their centres, ties by latitude, longitude."""
    shared = spark.sparkContext.broadcast((models, wanted))

    def partial(batches):
        held, asked = shared.value
        found: dict = {}
        for group, lat, lon, _ in _point_blocks(batches):
            for model, clat, clon in held.get(group, ()):
                _, d = nearest(lat, lon, clat, clon)
                rows = np.concatenate([found.get(model, np.zeros((0, 3))), np.column_stack([d, lat, lon])])
                found[model] = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[: asked[model]]]
        if found:
            stacked = np.concatenate(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(list(found), np.int64), [len(v) for v in found.values()])), *map(pa.array, stacked.T.copy())],
                names=["model", "d", "lat", "lon"],
            )

    rows = blocks.mapInArrow(partial, "model long, d double, lat double, lon double").toArrow().to_pandas()
    shared.destroy()
    rows = rows.sort_values(["model", "d", "lat", "lon"], ascending=[True, False, True, True])
    return {m: part[["lat", "lon"]].to_numpy()[: wanted[m]] for m, part in rows.groupby("model")}


def _moved(sums: np.ndarray, clat: np.ndarray, clon: np.ndarray):
    """New centres from (weight, lat, lon) sums; a centre without members stays where it is."""
    lat, lon, filled = clat.copy(), clon.copy(), sums[0] > 0
    lat[filled] = np.round(sums[1][filled] / sums[0][filled], DECIMALS)
    lon[filled] = np.round(sums[2][filled] / sums[0][filled], DECIMALS)
    return lat, lon


def _scattered(batch: _Batch, found: pd.DataFrame) -> np.ndarray:
    """Rows (model, j, w, s_lat, s_lon, s_dist) as four flat arrays over all centres of a batch."""
    sums = np.zeros((4, len(batch.lat)))
    at = batch.starts[found["model"].to_numpy()] + found["j"].to_numpy()
    for line, name in enumerate(("w", "s_lat", "s_lon", "s_dist")):
        sums[line][at] = found[name].to_numpy()
    return sums


def _settle(
    blocks: DataFrame, batch: _Batch, limit: np.ndarray, max_iter: int, tasks: int
) -> pd.DataFrame:
    """Move the models of a batch until they rest, one job per iteration; returns the final sums."""
    spark = blocks.sparkSession
    active = np.ones(len(batch.ks), dtype=bool)
    for _ in range(max_iter):
        sums = _scattered(batch, center_sums(blocks, batch.by_group(active), spark, tasks, with_cost=False))
        lat, lon = _moved(sums, batch.lat, batch.lon)
        empty = (sums[0] == 0) & np.repeat(active, batch.ks)
        if empty.any():
            missing = np.add.reduceat(empty, batch.starts)
            hurt = missing > 0
            far = farthest_locations(
                blocks, batch.by_group(hurt), {int(m): int(missing[m]) for m in np.flatnonzero(hurt)}, spark
            )
            for m, places in far.items():
                own = batch.starts[m] + np.flatnonzero(empty[batch.starts[m] : batch.starts[m] + batch.ks[m]])
                lat[own[: len(places)]], lon[own[: len(places)]] = np.round(places, DECIMALS).T
        moved = (lat - batch.lat) ** 2 + (lon - batch.lon) ** 2
        moved[np.repeat(~active, batch.ks)] = 0
        keep = np.repeat(active, batch.ks)
        batch.lat, batch.lon = np.where(keep, lat, batch.lat), np.where(keep, lon, batch.lon)
        active &= np.add.reduceat(moved, batch.starts) > limit
        if not active.any():
            break
    return center_sums(blocks, batch.by_group(np.ones_like(active)), spark, tasks)


def digits(lat: np.ndarray, lon: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers of 52 bits from a digest of seed and location, which is told apart to a millionth."""
    names = zip(np.floor(lat * 1e6).astype(np.int64).tolist(), np.floor(lon * 1e6).astype(np.int64).tolist())
    found = [hashlib.md5(b"%d:%d:%d" % (seed, a, b)).hexdigest() for a, b in names]
    return np.array([int(x[:13], 16) for x in found], np.int64), np.array([int(x[13:26], 16) for x in found], np.int64)


def exponentials(held: tuple[np.ndarray, np.ndarray], restart: int) -> np.ndarray:
    """-ln(u) per location, u being another one for each restart."""
    return -np.log((((held[0] + restart * held[1]) & ((1 << 52) - 1)) + 0.5) / 2.0**52)


class _Places:
    """All locations of one group, held by a task: sorted, and in blocks of neighbours with the box and the sums of each."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, w: np.ndarray, seed: int):
        order = np.lexsort((lon, lat))
        self.lat, self.lon, self.w, self.seed = lat[order], lon[order], w[order], seed
        self.digits, self.restart, self.drawn = None, None, []
        self.lines = self.w, self.w * self.lat, self.w * self.lon
        strip = np.arange(len(lat)) // (NEAR_POINTS * max(1, round((len(lat) / NEAR_POINTS) ** 0.5)))
        at = np.lexsort((self.lon, strip))  # strips of latitude, cut along the longitude
        spare = -len(at) % NEAR_POINTS  # the last block is filled up with a location that counts nothing
        at = np.append(at, np.repeat(at[-1:], spare)).reshape(-1, NEAR_POINTS)
        weight = self.w[at]
        weight.ravel()[len(lat):] = 0.0
        self.points = self.lat[at], self.lon[at]
        self.values = weight, weight * self.points[0], weight * self.points[1]
        self.totals = [v.sum(axis=1) for v in self.values]
        self.low, self.high = [x.min(axis=1) for x in self.points], [x.max(axis=1) for x in self.points]

    def _draw(self, restart: int, depth: int) -> None:
        """Goes on with the distance-weighted draws of a restart, and with the nearest drawn location of each."""
        if self.restart != restart:
            if self.digits is None:
                self.digits = digits(self.lat, self.lon, self.seed)
            self.restart, self.drawn = restart, []
            self.waits, self.near = exponentials(self.digits, restart), np.ones(len(self.lat))
            self.own, self.best = np.zeros(len(self.lat), np.int64), np.full(len(self.lat), np.inf)
        while len(self.drawn) < depth:
            with np.errstate(divide="ignore"):
                key = self.waits / (self.w * self.near)
            at = int(np.argmin(key))
            if not np.isfinite(key[at]):
                break
            d = (self.lat - self.lat[at]) ** 2 + (self.lon - self.lon[at]) ** 2
            self.near = np.minimum(self.near, d) if self.drawn else d
            lat, lon = (np.round(x[at], DECIMALS) for x in (self.lat, self.lon))  # centres are rounded, drawn locations are not
            if lat != self.lat[at] or lon != self.lon[at]:
                d = (self.lat - lat) ** 2 + (self.lon - lon) ** 2
            np.putmask(self.own, d < self.best, len(self.drawn))
            np.minimum(self.best, d, out=self.best)
            self.drawn.append(at)

    def starts(self, restart: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``depth`` distance-weighted draws, fewer if no other location is left."""
        self._draw(restart, depth)
        at = np.array(self.drawn[:depth], np.int64)
        return self.lat[at], self.lon[at]

    def started(self, lat: np.ndarray, lon: np.ndarray, restart: int) -> np.ndarray:
        """The nearest of the rounded starting centres for each location."""
        if self.restart == restart and len(self.drawn) == len(lat):  # else more are drawn by now
            return self.own.copy()
        return nearest(self.lat, self.lon, lat, lon)[0]

    def _can_win(self, own: slice, clat: np.ndarray, clon: np.ndarray) -> np.ndarray:
        """``can_win`` for many blocks and one model."""
        near, far = 0.0, 0.0
        for low, high, centers in zip(self.low, self.high, (clat, clon)):
            below, above = low[own, None] - centers, centers - high[own, None]
            inner, outer = np.maximum(np.maximum(below, above), 0.0), np.minimum(below, above)
            near, far = near + inner * inner, far + outer * outer
        return near <= (far.min(axis=1) * (1 + 1e-12))[:, None]

    def sums(self, clat: np.ndarray, clon: np.ndarray, with_cost: bool = False) -> np.ndarray:
        """Weight, weighted coordinates and, on demand, weighted squared distance of the members of each centre."""
        total, step = np.zeros((4, len(clat))), max(1, NEAR_CELLS // len(clat))
        for at in range(0, len(self.totals[0]), step):
            own = slice(at, at + step)
            keep = self._can_win(own, clat, clon)
            count, candidates = keep.sum(axis=1), np.nonzero(keep)[1]
            first = np.cumsum(count) - count
            if not with_cost:
                alone = np.flatnonzero(count == 1)
                for line in range(3):
                    total[line] += np.bincount(candidates[first[alone]], self.totals[line][own][alone], len(clat))
            use = np.flatnonzero(count > (not with_cost))
            if not len(use):
                continue
            use = use[np.argsort(-count[use], kind="stable")]
            first, count = first[use], count[use]
            lat, lon = (x[own][use] for x in self.points)
            place, best = winners(lat, lon, clat[candidates], clon[candidates], first, count)
            at_center = candidates[first[:, None] + place].ravel()
            values = [v[own][use] for v in self.values]
            for line, part in enumerate(values + [best * values[0]] * with_cost):
                total[line] += np.bincount(at_center, part.ravel(), len(clat))
        return total

    def settled(self, restart: int, size: int, limit: float, max_iter: int):
        """Centres of a model at rest, and its final sums; ``_settle`` for one model."""
        lat, lon = (np.round(x, DECIMALS) for x in self.starts(restart, size))
        followed = _Followed(self, lat.copy(), lon.copy(), self.started(lat, lon, restart)) if len(lat) > FOLLOWED_CENTERS else None
        for _ in range(max_iter):
            sums = followed.sums if followed else self.sums(lat, lon)
            new_lat, new_lon = _moved(sums, lat, lon)
            empty = np.flatnonzero(sums[0] == 0)
            if len(empty):
                d = followed.squares() if followed else nearest(self.lat, self.lon, lat, lon)[1]
                far = np.argsort(-d, kind="stable")[: len(empty)]  # locations are sorted by latitude, longitude
                new_lat[empty[: len(far)]] = np.round(self.lat[far], DECIMALS)
                new_lon[empty[: len(far)]] = np.round(self.lon[far], DECIMALS)
            moved = ((new_lat - lat) ** 2 + (new_lon - lon) ** 2).sum()
            lat, lon = new_lat, new_lon
            if followed:
                followed.follow(lat, lon)
            if moved <= limit:
                break
        return lat, lon, followed.costs() if followed else self.sums(lat, lon, with_cost=True)


def _runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1 and so on, count[i] numbers of each i, one after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + count, count)


def _squares(lat: np.ndarray, lon: np.ndarray, clat: np.ndarray, clon: np.ndarray) -> np.ndarray:
    """Squared distances, to the bit those of ``nearest``; the first two are written over."""
    lat -= clat
    lat *= lat
    lon -= clon
    lon *= lon
    lat += lon
    return lat


def near_pairs(lat: np.ndarray, lon: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(one, other) of all centres with the other one within the reach of the first, in order of the first; None for too many.

    The centres lie in strips of latitude of equally many, sorted by longitude, so towns of centres need no longer search.
    """
    k = len(lat)
    strips = max(1, round((k / 2) ** 0.5))
    strip, order = np.arange(k) * strips // k, np.argsort(lat, kind="stable")
    low = lat[order][np.searchsorted(strip, np.arange(strips))]
    at = order[np.lexsort((lon[order], strip))]
    x, width = lon - lon.min(), 2.0 * np.ptp(lon) + 1.0
    keys = strip * width + x[at]
    first = np.maximum(np.searchsorted(low, lat - reach) - 1, 0)
    count = np.searchsorted(low, lat + reach, "right") - first
    one, found = np.repeat(np.arange(k), count), _runs(first, count)
    middle, side = x[one], reach[one] + SURE * width
    first = np.searchsorted(keys, found * width + np.maximum(middle - side, 0.0))
    count = np.searchsorted(keys, found * width + np.minimum(middle + side, 0.75 * width), "right") - first
    if count.sum() > LISTED_PAIRS:
        return None
    one, other = np.repeat(one, count), at[_runs(first, count)]
    keep = (_squares(lat[one], lon[one], lat[other], lon[other]) <= (reach * reach)[one]) & (one != other)
    return one[keep], other[keep]


class _Followed:
    """The nearest centre of every location of a group, followed while the centres of one model move.

    A centre's list holds all centres that can be nearest to one of its members. It was made for centres at ``seen`` and holds
    those up to ``reach`` from there, which is enough until they are ``room`` away from where they were seen; members are up to
    ``radius`` away from where their centre was seen. Lists of single centres are made anew when that no longer holds, all when many are.

    A location knows a rival and a bound: no other centre is nearer than that, save its own and the rival. A bound shrinks by
    what the centres in the list of its own move, and never exceeds what is known of centres outside of the list. The
    location is looked at again when its centre and the list have moved by its ``margin`` in all, and compared with the list when
    the bound does not settle it. Everything that decides is the computed distance, as in ``nearest``; only bounds have a spare.
    """

    def __init__(self, places: _Places, lat: np.ndarray, lon: np.ndarray, own: np.ndarray):
        self.places, self.lat, self.lon, self.own = places, lat, lon, own
        self.rival, self.bound, self.margin = own.copy(), np.zeros(len(own)), np.full(len(own), -np.inf)
        self.drops, self.steps = np.zeros(len(lat)), np.zeros(len(lat))  # what a centre's list and the centre have moved in all
        self.one, self.spare = None, 1e-14 * (np.ptp(places.lat) + np.ptp(places.lon))  # far above rounding in a step
        self.sums = np.array([np.bincount(own, line, len(lat)) for line in places.lines])

    def squares(self, at=slice(None)) -> np.ndarray:
        """Squared distances of locations to their centres."""
        own = self.own[at]
        return _squares(self.places.lat[at].copy(), self.places.lon[at].copy(), self.lat.take(own), self.lon.take(own))

    def costs(self) -> np.ndarray:
        return np.vstack([self.sums, np.bincount(self.own, self.squares() * self.places.w, len(self.lat))])

    def follow(self, lat: np.ndarray, lon: np.ndarray) -> None:
        """The centres are there now."""
        step = np.sqrt(_squares(self.lat, self.lon, lat, lon))
        self.lat, self.lon = lat.copy(), lon.copy()
        self._listed()
        if self.one is None:
            self.own, _ = nearest(self.places.lat, self.places.lon, lat, lon)
            self.bound[:] = self.margin[:] = -np.inf
            self._add_up(np.arange(len(lat)))
            return
        gap = _squares(lat.take(self.one), lon.take(self.one), lat.take(self.other), lon.take(self.other))
        np.sqrt(gap, out=gap)
        gap *= 1 - SURE
        drop = self._of_lists(np.maximum, step.take(self.other), 0.0)
        moving = (drop > 0) | (step > 0)
        self.drops += drop * (1 + SURE) + self.spare * moving
        self.steps += step * (1 + SURE) + self.spare * moving
        open_ = ((self.drops + self.steps).take(self.own) >= self.margin).nonzero()[0]
        next_ = self._of_lists(np.minimum, gap, np.inf)
        open_ = [self._measured(open_[at : at + STEP_LOCATIONS], next_) for at in range(0, len(open_), STEP_LOCATIONS)]
        changed = [c for locations in open_ for c in self._compared(locations, gap)]
        if changed:
            self._add_up(np.unique(np.concatenate(changed)))

    def _listed(self) -> None:
        """Makes the lists hold for the centres as they are; members of centres with a new list are to be looked at."""
        k, new, stale = len(self.lat), (), self.one is None
        if not stale:
            gone = np.sqrt(_squares(self.seen[0].copy(), self.seen[1].copy(), self.lat, self.lon))
            left = (gone > self.room) | ((2 * self.radius + gone + self.room) * (1 + SURE) > self.reach)
            new = left.nonzero()[0]
            if not len(new):
                return
            stale = len(new) * 6 > k or len(new) * k > NEAR_CELLS
        members = np.arange(len(self.own)) if stale else left.take(self.own).nonzero()[0]
        self.margin[members] = -np.inf
        far = np.zeros(k)
        np.maximum.at(far, self.own.take(members), self.squares(members))
        far = np.sqrt(far)
        if stale:
            self.seen, self.radius = (self.lat.copy(), self.lon.copy()), far
            spare = LIST_SPARE * float(far.mean())
            self.room, self.reach = spare / 3, (2 * far + spare) * (1 + SURE)
            self.one, self.other = near_pairs(self.lat, self.lon, self.reach) or (None, None)
            if self.one is None:
                return
        else:
            self.radius[new] = far[new]
            self.reach[new] = (2 * far[new] + 3 * self.room) * (1 + SURE)
            self.seen[0][new], self.seen[1][new] = self.lat[new], self.lon[new]
            apart = (self.lat[new][:, None] - self.seen[0]) ** 2 + (self.lon[new][:, None] - self.seen[1]) ** 2
            apart[np.arange(len(new)), new] = np.inf
            reach = self.reach * self.reach
            i, j = np.divmod((apart <= reach[new][:, None]).ravel().nonzero()[0], k)
            reach[new] = -1.0  # their own lists have all already
            n, m = np.divmod((apart <= reach).ravel().nonzero()[0], k)
            keep = (~(left.take(self.one) | left.take(self.other))).nonzero()[0]
            one = np.concatenate([self.one.take(keep), new.take(i), m])
            order = np.argsort(one, kind="stable")
            self.one, self.other = one.take(order), np.concatenate([self.other.take(keep), j, new.take(n)]).take(order)
        self.count = np.bincount(self.one, minlength=k)
        self.first = np.cumsum(self.count) - self.count
        self.listing = self.count.nonzero()[0]

    def _of_lists(self, ufunc, values: np.ndarray, none: float) -> np.ndarray:
        out = np.full(len(self.lat), none)
        if len(self.listing):
            out[self.listing] = ufunc.reduceat(values, self.first[self.listing])
        return out

    def _outside(self, centers: np.ndarray) -> np.ndarray:
        """Least distance that members of each centre have to centres outside of its list, wherever these go before they are listed."""
        return (self.reach.take(centers) - self.radius.take(centers) - self.room) * (1 - SURE)

    def _settle(self, at: np.ndarray, own: np.ndarray, far: np.ndarray, rival_far: np.ndarray, bound: np.ndarray) -> None:
        drops = self.drops.take(own)
        self.bound[at] = bound + drops
        self.margin[at] = (np.minimum(rival_far, bound) - far) * (1 - SURE) - self.spare + drops + self.steps.take(own)

    def _measured(self, at: np.ndarray, next_: np.ndarray) -> np.ndarray:
        """Looks at locations; those whose centre stays open, as rival and bound do not settle it."""
        y, x = self.places.lat.take(at), self.places.lon.take(at)
        own, rival = self.own.take(at), self.rival.take(at)
        far = np.sqrt(_squares(y.copy(), x.copy(), self.lat.take(own), self.lon.take(own)))
        rival_far = np.sqrt(_squares(y, x, self.lat.take(rival), self.lon.take(rival)))
        rival_far[rival == own] = np.inf
        outside = self._outside(own)
        bound = np.minimum(self.bound.take(at) - self.drops.take(own), outside)
        open_ = (np.minimum(rival_far, bound) <= far).nonzero()[0]
        if len(open_):
            alone = np.minimum(next_.take(own.take(open_)) - far.take(open_), outside.take(open_))
            clear = alone > far.take(open_)
            use = open_[clear]
            bound[use], rival_far[use], self.rival[at.take(use)] = alone[clear], np.inf, own.take(use)
            open_ = open_[~clear]
        self._settle(at, own, far, rival_far, bound)
        return at.take(open_)

    def _compared(self, at: np.ndarray, gap: np.ndarray):
        """Compares locations with the list of their centre; the centres that lost or won one, step by step."""
        if len(at):
            pairs = np.cumsum(self.count.take(self.own.take(at)))
            for part in np.split(at, np.searchsorted(pairs, np.arange(STEP_LOCATIONS, pairs[-1], STEP_LOCATIONS))):
                if len(part):
                    yield from self._decided(part, gap)

    def _decided(self, at: np.ndarray, gap: np.ndarray):
        places, own, best = self.places, self.own.take(at), self.squares(at)
        far, count = np.sqrt(best), self.count.take(own)
        row, pair = np.repeat(np.arange(len(at)), count), _runs(self.first.take(own), count)
        close = (gap.take(pair) <= (TOLD_APART * far).take(row)).nonzero()[0]
        row, center = row.take(close), self.other.take(pair.take(close))
        point = at.take(row)
        d = _squares(places.lat.take(point), places.lon.take(point), self.lat.take(center), self.lon.take(center))
        count = np.bincount(row, minlength=len(at))
        some = count.nonzero()[0]
        first = (np.cumsum(count) - count).take(some)
        least, second, rival = np.full(len(at), np.inf), np.full(len(at), np.inf), own.copy()
        if len(some):
            least[some] = np.minimum.reduceat(d, first)
            winner = np.flatnonzero(d == least.take(row))
            winner = winner.take(np.lexsort((center.take(winner), row.take(winner))))  # the lowest number on ties
            winner = winner.take(np.append(True, np.diff(row.take(winner)) > 0).nonzero()[0])
            rival[some] = center.take(winner)
            d[winner] = np.inf
            second[some] = np.minimum.reduceat(d, first)
        bound = np.minimum(np.minimum(np.sqrt(second), (TOLD_APART - 1) * far), self._outside(own))
        won = ((least < best) | ((least == best) & (rival < own))).nonzero()[0]
        rival_far = np.sqrt(least)
        if len(won):
            lost, center, point = own.take(won), rival.take(won), at.take(won)
            rival[won], own[won], self.own[point] = lost, center, center
            rival_far[won], far[won] = far.take(won), rival_far.take(won)
            seen = _squares(places.lat.take(point), places.lon.take(point), self.seen[0].take(center), self.seen[1].take(center))
            np.maximum.at(self.radius, center, np.sqrt(seen))
            bound[won] = np.minimum(bound.take(won), self._outside(center))
            yield lost
            yield center
        self.rival[at] = rival
        self._settle(at, own, far, rival_far, bound)

    def _add_up(self, centers: np.ndarray) -> None:
        """The sums of these centres' members, always added in one order."""
        at, own, k = slice(None), self.own, len(self.lat)
        if len(centers) * 3 < k:
            flags = np.zeros(k, bool)
            flags[centers] = True
            at = flags.take(self.own).nonzero()[0]
            own = self.own.take(at)
        for total, line in zip(self.sums, self.places.lines):
            total[centers] = np.bincount(own, line[at], k)[centers]


def _whole_items(batches):
    """(item, lat, lon, w) over all blocks of each item, which follow each other."""
    held, parts = None, []
    for item, *part in _point_blocks(batches):
        if parts and item != held:
            yield held, *map(np.concatenate, zip(*parts))
            parts = []
        held = item
        parts.append(part)
    if parts:
        yield held, *map(np.concatenate, zip(*parts))


def _finished(group, k: int, restart: int, inertia: float, lat: np.ndarray, lon: np.ndarray, sums: np.ndarray) -> Model:
    """The model with ordered centres and the means of their members, from its centres and final sums."""
    means, filled = [lat.copy(), lon.copy()], sums[0] > 0
    for mean, line in zip(means, sums[1:3]):
        mean[filled] = line[filled] / sums[0][filled]
    order = np.lexsort((lon, lat))
    return Model(group, k, restart, inertia, *[x[order] for x in (lat, lon, sums[0].astype(np.int64), *means)])


@dataclass
class _Draws:
    """The locations drawn so far for one (group, restart)."""

    lat: list = field(default_factory=list)
    lon: list = field(default_factory=list)
    ended: bool = False  # no other location is left

    def extend(self, found: np.ndarray, beyond: float, depth: int) -> None:
        """Draw from rows (key, lat, lon, w, e) while the least key is not over ``beyond``, the least one left behind."""
        order = np.lexsort((found[:, 2], found[:, 1]))
        _, lat, lon, w, e = found[order].T
        near = np.ones(len(lat))
        if self.lat and len(lat):
            near = nearest(lat, lon, np.array(self.lat), np.array(self.lon))[1]
        while len(self.lat) < depth:
            if len(lat):
                with np.errstate(divide="ignore"):
                    key = e / (w * near)
                at = int(np.argmin(key))
            if not len(lat) or not np.isfinite(key[at]):
                self.ended = not np.isfinite(beyond)
                return
            if key[at] > beyond:
                return
            d = (lat - lat[at]) ** 2 + (lon - lon[at]) ** 2
            near = np.minimum(near, d) if self.lat else d
            self.lat.append(float(lat[at]))
            self.lon.append(float(lon[at]))
            if len(self.lat) == 1:
                return  # until now keys were without distances


def _merged(one: tuple | None, two: tuple) -> tuple:
    """(rows, places, mean latitude, mean longitude, sum of squared distances to the mean) of two parts together."""
    if one is None:
        return two
    n = one[0] + two[0]
    lat, lon = two[2] - one[2], two[3] - one[3]
    apart = one[4] + two[4] + (lat * lat + lon * lon) * one[0] * two[0] / n
    return n, one[1] + two[1], one[2] + lat * two[0] / n, one[3] + lon * two[0] / n, apart


class KeyedKMeans:
    """Fits k-means models per group over one samples frame.

    The distinct locations are kept on the executors between jobs; use as a context manager.
    """

    def __init__(
        self, samples: DataFrame, group_col: str = "country_id", settings: KMeansSettings | None = None,
    ):
        self.settings = settings or KMeansSettings()
        self.spark = samples.sparkSession
        rows = samples.select(F.col(group_col).alias("grp"), "latitude", "longitude")
        self.tasks = max(
            self.spark.sparkContext.defaultParallelism,
            int(self.spark.conf.get("spark.sql.shuffle.partitions")),
        )
        # Checkpointed, so that a lost executor costs a re-read and not the work behind the samples;
        # kept in memory on top of that for the iterations.
        self.blocks = cut_lineage(location_blocks(rows, self.tasks)).persist(StorageLevel.MEMORY_AND_DISK)
        self._draws: dict[tuple, _Draws] = defaultdict(_Draws)
        self._profiles: dict[object, GroupProfile] | None = None

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.blocks.unpersist()

    def profiles(self) -> dict[object, GroupProfile]:
        """Row count and mean coordinate variance of each group, merged from one row per group and task; found once."""
        if self._profiles is None:
            self._profiles = self._measured()
        return self._profiles

    def _measured(self) -> dict[object, GroupProfile]:
        kind = self.blocks.schema["grp"].dataType.simpleString()

        def moments(batches):
            held: dict = {}
            for group, lat, lon, w in _point_blocks(batches):
                n, m_lat, m_lon = w.sum(), np.average(lat, weights=w), np.average(lon, weights=w)
                apart = (w * ((lat - m_lat) ** 2 + (lon - m_lon) ** 2)).sum()
                held[group] = _merged(held.get(group), (n, float(len(w)), m_lat, m_lon, apart))
            if held:
                columns = [pa.array(list(held)), *(pa.array(c, pa.float64()) for c in zip(*held.values()))]
                yield pa.RecordBatch.from_arrays(columns, names=["grp", "n", "places", "m_lat", "m_lon", "apart"])

        found: dict = {}
        rows = self.blocks.mapInArrow(moments, f"grp {kind}, n double, places double, m_lat double, m_lon double, apart double")
        for group, *part in sorted(map(lambda r: tuple(r.values()), rows.toArrow().to_pylist())):
            found[group] = _merged(found.get(group), tuple(part))
        return {g: GroupProfile(int(n), int(places), float(apart) / n / 2) for g, (n, places, _, _, apart) in found.items()}

    def _seeds(self, depths: dict) -> dict:
        """Starting locations of each (group, restart): at least ``depths`` of them, if the group has as many."""
        while True:
            open_ = [
                (x, self._draws[x], depth) for x, depth in depths.items()
                if len(self._draws[x].lat) < depth and not self._draws[x].ended
            ]
            if not open_:
                return {x: (np.array(self._draws[x].lat), np.array(self._draws[x].lon)) for x in depths}
            by_group: dict = defaultdict(list)
            for number, ((group, restart), drawn, depth) in enumerate(open_):
                by_group[group].append((number, restart, np.array(drawn.lat), np.array(drawn.lon),
                                        min(DRAWN_KEYS, 2 * (depth - len(drawn.lat)) + 6) if drawn.lat else 1))
            for number, (found, beyond) in self._least_keys(dict(by_group)).items():
                _, drawn, depth = open_[number]
                drawn.extend(found, beyond, depth)

    def _least_keys(self, sequences: dict) -> dict:
        """Sequence -> (rows of key, lat, lon, w, e; the least key that may have been left behind)."""
        shared = self.spark.sparkContext.broadcast(sequences)

        seed = self.settings.seed

        def partial(batches):
            held: dict = {}
            more: dict = {}  # the least key that a task has let go
            for group, lat, lon, w in _point_blocks(batches):
                if group not in shared.value:
                    continue
                numbers = digits(lat, lon, seed)
                for number, restart, slat, slon, most in shared.value[group]:
                    e = exponentials(numbers, restart)
                    near = nearest(lat, lon, slat, slon)[1] if len(slat) else np.ones(len(lat))
                    with np.errstate(divide="ignore"):
                        key = e / (w * near)
                    use = np.flatnonzero(key < more.get(number, np.inf))
                    rows = np.column_stack([key, lat, lon, w, e])[use]
                    if number in held:
                        rows = np.concatenate([held[number], rows])
                    if len(rows) > most:
                        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
                        more[number] = rows[most, 0]
                    held[number] = rows[:most]
            for number, rows in held.items():
                end = np.array([[more.get(number, np.inf), np.nan, np.nan, np.nan, np.nan]])
                rows = np.concatenate([rows, end])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), number)), *map(pa.array, rows.T.copy())], names=["number", "key", "lat", "lon", "w", "e"]
                )

        rows = self.blocks.mapInArrow(partial, "number long, key double, lat double, lon double, w double, e double").toArrow().to_pandas()
        shared.destroy()
        out = {}
        for number, part in rows.groupby("number"):
            part = part[["key", "lat", "lon", "w", "e"]].to_numpy()
            ends = np.isnan(part[:, 1])
            out[int(number)] = (part[~ends], float(part[ends, 0].min()))
        return out

    def fit(self, specs: list[tuple[object, int]], profiles: dict[object, GroupProfile]) -> list[Model]:
        """Best model of every (group, k)."""
        best = self._best(specs, profiles, keep=True)
        return [best[spec][2] for spec in specs]

    def curve(self, specs: list[tuple[object, int]], profiles: dict[object, GroupProfile]) -> list[tuple]:
        """(group, k, inertia) of the best models; no centres are kept."""
        best = self._best(specs, profiles, keep=False)
        return [(g, k, best[g, k][0]) for g, k in specs]

    def _best(self, specs, profiles, keep: bool) -> dict:
        """(inertia, restart, model or None) of the first restart with the least inertia."""
        best: dict = {}
        for units in self._passes(specs, profiles, keep):
            near = [u for u in units if profiles[u[0]].locations <= self.settings.near_locations]
            far = [u for u in units if profiles[u[0]].locations > self.settings.near_locations]
            models = self._fit_near(near, profiles, keep) if near else []
            for model in models + (self._fit_pass(far, profiles) if far else []):
                old = best.get((model.group, model.k))
                if old is None or (model.inertia, model.restart) < old[:2]:
                    best[model.group, model.k] = (model.inertia, model.restart, model if keep else None)
        return best

    def _passes(self, specs, profiles, keep: bool):
        """Lists of (group, k, restart, centres) whose centres stay within the bound, or of one model.

        Models that tasks fit alone count as one where no centres are kept: then only their inertia comes back.
        """
        units, held = [], 0
        for group, k in specs:
            size = min(k, profiles[group].locations)
            weight = size if keep or profiles[group].locations > self.settings.near_locations else 1
            for restart in range(self.settings.restarts):
                if units and held + weight > self.settings.max_centers:
                    yield units
                    units, held = [], 0
                units.append((group, k, restart, size))
                held += weight
        if units:
            yield units

    def _fit_pass(self, units, profiles) -> list[Model]:
        depths: dict = defaultdict(int)
        for g, _, r, size in units:
            depths[g, r] = max(depths[g, r], size)
        seeds = self._seeds(depths)
        starts = [(seeds[g, r][0][:size], seeds[g, r][1][:size]) for g, _, r, size in units]
        batch = _Batch(
            groups=[g for g, *_ in units],
            ks=np.array([size for *_, size in units]),
            restarts=np.array([r for _, _, r, _ in units]),
            lat=np.round(np.concatenate([s[0] for s in starts]), DECIMALS),
            lon=np.round(np.concatenate([s[1] for s in starts]), DECIMALS),
        )
        limit = np.array([self.settings.tolerance * profiles[g].spread for g in batch.groups])
        sums = _scattered(batch, _settle(self.blocks, batch, limit, self.settings.max_iter, self.tasks))
        inertia = np.round(np.add.reduceat(sums[3], batch.starts), 6)
        models = []
        for m, (g, k, restart, size) in enumerate(units):
            cut = slice(batch.starts[m], batch.starts[m] + size)
            models.append(_finished(g, k, restart, float(inertia[m]), batch.lat[cut], batch.lon[cut], sums[:, cut]))
        return models

    def _dealt(self, units, profiles) -> tuple[list[tuple], list[list[int]], int]:
        """Rows (group, item, task), the units of each item, which share one copy of the group's locations, and the number of tasks."""
        by_group: dict = defaultdict(list)
        for number, (group, _, restart, size) in enumerate(units):
            by_group[group].append((restart, size, number))  # in this order a model goes on with the draws of the one before
        costs, items = {}, []
        for g, own in by_group.items():
            own.sort()
            places, size = profiles[g].locations, np.array([size for _, size, _ in own], float)
            costs[g] = (places + STEP_COST) * np.minimum(size + 8, FOLLOWED_CENTERS) / (1 + STEPS_SHRINK * size / places)
        tasks = 4 * self.spark.sparkContext.defaultParallelism
        share = sum(cost.sum() for cost in costs.values()) / tasks
        for g, own in by_group.items():
            pieces = min(len(own), max(1, round(costs[g].sum() / share)))
            piece = (np.cumsum(costs[g]) - costs[g] / 2) * pieces // costs[g].sum()
            items += [(costs[g][own_].sum(), g, [own[i][2] for i in own_]) for own_ in _slices(piece.astype(np.int64), pieces) if len(own_)]
        items.sort(key=lambda x: -x[0])
        tasks = min(tasks, len(items))
        rows, loads = [], [(0.0, task) for task in range(tasks)]
        for item, (size, group, _) in enumerate(items):
            load, task = heapq.heappop(loads)
            heapq.heappush(loads, (load + size, task))
            rows.append((group, item, task))
        return rows, [own for *_, own in items], tasks

    def _fit_near(self, units, profiles, keep: bool) -> list[Model]:
        """Best models of units whose groups fit a task, in one job; without ``keep`` they have no centres."""
        rows, items, tasks = self._dealt(units, profiles)
        kind = self.blocks.schema["grp"].dataType.simpleString()
        shared = self.spark.sparkContext.broadcast([
            [(number, *units[number][1:], self.settings.tolerance * profiles[units[number][0]].spread) for number in own]
            for own in items
        ])
        seed, max_iter = self.settings.seed, self.settings.max_iter

        def fitted(batches):
            for item, lat, lon, w in _whole_items(batches):
                places, best = _Places(lat, lon, w, seed), {}
                for number, k, restart, size, limit in shared.value[item]:
                    c_lat, c_lon, sums = places.settled(restart, size, limit, max_iter)
                    key = (float(np.round(sums[3].sum(), 6)), restart)
                    if k not in best or key < best[k][0]:
                        best[k] = (key, number, np.vstack([c_lat, c_lon, sums]).tobytes() if keep else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for _, n, _ in best.values()], pa.int64()), pa.array([x[0] for x, _, _ in best.values()], pa.float64()),
                     pa.array([body for *_, body in best.values()], pa.binary())], names=["unit", "inertia", "body"],
                )

        routes = self.spark.createDataFrame(rows, f"grp {kind}, item int, task int")
        found = (
            self.blocks.join(F.broadcast(routes), "grp").repartitionById(tasks, "task").sortWithinPartitions("item")
            .select("item", "lat", "lon", "w").mapInArrow(fitted, "unit long, inertia double, body binary").toArrow()
        )
        shared.destroy()
        models, none = [], np.zeros((6, 0)).tobytes()
        for row in found.to_pylist():
            g, k, restart, _ = units[row["unit"]]
            arrays = np.frombuffer(row["body"] or none).reshape(6, -1)
            models.append(_finished(g, k, restart, row["inertia"], arrays[0], arrays[1], arrays[2:]))
        return models


def label_column(spark: SparkSession, centers: dict, group, keep: dict | None = None) -> Column:
    """1-based number of the nearest centre of the row's group.

    ``centers`` maps a group to its (latitude, longitude) arrays. Null for groups without centres
    and, when ``keep`` is given, for centres whose flag there is false.
    """
    shared = spark.sparkContext.broadcast((centers, keep or {}))

    @F.pandas_udf("long")
    def label(grp: pd.Series, lat: pd.Series, lon: pd.Series) -> pd.Series:
        held, flags = shared.value
        out = np.zeros(len(grp), dtype=np.int64)  # 0: none
        usable = (lat.notna() & lon.notna()).to_numpy()
        y, x = lat.to_numpy(), lon.to_numpy()
        codes, values = pd.factorize(grp)
        for value, rows in zip(values, _slices(codes, len(values))):
            rows = rows[usable[rows]]
            if value not in held or not len(rows):
                continue
            j, _ = nearest(y[rows], x[rows], *held[value])
            out[rows] = np.where(flags[value][j], j + 1, 0) if value in flags else j + 1
        return pd.Series(pd.array(out, dtype="Int64")).mask(out == 0)

    return label(F.col(group) if isinstance(group, str) else group, F.col("latitude"), F.col("longitude"))


def model_labels(
    spark: SparkSession, models: list[Model], group="country_id", min_rows: int = 0
) -> Column:
    """Cluster numbers under fitted models; null for members of clusters below ``min_rows``."""
    return label_column(
        spark,
        {m.group: (m.latitude, m.longitude) for m in models},
        group,
        {m.group: m.rows >= min_rows for m in models},
    )


def clusters_frame(spark: SparkSession, models: list[Model], min_rows: int = 0) -> DataFrame:
    """One row per cluster; the centre is the mean of its members.

    Bounded by the centres of the fit. Clusters below ``min_rows`` are left out, and the numbers
    keep their gaps.
    """
    rows = [
        (m.group, j + 1, float(m.mean_latitude[j]), float(m.mean_longitude[j]), int(m.rows[j]))
        for m in models
        for j in range(len(m.rows))
        if m.rows[j] >= min_rows
    ]
    return spark.createDataFrame(
        rows,
        "country_id long, cluster_number long, center_latitude double, center_longitude double, "
        "sample_count long",
    )


def grouped_kmeans(
    samples: DataFrame, specs: list[tuple[object, int]], settings: KMeansSettings | None = None,
    group_col: str = "country_id",
) -> tuple[list[Model], DataFrame]:
    """Fit the given (group, k) pairs; returns the models and the labelled rows of those groups."""
    with KeyedKMeans(samples, group_col, settings=settings) as engine:
        profiles = engine.profiles()
        usable = [(g, k) for g, k in specs if g in profiles and 1 <= k <= profiles[g].n]
        models = engine.fit(usable, profiles)
    label = model_labels(samples.sparkSession, models, group_col)
    labelled = samples.withColumn("cluster_number", once(label))
    return models, labelled.where("cluster_number is not null")


def kmeans_assign(locations: DataFrame, centers: DataFrame, group_col: str = "country_id") -> DataFrame:
    """One assignment step against given centres (group, cluster_number, center_latitude, center_longitude).

    Centres are looked at in passes of bounded size; the nearest of all passes wins, and of equally near ones the
    smallest number. Null without coordinates or without centres of the group.
    """
    held = centers.select(group_col, "cluster_number", "center_latitude", "center_longitude")
    best = F.lit(None).cast("struct<d:double,number:bigint>")
    for part in _center_passes(held, group_col):
        found = _nearest_column(locations.sparkSession, part, group_col)
        best = F.least(best, found)  # least skips nulls
    return locations.withColumn("_best", once(best)).withColumn("cluster_number", F.col("_best.number")).drop("_best")


def _center_passes(centers: DataFrame, group_col: str):
    """Group -> (numbers, latitudes, longitudes), at most STEP_CENTERS centres at a time."""
    rows = []
    for row in centers.toLocalIterator():
        rows.append(tuple(row))
        if len(rows) == STEP_CENTERS:
            yield _by_group(rows)
            rows = []
    if rows:
        yield _by_group(rows)


def _by_group(rows: list[tuple]) -> dict:
    out: dict = defaultdict(list)
    for group, *center in rows:
        out[group].append(center)
    return {g: tuple(np.array(c) for c in zip(*sorted(v))) for g, v in out.items()}


def _nearest_column(spark: SparkSession, centers: dict, group_col: str) -> Column:
    shared = spark.sparkContext.broadcast(centers)

    @F.pandas_udf("d double, number long")
    def found(grp: pd.Series, lat: pd.Series, lon: pd.Series) -> pd.DataFrame:
        d, number = np.full(len(grp), np.inf), np.zeros(len(grp), dtype=np.int64)
        usable = (lat.notna() & lon.notna()).to_numpy()
        y, x = lat.to_numpy(), lon.to_numpy()
        codes, values = pd.factorize(grp)
        for value, rows in zip(values, _slices(codes, len(values))):
            rows = rows[usable[rows]]
            if value in shared.value and len(rows):
                numbers, clat, clon = shared.value[value]
                j, d[rows] = nearest(y[rows], x[rows], clat, clon)
                number[rows] = numbers[j]
        return pd.DataFrame({"d": d, "number": number})

    struct = found(F.col(group_col), F.col("latitude"), F.col("longitude"))
    return F.transform(F.array(struct), lambda s: F.when(~s.d.isin(float("inf")), s))[0]


def kmeans_update(labelled: DataFrame, group_col: str = "country_id") -> DataFrame:
    """One centroid step: mean of the members of each centre."""
    return labelled.where("cluster_number is not null").groupBy(group_col, "cluster_number").agg(
        F.avg("latitude").alias("center_latitude"),
        F.avg("longitude").alias("center_longitude"),
        F.count(F.lit(1)).alias("sample_count"),
    )
