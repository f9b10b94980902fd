"""Operators on chunk tables: a row holds a block of pixels as arrays, in row order.

They do what the operators on pixel tables do, with NumPy on Arrow batches in place of a row per
pixel: composites from states that merge, clipping by outlines, and parcels in two levels.  All chunks
of a table have the same width and height; those at the right and lower edges are filled up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.operators import geometry as G
from tilth.operators.components import connected_components
from tilth.operators.composite import BANDS
from tilth.operators.outlines import edge_rows, relations
from tilth.scratch import materialize

CHUNK = ("tile_id", "cx", "cy")
CELL = 1 << 24
#: Numbers that the states of one task hold before they are passed on.
HELD = 1 << 22


def from_pixels(pixels: DataFrame, keys: Sequence[str], values: Sequence[str], w: int, h: int) -> DataFrame:
    """(keys, cx, cy, values as arrays) of a pixel table; pixels that are missing are null.

    A window numbers the pixels of each chunk, and tasks fill the arrays as its rows come by, some chunks at a time.
    """
    of, cells = [*keys, "cx", "cy"], w * h
    at = ((F.col("py") % h) * w + F.col("px") % w).cast("int")
    p = pixels.select(*keys, F.floor(F.col("px") / w).alias("cx"), F.floor(F.col("py") / h).alias("cy"), at.alias("_at"), *values)
    p = p.withColumn("_n", F.row_number().over(W.partitionBy(*of).orderBy("_at")))
    kinds = {f.name: f.dataType for f in p.schema}
    schema = T.StructType([*(T.StructField(c, kinds[c]) for c in of), *(T.StructField(v, T.ArrayType(kinds[v])) for v in values)])

    def filled(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        place, first = rows.column("_at").to_numpy(), np.flatnonzero(rows.column("_n").to_numpy() == 1)
        chunk = np.repeat(np.arange(len(first)), np.diff(first, append=len(rows)))
        same = chunk[1:] == chunk[:-1]
        if np.any(same & (place[1:] == place[:-1])):
            raise ValueError("a chunk has a pixel twice")
        step = max(1, HELD // cells)
        for lo in range(0, len(first), step):
            k, take = min(step, len(first) - lo), (chunk >= lo) & (chunk < lo + step)
            row = np.full(k * cells, -1)
            row[(chunk[take] - lo) * cells + place[take]] = np.flatnonzero(take)
            index, offsets = pa.array(row, mask=row < 0), pa.array(np.arange(0, k * cells + 1, cells, dtype=np.int32))
            heads = rows.select(of).take(pa.array(first[lo : lo + k]))
            lists = [pa.ListArray.from_arrays(offsets, rows.column(v).combine_chunks().take(index)) for v in values]
            yield pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in heads.columns), *lists], [*of, *values])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # what has come of the last chunk
        for batch in batches:
            starts = np.flatnonzero(batch.column("_n").to_numpy() == 1)
            if len(starts):
                held.append(batch.slice(0, starts[-1]))
                if sum(b.num_rows for b in held):
                    yield from filled(pa.Table.from_batches(held).combine_chunks())
                held, batch = [], batch.slice(starts[-1])
            held.append(batch)
        if sum(b.num_rows for b in held):
            yield from filled(pa.Table.from_batches(held).combine_chunks())

    return p.mapInArrow(fill, schema)


def to_pixels(chunks: DataFrame, keys: Sequence[str], values: Sequence[str], w: int, h: int) -> DataFrame:
    """(keys, px, py, values), nulls included."""
    p = chunks.select(*keys, "cx", "cy", F.posexplode(F.arrays_zip(*values)).alias("i", "v"))
    return p.select(*keys, (F.col("cx") * w + F.col("i") % w).cast("long").alias("px"), (F.col("cy") * h + F.floor(F.col("i") / w)).cast("long").alias("py"), *[F.col(f"v.{v}").alias(v) for v in values])


# -- composites


def _matrix(batch: pa.RecordBatch, name: str, cells: int) -> np.ndarray:
    """A list column as rows x cells; nulls are 0."""
    flat = batch.column(name).flatten()
    if len(flat) != batch.num_rows * cells:
        raise ValueError(f"chunks have {cells} cells; {name} has others")
    return flat.fill_null(False if pa.types.is_boolean(flat.type) else 0).to_numpy(zero_copy_only=False).reshape(-1, cells)


class MeanState:
    """Sums and counts of valid values."""

    columns = ("n", *BANDS)
    kind = np.float64

    @staticmethod
    def start(rows: pa.RecordBatch, valid: np.ndarray, bands: Sequence[np.ndarray]) -> np.ndarray:
        """The states of many rows, one after another."""
        return np.stack([valid, *(np.where(valid, b, 0) for b in bands)], axis=1).astype(np.float64)

    @staticmethod
    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a + b

    @staticmethod
    def fold(states: np.ndarray, first: np.ndarray) -> np.ndarray:
        """``merge`` of all states from each place in ``first`` to the next."""
        return np.add.reduceat(states, first)

    @staticmethod
    def finish(state: np.ndarray) -> list[np.ndarray]:
        with np.errstate(invalid="ignore"):
            return [s / state[0] for s in state[1:]]


class BestState:
    """The bands of the scene of the greatest score; ties go to the earlier date, then the smaller scene.

    Rows: score, date, scene, bands; a score of -inf is none.
    """

    columns = ("score", "day", "scene", *BANDS)
    kind = np.float64

    @classmethod
    def start(cls, rows: pa.RecordBatch, valid: np.ndarray, bands: Sequence[np.ndarray]) -> np.ndarray:
        out = np.empty((len(valid), len(cls.columns), valid.shape[1]))
        for i, v in enumerate((cls.score(rows, valid, bands), *(rows.column(c).to_numpy()[:, None] for c in ("day", "scene_id")), *bands)):
            out[:, i] = v
        return out

    @staticmethod
    def score(rows: pa.RecordBatch, valid: np.ndarray, bands: Sequence[np.ndarray]) -> np.ndarray:
        red, near = bands[0].astype(np.float64), bands[3].astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(valid & (near + red != 0), (near - red) / (near + red), -np.inf)

    @staticmethod
    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        better = (b[0] > a[0]) | (b[0] == a[0]) & ((b[1] < a[1]) | (b[1] == a[1]) & (b[2] < a[2]))
        return np.where(better, b, a)

    @staticmethod
    def fold(states: np.ndarray, first: np.ndarray) -> np.ndarray:
        of = np.repeat(np.arange(len(first)), np.diff(first, append=len(states)))
        wins = np.ones((len(states), states.shape[2]), bool)
        for row, best, worst in ((0, np.maximum, -np.inf), (1, np.minimum, np.inf), (2, np.minimum, np.inf)):
            v = np.where(wins, states[:, row], worst)
            wins &= v == best.reduceat(v, first)[of]
        place = np.minimum.reduceat(np.where(wins, np.arange(len(states))[:, None], len(states)), first)
        return np.take_along_axis(states, place[:, None, :], 0)

    @staticmethod
    def finish(state: np.ndarray) -> list[np.ndarray]:
        none = np.isneginf(state[0])
        return [np.where(none, np.nan, s) for s in (*state[3:], state[0], state[2])]


class FirstState(BestState):
    """The bands of the first valid scene by rank."""

    @staticmethod
    def score(rows: pa.RecordBatch, valid: np.ndarray, bands: Sequence[np.ndarray]) -> np.ndarray:
        return np.where(valid, -rows.column("rank").to_numpy().astype(np.float64)[:, None], -np.inf)


STATE = "cx long, cy long, state array<double>"
OUTPUT = {MeanState: BANDS, BestState: (*BANDS, "ndvi", "scene_id"), FirstState: (*BANDS, "rank", "scene_id")}


def _states(rows: Iterator[tuple[tuple, np.ndarray]], merge, whole: bool) -> Iterator[list[tuple[tuple, np.ndarray]]]:
    """Merged states by key.  ``whole`` means that rows come sorted by key, so one state is held; else as many as fit."""
    held: dict[tuple, np.ndarray] = {}
    size = 0
    for key, state in rows:
        if key in held:
            held[key] = merge(held[key], state)
            continue
        if held and (whole or size + state.size > HELD):
            yield list(held.items())
            held, size = {}, 0
        held[key] = state
        size += state.size
    if held:
        yield list(held.items())


def _folded(keys: pa.RecordBatch, states: np.ndarray, fold) -> Iterator[tuple[tuple, np.ndarray]]:
    """One state per key of a batch; keys that come sorted stay so."""
    codes = [keys.column(0).dictionary_encode("encode").indices.to_numpy(), keys.column(1).to_numpy(), keys.column(2).to_numpy()]
    order = np.lexsort(codes[::-1])
    first = np.flatnonzero(np.concatenate([[True], np.any([c[order][1:] != c[order][:-1] for c in codes], axis=0)]))
    plain = keys.take(pa.array(order[first]))
    yield from zip(zip(*(c.to_pylist() for c in plain.columns), strict=True), fold(states[order], first), strict=True)


def _lists(arrays: Sequence[np.ndarray]) -> pa.ListArray:
    """Rows of numbers as lists; NaN is null."""
    return pa.array([pa.array(a, from_pandas=True) for a in arrays], pa.list_(pa.float64()))


def composite(chunks: DataFrame, method: type, cells: int) -> DataFrame:
    """(tile_id, cx, cy, bands as arrays of doubles) by one of the states above; null where no scene is valid.

    ``chunks`` has tile_id, cx, cy, scene_id, acquired, the bands and ``valid`` as arrays, and ``rank`` for the
    first valid scene.  A task merges the scenes that it reads into one state per chunk, first those of a batch all at once, and what tasks pass on is merged
    chunk by chunk, so a stack of scenes is never held and a tile of many scenes is no large group.
    """
    key_type = chunks.schema["tile_id"].dataType.simpleString()
    schema, names = f"tile_id {key_type}, {STATE}", OUTPUT[method]
    has_rank = "rank" in chunks.columns
    slim = chunks.select("tile_id", F.col("cx").cast("long").alias("cx"), F.col("cy").cast("long").alias("cy"), "scene_id", F.unix_date("acquired").alias("day"), (F.col("rank") if has_rank else F.lit(0)).alias("rank"), "valid", *BANDS)

    step = max(1, HELD // 4 // (len(method.columns) * cells))

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from (batch.slice(at, step) for at in range(0, batch.num_rows, step))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
        for batch in sliced(batches):
            if np.any(np.abs(batch.column("scene_id").to_numpy()) > 1 << 53):
                raise ValueError("scene ids beyond 2^53 are not exact in a state")
            valid, bands = _matrix(batch, "valid", cells).astype(bool), [_matrix(batch, b, cells) for b in BANDS]
            yield from _folded(batch.select(CHUNK), method.start(batch, valid, bands), method.fold)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
        for batch in sliced(batches):
            yield from _folded(batch.select(CHUNK), batch.column("state").flatten().to_numpy().reshape(batch.num_rows, -1, cells), method.fold)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for items in _states(read(batches), method.merge, whole=False):
            keys = [pa.array(c) for c in zip(*(k for k, _ in items), strict=True)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array([s.ravel() for _, s in items], pa.list_(pa.float64()))], [*CHUNK, "state"])

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for items in _states(again(batches), method.merge, whole=True):
            keys = [pa.array(c) for c in zip(*(k for k, _ in items), strict=True)]
            done = [method.finish(s) for _, s in items]
            yield pa.RecordBatch.from_arrays([*keys, *(_lists([d[i] for d in done]) for i in range(len(names)))], [*CHUNK, *names])

    states = slim.mapInArrow(partial, schema).repartition(*CHUNK).sortWithinPartitions(*CHUNK)
    return states.mapInArrow(final, f"tile_id {key_type}, cx long, cy long, " + ", ".join(f"{n} array<double>" for n in names))


def quantile_composite(chunks: DataFrame, share: float, cells: int, strip: int = 64) -> DataFrame:
    """(tile_id, cx, cy, strip, bands as arrays): exact quantiles of valid values, interpolated.

    A quantile needs all scenes of a pixel, so chunks are cut into strips of ``strip`` cells: one task holds
    the scenes of one strip at once.  Strip k has the cells from k * ``strip`` on.
    """
    key_type = chunks.schema["tile_id"].dataType.simpleString()
    parts = F.sequence(F.lit(0), F.lit((cells - 1) // strip))
    cut = chunks.select(F.col("tile_id"), F.col("cx").cast("long").alias("cx"), F.col("cy").cast("long").alias("cy"), "valid", *BANDS, F.explode(parts).alias("strip"))
    cut = cut.select(*CHUNK, "strip", *[F.slice(c, F.col("strip") * strip + 1, F.lit(strip)).alias(c) for c in ("valid", *BANDS)])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        n = len(batch.column("valid")[0])
        valid = _matrix(batch, "valid", n).astype(bool)
        count = valid.sum(axis=0)
        place = share * np.maximum(count - 1, 0)
        low, high = np.floor(place).astype(int), np.ceil(place).astype(int)
        out = []
        for b in BANDS:
            v = np.sort(np.where(valid, _matrix(batch, b, n).astype(np.float64), np.inf), axis=0)
            at = lambda i: np.take_along_axis(v, i[None], 0)[0]  # noqa: B023, E731
            with np.errstate(invalid="ignore"):  # pixels that are never valid
                found = at(low) * (1 - (place - low)) + np.where(high > low, at(high) * (place - low), 0)
            out.append(np.where(count > 0, found, np.nan))
        return pa.table([*(pa.array([k.as_py()], k.type) for k in key), *(_lists([o]) for o in out)], names=[*CHUNK, "strip", *BANDS])

    return cut.groupBy(*CHUNK, "strip").applyInArrow(run, f"tile_id {key_type}, cx long, cy long, strip int, " + ", ".join(f"{b} array<double>" for b in BANDS))


# -- clipping


def clip_window(meta: DataFrame, aoi: DataFrame) -> DataFrame:
    """``meta`` with x0, x1, y0, y1, the AOI's window in whole pixels, and ``problem`` where there is none."""
    b = G.bounds(F.col("geom"))
    box = aoi.filter(G.nonempty(F.col("geom"))).select("raster_id", b.alias("b")).groupBy("raster_id").agg(*[f(f"b.{c}").alias(c) for f, c in ((F.min, "minx"), (F.min, "miny"), (F.max, "maxx"), (F.max, "maxy"))])
    w = meta.join(box, "raster_id", "left").withColumns({
        "x0": F.greatest(F.lit(0), F.floor((F.col("minx") - F.col("ox")) / F.col("rx"))).cast("long"),
        "x1": F.least("width", F.ceil((F.col("maxx") - F.col("ox")) / F.col("rx"))).cast("long"),
        "y0": F.greatest(F.lit(0), F.floor((F.col("oy") - F.col("maxy")) / F.col("ry"))).cast("long"),
        "y1": F.least("height", F.ceil((F.col("oy") - F.col("miny")) / F.col("ry"))).cast("long"),
    })
    problem = F.when(F.col("minx").isNull(), "no AOI").when((F.col("x1") <= F.col("x0")) | (F.col("y1") <= F.col("y0")), "the AOI does not overlap the raster")
    return w.withColumn("problem", problem).drop("minx", "miny", "maxx", "maxy")


def clipped_meta(meta: DataFrame, aoi: DataFrame) -> DataFrame:
    """The headers of the clipped rasters: origin moved, size cut, other columns kept; ``problem`` where nothing overlaps."""
    w = clip_window(meta, aoi)
    ok = F.col("problem").isNull()
    out = w.withColumns({"ox": F.when(ok, F.col("ox") + F.col("x0") * F.col("rx")), "oy": F.when(ok, F.col("oy") - F.col("y0") * F.col("ry")), "width": F.when(ok, F.col("x1") - F.col("x0")), "height": F.when(ok, F.col("y1") - F.col("y0"))})
    return out.select(*meta.columns, "problem")


def clip(chunks: DataFrame, meta: DataFrame, aoi: DataFrame, w: int, h: int) -> DataFrame:
    """(raster_id, band, cx, cy, x0, y0, values): chunks of the AOI's window; outside the AOI they are nodata.

    ``aoi`` has parts of any number per raster, which count as their union.  Chunks keep their place in the source;
    x0, y0 is the window's first pixel there.  A chunk that no outline crosses is passed as it is if it is
    inside, and with null ``values``, all nodata, if it is outside.  In the others, the row spans of the parts say which pixels stay.
    """
    win = clip_window(meta, aoi).filter("problem is null")
    span = lambda lo, hi, size: F.sequence(F.floor(F.col(lo) / size), F.floor((F.col(hi) - 1) / size))
    grid = win.withColumn("cx", F.explode(span("x0", "x1", w))).withColumn("cy", F.explode(span("y0", "y1", h)))
    centre = lambda i: F.col("ox") + (i + 0.5) * F.col("rx")
    row = lambda j: F.col("oy") - (j + 0.5) * F.col("ry")
    box = G.box(centre(F.col("cx") * w), row(F.col("cy") * h + (h - 1)), centre(F.col("cx") * w + (w - 1)), row(F.col("cy") * h))
    grid = materialize(grid.select("raster_id", "cx", "cy", "x0", "y0", "x1", "y1", F.coalesce("nodata", F.lit(0.0)).alias("nodata"), F.struct("raster_id", "cx", "cy").alias("chunk"), box.alias("geom")), "clip-grid")
    parts = aoi.filter(G.nonempty(F.col("geom"))).select("raster_id", F.posexplode("geom").alias("i", "poly"), F.monotonically_increasing_id().alias("row"))
    parts = materialize(parts.select("raster_id", F.struct("raster_id", "row", "i").alias("part"), F.array("poly").alias("geom")), "clip-parts")
    near = relations(grid.select("raster_id", "chunk", "geom"), parts, "chunk", "part", on=["raster_id"]).groupBy("chunk").agg(F.bool_or(~F.col("edge")).alias("inside"), F.bool_or("edge").alias("edge"))
    grid = materialize(grid.drop("geom").join(near, "chunk", "left").withColumn("kind", F.when(F.col("inside"), "inside").when(F.col("edge"), "edge").otherwise("outside")).drop("inside", "edge"), "clip-kinds")
    crossed = grid.filter("kind = 'edge'").select("raster_id", "cx", "cy")
    # a span goes to the chunks that it meets, and equal shares of a chunk's row are one before they are shuffled
    spans = _row_spans(parts, win).withColumns({"lo": F.floor(F.greatest("first", "x0") / w), "hi": F.floor((F.least("stop", "x1") - 1) / w)}).filter("lo <= hi")
    spans = spans.select("raster_id", F.floor(F.col("py") / h).alias("cy"), (F.col("py") % h).alias("y"), "first", "stop", F.explode(F.sequence("lo", "hi")).alias("cx"))
    spans = spans.select("raster_id", "cx", "cy", "y", F.greatest(F.col("first") - F.col("cx") * w, F.lit(0)).alias("a"), F.least(F.col("stop") - F.col("cx") * w, F.lit(w)).alias("b")).filter("a < b")
    spans = spans.distinct().join(crossed, ["raster_id", "cx", "cy"], "left_semi")
    spans = spans.groupBy("raster_id", "cx", "cy").agg(F.collect_list(F.struct("y", "a", "b")).alias("spans"))  # within one chunk
    grid = grid.join(spans, ["raster_id", "cx", "cy"], "left")
    c = chunks.select("raster_id", "band", F.col("cx").cast("long").alias("cx"), F.col("cy").cast("long").alias("cy"), F.col("values").cast("array<double>").alias("values"))
    hit = c.join(grid.select("raster_id", "cx", "cy", "x0", "y0", "kind", "nodata", "spans"), ["raster_id", "cx", "cy"])
    hit = hit.withColumn("values", F.when(F.col("kind") != "outside", F.col("values")))
    kind = chunks.schema["raster_id"].dataType.simpleString(), chunks.schema["band"].dataType.simpleString()

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["raster_id", "band", "cx", "cy", "x0", "y0"]
        for batch in batches:
            out = []
            for values, kind, nodata, spans in zip(batch.column("values"), *(batch.column(x).to_pylist() for x in ("kind", "nodata", "spans")), strict=True):
                if kind == "edge":
                    keep = np.zeros((h, w), bool)
                    for s in spans or ():
                        keep[s["y"], s["a"] : s["b"]] = True
                    own = values.values.to_numpy(zero_copy_only=False).reshape(h, w)
                    out.append(np.where(keep, own, nodata).ravel())
                else:
                    out.append(values.values.to_numpy(zero_copy_only=False) if kind == "inside" else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(out, pa.list_(pa.float64()))], [*names, "values"])

    return hit.mapInArrow(masked, f"raster_id {kind[0]}, band {kind[1]}, cx long, cy long, x0 long, y0 long, values array<double>")


def _row_spans(parts: DataFrame, win: DataFrame) -> DataFrame:
    """(raster_id, py, x0, x1, first, stop): pixels of a row whose centres are in a part, its outline included."""
    e = edge_rows(parts, ["raster_id", "part"]).join(win.select("raster_id", "ox", "oy", "rx", "ry", "x0", "x1", "y0", "y1"), "raster_id")
    top, low = F.ceil((F.col("oy") - F.col("maxy")) / F.col("ry") - 0.5), F.floor((F.col("oy") - F.col("miny")) / F.col("ry") - 0.5)
    e = e.withColumns({"first": F.greatest("y0", top), "last": F.least(F.col("y1") - 1, low)}).filter("first <= last")
    e = e.withColumn("py", F.explode(F.sequence("first", "last"))).withColumn("y", F.col("oy") - (F.col("py") + 0.5) * F.col("ry"))
    level = F.col("a.y") == F.col("b.y")
    x = (F.col("b.x") - F.col("a.x")) * F.coalesce(F.try_divide(F.col("y") - F.col("a.y"), F.col("b.y") - F.col("a.y")), F.lit(0.0)) + F.col("a.x")
    e = e.withColumn("x", x)
    crossed = e.filter((F.col("a.y") > F.col("y")) != (F.col("b.y") > F.col("y")))
    line = W.partitionBy("raster_id", "part", "py").orderBy("x")
    pairs = crossed.select("raster_id", "py", "x0", "x1", "ox", "rx", F.col("x").alias("low"), F.lead("x").over(line).alias("high"), F.row_number().over(line).alias("n")).filter("n % 2 = 1").drop("n")
    # ends of edges, and level edges, that lie on the line of centres
    on = e.filter((F.col("a.y") == F.col("y")) | (F.col("b.y") == F.col("y"))).select("raster_id", "py", "x0", "x1", "ox", "rx", F.when(level, F.col("minx")).otherwise(F.col("x")).alias("low"), F.when(level, F.col("maxx")).otherwise(F.col("x")).alias("high"))
    both = pairs.unionByName(on)
    first, last = F.ceil((F.col("low") - F.col("ox")) / F.col("rx") - 0.5), F.floor((F.col("high") - F.col("ox")) / F.col("rx") - 0.5)
    return both.select("raster_id", "py", "x0", "x1", first.alias("first"), (last + 1).alias("stop")).filter("first < stop")


# -- parcels


def _roots(labels: np.ndarray) -> np.ndarray:
    """Each cell's component among equal neighbours of a block: the flat place of its first cell; -1 where the label is below 0.

    Runs of each row are joined with the runs above that they meet.
    """
    h, w = labels.shape
    flat = labels.ravel()
    new = np.ones(h * w, bool)
    new[1:] = (flat[1:] != flat[:-1]) | (np.arange(1, h * w) % w == 0)
    starts = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    root = np.arange(len(starts))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    same = (flat[w:] == flat[:-w]) & (flat[w:] >= 0)
    for a, b in np.unique(np.stack([run[:-w][same], run[w:][same]], axis=1), axis=0).tolist():
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    for i in range(len(root)):  # parents come first
        root[i] = root[root[i]]
    return np.where(flat >= 0, starts[root[run]], -1).reshape(h, w)


def segments(chunks: DataFrame, w: int, h: int, label: str = "label") -> DataFrame:
    """(raster_id, cx, cy, label, parcel as arrays): 4-connected components of equal labels; null labels have none.

    Components within a chunk are found by union-find in its task.  Only those that meet an equal label across
    a chunk's border enter the components of the whole raster, so their number is bounded by the borders.
    ``parcel`` is py * 2^24 + px of the first pixel in row order, as for pixel tables.
    """
    kind = chunks.schema["raster_id"].dataType.simpleString()
    slim = chunks.select("raster_id", F.col("cx").cast("long").alias("cx"), F.col("cy").cast("long").alias("cy"), F.col(label).cast("array<int>").alias("label"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sides = [], []
            for cx, cy, own in zip(batch.column("cx").to_pylist(), batch.column("cy").to_pylist(), batch.column("label"), strict=True):
                block = own.values.fill_null(-1).to_numpy(zero_copy_only=False).reshape(h, w)
                at = _roots(block)
                name = np.where(at >= 0, (cy * h + at // w) * CELL + cx * w + at % w, -1)
                nodes.append(name.ravel())
                # what lies beyond a border is asked for by the pixel on this side
                edge = [(x, y) for x in {0, w - 1} for y in range(h)] + [(x, y) for y in {0, h - 1} for x in range(1, w - 1)]
                sides.append([{"px": cx * w + x, "py": cy * h + y, "label": int(block[y, x]), "node": int(name[y, x])} for x, y in edge if at[y, x] >= 0])
            side = pa.list_(pa.struct([("px", pa.int64()), ("py", pa.int64()), ("label", pa.int32()), ("node", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("raster_id", "cx", "cy", "label")), pa.array(nodes, pa.list_(pa.int64())), pa.array(sides, side)], ["raster_id", "cx", "cy", "label", "nodes", "sides"])

    found = materialize(slim.mapInArrow(local, f"raster_id {kind}, cx long, cy long, label array<int>, nodes array<long>, sides array<struct<px:bigint,py:bigint,label:int,node:bigint>>"), "chunk-nodes")
    links = border_links(found.select("raster_id", F.explode("sides").alias("s")).select("raster_id", "s.*"), w, h)
    # nodes of all rasters are numbered once
    ends = links.select("raster_id", F.explode(F.array("node", "other")).alias("node")).distinct()
    ends = materialize(ends.withColumn("id", F.monotonically_increasing_id()), "chunk-ends")
    other = ends.withColumnsRenamed({"node": "other", "id": "other_id"})
    comp = connected_components(links.join(ends, ["raster_id", "node"]).join(other, ["raster_id", "other"]), "id", "other_id")
    named = ends.join(comp.withColumnRenamed("node", "id"), "id")
    first = named.groupBy("component").agg(F.min("node").alias("parcel"))
    named = named.join(first, "component").select("raster_id", "node", "parcel").filter("node <> parcel")
    x, y = F.col("node") % CELL, F.floor(F.col("node") / CELL)
    per = named.groupBy("raster_id", F.floor(x / w).alias("cx"), F.floor(y / h).alias("cy")).agg(F.collect_list(F.struct("node", "parcel")).alias("names"))  # of one chunk

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, names in zip(batch.column("nodes"), batch.column("names").to_pylist(), strict=True):
                own = own.values.to_numpy().copy()
                if names:
                    old = np.array([n["node"] for n in names])
                    order = np.argsort(old)
                    at = np.minimum(np.searchsorted(old[order], own), len(old) - 1)
                    hit = old[order][at] == own
                    own[hit] = np.array([n["parcel"] for n in names])[order][at[hit]]
                out.append(pa.array(own, mask=own < 0))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("raster_id", "cx", "cy", "label")), pa.array(out, pa.list_(pa.int64()))], ["raster_id", "cx", "cy", "label", "parcel"])

    out = found.drop("sides").join(per, ["raster_id", "cx", "cy"], "left")
    return out.mapInArrow(renamed, f"raster_id {kind}, cx long, cy long, label array<int>, parcel array<long>")


def border_links(sides: DataFrame, w: int, h: int) -> DataFrame:
    """Distinct (raster_id, node, other) of equal labels on both sides of a chunk's right or lower border."""
    right = F.when(F.col("px") % w == w - 1, F.struct((F.col("px") + 1).alias("px"), F.col("py").alias("py")))
    below = F.when(F.col("py") % h == h - 1, F.struct(F.col("px").alias("px"), (F.col("py") + 1).alias("py")))
    asks = sides.select("raster_id", "label", F.col("node"), F.explode(F.array_compact(F.array(right, below))).alias("to")).select("raster_id", "label", "node", "to.*")
    return asks.join(sides.withColumnRenamed("node", "other"), ["raster_id", "label", "px", "py"]).select("raster_id", "node", "other").distinct()

