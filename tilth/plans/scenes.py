"""Queries on scenes, composites and land cover."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.operators import chunks as K
from tilth.operators import composite as C
from tilth.operators import landcover as L
from tilth.plans.fixtures import fixture, oracle
from tilth.plans.registry import query

START, END = date(1996, 1, 1), date(1999, 1, 1)
PERIOD = "acquired >= date '1996-01-01' and acquired < date '1999-01-01'"
RANKS = """ranks as (select tile_id, scene_id, acquired, n_valid, row_number() over (partition by tile_id order by n_valid desc, acquired, scene_id) as rank
    from (select tile_id, scene_id, acquired, sum(case when valid then 1 else 0 end) as n_valid from fx_obs group by tile_id, scene_id, acquired) s)"""


def ranked(sql: str) -> str:
    """An oracle on the observations and their scene ranks."""
    head, _, _ = oracle("@", "fx_obs").partition("@")
    return f"{head.rstrip()}, {RANKS} {sql}"


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_obs")


@query(oracle(f"select scene_id, cast(acquired as string) as acquired, cast(date '1999-01-01' - date '1996-01-01' as int) as days from fx_scenes where {PERIOD}", "fx_scenes"))
def scene_date_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.in_period(fixture(spark, sf_dir, "fx_scenes"), START, END)
    return out.select("scene_id", F.col("acquired").cast("string").alias("acquired"), F.datediff(F.lit(END), F.lit(START)).alias("days"))


@query(oracle("select scene_id, cloud_cover from fx_scenes where cloud_cover < 100", "fx_scenes"))
def scene_cloud_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clear_enough(fixture(spark, sf_dir, "fx_scenes"), 100).select("scene_id", "cloud_cover")


@query(ranked("select tile_id, scene_id, cast(n_valid as bigint) as n_valid, rank from ranks"))
def scene_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.rank_scenes(obs(spark, sf_dir)).select("tile_id", "scene_id", "n_valid", "rank")


_NDVI = "case when b08 + b04 = 0 then null else cast(b08 - b04 as double) / cast(b08 + b04 as double) end"


@query(oracle(f"select tile_id, px, py, b04, b03, b02, b08, ndvi, scene_id from (select *, row_number() over (partition by tile_id, px, py order by ndvi desc nulls last, acquired, scene_id) as n from (select *, {_NDVI} as ndvi from fx_obs where valid and {PERIOD} and cloud_cover < 60) v) r where n = 1", "fx_obs"))
def composite_max_ndvi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.max_ndvi(C.clear_enough(C.in_period(obs(spark, sf_dir), START, END), 60))


@query(oracle("select tile_id, px, py, round(avg(b04), 6) as b04, round(avg(b03), 6) as b03, round(avg(b02), 6) as b02, round(avg(b08), 6) as b08 from fx_obs where valid group by tile_id, px, py", "fx_obs"))
def composite_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.mean(obs(spark, sf_dir)).select(*C.PIXEL, *[F.round(b, 6).alias(b) for b in C.BANDS])


@query(oracle("select tile_id, px, py, median(b04) as b04, median(b03) as b03, median(b02) as b02, median(b08) as b08 from fx_obs where valid group by tile_id, px, py", "fx_obs"))
def composite_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.median(obs(spark, sf_dir))


@query(oracle("select tile_id, px, py, round(quantile_cont(b04, 0.2), 6) as b04, round(quantile_cont(b03, 0.2), 6) as b03, round(quantile_cont(b02, 0.2), 6) as b02, round(quantile_cont(b08, 0.2), 6) as b08 from fx_obs where valid group by tile_id, px, py", "fx_obs"))
def composite_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.percentile(obs(spark, sf_dir), 20).select(*C.PIXEL, *[F.round(b, 6).alias(b) for b in C.BANDS])


@query(ranked("select tile_id, px, py, b04, b03, b02, b08, scene_id from (select o.*, row_number() over (partition by o.tile_id, px, py order by rank) as n from fx_obs o join ranks using (tile_id, scene_id) where valid) f where n = 1"))
def composite_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = obs(spark, sf_dir)
    return C.first(o, C.rank_scenes(o))


@query(
    ranked(
        """, pix as (select tile_id, px, py, min(case when valid then rank end) as rank from fx_obs join ranks using (tile_id, scene_id) group by tile_id, px, py),
        tot as (select tile_id, count(*) as total from pix group by tile_id),
        steps as (select r.tile_id, r.rank, total, cast((select count(*) from pix p where p.tile_id = r.tile_id and p.rank <= r.rank) as bigint) as covered from ranks r join tot using (tile_id))
        select tile_id, rank, covered, total, not exists (select 1 from steps b where b.tile_id = s.tile_id and b.rank < s.rank and b.total - b.covered < 0.2 * b.total) as kept from steps s"""
    ).replace(") s) ,", ") s),")
)
def composite_coverage_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = obs(spark, sf_dir)
    return C.coverage_stop(o, C.rank_scenes(o), 0.2)


@query(oracle("select tile_id, px, py, coalesce(b04, 0) as b04, coalesce(b08, 0) as b08 from (select tile_id, px, py from (select distinct tile_id from fx_obs) t, (select unnest(range(8)) as px) x, (select unnest(range(8)) as py) y) g left join (select tile_id, px, py, median(b04) as b04, median(b08) as b08 from fx_obs where valid group by tile_id, px, py) c using (tile_id, px, py)", "fx_obs"))
def composite_fill_nodata(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = obs(spark, sf_dir)
    grid = o.select("tile_id").distinct().select("tile_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("px")).select("tile_id", "px", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("py"))
    return C.fill_nodata(C.median(o, ("b04", "b08")), grid, ("b04", "b08"))


@query(oracle("select tile_id, px, py, label from (select tile_id, px, py, label, row_number() over (partition by tile_id, px, py order by count(*) desc, label) as n from fx_lclu where acquired >= date '2024-01-05' and acquired < date '2024-01-25' group by tile_id, px, py, label) m where n = 1", "fx_lclu"))
def lclu_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.mode(C.in_period(fixture(spark, sf_dir, "fx_lclu"), date(2024, 1, 5), date(2024, 1, 25)))


@query(oracle("select obs_id, cast(floor((x - 1.5) / 0.25) as bigint) as px, cast(floor((43.75 - y) / 0.25) as bigint) as py from (select obs_id, px * 0.5e0 + (obs_id % 4) * 0.125e0 as x, 40 + py * 0.5e0 as y from fx_lclu) p", "fx_lclu"))
def pixel_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir, "fx_lclu").selectExpr("obs_id", "px * 0.5e0 + (obs_id % 4) * 0.125e0 as x", "40 + py * 0.5e0 as y")
    px, py = L.snap(F.col("x"), F.col("y"), 1.5, 43.75, 0.25)
    return p.select("obs_id", px.alias("px"), py.alias("py"))


_NAMES = ", ".join(f"({i}, '{n}')" for i, n in enumerate(L.CLASSES))


@query(oracle(f"select l.label, class_name, n, round(n / total, 9) as share from (select label, count(*) as n from fx_lclu group by label) l join (values {_NAMES}) c(label, class_name) on l.label = c.label, (select count(*) as total from fx_lclu) t", "fx_lclu"))
def lclu_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.histogram(fixture(spark, sf_dir, "fx_lclu")).withColumn("share", F.round("share", 9))


_PIXEL_MODE = "select tile_id, px, py, label from (select tile_id, px, py, label, row_number() over (partition by tile_id, px, py order by count(*) desc, label) as n from fx_lclu group by tile_id, px, py, label) m where n = 1"


@query(oracle(f"select tile_id, px, py, label from ({_PIXEL_MODE}) p where label not in (0, 6, 7, 8)", "fx_lclu"))
def mask_clip_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.clip_pixels(L.mode(fixture(spark, sf_dir, "fx_lclu")))


@query(oracle("select tile_id, obs_id, label from fx_lclu where (tile_id, px) in (select (tile_id, px) from (select tile_id, px, label, row_number() over (partition by tile_id, px order by count(*) desc, label) as n from fx_lclu group by tile_id, px, label) m where n = 1 and label not in (0, 1, 2))", "fx_lclu"))
def mask_filter_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pixel column of a tile is a parcel here."""
    p = fixture(spark, sf_dir, "fx_lclu").withColumn("parcel", F.struct("tile_id", "px"))
    return L.filter_parcels(p, "parcel", (0, 1, 2)).select("tile_id", "obs_id", "label")


def chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations as chunks of 4 x 4 pixels."""
    return K.from_pixels(obs(spark, sf_dir), ["tile_id", "scene_id", "acquired"], [*C.BANDS, "valid"], 4, 4)


def unchunked(table: DataFrame, values: tuple[str, ...]) -> DataFrame:
    return K.to_pixels(table, ["tile_id"], values, 4, 4).filter(F.col(values[0]).isNotNull())


@query(oracle(f"select tile_id, px, py, b04, b03, b02, b08, ndvi, scene_id from (select *, row_number() over (partition by tile_id, px, py order by ndvi desc nulls last, acquired, scene_id) as n from (select *, {_NDVI} as ndvi from fx_obs where valid) v) r where n = 1 and ndvi is not null", "fx_obs"))
def composite_chunks_max_ndvi(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = unchunked(K.composite(chunked(spark, sf_dir), K.BestState, 16), K.OUTPUT[K.BestState])
    return out.select(*C.PIXEL, *[F.col(c).cast("long").alias(c) for c in (*C.BANDS, "scene_id")], "ndvi")


@query(oracle("select tile_id, px, py, round(avg(b04), 6) as b04, round(avg(b03), 6) as b03, round(avg(b02), 6) as b02, round(avg(b08), 6) as b08 from fx_obs where valid group by tile_id, px, py", "fx_obs"))
def composite_chunks_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unchunked(K.composite(chunked(spark, sf_dir), K.MeanState, 16), C.BANDS).select(*C.PIXEL, *[F.round(b, 6).alias(b) for b in C.BANDS])


@query(ranked("select tile_id, px, py, b04, b03, b02, b08, scene_id from (select o.*, row_number() over (partition by tile_id, px, py order by rank) as n from fx_obs o join ranks using (tile_id, scene_id) where valid) r where n = 1"))
def composite_chunks_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = C.rank_scenes(obs(spark, sf_dir)).select("tile_id", "scene_id", "rank")
    out = unchunked(K.composite(chunked(spark, sf_dir).join(ranks, ["tile_id", "scene_id"]), K.FirstState, 16), K.OUTPUT[K.FirstState])
    return out.select(*C.PIXEL, *[F.col(c).cast("long").alias(c) for c in (*C.BANDS, "scene_id")])


@query(oracle("select tile_id, px, py, round(quantile_cont(b04, 0.25), 6) as b04, round(quantile_cont(b03, 0.25), 6) as b03, round(quantile_cont(b02, 0.25), 6) as b02, round(quantile_cont(b08, 0.25), 6) as b08 from fx_obs where valid group by tile_id, px, py", "fx_obs"))
def composite_chunks_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25th percentile, in strips of two rows of a chunk."""
    out = K.quantile_composite(chunked(spark, sf_dir), 0.25, 16, strip=8)
    p = out.select("tile_id", "cx", "cy", "strip", F.posexplode(F.arrays_zip(*C.BANDS)).alias("i", "v"))
    i = F.col("strip") * 8 + F.col("i")
    p = p.select("tile_id", (F.col("cx") * 4 + i % 4).alias("px"), (F.col("cy") * 4 + F.floor(i / 4)).alias("py"), "v.*").filter("b04 is not null")
    return p.select(*C.PIXEL, *[F.round(b, 6).alias(b) for b in C.BANDS])
