"""Tables of parcel data derived from the given tables, by arithmetic only.

The SQL is valid in Spark and DuckDB, so both build identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Rows of a large table in one task.
ROWS = 250_000

SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_tiles": (("part",), """
        select concat('T', lpad(cast(p_partkey as string), 5, '0')) as tile_id,
               (p_partkey % 10) * 1.0e0 as minx, 40 + floor(p_partkey / 10) * 1.0e0 as miny,
               (p_partkey % 10) * 1.0e0 + 1.1e0 as maxx, 40 + floor(p_partkey / 10) * 1.0e0 + 1.1e0 as maxy
        from {part}"""),
    "fx_aoi": (("customer",), """
        select c_custkey as aoi_id, (c_custkey * 37 % 1000) / 100.0e0 as cx, 40 + (c_custkey * 53 % 1000) / 100.0e0 as cy,
               0.05e0 + (c_custkey % 7) * 0.03e0 as h,
               case when c_custkey % 50 = 49 then 'null' when c_custkey % 50 = 48 then 'empty' else 'polygon' end as kind
        from {customer}"""),
    "fx_scenes": (("orders",), """
        select o_orderkey as scene_id, concat('T', lpad(cast(o_custkey % 100 as string), 5, '0')) as tile_id,
               cast(o_orderdate as date) as acquired, (o_orderkey * 7919 % 1001) / 10.0e0 as cloud_cover
        from {orders}"""),
    "fx_obs": (("lineitem", "fx_scenes"), """
        select scene_id, tile_id, acquired, cloud_cover, px, py, min(b04) as b04, min(b03) as b03, min(b02) as b02, min(b08) as b08, min(ok) = 1 as valid
        from (select s.scene_id, s.tile_id, s.acquired, s.cloud_cover,
                     l_partkey % 8 as px, cast(floor(l_suppkey / 8) as bigint) % 8 as py,
                     200 + cast(floor(l_extendedprice) as bigint) % 2800 as b04, 200 + (l_partkey * 13 + l_orderkey) % 2800 as b03,
                     200 + (l_suppkey * 17 + l_orderkey) % 2800 as b02, 1000 + (l_partkey * 31 + l_orderkey * 7) % 4000 as b08,
                     case when l_discount < 0.085e0 then 1 else 0 end as ok
              from {lineitem} join {fx_scenes} s on l_orderkey = s.scene_id) o
        group by scene_id, tile_id, acquired, cloud_cover, px, py"""),
    "fx_lclu": (("events",), """
        select event_id as obs_id, concat('T', lpad(cast(user_id % 10 as string), 5, '0')) as tile_id,
               event_id % 8 as px, cast(floor(event_id / 8) as bigint) % 8 as py, cast(ts as date) as acquired,
               (event_id * event_id + user_id) % 9 as label
        from {events}"""),
    "fx_fields": (("orders",), """
        select o_orderkey as field_id, concat('T', lpad(cast(o_custkey % 100 as string), 5, '0')) as tile_id,
               concat('/runs/r1/06_results/T', lpad(cast(o_custkey % 100 as string), 5, '0'), case when o_orderkey % 2 = 0 then '.simp.gpkg' else '.gpkg' end) as source,
               (o_orderkey * 17 % 10000) / 1000.0e0 as x0, 40 + (o_custkey * 29 % 10000) / 1000.0e0 as y0, 0.001e0 + (o_orderkey % 9) * 0.0005e0 as w
        from {orders}"""),
    "fx_shores": (("customer",), """
        select c_nationkey as nation, k, n, 1.0e0 + 2 * (c_nationkey % 5) + r * cos(2 * pi() * turn / n) as x, 41.0e0 + 2 * floor(c_nationkey / 5) + r * sin(2 * pi() * turn / n) as y
        from (select c_nationkey, k, n, r, case when c_nationkey % 3 = 1 and k % 5 = 2 and k < n then k + 1 when c_nationkey % 3 = 1 and k % 5 = 3 then k - 1 else k end as turn
              from (select c_nationkey, 0.5e0 + (c_custkey * 37 % 100) / 100.0e0 as r, row_number() over (partition by c_nationkey order by c_custkey) as k, count(*) over (partition by c_nationkey) as n from {customer}) a) b"""),
    "fx_steps": (("events",), """
        select event_id as seq, user_id as run_id, event_type as step, ts as started_at, value as duration_seconds,
               case when event_type = 'error' then 'failed' else 'completed' end as status
        from {events}"""),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, or the given table of that name."""
    if name not in SQL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs, sql = SQL[name]
    tables = {n: fixture(spark, sf_dir, n) for n in needs}
    if name == "fx_obs":
        tables["lineitem"] = spread(tables["lineitem"], "l_orderkey")
    return spark.sql(sql, **tables)


def spread(table: DataFrame, key: str) -> DataFrame:
    """A large table in tasks of at most about ``ROWS`` rows, so that a join and an aggregation by its key hold no more of a larger one."""
    parts = table.count() // ROWS + 1
    return table.repartition(parts, key) if parts > int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")) else table


def chips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as 8 x 8 chips laid out 20 across: (vec_id, px, py, grow, gcol, value)."""
    return fixture(spark, sf_dir, "embeddings").selectExpr("vec_id", "posexplode(embedding) as (i, v)").selectExpr(
        "vec_id", "cast(i % 8 as bigint) as px", "cast(floor(i / 8) as bigint) as py", "cast(floor(vec_id / 20) as bigint) * 8 + cast(floor(i / 8) as bigint) as grow", "(vec_id % 20) * 8 + i % 8 as gcol", "cast(v as double) as value"
    )


CHIPS_SQL = """
    fx_chips as (
      select vec_id, cast(i % 8 as bigint) as px, cast(floor(i / 8) as bigint) as py, cast(floor(vec_id / 20) as bigint) * 8 + cast(floor(i / 8) as bigint) as grow,
             (vec_id % 20) * 8 + i % 8 as gcol, cast(v as double) as value
      from (select vec_id, unnest(embedding) as v, generate_subscripts(embedding, 1) - 1 as i from embeddings) e)"""


def oracle(sql: str, *names: str) -> str:
    """DuckDB SQL with the named fixtures, and what they need, in front."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        if name == "fx_chips":
            parts[name] = CHIPS_SQL
        elif name in SQL and name not in parts:
            needs, text = SQL[name]
            for n in needs:
                add(n)
            parts[name] = f"{name} as ({text.format(**{n: n for n in needs})})"

    for n in names:
        add(n)
    return f"with {', '.join(parts.values())} {sql}" if parts else sql
