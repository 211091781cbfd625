"""Queries over the encoder registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import registry as rg
from tilewright.plans.catalog import register
from tilewright.plans.tables import table

_ROWS = ", ".join(f"('{e.code}', '{e.kind}', {e.px}, {'null' if e.mpp is None else e.mpp}::double, {'null' if e.needs is None else repr(e.needs)})" for e in rg.ENCODERS)
REGISTRY_SQL = f"registry as (select * from (values {_ROWS}) t(code, kind, px, mpp, needs))"
CODES_SQL = "codes as (select code, row_number() over (order by code) - 1 as k from registry)"


def coded(spark: SparkSession, rows: DataFrame, number: str, name: str) -> DataFrame:
    """``rows`` with the code whose place in the sorted registry is the column ``number``; -1 has none."""
    codes = F.array(*map(F.lit, sorted(rg.BY_CODE)))
    return rows.withColumn(name, F.get(codes, F.col(number).cast("int")))


@register("model_patch_sizes", f"with {REGISTRY_SQL} select code, px, mpp from registry")
def model_patch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommended tile size and resolution of every encoder."""
    return rg.encoders(spark).select("code", "px", "mpp")


@register(
    "tile_size_check",
    f"""with {REGISTRY_SQL}, {CODES_SQL}, sets as (select p_partkey, code, [224, 256, 512][(p_partkey % 3 + 1)::int] as tile_px, [0.25, 0.5, 0.51, 1.0, null][(p_partkey % 5 + 1)::int]::double as tile_mpp from part join codes on k = p_partkey % 40),
p as (select p_partkey, s.code, case when tile_px <> px then 'tiles are ' || tile_px || ' px, recommended ' || px || ' px' end as a, case when abs(tile_mpp - mpp) > 0.05 * mpp then 'tiles are at ' || printf('%g', tile_mpp) || ' µm/px, recommended ' || printf('%g', mpp) end as b from sets s join registry r on r.code = s.code)
select p_partkey, code, nullif(concat_ws('; ', a, b), '') as problem from p""",
)
def tile_size_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with a tile set for an encoder."""
    parts = coded(spark, table(spark, sf_dir, "part").withColumn("_k", F.col("p_partkey") % 40), "_k", "code").where("code is not null")
    px, mpp = F.get(F.array(F.lit(224), F.lit(256), F.lit(512)), (F.col("p_partkey") % 3).cast("int")), F.get(F.array(F.lit(0.25), F.lit(0.5), F.lit(0.51), F.lit(1.0), F.lit(None).cast("double")), (F.col("p_partkey") % 5).cast("int"))
    return rg.checked_tiles(parts.select("p_partkey", "code", px.alias("px"), mpp.alias("mpp")), rg.encoders(spark)).select("p_partkey", "code", "problem")


@register(
    "encoder_compatibility",
    f"""with {REGISTRY_SQL}, {CODES_SQL}, pairs as (select p_partkey, a.code as patch, b.code as slide from part join codes a on a.k = p_partkey % 37 join codes b on b.k = p_partkey // 5 % 37)
select p_partkey, patch, slide, case when slide = 'abmil_slide' then true when kind = 'slide' then patch = needs end as compatible from pairs join registry on code = slide""",
)
def encoder_compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a slide encoder takes a patch encoder's features."""
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_partkey % 37 as a", "p_partkey div 5 % 37 as b")
    pairs = coded(spark, coded(spark, parts, "a", "patch"), "b", "slide")
    return rg.compatible(pairs, rg.encoders(spark)).select("p_partkey", "patch", "slide", "compatible")


@register(
    "model_groups",
    f"with {REGISTRY_SQL}, {CODES_SQL}, m as (select distinct code from part join codes on k = p_partkey % 37 where p_partkey % 3 <> 0), e as (select code, px, mpp from m join registry using (code) union select needs, px, mpp from m join registry using (code) where needs is not null) select px, mpp, string_agg(code, ',' order by code) as models from e group by px, mpp",
)
def model_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoders that can share a tile set, with the patch encoders that slide encoders need."""
    parts = coded(spark, table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").selectExpr("p_partkey % 37 as k").distinct(), "k", "code")
    return rg.model_groups(parts.select("code"), rg.encoders(spark))


@register(
    "aggregation_resolution",
    f"with {REGISTRY_SQL} select code, m as method, case when kind = 'slide' and m = 'identity' then 'model' else m end as resolved, case when kind <> 'slide' or code = 'abmil_slide' then 'clip' else needs end as patch_encoder from registry cross join (select unnest(['identity', 'mean', 'max', 'model']) as m)",
)
def aggregation_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregation that a job runs and the patch encoder that it needs, for each encoder as its slide encoder."""
    rows = []
    for e in rg.ENCODERS:
        slide = e.code if e.kind == "slide" else None
        rows += [(e.code, m, rg.resolved_aggregation(m, slide), rg.resolved_patch_encoder("clip", slide)) for m in ("identity", "mean", "max", "model")]
    return spark.createDataFrame(rows, "code string, method string, resolved string, patch_encoder string")
