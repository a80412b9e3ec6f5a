"""The five-level manufacturing dimension and how missing levels are filled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.values import blank_to_null, first_nonblank
from cohortmill.operators.versions import first_by_key


def build_five_level(
    line_desc: DataFrame,
    prod_area: DataFrame,
    mfg_plant: DataFrame,
    factory_area: DataFrame,
    mfg_site: DataFrame,
) -> DataFrame:
    """line -> production area -> plant, and area's factory -> factory area -> site; distinct rows.

    Names a level cannot supply are ''. Write the result as a table: its size is then known to the
    planner, which broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    lines = line_desc.where(F.col("LINE_NAME") != "").select("LINE_NAME", "LINE_DESC", "PROD_AREA_ID")
    areas = prod_area.select("PROD_AREA_ID", "PROD_AREA_CODE", F.col("FACTORY").alias("area_factory"), "MFG_PLANT_ID")
    plants = mfg_plant.select("MFG_PLANT_ID", "MFG_PLANT_CODE", "MFG_PLANT_DESC", F.col("FACTORY").alias("plant_factory"))
    sites = factory_area.select(F.col("FACTORY").alias("area_factory"), "MFG_SITE")
    joined = (
        lines.join(areas, "PROD_AREA_ID", "left")
        .join(plants, "MFG_PLANT_ID", "left")
        .join(sites, "area_factory", "left")
        .join(mfg_site.select("MFG_SITE", "MFG_SITE_DESC"), "MFG_SITE", "left")
    )
    columns = {
        "line_name": "LINE_NAME", "line_desc": "LINE_DESC", "prod_area_code": "PROD_AREA_CODE",
        "factory_code": "MFG_PLANT_CODE", "factory_name": "MFG_PLANT_DESC",
        "plant_code": "plant_factory", "plant_name": "plant_factory",
        "region_code": "MFG_SITE", "region_name": "MFG_SITE_DESC",
    }
    return joined.select(
        *[F.coalesce(F.col(source), F.lit("")).alias(name) for name, source in columns.items()]
    ).distinct()


def one_row_per_line(five_level: DataFrame) -> DataFrame:
    """(plant, line) may belong to several factories: keep the smallest non-blank factory code."""
    best = F.min(F.struct(
        (F.col("factory_code") == "").alias("blank"), "factory_code", "region_code",
    ))
    return (
        five_level.groupBy("plant_code", "line_name").agg(best.alias("_best"))
        .select("plant_code", "line_name", "_best.factory_code", "_best.region_code")
    )


def region_of_plant(five_level: DataFrame) -> DataFrame:
    """The first region of each plant, for lines the master data does not know."""
    usable = five_level.where((F.col("plant_code") != "") & (F.col("region_code") != ""))
    return first_by_key(usable.select("plant_code", "region_code"), ["plant_code"], ["region_code"])


def resolve_levels(pivot: DataFrame, five_level: DataFrame) -> DataFrame:
    """Add region, plant, factory and line: variable, then exact master row, then plant's region, then ''.

    Works on process rows, of which there are far fewer than tasks.
    """
    exact = one_row_per_line(five_level).select(
        F.col("plant_code").alias("mdm_plant"), F.col("line_name").alias("mdm_line"),
        F.col("factory_code").alias("mdm_factory"), F.col("region_code").alias("mdm_region"),
    )
    fallback = region_of_plant(five_level).select(
        F.col("plant_code").alias("fallback_plant"), F.col("region_code").alias("fallback_region")
    )
    line, plant = F.col("varinst_lineName"), F.col("varinst_plant")
    return (
        pivot
        .join(exact, (blank_to_null(line) == F.col("mdm_line")) & (blank_to_null(plant) == F.col("mdm_plant")), "left")
        .join(fallback, blank_to_null(plant) == F.col("fallback_plant"), "left")
        .select(
            *pivot.columns,
            first_nonblank(F.col("varinst_region"), F.col("mdm_region"), F.col("fallback_region")).alias("region"),
            first_nonblank(plant, F.col("mdm_plant")).alias("plant"),
            first_nonblank(F.col("varinst_factory"), F.col("mdm_factory")).alias("factory"),
            first_nonblank(line, F.col("mdm_line")).alias("line"),
        )
    )
