"""Subsurface data records: a common envelope and type-specific columns by kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shape import as_string_list, kind_dispatch, variant_text

# Columns per kind. ``_json`` columns hold JSON text, ``:num`` columns numbers.
WELLBORE = """
FacilityID FacilityName FacilityTypeID WellID KickOffWellboreID StatusSummary TargetFormation FacilityNameAliases_json
FacilityOperators_json VerticalMeasurements_json SpatialLocation_json GeoContexts_json DrillingReasons_json
InitialCompletion_json ExtensionProperties_json
"""
RESERVOIR = """
ReservoirID ReservoirName ReservoirType ReservoirDescription FieldID BasinID FormationID FluidTypeID DepthTopMD:num
DepthBaseMD:num DepthTopTVD:num DepthBaseTVD:num GrossThickness:num NetPayThickness:num PorosityAverage:num
WaterSaturationAverage:num PermeabilityHorizontal:num PermeabilityVertical:num InitialReservoirPressure:num
ReservoirTemperature:num GeoContexts_json NameAliases_json ExtensionProperties_json
"""
SAMPLE = """
SampleAcquisitionJobID=SampleAcquisition.SampleAcquisitionJobID SampleAcquisitionTypeID=SampleAcquisition.SampleAcquisitionTypeID
SampleAcquisitionContainerID=SampleAcquisition.SampleAcquisitionContainerID AcquisitionStartDate=SampleAcquisition.AcquisitionStartDate
AcquisitionEndDate=SampleAcquisition.AcquisitionEndDate CollectionServiceCompanyID=SampleAcquisition.CollectionServiceCompanyID
HandlingServiceCompanyID=SampleAcquisition.HandlingServiceCompanyID
WellboreID=SampleAcquisition.SampleAcquisitionDetail.WellboreID ToolKind=SampleAcquisition.SampleAcquisitionDetail.ToolKind
RunNumber=SampleAcquisition.SampleAcquisitionDetail.RunNumber TopDepth=SampleAcquisition.SampleAcquisitionDetail.TopDepth:num
BaseDepth=SampleAcquisition.SampleAcquisitionDetail.BaseDepth:num
FormationPressure=SampleAcquisition.SampleAcquisitionDetail.FormationCondition.Pressure:num
FormationTemperature=SampleAcquisition.SampleAcquisitionDetail.FormationCondition.Temperature:num
SampleAcquisition_json ExtensionProperties_json
"""
KINDS = {
    "Wellbore": ("master-data--Wellbore", WELLBORE),
    "Reservoir": ("master-data--Reservoir", RESERVOIR),
    "Rock_and_Fluid": ("master-data--Sample", SAMPLE),
}


def _data(path: str) -> Column:
    return F.try_variant_get("__data", "$." + path, "variant")


def _columns(text: str) -> dict[str, Column]:
    out = {}
    for word in text.split():
        word, _, kind = word.partition(":")
        name, _, path = word.partition("=")
        if name.endswith("_json"):
            v = _data(name[: -len("_json")])
            out[name] = F.when(~F.is_variant_null(v), F.to_json(v))
        elif kind == "num":
            out[name] = variant_text(_data(path or name)).try_cast("double")
        else:
            out[name] = variant_text(_data(path or name))
    return out


def records(df: DataFrame, body: str, tables: list[str] | None = None) -> DataFrame:
    """Envelope columns and the columns of the record's kind; modifyTime falls back to createTime."""
    v = df.select(F.try_parse_json(body).alias("__v"))
    v = v.select("__v", F.try_variant_get("__v", "$.data", "variant").alias("__data"), F.try_variant_get("__v", "$.kind", "string").alias("kind"))
    at = lambda p: F.try_variant_get("__v", "$." + p, "string")
    sub = lambda p: F.try_variant_get("__v", "$." + p, "variant")
    as_json = lambda p: F.when(~F.is_variant_null(sub(p)), F.to_json(sub(p)))
    envelope = {
        "id": at("id"), "kind": F.col("kind"), "version": at("version").try_cast("bigint"), "createTime": at("createTime"),
        "createUser": at("createUser"), "modifyTime": F.coalesce(F.nullif(at("modifyTime"), F.lit("")), at("createTime")),
        "modifyUser": at("modifyUser"), "acl_owners": as_string_list(sub("acl.owners")), "acl_viewers": as_string_list(sub("acl.viewers")),
        "legal_legaltags": as_string_list(sub("legal.legaltags")), "legal_status": at("legal.status"),
        "legal_otherRelevantDataCountries": as_string_list(sub("legal.otherRelevantDataCountries")), "tags_json": as_json("tags"),
        "meta_json": as_json("meta"), "data_json": F.coalesce(F.to_json("__data"), F.lit("{}")),
    }
    chosen = [KINDS[t] for t in (tables or KINDS)]
    return kind_dispatch(v, "kind", {part: _columns(text) for part, text in chosen}, envelope)
