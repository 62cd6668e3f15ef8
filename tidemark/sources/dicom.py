"""DICOM JSON (tag-keyed) as study, series and instance rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tag -> column per level, and how value representations are read.
LEVELS = {
    "studies": {
        "0020000D": "study_instance_uid", "00080020": "study_date", "00080030": "study_time", "00080050": "accession_number",
        "00100010": "patient_name", "00100020": "patient_id", "00081030": "study_description", "00080061": "modalities_in_study",
        "00201206": "number_of_study_related_series", "00201208": "number_of_study_related_instances",
    },
    "series": {
        "0020000E": "series_instance_uid", "0020000D": "study_instance_uid", "00080020": "study_date", "00200011": "series_number",
        "0008103E": "series_description", "00080060": "modality", "00180015": "body_part_examined", "00080021": "series_date",
    },
    "instances": {
        "00080018": "sop_instance_uid", "0020000E": "series_instance_uid", "0020000D": "study_instance_uid", "00080016": "sop_class_uid",
        "00200013": "instance_number", "00080020": "study_date", "00080023": "content_date", "00080033": "content_time",
    },
}
LISTS = ["modalities_in_study"]
INTEGER_COLUMNS = ["number_of_study_related_series", "number_of_study_related_instances", "series_number", "instance_number"]


def _tag(v: Column, tag: str) -> Column:
    """The tag object; tags may be in lower case."""
    return F.coalesce(
        F.try_variant_get(v, f'$["{tag}"]', "variant"), F.try_variant_get(v, f'$["{tag.lower()}"]', "variant")
    )


def _first(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _text(tag: Column) -> Column:
    """First value as text; a person name by its alphabetic, else ideographic, else phonetic form."""
    name = F.coalesce(*[F.nullif(_first(tag, f"$.Value[0].{p}"), F.lit("")) for p in ("Alphabetic", "Ideographic", "Phonetic")])
    is_name = _first(tag, "$.vr").eqNullSafe("PN") & F.schema_of_variant(F.try_variant_get(tag, "$.Value[0]", "variant")).startswith("OBJECT")
    return F.when(is_name, name).otherwise(_first(tag, "$.Value[0]"))


def dicom_rows(df: DataFrame, body: str, level: str, keep: list[str] = ()) -> DataFrame:
    """Named columns of a level: counts and numbers as integers, modalities as a list, the rest text.

    Instances also get ``dicom_file_path`` and ``metadata``, filled by a download elsewhere.
    """
    if level not in LEVELS:
        raise ValueError(f"unknown level {level}")
    tags = LEVELS[level]
    parsed = df.select(*keep, F.try_parse_json(body).alias("__v"))
    parsed = parsed.select(*keep, *[_tag(F.col("__v"), t).alias(f"__{n}") for t, n in tags.items()])
    cols = []
    for name in tags.values():
        tag = F.col(f"__{name}")
        if name in LISTS:
            value = F.try_variant_get(tag, "$.Value", "array<string>")
            value = F.when(F.size(value) > 0, value)
        elif name in INTEGER_COLUMNS:
            value = F.trim(_text(tag)).try_cast("bigint")
        else:
            value = _text(tag)
        cols.append(value.alias(name))
    extra = [F.lit(None).cast("string").alias(c) for c in ("dicom_file_path", "metadata")] if level == "instances" else []
    return parsed.select(*keep, *cols, *extra)


def parse_date_range(text: str) -> tuple[str | None, str | None]:
    """``YYYYMMDD-YYYYMMDD``, open on either side, or one day."""
    lo, dash, hi = text.partition("-")
    return (lo or None, hi or None) if dash else (lo or None, lo or None)


def date_filters(df: DataFrame, date_column: str, date_range: str | None = None, attributes: dict[str, str] | None = None) -> DataFrame:
    """Rows whose ``YYYYMMDD`` date is in the range (bounds included) and whose attributes match.

    The text order of such dates is their time order, so the scan can use the bounds.
    """
    if date_range:
        lo, hi = parse_date_range(date_range)
        if lo:
            df = df.filter(F.col(date_column) >= lo)
        if hi:
            df = df.filter(F.col(date_column) <= hi)
    for name, value in (attributes or {}).items():
        df = df.filter(F.col(name) == value)
    return df
