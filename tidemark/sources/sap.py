"""Enterprise OData records: metadata stripped, nested entities cleaned, dates in ISO."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import ms_date_to_iso
from tidemark.functions.shape import json_depth, strip_meta_keys


def clean(body: Column, depth: int) -> Column:
    """JSON text without metadata, with every ``/Date(ms)/`` text as ISO text."""
    text = strip_meta_keys(body, depth)
    # a date text has no quotes or backslashes, so it can be rewritten in place
    pieces = F.split(text, r'(?="\\?/Date\()|(?<=\)\\?/")')
    iso = F.transform(
        pieces,
        lambda p: F.when(
            p.rlike(r'^"\\?/Date\(-?\d+([+-]\d{4})?\)\\?/"$'),
            F.concat(F.lit('"'), ms_date_to_iso(F.regexp_replace(p, r'["\\]', "")), F.lit('"')),
        ).otherwise(p),
    )
    return F.when(F.contains(text, F.lit("/Date(")), F.array_join(iso, "")).otherwise(text)


def records(df: DataFrame, body: str, columns: dict[str, str], keep: list[str] = ()) -> DataFrame:
    """The cleaned records' fields as typed columns (name -> type)."""
    done = df.select(*keep, clean(F.col(body), json_depth(df, body)).alias("__c"))
    return done.select(*keep, *[F.get_json_object("__c", f"$['{n}']").try_cast(t).alias(n) for n, t in columns.items()])
