"""Queries of the format group (I): tables rendered in a format, parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import hl7_dtm
from tidemark.queries import query
from tidemark.sources import dicom, fhir, hl7, osdu, sap


def _s(c: str):
    return F.col(c).cast("string")


def _join(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def hl7_files(t):
    """One message per order: header, patient, a result line and a private segment; some
    orders arrive in a batch envelope with other line ends and other separators."""
    when = F.date_format("o_orderdate", "yyyyMMddHHmmss")
    body = _join(
        "MSH|^~\\&|SHOP^1.2^ISO|F|R|RF|", when, "||ORU^R01^ORU_R01|", _s("o_orderkey"), "|P|2.5\r",
        "PID|1||", _s("o_custkey"), "^^^SHOP&1.2.3&ISO^MR~", _s("o_custkey"), "x||Doe^J\\T\\J||", F.date_format("o_orderdate", "yyyyMM"), "|",
        F.col("o_orderstatus"), "\r",
        "ORC|RE|P", _s("o_orderkey"), "^NS\r", "OBX|1|NM|TOTAL^Total^L||", F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "~0|USD\r",
        "OBX|2|ST|PRIO^Priority||", F.col("o_orderpriority"), "\r", "ZOR|", _s("o_custkey"), "|", F.col("o_orderstatus"),
        "|" * 24 + "twenty-six||P", _s("o_orderkey"),
    )
    odd = F.translate(F.replace(body, F.lit("\r"), F.lit("\n")), "|^~&", "#*+%")
    batch = _join("FHS|^~\\&|X\r\nBHS|^~\\&\r\n", F.replace(body, F.lit("\r"), F.lit("\r\n")), "\r\nBTS|1\r\nFTS|1\r\n")
    text = F.when(F.col("o_orderstatus") == "O", odd).when(F.col("o_orderstatus") == "P", batch).otherwise(body)
    return t.orders.select(_join("file-", _s("o_orderkey")).alias("file"), text.alias("text"))


@query("i01_hl7_split_messages", "select 'file-' || o_orderkey as file, cast(o_orderkey as varchar) as message_id from orders")
def i01(t):
    m = hl7.split_messages(hl7_files(t), "text", ["file"])
    return m.select("file", F.regexp_extract("message", r"R01[|#](\d+)[|#]P", 1).alias("message_id"))


@query(
    "i02_hl7_segments",
    """select 'file-' || o_orderkey as file, unnest(['MSH', 'PID', 'ORC', 'OBX', 'OBX', 'ZOR']) as segment,
       unnest([1, 2, 3, 4, 5, 6]) as ordinal, cast(o_orderkey as varchar) as message_id from orders""",
)
def i02(t):
    rows = hl7.segments(hl7.split_messages(hl7_files(t), "text", ["file"]), "message", ["file"])
    return rows.select("file", "segment", "ordinal", "message_id")


@query(
    "i03_hl7_field",
    """select cast(o_orderkey as varchar) as message_id, cast(o_custkey as varchar) as id, 'SHOP' as authority, '1.2.3' as universal,
       o_custkey || 'x' as second, cast(null as varchar) as missing from orders""",
)
def i03(t):
    rows = hl7.segments(hl7.split_messages(hl7_files(t), "text", []), "message", [], "PID")
    second = hl7.repetitions(3)
    return rows.select(
        "message_id", hl7.component(3, 1).alias("id"), hl7.sub_component(3, 4, 1).alias("authority"), hl7.sub_component(3, 4, 2).alias("universal"),
        F.get(second, F.lit(1)).alias("second"), hl7.component(3, 9).alias("missing"),
    )


@query("i04_hl7_unescape", "select cast(o_orderkey as varchar) as message_id, case when o_orderstatus = 'O' then 'J%J' else 'J&J' end as given from orders")
def i04(t):
    rows = hl7.segments(hl7.split_messages(hl7_files(t), "text", []), "message", [], "PID")
    return rows.select("message_id", hl7.component(5, 2).alias("given"))


@query(
    "i05_hl7_table_pid",
    """select cast(o_orderkey as varchar) as message_id, cast(1 as bigint) as set_id, cast(o_custkey as varchar) as patient_id, 'MR' as type_code,
       cast(2 as bigint) as ids, 'Doe' as family, strftime(o_orderdate, '%Y-%m-01T00:00:00') as date_of_birth, o_orderstatus as sex from orders""",
)
def i05(t):
    rows = hl7.table(hl7_files(t), "text", "PID", "file")
    return rows.select(
        "message_id", "set_id", F.col("patient_id")[0]["id"].alias("patient_id"), F.col("patient_id")[0]["type_code"].alias("type_code"),
        F.size("patient_id").cast("bigint").alias("ids"), F.col("patient_names")[0]["family_name"].alias("family"), "date_of_birth",
        F.col("administrative_sex.code").alias("sex"),
    )


@query(
    "i05_hl7_table_obx",
    """select cast(o_orderkey as varchar) as message_id, cast(1 as bigint) as set_id, 'TOTAL' as code, cast(cast(o_totalprice as decimal(18,2)) as varchar) as value,
         cast(2 as bigint) as values_n, 'USD' as units from orders
       union all select cast(o_orderkey as varchar), 2, 'PRIO', o_orderpriority, 1, null from orders""",
)
def i05_obx(t):
    rows = hl7.table(hl7_files(t), "text", "OBX", "file")
    return rows.select(
        "message_id", "set_id", F.col("observation_id.code").alias("code"), F.col("observation_value")[0].alias("value"),
        F.size("observation_value").cast("bigint").alias("values_n"), F.col("units.code").alias("units"),
    )


@query(
    "i05_hl7_table_msh",
    """select cast(o_orderkey as varchar) as message_id, 'SHOP' as sending_application, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as message_datetime,
       'ORU' as message_code, 'R01' as trigger_event, case when o_orderstatus = 'O' then '#' else '|' end as field_separator from orders""",
)
def i05_msh(t):
    return hl7.table(hl7_files(t), "text", "MSH", "file").select(
        "message_id", "sending_application", "message_datetime", "message_code", "trigger_event", "field_separator"
    )


@query(
    "i06_hl7_generic",
    """select cast(o_orderkey as varchar) as message_id, 'ZOR' as segment_type, cast(o_custkey as varchar) as field_1, o_orderstatus as field_2, cast(null as varchar) as field_25,
       'twenty-six|-|P' || o_orderkey as more_fields from orders""",
)
def i06(t):
    return hl7.table(hl7_files(t), "text", "zor", "file").select("message_id", "segment_type", "field_1", "field_2", "field_25", F.array_join("more_fields", "|", "-").alias("more_fields"))


@query(
    "i07_hl7_base64",
    "select cast(o_orderkey as varchar) as message_id, cast(1 as bigint) as set_id, 'RE' as order_control, 'P' || o_orderkey as placer, '2024-01-01' as create_time from orders",
)
def i07(t):
    df = hl7_files(t).select("file", F.base64(F.encode("text", "UTF-8")).alias("data"), F.lit("2024-01-01").alias("sent"), F.lit("").alias("made"))
    out = hl7.table(df, "data", "ORC", "file", "sent", "made", base64=True)
    return out.select("message_id", "set_id", "order_control", F.col("placer_order_number.entity_identifier").alias("placer"), "create_time")


def patients(t):
    """One patient resource per customer."""
    ext = F.when(
        F.col("c_mktsegment") == "BUILDING",
        F.array(F.struct(F.lit("https://fhir.hl7.org.uk/StructureDefinition/Extension-UKCore-BirthSex").alias("url"),
                         F.struct(F.array(F.struct(F.lit("F").alias("code"))).alias("coding")).alias("valueCodeableConcept"))),
    )
    body = F.struct(
        F.lit("Patient").alias("resourceType"), _join("p", _s("c_custkey")).alias("id"), F.struct(F.lit("2024-01-02T03:04:05Z").alias("lastUpdated")).alias("meta"),
        F.array(F.struct(F.lit("https://fhir.nhs.uk/Id/nhs-number").alias("system"), _s("c_custkey").alias("value"))).alias("identifier"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.array(F.struct(F.col("c_name").alias("family"), F.array(F.lit("A"), F.lit("B")).alias("given"))).alias("name"),
        F.struct(F.array(F.struct(F.col("c_mktsegment").alias("code"))).alias("coding")).alias("maritalStatus"), ext.alias("extension"),
    )
    return t.customer.select(F.to_json(body).alias("resource"))


@query("i08_fhir_bundle", "select 'p' || c_custkey as id, 'Patient' as kind from customer union all select 'o' || c_custkey, 'Observation' from customer")
def i08(t):
    obs = _join('{"resource":{"resourceType":"Observation","id":"o', F.regexp_extract("resource", '"id":"p(\\d+)"', 1), '"}}')
    bundle = _join('{"resourceType":"Bundle","entry":[{"resource":', F.col("resource"), "},", obs, ',{"fullUrl":"x"}]}')
    out = fhir.bundle_to_resources(patients(t).select(bundle.alias("b")), "b")
    return out.select(F.get_json_object("resource", "$.id").alias("id"), F.get_json_object("resource", "$.resourceType").alias("kind"))


@query(
    "i09_fhir_resource",
    """select 'p' || c_custkey as id, timestamp '2024-01-02 03:04:05' as last_updated, c_acctbal > 0 as active, c_mktsegment as status,
       cast(c_custkey as varchar) as nhs_number, case when c_mktsegment = 'BUILDING' then 'F' end as birth_sex from customer""",
)
def i09(t):
    p = fhir.resource_table(patients(t), "resource", "Patient")
    return p.select(
        "id", F.col("lastUpdated").cast("timestamp_ntz").alias("last_updated"), "active", F.get(F.col("maritalStatus.coding"), F.lit(0))["code"].alias("status"),
        "nhs_number", F.get(F.col("birth_sex.coding"), F.lit(0))["code"].alias("birth_sex"),
    )


def observations(t):
    """One observation per event: the value's variant depends on the event type."""
    k = F.col("event_type")
    body = F.struct(
        F.lit("Observation").alias("resourceType"), _s("event_id").alias("id"), F.lit("final").alias("status"),
        F.struct(F.array(F.struct(F.lit("s").alias("system"), k.alias("code"))).alias("coding"), F.lit("t").alias("text")).alias("code"),
        F.struct(_join("Patient/", _s("user_id")).alias("reference")).alias("subject"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("effectiveDateTime"),
        F.when(k == "purchase", F.struct(F.col("value"), F.lit("USD").alias("unit"))).alias("valueQuantity"),
        F.when(k == "view", F.col("props")).alias("valueString"), F.when(k == "click", F.lit(True)).alias("valueBoolean"),
        F.when(k == "signup", F.col("user_id")).alias("valueInteger"),
        F.array(F.struct(F.struct(F.lit(1.5).alias("value")).alias("low"), F.struct(F.lit(9).alias("value"), F.lit("u").alias("unit")).alias("high"))).alias("referenceRange"),
    )
    return t.events.select(F.to_json(body).alias("resource"))


@query(
    "i10_fhir_observation",
    """select cast(event_id as varchar) as id, event_type as code, 'Patient/' || user_id as subject, ts as effective,
       case when event_type = 'purchase' then value end as quantity, case when event_type = 'view' then props end as text,
       case when event_type = 'click' then true end as flag, case when event_type = 'signup' then user_id end as whole, 9.0::double as high_value from events""",
)
def i10(t):
    o = fhir.resource_table(observations(t), "resource", "Observation")
    return o.select(
        "id", F.get(F.col("code.coding"), F.lit(0))["code"].alias("code"), F.col("subject.reference").alias("subject"),
        F.col("effective_datetime").cast("timestamp_ntz").alias("effective"), F.col("value_quantity.value").alias("quantity"),
        F.col("value_string").alias("text"), F.col("value_boolean").alias("flag"), F.col("value_integer").alias("whole"),
        F.get("reference_range", F.lit(0))["high_value"].alias("high_value"),
    )


@query(
    "i11_fhir_types",
    "select 'p' || c_custkey as id, c_name as family, 'A B' as given, cast(0 as bigint) as telecom, c_custkey || '' as identifier from customer",
)
def i11(t):
    p = fhir.resource_table(patients(t), "resource", "Patient", "base_r4")
    return p.select(
        "id", F.col("name")[0]["family"].alias("family"), F.array_join(F.col("name")[0]["given"], " ").alias("given"),
        F.size("telecom").cast("bigint").alias("telecom"), F.col("identifier")[0]["value"].alias("identifier"),
    )


def studies(t):
    d = F.date_format("o_orderdate", "yyyyMMdd")
    body = _join(
        '{"0020000D":{"vr":"UI","Value":["1.2.', _s("o_orderkey"), '"]},"00080020":{"vr":"DA","Value":["', d, '"]},"00100010":{"vr":"PN","Value":[{"Alphabetic":"C^',
        _s("o_custkey"), '"}]},"00080061":{"vr":"CS","Value":["CT","', F.col("o_orderstatus"), '"]},"0008103e":{"vr":"LO"},"00201206":{"vr":"IS","Value":[', _s("o_custkey"), "]}}",
    )
    return t.orders.select(body.alias("b"))


@query(
    "i12_dicom_json",
    """select '1.2.' || o_orderkey as study_instance_uid, strftime(o_orderdate, '%Y%m%d') as study_date, 'C^' || o_custkey as patient_name,
       'CT,' || o_orderstatus as modalities, o_custkey as series, cast(null as varchar) as accession_number from orders""",
)
def i12(t):
    s = dicom.dicom_rows(studies(t), "b", "studies")
    return s.select(
        "study_instance_uid", "study_date", "patient_name", F.array_join("modalities_in_study", ",").alias("modalities"),
        F.col("number_of_study_related_series").alias("series"), "accession_number",
    )


@query(
    "i13_dicom_date_filters",
    """select '1.2.' || o_orderkey as study_instance_uid, strftime(o_orderdate, '%Y%m%d') as study_date from orders
       where o_orderdate >= timestamp '1997-01-01' and o_orderdate <= timestamp '1997-06-30' and o_custkey > 0 and o_custkey = 7 or
       (o_orderdate >= timestamp '2001-01-01')""",
)
def i13(t):
    s = dicom.dicom_rows(studies(t), "b", "studies")
    some = dicom.date_filters(s, "study_date", "19970101-19970630", {"patient_name": "C^7"})
    return some.unionByName(dicom.date_filters(s, "study_date", "20010101-")).select("study_instance_uid", "study_date")


@query(
    "i14_osdu_records",
    """select 'r' || p_partkey as id, case when p_size > 25 then 'osdu:master-data--Wellbore:1' else 'osdu:master-data--Reservoir:1' end as kind, 't0' as modifyTime, 'a,b' as owners,
       case when p_size > 25 then p_name end as FacilityName, case when p_size <= 25 then p_retailprice end as DepthTopMD,
       case when p_size > 25 then '[{"x":1}]' end as GeoContexts_json, cast(p_size as bigint) as version from part""",
)
def i14(t):
    big = F.col("p_size") > 25
    data = F.struct(
        F.when(big, F.col("p_name")).alias("FacilityName"), F.when(~big, F.col("p_retailprice").cast("string")).alias("DepthTopMD"),
        F.when(big, F.array(F.struct(F.lit(1).alias("x")))).alias("GeoContexts"),
    )
    body = F.struct(
        _join("r", _s("p_partkey")).alias("id"), F.when(big, "osdu:master-data--Wellbore:1").otherwise("osdu:master-data--Reservoir:1").alias("kind"),
        _s("p_size").alias("version"), F.lit("t0").alias("createTime"), F.struct(F.array(F.lit("a"), F.lit("b")).alias("owners")).alias("acl"), data.alias("data"),
    )
    out = osdu.records(t.part.select(F.to_json(body).alias("b")), "b", ["Wellbore", "Reservoir"])
    return out.select("id", "kind", "modifyTime", F.array_join("acl_owners", ",").alias("owners"), "FacilityName", "DepthTopMD", "GeoContexts_json", "version")


@query(
    "i15_sap_records",
    """select o_orderkey as id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as startDate, o_orderstatus as status, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as nested_date,
       cast(null as varchar) as links from orders""",
)
def i15(t):
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    body = _join(
        '{"__metadata":{"uri":"u"},"id":', _s("o_orderkey"), ',"startDate":"/Date(', ms, ')/","links":{"__deferred":{"uri":"u"}},', '"nav":{"__metadata":{},' * 7, '"status":"',
        F.col("o_orderstatus"), '","on":"/Date(', ms, '+0000)/"' + "}" * 8,
    )
    out = sap.records(t.orders.select(body.alias("b")), "b", {"id": "bigint", "startDate": "string", "nav": "string", "links": "string"})
    nav = lambda n: F.get_json_object("nav", f"${'.nav' * 6}.{n}")
    return out.select("id", "startDate", nav("status").alias("status"), nav("on").alias("nested_date"), "links")


@query(
    "i17_hl7_dtm",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then strftime(o_orderdate, '%Y-01-01T00:00:00') when '2-HIGH' then strftime(o_orderdate, '%Y-%m-01T00:00:00')
       when '3-MEDIUM' then strftime(o_orderdate + interval 30 minute, '%Y-%m-%dT%H:%M:%S') when '5-LOW' then null else strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') end as iso from orders""",
)
def i17(t):
    d, p = F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1)
    text = (
        F.when(p == "1", F.date_format(d, "yyyy")).when(p == "2", F.date_format(d, "yyyyMM"))
        .when(p == "3", _join(F.date_format(d, "yyyyMMdd"), "000000.123-0030")).when(p == "5", F.lit("20240231")).otherwise(F.date_format(d, "yyyyMMdd"))
    )
    return t.orders.select("o_orderkey", hl7_dtm(text).alias("iso"))
