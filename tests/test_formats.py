"""Formats: every layout compiles and reads a small hand-written sample."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources import dicom, fhir, files, hl7, sap
from tidemark.sources.fhir_layouts import RESOURCES
from tidemark.sources.hl7_layouts import SEGMENTS

MESSAGES = (
    "FHS|^~\\&|X\r\nMSH|^~\\&|APP^1.2^ISO|FAC|R|RF|20240102030405+0100||ADT^A01^ADT_A01|M1|P|2.5\r\n"
    "PID|1||123^^^HOSP&1.2&ISO^MR~456^^^X||Doe^Jo\\T\\n^Q~Roe^J||19800101|M|||12 Main^^City^ST^12345\r\n"
    + "PV1||I^In|W1&a^2^B^FAC" + "|" * 16 + "V1" + "|" * 6 + "20240101~20240102" + "|" * 19 + "20240101~20240102\r\n"
    + "OBX|1|NM|8480-6^Sys^LN||120~130|mmHg\r\nOBX||TX|note||b\\T\\c\r\nORC|RE|P1^NS||||||A&ns^B\r\nORC|RF|P2\r\nNTE|0|L|a~b\r\n"
    "SPM|1|A&n^B|||||||||||||||20240101^2024010203\r\nZPD|x|y\r\n"
    "MSH#*+%@#APP*F2####20240101##ORU*R01#M2#P#2.3\rNTE|9\rNTE#2##a|b%S%c\rFTS|1\r"
)


@pytest.fixture(scope="module")
def hl7_df(spark):
    return spark.createDataFrame([("f1", MESSAGES), ("f2", "no header\rPID|1")], "f string, t string")


def _one(df):
    return df.collect()[0].asDict(recursive=True)


def test_every_segment_compiles(spark, hl7_df):
    counts = {"MSH": 2, "PID": 1, "PV1": 1, "OBX": 2, "ORC": 2, "NTE": 2, "SPM": 1}
    for name in SEGMENTS:
        df = hl7.table(hl7_df, "t", name, "f")
        assert df.columns[:7] == hl7.METADATA
        if name in counts:
            assert df.count() == counts[name], name
    assert len(SEGMENTS) == 23


def test_hl7_patient(hl7_df):
    r = _one(hl7.table(hl7_df, "t", "PID", "f"))
    assert r["message_id"] == "M1" and r["message_timestamp"] == "20240102030405+0100" and r["source_file"] == "f1"
    assert [p["id"] for p in r["patient_id"]] == ["123", "456"] and r["patient_id"][0]["assigning_authority_universal_id"] == "1.2"
    assert r["patient_names"][0]["given_name"] == "Jo\\T\\n" and r["patient_names"][1]["family_name"] == "Roe"
    assert r["date_of_birth"] == "1980-01-01T00:00:00" and r["administrative_sex"]["code"] == "M"
    assert r["drivers_license"] is None and r["race"] is None and r["address"][0]["zip"] == "12345"


def test_hl7_single_composites_and_dates(hl7_df):
    r = _one(hl7.table(hl7_df, "t", "PV1", "f"))
    assert r["patient_class"]["text"] == "In" and r["visit_number"]["id"] == "V1" and r["set_id"] is None
    loc = r["assigned_patient_location"]
    assert (loc["point_of_care"], loc["room"], loc["bed"], loc["facility"]) == ("W1", "2", "B", "FAC")
    assert r["contract_effective_date"] == ["2024-01-01T00:00:00", "2024-01-02T00:00:00"]
    m = hl7.table(hl7_df, "t", "MSH", "f").orderBy("message_id").collect()
    assert m[0]["message_datetime"] == "2024-01-02T02:04:05" and m[0]["sending_application_universal_id"] == "1.2"
    assert m[1]["field_separator"] == "#" and m[1]["encoding_characters"] == "*+%@" and m[1]["sending_application_universal_id"] == "F2"
    assert m[1]["message_code"] == "ORU" and m[1]["trigger_event"] == "R01"


def test_hl7_repeats_and_ordinals(hl7_df):
    obx = hl7.table(hl7_df, "t", "OBX", "f").collect()
    assert [(r["set_id"], r["observation_value"]) for r in obx] == [(1, ["120", "130"]), (1, ["b\\T\\c"])]
    orc = hl7.table(hl7_df, "t", "ORC", "f").collect()
    assert [(r["set_id"], r["placer_order_number"]["entity_identifier"]) for r in orc] == [(1, "P1"), (2, "P2")]
    assert orc[0]["parent_order"][0]["placer_assigned_identifier"]["namespace_id"] == "ns"
    assert orc[0]["parent_order"][0]["filler_assigned_identifier"]["entity_identifier"] == "B"
    nte = hl7.table(hl7_df, "t", "NTE", "f").orderBy("message_id").collect()
    assert nte[0]["set_id"] == 0 and nte[1]["set_id"] == 2 and nte[1]["raw_segment"] == "NTE#2##a|b%S%c" and nte[1]["comment"] == ["a|b%S%c"]
    spm = _one(hl7.table(hl7_df, "t", "SPM", "f"))
    assert spm["specimen_collection_datetime_start"] == "2024-01-01T00:00:00" and spm["specimen_collection_datetime_end"] == "2024-01-02T03:00:00"
    assert spm["specimen_id"]["placer_assigned_identifier"]["entity_identifier"] == "A"


def test_hl7_generic_and_columns(hl7_df):
    z = _one(hl7.table(hl7_df, "t", "ZPD", "f"))
    assert (z["segment_type"], z["field_1"], z["field_2"], z["field_25"]) == ("ZPD", "x", "y", None)
    some = hl7.table(hl7_df, "t", "PID", "f", columns=["date_of_birth"])
    assert some.columns == [*hl7.METADATA, "date_of_birth"]
    assert hl7.primary_keys("obx") == ["message_id", "set_id"] and hl7.primary_keys("pid") == ["message_id"]


def test_every_fhir_resource_compiles(spark):
    df = spark.createDataFrame([(json.dumps({"resourceType": n, "id": n.lower(), "meta": {"lastUpdated": "2024-01-01T00:00:00Z"}}),) for n in RESOURCES], "b string")
    for name in RESOURCES:
        r = _one(fhir.resource_table(df, "b", name))
        assert r["id"] == name.lower() and r["resourceType"] == name and r["extension"] == "null"
        lists = [v for v in r.values() if isinstance(v, list)]
        assert lists and all(v == [] for v in lists)
    assert len(RESOURCES) == 14
    assert fhir.resource_table(df, "b", "Unknown").columns == ["id", "resourceType", "lastUpdated", "raw_json", "extension"]


def test_fhir_nested_paths(spark):
    body = {
        "resourceType": "MedicationRequest", "id": "m", "dosageInstruction": [{"text": "t", "timing": {"code": {"coding": [{"code": "BID"}]}}, "doseAndRate": [{"doseQuantity": {"value": 2.5, "unit": "mg"}}]}],
        "dispenseRequest": {"numberOfRepeatsAllowed": 3, "quantity": {"value": 30}}, "substitution": {"allowedBoolean": True}, "medicationCodeableConcept": {"coding": [{"code": "x"}], "text": "y"},
    }
    r = _one(fhir.resource_table(spark.createDataFrame([(json.dumps(body),)], "b string"), "b", "MedicationRequest"))
    assert r["dosage_instruction"][0]["timing_code"] == "BID" and r["dosage_instruction"][0]["dose_value"] == 2.5
    assert r["dispense_request"]["number_of_repeats_allowed"] == 3 and r["dispense_request"]["quantity_value"] == 30.0
    assert r["substitution_allowed_boolean"] is True and r["medication_codeable_concept"]["coding"][0]["code"] == "x" and r["status_reason"] is None
    enc = {"resourceType": "Encounter", "class": {"code": "AMB"}, "hospitalization": {"admitSource": {"text": "s"}}}
    e = _one(fhir.resource_table(spark.createDataFrame([(json.dumps(enc),)], "b string"), "b", "Encounter"))
    assert e["class_coding"]["code"] == "AMB" and e["hospitalization"]["admit_source"]["text"] == "s" and e["period"] is None
    with pytest.raises(Exception, match="expected a Bundle"):
        fhir.bundle_to_resources(spark.createDataFrame([('{"resourceType":"Patient"}',)], "b string"), "b").collect()


def test_dicom_lower_case_tags_and_names(spark):
    body = {"0020000d": {"vr": "UI", "Value": ["1.2"]}, "00100010": {"vr": "PN", "Value": [{"Ideographic": "I"}]}, "00201208": {"vr": "IS", "Value": ["x"]}, "00080020": {"vr": "DA"}}
    r = _one(dicom.dicom_rows(spark.createDataFrame([(json.dumps(body),)], "b string"), "b", "studies"))
    assert (r["study_instance_uid"], r["patient_name"], r["number_of_study_related_instances"], r["study_date"], r["modalities_in_study"]) == ("1.2", "I", None, None, None)
    assert dicom.parse_date_range("2024-") == ("2024", None) and dicom.parse_date_range("20240101") == ("20240101", "20240101")


def test_sap_dates(spark):
    body = '{"__metadata":{},"d":"/Date(-1000)/","t":"see /Date(5)/ here","n":{"__deferred":{}}}'
    r = spark.createDataFrame([(body,)], "b string").select(sap.clean(F.col("b"), 1).alias("c")).first()["c"]
    assert json.loads(r) == {"d": "1969-12-31T23:59:59Z", "t": "see /Date(5)/ here"}


def test_json_files_are_unwrapped_and_bad_lines_counted(spark, folder):
    with open(f"{folder}/a.json", "w") as f:
        f.write('{"id":1}\n\n{"events":[{"id":2},{"id":3}]}\nbroken\n[{"id":4},5]\n{"items":[{"id":5}]}\n')
    rows, bad = files.read_ndjson(spark, f"{folder}/a.json")
    assert sorted(json.loads(r["record"])["id"] for r in rows.collect()) == [1, 2, 3, 4, 5]
    assert bad.first()["bad"] == 2
    with open(f"{folder}/b.json", "w") as f:
        f.write('[\n{"id":1},\n{"id":2}\n]')
    rows, bad = files.read_json_array(spark, f"{folder}/b.json")
    assert rows.count() == 2 and bad.first()["bad"] == 0


def test_messages_of_one_split_are_parsed_by_many_tasks(spark, folder):
    from tidemark.queries import Tables, clinical

    rows = spark.range(2000).selectExpr("id as c_custkey", "'n' || id as c_name", "'S' as c_mktsegment")
    rows.coalesce(1).write.parquet(f"{folder}/customer.parquet")
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(least, "1b")
    try:
        texts = clinical.messages(Tables(spark, folder))
        per = texts.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset(least)
    assert len(per) > 1 and sum(r["count"] for r in per) == 2000
