"""Queries of the clinical formats, segment by segment and resource by resource: one message and one resource of each
kind for every customer, with repeats, composites, partial dates and missing parts."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tidemark.queries import query
from tidemark.sources import dicom, fhir, hl7, osdu

# Places in the templates: name -> expression in either SQL.
PLACES = {"k": "c_custkey || ''", "name": "c_name", "seg": "c_mktsegment"}

# Segment -> its text, and the columns looked at: name -> (Spark expression, value as a template, its type).
# A template None is a null.
SEGMENTS = {
    "EVN": (
        "EVN|A01|20240102030405||{seg}^Why^L|{k}^Doe^Jo~x{k}^Roe|202403|FAC^1.2^ISO",
        {
            "event": ("event_type_code", "A01", "text"), "recorded": ("recorded_datetime", "2024-01-02T03:04:05", "text"), "planned": ("date_time_planned_event", None, "text"),
            "reason": ("event_reason.code", "{seg}", "text"), "operators": ("size(operator)", "2", "int"), "second": ("operator[1].id", "x{k}", "text"),
            "occurred": ("event_occurred", "2024-03-01T00:00:00", "text"), "facility": ("event_facility.universal_id", "1.2", "text"),
        },
    ),
    "PD1": (
        "PD1|S~C|A|Clinic {k}^L^{k}|{k}^Physician^Pat||||D1|||||20240102",
        {
            "dependencies": ("array_join(transform(living_dependency, x -> x.code), ',')", "S,C", "text"), "arrangement": ("living_arrangement.code", "A", "text"),
            "facility": ("patient_primary_facility[0].name", "Clinic {k}", "text"), "provider": ("patient_primary_care_provider.family_name", "Physician", "text"),
            "donor": ("organ_donor_code.code", "D1", "text"), "since": ("protection_indicator_effective_date", "2024-01-02T00:00:00", "text"),
        },
    ),
    "PV1": (
        "PV1|1|I|W{k}^R1^B2^HOSP&9.9&ISO|E||||{k}^Ref^Ann~y^Ref2||SUR|||||A0~B6||||V{k}^^^HOSP|C&Cash^20240101|" + "|" * 23 + "20240102030405-0500|20240105|" + "|12.50",
        {
            "set_id": ("set_id", "1", "bigint"), "patient_class": ("patient_class.code", "I", "text"), "ward": ("assigned_patient_location.point_of_care", "W{k}", "text"),
            "facility": ("assigned_patient_location.facility", "HOSP", "text"), "referring": ("size(referring_doctor)", "2", "int"), "given": ("referring_doctor[0].given_name", "Ann", "text"),
            "status": ("array_join(transform(ambulatory_status, x -> x.code), ',')", "A0,B6", "text"), "visit": ("visit_number.id", "V{k}", "text"),
            "authority": ("visit_number.assigning_authority", "HOSP", "text"), "class_text": ("financial_class[0].text", "Cash", "text"),
            "class_since": ("financial_class[0].effective_date", "2024-01-01T00:00:00", "text"), "admitted": ("admit_datetime", "2024-01-02T08:04:05", "text"),
            "discharged": ("discharge_datetime", "2024-01-05T00:00:00", "text"), "charges": ("total_charges", "12.50", "text"),
        },
    ),
    "PV2": (
        "PV2|^^^HOSP||R{k}^Reason^L||ring~watch||||20240110|5|x",
        {
            "from_facility": ("prior_pending_location.facility", "HOSP", "text"), "reason": ("admit_reason.text", "Reason", "text"), "valuables": ("patient_valuables[1]", "watch", "text"),
            "expected_discharge": ("expected_discharge_datetime", "2024-01-10T00:00:00", "text"), "days": ("estimated_length_of_inpatient_stay", "5", "bigint"),
            "actual_days": ("actual_length_of_inpatient_stay", None, "bigint"),
        },
    ),
    "NK1": (
        "NK1||Kin^{name}~Alias^K|SPO^Spouse|1 Road^^Town {k}^ST^12345^US|^PRN^PH^k{k}@example.com^1^555^123\rNK1|7|Second^{k}|CHD",
        {
            "set_id": ("set_id", None, "bigint"), "family": ("names[0].family_name", None, "text"), "given": ("names[0].given_name", None, "text"),
            "relationship": ("relationship.code", None, "text"), "city": ("address[0].city", None, "text"), "mail": ("phone_number[0].communication_address", None, "text"),
        },
    ),
    "MRG": (
        "MRG|OLD{k}^^^HOSP^MR~ALT{k}||ACC{k}||||Former^{name}",
        {
            "prior": ("prior_patient_id[0].id", "OLD{k}", "text"), "priors": ("size(prior_patient_id)", "2", "int"), "kind": ("prior_patient_id[0].type_code", "MR", "text"),
            "account": ("prior_patient_account_number.id", "ACC{k}", "text"), "former": ("prior_patient_names[0].given_name", "{name}", "text"),
        },
    ),
    "AL1": (
        "AL1|2|DA^Drug|PEN{k}^Penicillin^L|SV|Hives~Rash|20230506",
        {
            "set_id": ("set_id", "2", "bigint"), "kind": ("allergen_type_code.text", "Drug", "text"), "allergen": ("allergen_code.code", "PEN{k}", "text"),
            "severity": ("allergy_severity_code.code", "SV", "text"), "reactions": ("array_join(transform(allergy_reaction, x -> x.code), ',')", "Hives,Rash", "text"),
            "identified": ("identification_date", "2023-05-06T00:00:00", "text"),
        },
    ),
    "IAM": (
        "IAM||DA|{seg}^Dust^L|MO|Itch|A|U{k}^NS",
        {"set_id": ("set_id", "1", "bigint"), "allergen": ("allergen_code.code", "{seg}", "text"), "unique_id": ("allergy_unique_identifier.entity_identifier", "U{k}", "text")},
    ),
    "DG1": (
        "DG1|1|I10|E11.{k}^Diabetes^I10C|Type 2|2024010203|A||||||4|99.5&USD^UP||2|{k}^Doc^Di",
        {
            "set_id": ("set_id", "1", "bigint"), "code": ("diagnosis_code.code", "E11.{k}", "text"), "system": ("diagnosis_code.coding_system", "I10C", "text"),
            "at": ("diagnosis_datetime", "2024-01-02T03:00:00", "text"), "kind": ("diagnosis_type.code", "A", "text"), "outlier_days": ("outlier_days", "4", "bigint"),
            "cost": ("outlier_cost.price", "99.5", "text"), "currency": ("outlier_cost.currency", "USD", "text"), "priority": ("diagnosis_priority", "2", "bigint"),
            "clinician": ("diagnosing_clinician[0].family_name", "Doc", "text"),
        },
    ),
    "PR1": (
        "PR1|1||P{k}^Excision^L|Cut|20240102||45|||10|{k}^Sur^Geo~b^Second",
        {
            "code": ("procedure_code.code", "P{k}", "text"), "at": ("procedure_datetime", "2024-01-02T00:00:00", "text"), "minutes": ("procedure_minutes", "45", "bigint"),
            "anesthesia": ("anesthesia_minutes", "10", "bigint"), "surgeons": ("size(surgeon)", "2", "int"), "surgeon": ("surgeon[0].given_name", "Geo", "text"),
        },
    ),
    "OBR": (
        "OBR|3|P{k}^NS|F{k}|GLU^Glucose^LN|R||20240102030405.123|20240102|5^ml&milli|||||20240103|BLD&Blood^HEP|{k}^Ord^Olga~z^Other|||||||12^USD|LAB|F||1^Q6H^^20240104",
        {
            "set_id": ("set_id", "3", "bigint"), "placer": ("placer_order_number.entity_identifier", "P{k}", "text"), "namespace": ("placer_order_number.namespace_id", "NS", "text"),
            "filler": ("filler_order_number.entity_identifier", "F{k}", "text"), "service": ("service.text", "Glucose", "text"), "observed": ("observation_datetime", "2024-01-02T03:04:05", "text"),
            "volume": ("collection_volume.quantity", "5", "text"), "unit": ("collection_volume.units", "ml", "text"), "specimen": ("specimen_source.text", "Blood", "text"),
            "providers": ("size(ordering_provider)", "2", "int"), "provider": ("ordering_provider[0].id", "{k}", "text"), "section": ("diagnostic_service_section", "LAB", "text"),
            "status": ("result_status", "F", "text"), "timing_start": ("quantity_timing[0].start_datetime", "2024-01-04T00:00:00", "text"),
        },
    ),
    "IN1": (
        "IN1|1|PLAN{k}^Gold|INS{k}^^^AUTH~INS2|Acme {seg}^L|9 St^^City|||G{k}||||20240101|2025|A9^20240203^Web|HMO|Doe^{name}|SEL|19800506" + "|" * 18 + "POL{k}|50&USD",
        {
            "plan": ("insurance_plan.code", "PLAN{k}", "text"), "companies": ("size(insurance_company)", "2", "int"), "company": ("insurance_company_name[0].name", "Acme {seg}", "text"),
            "group": ("group_number", "G{k}", "text"), "since": ("plan_effective_date", "2024-01-01T00:00:00", "text"), "until": ("plan_expiration_date", "2025-01-01T00:00:00", "text"),
            "authorised": ("authorization_information.date", "2024-02-03T00:00:00", "text"), "insured": ("insured_names[0].given_name", "{name}", "text"),
            "born": ("insureds_date_of_birth", "1980-05-06T00:00:00", "text"), "policy": ("policy_number", "POL{k}", "text"), "deductible": ("policy_deductible.price", "50", "text"),
        },
    ),
    "GT1": (
        "GT1|1|GN{k}|Payer^{name}||5 Way^^Ville|||19700102|F||||||3",
        {
            "number": ("guarantor_number[0].id", "GN{k}", "text"), "given": ("guarantor_names[0].given_name", "{name}", "text"), "city": ("guarantor_address[0].city", "Ville", "text"),
            "born": ("guarantor_date_of_birth", "1970-01-02T00:00:00", "text"), "priority": ("guarantor_priority", "3", "bigint"),
        },
    ),
    "FT1": (
        "FT1|1|T{k}||20240102^20240109|20240110|CG|{seg}^Charge|||2|20.5&USD|10.25&USD|||||||I1~I2|{k}^Per",
        {
            "transaction": ("transaction_id.id", "T{k}", "text"), "from_date": ("transaction_date_start", "2024-01-02T00:00:00", "text"), "to_date": ("transaction_date_end", "2024-01-09T00:00:00", "text"),
            "posted": ("transaction_posting_date", "2024-01-10T00:00:00", "text"), "code": ("transaction_code.code", "{seg}", "text"), "quantity": ("transaction_quantity", "2", "bigint"),
            "amount": ("transaction_amount_extended.price", "20.5", "text"), "unit_amount": ("transaction_amount_unit.price", "10.25", "text"),
            "diagnoses": ("array_join(transform(diagnosis_code, x -> x.code), ',')", "I1,I2", "text"), "by": ("performed_by[0].id", "{k}", "text"),
        },
    ),
    "RXA": (
        "RXA|0|1|20240102030405|20240102|V{k}^Vaccine^CVX|0.5|mL|||{k}^Nurse|||||L1~L2|20250101~20260101|MSD^Maker",
        {
            "counter": ("administration_sub_id_counter", "1", "bigint"), "started": ("datetime_start_of_administration", "2024-01-02T03:04:05", "text"), "code": ("administered_code.code", "V{k}", "text"),
            "amount": ("administered_amount", "0.5", "text"), "units": ("administered_units.code", "mL", "text"), "provider": ("administering_provider[0].family_name", "Nurse", "text"),
            "lots": ("array_join(substance_lot_number, ',')", "L1,L2", "text"), "second_expiry": ("substance_expiration_date[1]", "2026-01-01T00:00:00", "text"),
            "maker": ("substance_manufacturer_name[0].text", "Maker", "text"),
        },
    ),
    "SCH": (
        "SCH|A{k}^NS|F{k}|4||S1|{seg}^Event||CHECKUP|30|min^Minutes|^^30^20240102~x||^^PH||W^1",
        {
            "placer": ("placer_appointment_id.entity_identifier", "A{k}", "text"), "filler": ("filler_appointment_id.entity_identifier", "F{k}", "text"), "occurrence": ("occurrence_number", "4", "bigint"),
            "event": ("event_reason.code", "{seg}", "text"), "kind": ("appointment_type.code", "CHECKUP", "text"), "duration": ("appointment_duration", "30", "bigint"),
            "units": ("appointment_duration_units.text", "Minutes", "text"), "timing": ("appointment_timing_quantity", "^^30^20240102", "text"), "room": ("placer_contact_location.room", "1", "text"),
        },
    ),
    "TXA": (
        "TXA|1|CN^Consult|TX|20240102||20240103|||{k}^Orig^Ann|||D{k}^SYS||||file{k}.txt|AU||AV",
        {
            "kind": ("document_type.text", "Consult", "text"), "at": ("activity_datetime", "2024-01-02T00:00:00", "text"), "originated": ("origination_datetime", "2024-01-03T00:00:00", "text"),
            "originator": ("originator[0].family_name", "Orig", "text"), "document": ("unique_document_number.entity_identifier", "D{k}", "text"), "file_name": ("unique_document_file_name", "file{k}.txt", "text"),
            "completion": ("document_completion_status", "AU", "text"), "availability": ("document_availability_status", "AV", "text"),
        },
    ),
    "NTE": (
        "NTE||P|First {k}~Second\\T\\half|RE",
        {"set_id": ("set_id", "1", "bigint"), "source": ("source_of_comment", "P", "text"), "comments": ("array_join(comment, '/')", "First {k}/Second\\T\\half", "text"), "kind": ("comment_type.code", "RE", "text")},
    ),
    "SPM": (
        "SPM|1|S{k}&NS^F{k}||BLD^Blood|X~Y|||ARM|||||2|d1~d2|||20240102^20240103|20240104",
        {
            "kind": ("specimen_type.text", "Blood", "text"), "modifiers": ("size(specimen_type_modifier)", "2", "int"), "site": ("specimen_source_site.code", "ARM", "text"),
            "grouped": ("grouped_specimen_count", "2", "bigint"), "described": ("specimen_description[1]", "d2", "text"), "from_time": ("specimen_collection_datetime_start", "2024-01-02T00:00:00", "text"),
            "to_time": ("specimen_collection_datetime_end", "2024-01-03T00:00:00", "text"), "received": ("specimen_received_datetime", "2024-01-04T00:00:00", "text"),
        },
    ),
}


def spark_text(template: str):
    parts = [F.expr(PLACES[p[1:-1]]) if re.fullmatch(r"\{\w+\}", p) else F.lit(p) for p in re.split(r"(\{\w+\})", template) if p]
    return F.concat(*parts)


def sql_text(template: str | None) -> str:
    if template is None:
        return "null"
    parts = [PLACES[p[1:-1]] if re.fullmatch(r"\{\w+\}", p) else "'" + p.replace("'", "''") + "'" for p in re.split(r"(\{\w+\})", template) if p]
    return " || ".join(parts)


SQL_TYPE = {"text": "varchar", "bigint": "bigint", "int": "integer", "double": "double", "boolean": "boolean"}


def sql_row(columns: dict, head: str) -> str:
    cols = [f'cast({sql_text(value)} as {SQL_TYPE[kind]}) as "{name}"' for name, (_, value, kind) in columns.items()]
    return f"select {head}, {', '.join(cols)} from customer"


def customers(t):
    """The customers dealt out anew: each becomes a text many times as large, so a split of the file holds far more work than bytes."""
    return t.customer.select("c_custkey", "c_name", "c_mktsegment").repartition("c_custkey")


def messages(t):
    text = "MSH|^~\\&|A|F|R|RF|20240102||ADT^A01|m{k}|P|2.5\r" + "\r".join(text for text, _ in SEGMENTS.values())
    return customers(t).select(F.lit("f").alias("file"), spark_text(text).alias("text"))


def _segment_query(segment: str, columns: dict) -> None:
    if segment == "NK1":
        first = {"set_id": "1", "family": "Kin", "given": "{name}", "relationship": "SPO", "city": "Town {k}", "mail": "k{k}@example.com"}
        second = {"set_id": "7", "family": "Second", "given": "{k}", "relationship": "CHD"}
        sql = " union all ".join(
            sql_row({n: (e, v.get(n), kind) for n, (e, _, kind) in columns.items()}, "'m' || c_custkey as message_id") for v in (first, second)
        )
    else:
        sql = sql_row(columns, "'m' || c_custkey as message_id")

    @query(f"i05_hl7_table_{segment.lower()}", sql)
    def run(t):
        return hl7.table(messages(t), "text", segment, "file").selectExpr("message_id", *[f"{e} as `{n}`" for n, (e, _, _) in columns.items()])


for _segment, (_, _columns) in SEGMENTS.items():
    _segment_query(_segment, _columns)


# --- FHIR resources ---------------------------------------------------------------------

CODE = '{"coding":[{"system":"s","code":"{seg}","display":"d"}],"text":"t{k}"}'
REF = '{"reference":"Patient/{k}"}'
RESOURCES = {
    "Condition": (
        '"clinicalStatus":' + CODE + ',"category":[' + CODE + '],"subject":' + REF + ',"onsetDateTime":"2024-01-02T03:04:05Z","note":[{"text":"n{k}"}]',
        {"status": ("clinical_status.coding[0].code", "{seg}", "text"), "categories": ("size(category)", "1", "int"), "subject": ("subject.reference", "Patient/{k}", "text"),
         "onset": ("date_format(onset_datetime, 'yyyy-MM-dd HH:mm:ss')", "2024-01-02 03:04:05", "text"), "note": ("note[0].text", "n{k}", "text"), "notes_missing": ("abatement_string", None, "text")},
    ),
    "AllergyIntolerance": (
        '"type":"allergy","category":["food","{seg}"],"criticality":"high","patient":' + REF + ',"reaction":[{"severity":"mild","manifestation":[' + CODE + ']}]',
        {"kind": ("type", "allergy", "text"), "categories": ("array_join(category, ',')", "food,{seg}", "text"), "patient": ("patient.reference", "Patient/{k}", "text"),
         "severity": ("reaction[0].severity", "mild", "text"), "shown": ("reaction[0].manifestation[0].text", "t{k}", "text")},
    ),
    "Encounter": (
        '"status":"finished","class":{"code":"{seg}"},"period":{"start":"2024-01-02","end":"2024-01-03"},"diagnosis":[{"condition":' + REF + ',"rank":2}],"hospitalization":{"origin":' + REF + '},'
        '"location":[{"status":"active"},{"status":"planned"}]',
        {"status": ("status", "finished", "text"), "class": ("class_coding.code", "{seg}", "text"), "start": ("period.start", "2024-01-02", "text"), "rank": ("diagnosis[0].rank", "2", "bigint"),
         "origin": ("hospitalization.origin.reference", "Patient/{k}", "text"), "locations": ("array_join(transform(location, x -> x.status), ',')", "active,planned", "text")},
    ),
    "Procedure": (
        '"status":"done","code":' + CODE + ',"performedPeriod":{"start":"2024-01-02"},"performer":[{"actor":' + REF + ',"onBehalfOf":{"display":"o{k}"}}],"bodySite":[' + CODE + ',' + CODE + "]",
        {"code": ("code.text", "t{k}", "text"), "start": ("performed_period.start", "2024-01-02", "text"), "actor": ("performer[0].actor.reference", "Patient/{k}", "text"),
         "behalf": ("performer[0].on_behalf_of.display", "o{k}", "text"), "sites": ("size(body_site)", "2", "int"), "complications": ("size(complication)", "0", "int")},
    ),
    "DiagnosticReport": (
        '"status":"final","issued":"2024-01-02T03:04:05+02:00","result":[' + REF + '],"conclusion":"c{k}","conclusionCode":[' + CODE + "]",
        {"status": ("status", "final", "text"), "issued": ("date_format(issued, 'yyyy-MM-dd HH:mm:ss')", "2024-01-02 01:04:05", "text"), "result": ("result[0].reference", "Patient/{k}", "text"),
         "conclusion": ("conclusion", "c{k}", "text"), "code": ("conclusion_code[0].coding[0].code", "{seg}", "text")},
    ),
    "MedicationRequest": (
        '"status":"active","intent":"order","medicationCodeableConcept":' + CODE + ',"dosageInstruction":[{"text":"one","timing":{"code":{"coding":[{"code":"BID"}]}},"doseAndRate":[{"doseQuantity":{"value":1.5,'
        '"unit":"mg"}}]}],"dispenseRequest":{"numberOfRepeatsAllowed":3,"quantity":{"value":30,"unit":"tab"}},"substitution":{"allowedBoolean":true}',
        {"medication": ("medication_codeable_concept.coding[0].code", "{seg}", "text"), "timing": ("dosage_instruction[0].timing_code", "BID", "text"), "dose": ("dosage_instruction[0].dose_value", "1.5", "double"),
         "unit": ("dosage_instruction[0].dose_unit", "mg", "text"), "repeats": ("dispense_request.number_of_repeats_allowed", "3", "bigint"), "quantity": ("dispense_request.quantity_value", "30", "double"),
         "substitution": ("substitution_allowed_boolean", "true", "boolean")},
    ),
    "Immunization": (
        '"status":"completed","vaccineCode":' + CODE + ',"occurrenceDateTime":"2024-01-02","primarySource":false,"doseQuantity":{"value":0.5,"unit":"mL"},"protocolApplied":[{"series":"s{k}","doseNumberPositiveInt":2}]',
        {"vaccine": ("vaccine_code.text", "t{k}", "text"), "at": ("date_format(occurrence_datetime, 'yyyy-MM-dd')", "2024-01-02", "text"), "own_record": ("primary_source", "false", "boolean"),
         "dose": ("dose_quantity.value", "0.5", "double"), "series": ("protocol_applied[0].series", "s{k}", "text"), "number": ("protocol_applied[0].dose_number_positive_int", "2", "bigint")},
    ),
    "Coverage": (
        '"status":"active","subscriberId":"sub{k}","beneficiary":' + REF + ',"period":{"end":"2025-01-01"},"class":[{"type":' + CODE + ',"value":"v{k}"}],"order":1,"subrogation":true',
        {"subscriber": ("subscriber_id", "sub{k}", "text"), "until": ("period.end", "2025-01-01", "text"), "class_value": ("class_coverage[0].value", "v{k}", "text"),
         "class_code": ("class_coverage[0].type.coding[0].code", "{seg}", "text"), "place": ("`order`", "1", "bigint"), "subrogation": ("subrogation", "true", "boolean")},
    ),
    "CarePlan": (
        '"status":"active","intent":"plan","title":"p{k}","activity":[{"reference":' + REF + ',"detail":{"status":"done","code":' + CODE + ',"description":"walk"}}],"goal":[' + REF + "]",
        {"title": ("title", "p{k}", "text"), "activity": ("activity[0].reference.reference", "Patient/{k}", "text"), "state": ("activity[0].detail_status", "done", "text"),
         "code": ("activity[0].detail_code.text", "t{k}", "text"), "described": ("activity[0].detail_description", "walk", "text"), "goals": ("size(goal)", "1", "int")},
    ),
    "Goal": (
        '"lifecycleStatus":"active","description":' + CODE + ',"startDate":"2024-01-02","target":[{"measure":' + CODE + ',"detailQuantity":{"value":7.5},"dueDate":"2024-06-01"}]',
        {"status": ("lifecycle_status", "active", "text"), "described": ("description.text", "t{k}", "text"), "start": ("start_date", "2024-01-02", "text"),
         "target": ("target[0].detail_quantity.value", "7.5", "double"), "due": ("target[0].due_date", "2024-06-01", "text")},
    ),
    "Device": (
        '"status":"active","lotNumber":"L{k}","deviceName":[{"name":"n{k}","type":"model-name"}],"type":' + CODE + ',"contact":[{"system":"phone","value":"{k}"}],"safety":[' + CODE + "]",
        {"lot": ("lot_number", "L{k}", "text"), "device": ("device_name[0].name", "n{k}", "text"), "kind": ("type.coding[0].code", "{seg}", "text"), "phone": ("contact[0].value", "{k}", "text"),
         "safety": ("safety[0].text", "t{k}", "text")},
    ),
    "DocumentReference": (
        '"status":"current","docStatus":"final","date":"2024-01-02T03:04:05.678Z","relatesTo":[{"code":"replaces","target":' + REF + '}],"content":[{"attachment":{"url":"u{k}","contentType":"text/plain"},"format":{"code":"f"}}],'
        '"context":{"encounter":[' + REF + '],"period":{"start":"2024"}}',
        {"status": ("doc_status", "final", "text"), "at": ("date_format(date, 'yyyy-MM-dd HH:mm:ss.SSS')", "2024-01-02 03:04:05.678", "text"), "replaces": ("relates_to[0].target.reference", "Patient/{k}", "text"),
         "url": ("content[0].attachment_url", "u{k}", "text"), "content_type": ("content[0].attachment_content_type", "text/plain", "text"), "format": ("content[0].format_code", "f", "text"),
         "encounter": ("context.encounter[0].reference", "Patient/{k}", "text"), "since": ("context.period.start", "2024", "text")},
    ),
}


def _resource_query(resource: str, body: str, columns: dict) -> None:
    @query(f"i10_fhir_{resource.lower()}", sql_row(columns, "'r' || c_custkey as id"))
    def run(t):
        text = spark_text('{"resourceType":"' + resource + '","id":"r{k}",' + body + "}")
        rows = fhir.resource_table(customers(t).select(text.alias("b")), "b", resource)
        return rows.selectExpr("id", *[f"{e} as `{n}`" for n, (e, _, _) in columns.items()])


for _resource, (_body, _columns) in RESOURCES.items():
    _resource_query(_resource, _body, _columns)


# --- the other levels and kinds ---------------------------------------------------------


@query(
    "i12_dicom_series",
    """select '1.3.' || c_custkey as series_instance_uid, '1.2.' || c_custkey as study_instance_uid, c_custkey as series_number, c_name as series_description, 'MR' as modality,
       cast(null as varchar) as body_part_examined, '20240102' as series_date from customer""",
)
def i12_series(t):
    body = spark_text(
        '{"0020000E":{"vr":"UI","Value":["1.3.{k}"]},"0020000d":{"vr":"UI","Value":["1.2.{k}"]},"00200011":{"vr":"IS","Value":[" {k} "]},"0008103E":{"vr":"LO","Value":["{name}"]},'
        '"00080060":{"vr":"CS","Value":["MR","CT"]},"00180015":{"vr":"CS","Value":[]},"00080021":{"vr":"DA","Value":["20240102"]}}'
    )
    return dicom.dicom_rows(customers(t).select(body.alias("b")), "b", "series").drop("study_date")


@query(
    "i12_dicom_instances",
    """select '1.4.' || c_custkey as sop_instance_uid, '1.3.' || c_custkey as series_instance_uid, c_mktsegment as sop_class_uid, cast(null as bigint) as instance_number, '20240102' as content_date,
       '030405.6' as content_time, cast(null as varchar) as dicom_file_path, cast(null as varchar) as metadata from customer""",
)
def i12_instances(t):
    body = spark_text(
        '{"00080018":{"vr":"UI","Value":["1.4.{k}"]},"0020000E":{"vr":"UI","Value":["1.3.{k}"]},"00080016":{"vr":"UI","Value":["{seg}"]},"00200013":{"vr":"IS","Value":["x{k}"]},'
        '"00080023":{"vr":"DA","Value":["20240102"]},"00080033":{"vr":"TM","Value":["030405.6"]}}'
    )
    return dicom.dicom_rows(customers(t).select(body.alias("b")), "b", "instances").drop("study_instance_uid", "study_date")


@query(
    "i14_osdu_samples",
    """select 's' || c_custkey as id, 'osdu:master-data--Sample:1' as kind, 'j' || c_custkey as SampleAcquisitionJobID, 'w' || c_custkey as WellboreID, 1500.5::double as TopDepth,
       cast(null as double) as BaseDepth, 210.0::double as FormationPressure, cast(null as varchar) as ToolKind, '{"a":1}' as ExtensionProperties_json from customer""",
)
def i14_samples(t):
    body = spark_text(
        '{"id":"s{k}","kind":"osdu:master-data--Sample:1","version":1,"data":{"SampleAcquisition":{"SampleAcquisitionJobID":"j{k}","SampleAcquisitionDetail":{"WellboreID":"w{k}","TopDepth":1500.5,"BaseDepth":"deep",'
        '"FormationCondition":{"Pressure":"210"}}},"ExtensionProperties":{"a":1}}}'
    )
    out = osdu.records(customers(t).select(body.alias("b")), "b", ["Rock_and_Fluid"])
    return out.select("id", "kind", "SampleAcquisitionJobID", "WellboreID", "TopDepth", "BaseDepth", "FormationPressure", "ToolKind", "ExtensionProperties_json")
