"""FHIR R4 layouts as plain text: the columns of each resource and where they are in its JSON.

Fixed values. ``name:type`` with ``*`` for a list; the JSON element is the name in camelCase
unless ``name=path`` says otherwise. Plain types: ``str bool long double ts``; the others
are the structs below.
"""

TYPES = {
    "Coding": "system code display",
    "Concept": "coding:Coding* text",
    "Reference": "reference display",
    "Period": "start end",
    "Identifier": "system value use",
    "Name": "family given:str* text use",
    "Address": "use line:str* city district postalCode country",
    "Contact": "system value use",
    "Quantity": "value:double unit system code",
    "Annotation": "text time:ts",
    "Dosage": (
        "text timing_code=timing.code.coding[0].code dose_value=doseAndRate[0].doseQuantity.value:double "
        "dose_unit=doseAndRate[0].doseQuantity.unit route:Concept site:Concept"
    ),
    "ReferenceRange": (
        "low_value=low.value:double low_unit=low.unit high_value=high.value:double high_unit=high.unit type:Concept text"
    ),
    "Component": (
        "code:Concept value_quantity:Quantity value_string value_codeable_concept:Concept value_boolean:bool "
        "value_integer:long data_absent_reason:Concept"
    ),
    "Reaction": "substance:Concept manifestation:Concept* description onset:ts severity exposure_route:Concept",
    "Participant": "type:Concept* period:Period individual:Reference",
    "Diagnosis": "condition:Reference use:Concept rank:long",
    "Hospitalization": (
        "admit_source:Concept re_admission:Concept discharge_disposition:Concept origin:Reference destination:Reference"
    ),
    "Location": "location:Reference status physical_type:Concept period:Period",
    "Performer": "function:Concept actor:Reference on_behalf_of:Reference",
    "Vaccinator": "function:Concept actor:Reference",
    "Dispense": (
        "validity_period:Period number_of_repeats_allowed:long quantity_value=quantity.value:double "
        "quantity_unit=quantity.unit expected_supply_duration_value=expectedSupplyDuration.value:double "
        "expected_supply_duration_unit=expectedSupplyDuration.unit"
    ),
    "Protocol": (
        "series authority:Reference target_disease:Concept* dose_number_positive_int:long dose_number_string "
        "series_doses_positive_int:long series_doses_string"
    ),
    "CoverageClass": "type:Concept value name",
    "Activity": "reference:Reference detail_status=detail.status detail_code=detail.code:Concept detail_description=detail.description",
    "Target": "measure:Concept detail_quantity:Quantity detail_string detail_boolean:bool due_date",
    "DeviceName": "name type",
    "RelatesTo": "code target:Reference",
    "Content": (
        "attachment_url=attachment.url attachment_title=attachment.title attachment_content_type=attachment.contentType "
        "format_code=format.code format_system=format.system"
    ),
    "Context": "encounter:Reference* event:Concept* period:Period facility_type:Concept practice_setting:Concept",
}

PATIENT = """
identifier:Identifier* active:bool name:Name* telecom:Contact* gender birthDate deceased_boolean:bool deceased_datetime:ts
address:Address* maritalStatus:Concept generalPractitioner:Reference* managingOrganization:Reference
"""

OBSERVATION = """
status category:Concept* code:Concept subject:Reference encounter:Reference effective_datetime:ts effective_period:Period
issued:ts performer:Reference* value_quantity:Quantity value_codeable_concept:Concept value_string value_boolean:bool
value_integer:long data_absent_reason:Concept interpretation:Concept* body_site:Concept method:Concept specimen:Reference
device:Reference reference_range:ReferenceRange* has_member:Reference* derived_from:Reference* component:Component*
"""

CONDITION = """
identifier:Identifier* clinical_status:Concept verification_status:Concept category:Concept* severity:Concept code:Concept
body_site:Concept* subject:Reference encounter:Reference onset_datetime:ts onset_period:Period onset_string
abatement_datetime:ts abatement_string recorded_date recorder:Reference asserter:Reference note:Annotation*
"""

ALLERGY_INTOLERANCE = """
identifier:Identifier* clinical_status:Concept verification_status:Concept type category:str* criticality code:Concept
patient:Reference encounter:Reference onset_datetime:ts onset_string recorded_date recorder:Reference asserter:Reference
last_occurrence:ts note:Annotation* reaction:Reaction*
"""

ENCOUNTER = """
identifier:Identifier* status class_coding=class:Coding type:Concept* service_type:Concept priority:Concept
subject:Reference episode_of_care:Reference* participant:Participant* appointment:Reference* period:Period
reason_code:Concept* reason_reference:Reference* diagnosis:Diagnosis* hospitalization:Hospitalization location:Location*
service_provider:Reference part_of:Reference
"""

PROCEDURE = """
identifier:Identifier* status status_reason:Concept category:Concept code:Concept subject:Reference encounter:Reference
performed_datetime:ts performed_period:Period recorder:Reference asserter:Reference performer:Performer* location:Reference
reason_code:Concept* reason_reference:Reference* body_site:Concept* outcome:Concept report:Reference*
complication:Concept* follow_up:Concept* note:Annotation*
"""

DIAGNOSTIC_REPORT = """
identifier:Identifier* based_on:Reference* status category:Concept* code:Concept subject:Reference encounter:Reference
effective_datetime:ts effective_period:Period issued:ts performer:Reference* results_interpreter:Reference*
specimen:Reference* result:Reference* conclusion conclusion_code:Concept*
"""

MEDICATION_REQUEST = """
identifier:Identifier* status status_reason:Concept intent category:Concept* priority medication_codeable_concept:Concept
medication_reference:Reference subject:Reference encounter:Reference authored_on requester:Reference reason_code:Concept*
reason_reference:Reference* note:Annotation* dosage_instruction:Dosage* dispense_request:Dispense
substitution_allowed_boolean=substitution.allowedBoolean:bool
"""

IMMUNIZATION = """
identifier:Identifier* status status_reason:Concept vaccine_code:Concept patient:Reference encounter:Reference
occurrence_datetime:ts occurrence_string recorded primary_source:bool manufacturer:Reference lot_number expiration_date
site:Concept route:Concept dose_quantity:Quantity performer:Vaccinator* reason_code:Concept* reason_reference:Reference*
is_subpotent:bool program_eligibility:Concept* funding_source:Concept protocol_applied:Protocol*
"""

COVERAGE = """
identifier:Identifier* status type:Concept policy_holder:Reference subscriber:Reference subscriber_id beneficiary:Reference
dependent relationship:Concept period:Period payor:Reference* class_coverage=class:CoverageClass* order:long network
subrogation:bool
"""

CARE_PLAN = """
identifier:Identifier* status intent category:Concept* title description subject:Reference encounter:Reference
period:Period created author:Reference care_team:Reference* addresses:Reference* goal:Reference* activity:Activity*
note:Annotation*
"""

GOAL = """
identifier:Identifier* lifecycle_status achievement_status:Concept category:Concept* priority:Concept description:Concept
subject:Reference start_date start_codeable_concept:Concept target:Target* status_date status_reason
expressed_by:Reference addresses:Reference* note:Annotation*
"""

DEVICE = """
identifier:Identifier* status status_reason:Concept* manufacturer manufacture_date expiration_date lot_number serial_number
device_name:DeviceName* model_number type:Concept patient:Reference owner:Reference contact:Contact* note:Annotation*
safety:Concept*
"""

DOCUMENT_REFERENCE = """
identifier:Identifier* status doc_status type:Concept category:Concept* subject:Reference date:ts author:Reference*
authenticator:Reference custodian:Reference relates_to:RelatesTo* description security_label:Concept* content:Content*
context:Context
"""

RESOURCES = {
    "Patient": PATIENT, "Observation": OBSERVATION, "Condition": CONDITION, "AllergyIntolerance": ALLERGY_INTOLERANCE,
    "Encounter": ENCOUNTER, "Procedure": PROCEDURE, "DiagnosticReport": DIAGNOSTIC_REPORT,
    "MedicationRequest": MEDICATION_REQUEST, "Immunization": IMMUNIZATION, "Coverage": COVERAGE, "CarePlan": CARE_PLAN,
    "Goal": GOAL, "Device": DEVICE, "DocumentReference": DOCUMENT_REFERENCE,
}

# Where the national patient profile keeps its extra columns.
NHS_NUMBER = "https://fhir.nhs.uk/Id/nhs-number"
UK_EXTENSION = "https://fhir.hl7.org.uk/StructureDefinition/Extension-UKCore-"
INTERPRETER = "http://hl7.org/fhir/StructureDefinition/patient-interpreterRequired"
