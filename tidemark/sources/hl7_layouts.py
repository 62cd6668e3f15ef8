"""HL7 v2 layouts as plain text: what each segment field is called and how it is made up.

Fixed values. ``SEGMENTS``: the fields of a segment in order, ``name:type``; no type is plain
text, ``-`` an unused field, ``*`` after the type a repeating field kept as an array.
Types in lower case: ``int``; ``dtm`` date-time; ``seq`` the set id, 1 when absent; ``first``
and ``firstdtm`` the first repetition; ``id`` the first component; ``range`` a pair of times
(``_start``, ``_end``); ``authority`` and ``message`` several plain columns.
Types in capitals are the structs of ``COMPOSITES``: their components in order, ``@n`` jumps
to component n, ``@n.m`` is a sub-component, ``?`` falls back to the whole component when
the sub-component is empty, ``:dtm`` is a date-time.
"""

CODED = "code text coding_system alt_code alt_text alt_coding_system coding_system_version alt_coding_system_version original_text"
PLACE = (
    "point_of_care@1.1? room@2.1? bed@3.1? facility@4.1? status@5 type@6 building@7.1? floor@8.1? "
    "description@9 comprehensive_id@10.1? assigning_authority@11.1?"
)

COMPOSITES = {
    "CWE": CODED,
    "HD": "namespace_id universal_id universal_id_type",
    "EI": "entity_identifier namespace_id universal_id universal_id_type",
    "CX": (
        "id check_digit check_digit_scheme assigning_authority@4.1 assigning_authority_universal_id@4.2 "
        "assigning_authority_universal_id_type@4.3 type_code@5 assigning_facility@6.1 assigning_facility_universal_id@6.2 "
        "assigning_facility_universal_id_type@6.3 effective_date@7 expiration_date assigning_jurisdiction assigning_agency "
        "security_check security_check_scheme"
    ),
    "XPN": (
        "family_name given_name middle_name suffix prefix degree name_type_code name_representation_code name_context "
        "name_assembly_order@11 name_effective_date name_expiration_date professional_suffix called_by"
    ),
    "XCN": (
        "id family_name given_name middle_name suffix prefix degree source_table assigning_authority@9.1 "
        "assigning_authority_universal_id@9.2 assigning_authority_universal_id_type@9.3 name_type_code@10 check_digit "
        "check_digit_scheme identifier_type_code assigning_facility@14.1 assigning_facility_universal_id@14.2 "
        "assigning_facility_universal_id_type@14.3 name_representation_code@15 name_assembly_order@18 effective_date "
        "expiration_date professional_suffix"
    ),
    "XON": (
        "name type_code id check_digit check_digit_scheme assigning_authority@6.1 assigning_authority_universal_id@6.2 "
        "assigning_authority_universal_id_type@6.3 id_type_code@7 assigning_facility@8.1 assigning_facility_universal_id@8.2 "
        "assigning_facility_universal_id_type@8.3 name_rep_code@9 identifier"
    ),
    "XAD": (
        "street other_designation city state zip country type other_geographic county_parish_code@9.1 county_parish_text@9.2 "
        "county_parish_coding_system@9.3 census_tract@10.1 census_tract_text@10.2 census_tract_coding_system@10.3 "
        "representation_code@11 effective_date@13 expiration_date expiration_reason@15.1 expiration_reason_text@15.2 "
        "expiration_reason_coding_system@15.3 temporary_indicator@16 bad_address_indicator usage addressee comment "
        "preference_order protection_code@22.1 protection_code_text@22.2 protection_code_coding_system@22.3 identifier@23.1"
    ),
    "XTN": (
        "number use_code equipment_type communication_address country_code area_code local_number extension any_text "
        "extension_prefix speed_dial_code unformatted_number effective_start_date expiration_date expiration_reason@15.1 "
        "protection_code@16.1 shared_telecom_id@17.1 preference_order@18"
    ),
    "PL": PLACE,
    "CP": "price@1.1? currency@1.2 price_type@2 from_value to_value range_units@5.1? range_units_text@5.2 range_units_coding_system@5.3 range_type@6",
    "PT": "id mode",
    "VID": (
        "id internationalization@2.1? internationalization_text@2.2 internationalization_coding_system@2.3 "
        "international_version@3.1? international_version_text@3.2 international_version_coding_system@3.3"
    ),
    "AUI": "number date:dtm source",
    "SPS": (
        "code@1.1? text@1.2 additives@2.1? collection_method@3 body_site@4.1? site_modifier@5.1? "
        "collection_method_modifier@6.1? role@7.1?"
    ),
    "DLN": "number issuing_state expiration_date:dtm",
    "DLD": "code@1.1? effective_date@2:dtm",
    "FC": (
        "code@1.1? text@1.2 coding_system@1.3 alt_code@1.4 alt_text@1.5 alt_coding_system@1.6 coding_system_version@1.7 "
        "alt_coding_system_version@1.8 original_text@1.9 effective_date@2:dtm"
    ),
    "TQ": (
        "quantity@1.1? quantity_units@1.2 interval_repeat_pattern@2.1 interval_explicit_time@2.2 duration@3 start_datetime:dtm "
        "end_datetime:dtm priority condition text conjunction order_sequencing occurrence_duration@11.1? total_occurrences@12"
    ),
    "JCC": "code@1.1? text@1.2 coding_system@1.3 class@2.1? class_text@2.2 class_coding_system@2.3 description@3",
    "MOC": "monetary_amount@1.1? monetary_amount_currency@1.2 charge_code@2.1? charge_code_text@2.2 charge_code_coding_system@2.3",
    "PRL": "code@1.1? text@1.2 coding_system@1.3 sub_id@2 descriptor",
    "NDL": (
        "id@1.1 family_name@1.2 given_name@1.3 middle_name@1.4 suffix@1.5 prefix@1.6 degree@1.7 start_datetime@2:dtm "
        "end_datetime:dtm point_of_care room bed facility@7.1? location_status@8 patient_location_type building floor"
    ),
    "CQ": "quantity units@2.1?",
    "MO": "amount currency",
    "OG": "sub_identifier group sequence identifier",
}

# Segments that occur once per message: their key is the message alone.
SINGLE = ["MSH", "EVN", "PID", "PD1", "PV1", "PV2", "MRG", "SCH", "TXA"]

MSH = """
field_separator, encoding_characters, sending_application:authority, sending_facility:authority,
receiving_application:authority, receiving_facility:authority, message_datetime:dtm, security, :message,
message_control_id, processing_id:PT, version_id:VID, sequence_number:int, continuation_pointer,
accept_acknowledgment_type, application_acknowledgment_type, country_code, character_set:id*, principal_language:CWE,
alt_character_set_handling, message_profile_identifiers:EI*, sending_responsible_org:XON, receiving_responsible_org:XON,
sending_network_address:HD, receiving_network_address:HD, security_classification_tag:CWE,
security_handling_instructions:CWE*, special_access_restriction:CWE*
"""

EVN = """
event_type_code, recorded_datetime:dtm, date_time_planned_event:dtm, event_reason:CWE, operator:XCN*,
event_occurred:dtm, event_facility:HD
"""

PID = """
set_id:int, patient_external_id:CX, patient_id:CX*, alternate_patient_id:CX, patient_names:XPN*, mothers_maiden_names:XPN*,
date_of_birth:dtm, administrative_sex:CWE, patient_alias:first, race:CWE*, address:XAD*, county_code, home_phone:XTN*,
business_phone:XTN*, primary_language:CWE, marital_status:CWE, religion:CWE, patient_account_number:CX, ssn,
drivers_license:DLN, mothers_identifier:CX*, ethnic_group:CWE*, birth_place, multiple_birth_indicator, birth_order:int,
citizenship:CWE*, veterans_military_status:CWE, nationality:CWE, patient_death_datetime:dtm, patient_death_indicator,
identity_unknown_indicator, identity_reliability_code:CWE*, last_update_datetime:dtm, last_update_facility:HD,
species_code:CWE, breed_code:CWE, strain, production_class_code:CWE, tribal_citizenship:CWE*, patient_telecom:XTN*
"""

PD1 = """
living_dependency:CWE*, living_arrangement:CWE, patient_primary_facility:XON*, patient_primary_care_provider:XCN,
student_indicator:CWE, handicap:CWE, living_will_code:CWE, organ_donor_code:CWE, separate_bill, duplicate_patient:CX*,
publicity_code:CWE, protection_indicator, protection_indicator_effective_date:dtm, place_of_worship:XON*,
advance_directive_code:CWE*, immunization_registry_status:CWE, immunization_registry_status_effective_date:dtm,
publicity_code_effective_date:dtm, military_branch:CWE, military_rank_grade:CWE, military_status:CWE,
advance_directive_last_verified_date:dtm, retirement_date:dtm
"""

PV1 = """
set_id:int, patient_class:CWE, assigned_patient_location:PL, admission_type:CWE, preadmit_number:CX,
prior_patient_location:PL, attending_doctor:XCN*, referring_doctor:XCN*, consulting_doctor:XCN*, hospital_service:CWE,
temporary_location:PL, preadmit_test_indicator:CWE, readmission_indicator:CWE, admit_source:CWE, ambulatory_status:CWE*,
vip_indicator:CWE, admitting_doctor:XCN*, patient_type:CWE, visit_number:CX, financial_class:FC*,
charge_price_indicator:CWE, courtesy_code:CWE, credit_rating:CWE, contract_code:CWE*, contract_effective_date:dtm*,
contract_amount:st*, contract_period:st*, interest_code:CWE, transfer_to_bad_debt_code:CWE, transfer_to_bad_debt_date:dtm,
bad_debt_agency_code:CWE, bad_debt_transfer_amount, bad_debt_recovery_amount, delete_account_indicator:CWE,
delete_account_date:dtm, discharge_disposition:CWE, discharged_to_location:DLD, diet_type:CWE, servicing_facility:CWE,
bed_status:CWE, account_status:CWE, pending_location:PL, prior_temporary_location:PL, admit_datetime:firstdtm,
discharge_datetime:firstdtm, current_patient_balance, total_charges, total_adjustments, total_payments,
alternate_visit_id:CX*, visit_indicator:CWE, other_healthcare_provider:XCN*, service_episode_description,
service_episode_identifier:CX
"""

PV2 = """
prior_pending_location:PL, accommodation_code:CWE, admit_reason:CWE, transfer_reason:CWE, patient_valuables:st*,
patient_valuables_location, visit_user_code:CWE*, expected_admit_datetime:dtm, expected_discharge_datetime:dtm,
estimated_length_of_inpatient_stay:int, actual_length_of_inpatient_stay:int, visit_description, referral_source:XCN*,
previous_service_date:dtm, employment_illness_related_indicator, purge_status_code:CWE, purge_status_date:dtm,
special_program_code:CWE, retention_indicator, expected_number_of_insurance_plans:int, visit_publicity_code:CWE,
visit_protection_indicator, clinic_organization:XON*, patient_status_code:CWE, visit_priority_code:CWE,
previous_treatment_date:dtm, expected_discharge_disposition:CWE, signature_on_file_date:dtm,
first_similar_illness_date:dtm, patient_charge_adjustment_code:CWE, recurring_service_code:CWE, billing_media_code,
expected_surgery_datetime:dtm, military_partnership_code, military_non_availability_code, newborn_baby_indicator,
baby_detained_indicator, mode_of_arrival_code:CWE, recreational_drug_use_code:CWE*, admission_level_of_care_code:CWE,
precaution_code:CWE*, patient_condition_code:CWE, living_will_code:CWE, organ_donor_code:CWE, advance_directive_code:CWE*,
patient_status_effective_date:dtm, expected_loa_return_datetime:dtm, expected_preadmission_testing_datetime:dtm,
notify_clergy_code:CWE*, advance_directive_last_verified_date:dtm
"""

NK1 = """
set_id:seq, names:XPN*, relationship:CWE, address:XAD*, phone_number:XTN*, business_phone:XTN*, contact_role:CWE,
start_date:dtm, end_date:dtm, job_title, job_code:JCC, employee_number:CX, organization_name:XON*, marital_status:CWE,
administrative_sex:CWE, date_of_birth:dtm, living_dependency:CWE*, ambulatory_status:CWE*, citizenship:CWE*,
primary_language:CWE, living_arrangement:CWE, publicity_code:CWE, protection_indicator, student_indicator:CWE,
religion:CWE, mothers_maiden_names:XPN*, nationality:CWE, ethnic_group:CWE*, contact_reason:CWE*, contact_persons:XPN*,
contact_person_telephone:XTN*, contact_persons_address:XAD*, associated_party_identifiers:CX*, job_status:CWE, race:CWE*,
handicap:CWE, contact_ssn, birth_place, vip_indicator:CWE, telecommunication_info:XTN, contact_telecommunication_info:XTN
"""

MRG = """
prior_patient_id:CX*, prior_alternate_patient_id:CX*, prior_patient_account_number:CX, prior_patient_id_external:CX,
prior_visit_number:CX, prior_alternate_visit_id:CX, prior_patient_names:XPN*
"""

AL1 = """
set_id:seq, allergen_type_code:CWE, allergen_code:CWE, allergy_severity_code:CWE, allergy_reaction:CWE*,
identification_date:dtm
"""

IAM = """
set_id:seq, allergen_type_code:CWE, allergen_code:CWE, allergy_severity_code:CWE, allergy_reaction:CWE*,
allergy_action_code:CWE, allergy_unique_identifier:EI, action_reason, sensitivity_to_causative_agent_code:CWE,
allergen_group_code:CWE, onset_date:dtm, onset_date_text, reported_datetime:dtm, reported_by:XCN,
relationship_to_patient_code:CWE, alert_device_code:CWE, allergy_clinical_status_code:CWE, statused_by_person:XCN,
statused_by_organization:XON, statused_at_datetime:dtm, inactivated_by_person:XCN, inactivated_datetime:dtm,
initially_recorded_by_person:XCN, initially_recorded_datetime:dtm, modified_by_person:XCN, modified_datetime:dtm,
clinician_identified_allergen_code:CWE, initially_recorded_by_organization:XON, modified_by_organization:XON,
inactivated_by_organization:XON
"""

DG1 = """
set_id:seq, diagnosis_coding_method, diagnosis_code:CWE, diagnosis_description, diagnosis_datetime:dtm,
diagnosis_type:CWE, major_diagnostic_category:CWE, diagnostic_related_group:CWE, drg_approval_indicator,
drg_grouper_review_code:CWE, outlier_type:CWE, outlier_days:int, outlier_cost:CP, grouper_version_and_type,
diagnosis_priority:int, diagnosing_clinician:XCN*, diagnosis_classification:CWE, confidential_indicator,
attestation_datetime:dtm, diagnosis_identifier:EI, diagnosis_action_code, parent_diagnosis:EI, drg_ccl_value_code:CWE,
drg_grouping_usage, drg_diagnosis_determination_status:CWE, present_on_admission_indicator:CWE
"""

PR1 = """
set_id:seq, procedure_coding_method, procedure_code:CWE, procedure_description, procedure_datetime:dtm,
procedure_functional_type:CWE, procedure_minutes:int, anesthesiologist:XCN*, anesthesia_code:CWE, anesthesia_minutes:int,
surgeon:XCN*, procedure_practitioner:XCN*, consent_code:CWE, procedure_priority, associated_diagnosis_code:CWE,
procedure_code_modifier:CWE*, procedure_drg_type:CWE, tissue_type_code:CWE*, procedure_identifier:EI,
procedure_action_code, drg_procedure_determination_status:CWE, drg_procedure_relevance:CWE,
treating_organizational_unit:PL*, respiratory_within_surgery, parent_procedure_id:EI
"""

ORC = """
order_control, placer_order_number:EI, filler_order_number:EI, placer_group_number:EI, order_status, response_flag,
quantity_timing:TQ*, parent_order:EIP*, datetime_of_transaction:dtm, entered_by:XCN*, verified_by:XCN*,
ordering_provider:XCN*, enterers_location:PL, call_back_phone:XTN*, order_effective_datetime:dtm,
order_control_code_reason:CWE, entering_organization:CWE, entering_device:CWE, action_by:XCN*,
advanced_beneficiary_notice_code:CWE, ordering_facility_name:XON*, ordering_facility_address:XAD*,
ordering_facility_phone:XTN*, ordering_provider_address:XAD*, order_status_modifier:CWE, abn_override_reason:CWE,
fillers_expected_availability_datetime:dtm, confidentiality_code:CWE, order_type:CWE, enterer_authorization_mode:CWE,
parent_universal_service_id:CWE, advanced_beneficiary_notice_date:dtm, alternate_placer_order_number:CX*,
order_workflow_profile:CWE*, action_code, order_status_date_range:range, order_creation_datetime:dtm,
filler_order_group_number:EI
"""

OBR = """
set_id:seq, placer_order_number:EI, filler_order_number:EI, service:CWE, priority, requested_datetime:dtm,
observation_datetime:dtm, observation_end_datetime:dtm, collection_volume:CQ, collector:XCN*, specimen_action_code,
danger_code:CWE, relevant_clinical_information:CWE*, specimen_received_datetime:dtm, specimen_source:SPS,
ordering_provider:XCN*, order_callback_phone:XTN*, placer_field_1, placer_field_2, filler_field_1, filler_field_2,
results_rpt_status_chng_datetime:dtm, charge_to_practice:MOC, diagnostic_service_section, result_status,
parent_result:PRL, quantity_timing:TQ*, result_copies_to:XCN*, parent_results_observation_identifier:EIP,
transportation_mode, reason_for_study:CWE*, principal_result_interpreter:NDL, assistant_result_interpreter:NDL*,
technician:NDL*, transcriptionist:NDL*, scheduled_datetime:dtm, number_of_sample_containers:int, transport_logistics:CWE*,
collectors_comment:CWE*, transport_arrangement_responsibility:CWE, transport_arranged, escort_required,
planned_patient_transport_comment:CWE*, procedure_code:CWE, procedure_code_modifier:CWE*,
placer_supplemental_service_info:CWE*, filler_supplemental_service_info:CWE*, medically_necessary_dup_proc_reason:CWE,
result_handling:CWE, parent_universal_service_id:CWE, observation_group:EI, parent_observation_group:EI,
alternate_placer_order:CX*, parent_order:EIP*, action_code
"""

OBX = """
set_id:seq, value_type, observation_id:CWE, observation_sub_id:OG, observation_value:st*, units:CWE, references_range,
interpretation_codes:CWE*, probability, nature_of_abnormal_test:id*, observation_result_status,
effective_date_of_ref_range:dtm, user_defined_access_checks, datetime_of_observation:dtm, producers_id:CWE,
responsible_observer:XCN*, observation_method:CWE*, equipment_instance_identifier:EI*, datetime_of_analysis:dtm,
observation_site:CWE*, observation_instance_identifier:EI, mood_code:CWE, performing_organization:XON,
performing_org_address:XAD, performing_org_medical_director:XCN, patient_results_release_category, root_cause:CWE,
local_process_control:CWE*, observation_type, observation_sub_type, action_code, observation_value_absent_reason:CWE*,
observation_related_specimen:EIP*
"""

NTE = """
set_id:seq, source_of_comment, comment:st*, comment_type:CWE, entered_by:XCN, entered_datetime:dtm,
effective_start_date:dtm, expiration_date:dtm, coded_comment:CWE*
"""

SPM = """
set_id:seq, specimen_id:EIP, specimen_parent_ids:EIP*, specimen_type:CWE, specimen_type_modifier:CWE*,
specimen_additives:CWE*, specimen_collection_method:CWE, specimen_source_site:CWE, specimen_source_site_modifier:CWE*,
specimen_collection_site:CWE, specimen_role:CWE*, specimen_collection_amount:CQ, grouped_specimen_count:int,
specimen_description:st*, specimen_handling_code:CWE*, specimen_risk_code:CWE*, specimen_collection_datetime:range,
specimen_received_datetime:dtm, specimen_expiration_datetime:dtm, specimen_availability, specimen_reject_reason:CWE*,
specimen_quality:CWE, specimen_appropriateness:CWE, specimen_condition:CWE*, specimen_current_quantity:CQ,
number_of_specimen_containers:int, container_type:CWE, container_condition:CWE, specimen_child_role:CWE, accession_id:CX*,
other_specimen_id:CX*, shipment_id:EI, culture_start_datetime:dtm, culture_final_datetime:dtm, action_code
"""

IN1 = """
set_id:seq, insurance_plan:CWE, insurance_company:CX*, insurance_company_name:XON*, insurance_company_address:XAD*,
insurance_co_contacts:XPN*, insurance_co_phone_number:XTN*, group_number, group_name:XON*, insureds_group_emp:CX*,
insureds_group_emp_name:XON*, plan_effective_date:dtm, plan_expiration_date:dtm, authorization_information:AUI,
plan_type:CWE, insured_names:XPN*, insureds_relationship_to_patient:CWE, insureds_date_of_birth:dtm, insureds_address:XAD*,
assignment_of_benefits:CWE, coordination_of_benefits:CWE, coord_of_ben_priority, notice_of_admission_flag,
notice_of_admission_date:dtm, report_of_eligibility_flag, report_of_eligibility_date:dtm, release_information_code:CWE,
pre_admit_cert, verification_datetime:dtm, verification_by:XCN*, type_of_agreement_code:CWE, billing_status:CWE,
lifetime_reserve_days:int, delay_before_lr_day:int, company_plan_code:CWE, policy_number, policy_deductible:CP,
policy_limit_amount:CP, policy_limit_days:int, room_rate_semi_private:CP, room_rate_private:CP,
insureds_employment_status:CWE, insureds_administrative_sex:CWE, insureds_employers_address:XAD*, verification_status,
prior_insurance_plan_id:CWE, coverage_type:CWE, handicap:CWE, insureds_id_number:CX*, signature_code:CWE,
signature_code_date:dtm, insureds_birth_place, vip_indicator:CWE, external_health_plan_identifiers:CWE*,
insurance_action_code
"""

GT1 = """
set_id:seq, guarantor_number:CX*, guarantor_names:XPN*, guarantor_spouse_names:XPN*, guarantor_address:XAD*,
guarantor_ph_num_home:XTN*, guarantor_ph_num_business:XTN*, guarantor_date_of_birth:dtm, guarantor_administrative_sex:CWE,
guarantor_type:CWE, guarantor_relationship:CWE, guarantor_ssn, guarantor_date_begin:dtm, guarantor_date_end:dtm,
guarantor_priority:int, guarantor_employer_names:XPN*, guarantor_employer_address:XAD*,
guarantor_employer_phone_number:XTN*, guarantor_employee_id_number:CX*, guarantor_employment_status:CWE,
guarantor_organization_name:XON*, guarantor_billing_hold_flag, guarantor_credit_rating_code:CWE,
guarantor_death_date_and_time:dtm, guarantor_death_flag, guarantor_charge_adjustment_code:CWE,
guarantor_household_annual_income:CP, guarantor_household_size:int, guarantor_employer_id_number:CX*,
guarantor_marital_status_code:CWE, guarantor_hire_effective_date:dtm, employment_stop_date:dtm, living_dependency:CWE,
ambulatory_status:CWE*, citizenship:CWE*, primary_language:CWE, living_arrangement:CWE, publicity_code:CWE,
protection_indicator, student_indicator:CWE, religion:CWE, mothers_maiden_names:XPN*, nationality:CWE, ethnic_group:CWE*,
contact_persons:XPN*, contact_persons_telephone_number:XTN*, contact_reason:CWE, contact_relationship:CWE, job_title,
job_code_class:JCC, guarantor_employers_org_name:XON*, handicap:CWE, job_status:CWE, guarantor_financial_class:FC,
guarantor_race:CWE*, guarantor_birth_place, vip_indicator:CWE
"""

FT1 = """
set_id:seq, transaction_id:CX, transaction_batch_id, transaction_date:range, transaction_posting_date:dtm,
transaction_type:CWE, transaction_code:CWE, transaction_description, transaction_description_alt, transaction_quantity:int,
transaction_amount_extended:CP, transaction_amount_unit:CP, department_code:CWE, insurance_plan_id:CWE,
insurance_amount:CP, assigned_patient_location:PL, fee_schedule:CWE, patient_type:CWE, diagnosis_code:CWE*,
performed_by:XCN*, ordered_by:XCN*, unit_cost:CP, filler_order_number:EI, entered_by:XCN*, procedure_code:CWE,
procedure_code_modifier:CWE*, advanced_beneficiary_notice_code:CWE, medically_necessary_dup_proc_reason:CWE, ndc_code:CWE,
payment_reference_id:CX, transaction_reference_key:st*, performing_facility:XON*, ordering_facility:XON, item_number:CWE,
model_number, special_processing_code:CWE*, clinic_code:CWE, referral_number:CX, authorization_number:CX,
service_provider_taxonomy_code:CWE, revenue_code:CWE, prescription_number, ndc_qty_and_uom:CQ,
dme_certificate_of_medical_necessity_transmission_code:CWE, dme_certification_type_code:CWE, dme_duration_value,
dme_certification_revision_date, dme_initial_certification_date, dme_last_certification_date,
dme_length_of_medical_necessity_days, dme_rental_price:MO, dme_purchase_price:MO, dme_frequency_code:CWE,
dme_certification_condition_indicator, dme_condition_indicator_code:CWE*, service_reason_code:CWE
"""

RXA = """
set_id:seq, administration_sub_id_counter:int, datetime_start_of_administration:dtm, datetime_end_of_administration:dtm,
administered_code:CWE, administered_amount, administered_units:CWE, administered_dosage_form:CWE,
administration_notes:CWE*, administering_provider:XCN*, administered_at_location, administered_per_time_unit,
administered_strength, administered_strength_units:CWE, substance_lot_number:st*, substance_expiration_date:dtm*,
substance_manufacturer_name:CWE*, substance_treatment_refusal_reason:CWE*, indication:CWE*, completion_status,
action_code_rxa, system_entry_datetime:dtm, administered_drug_strength_volume, administered_drug_strength_volume_units:CWE,
administered_barcode_identifier:CWE, pharmacy_order_type, administer_at:PL, administered_at_address:XAD,
administered_tag_identifier:EI*
"""

SCH = """
placer_appointment_id:EI, filler_appointment_id:EI, occurrence_number:int, placer_group_number:EI, schedule_id:CWE,
event_reason:CWE, appointment_reason:CWE, appointment_type:CWE, appointment_duration:int, appointment_duration_units:CWE,
appointment_timing_quantity:first, placer_contact_person:XCN*, placer_contact_phone:XTN, placer_contact_address:XAD*,
placer_contact_location:PL, filler_contact_person:XCN*, filler_contact_phone:XTN, filler_contact_address:XAD*,
filler_contact_location:PL, entered_by_person:XCN*, entered_by_phone_number:XTN*, entered_by_location:PL,
parent_placer_appointment_id:EI, parent_filler_appointment_id:EI, filler_status_code:CWE, placer_order_number:EI*,
filler_order_number:EI*, alternate_placer_order_group_number:EIP
"""

TXA = """
set_id:seq, document_type:CWE, document_content_presentation, activity_datetime:dtm, primary_activity_provider:XCN*,
origination_datetime:dtm, transcription_datetime:dtm, edit_datetime:dtm*, originator:XCN*,
assigned_document_authenticator:XCN*, transcriptionist:XCN*, unique_document_number:EI, parent_document_number:EI,
placer_order_number:EI*, filler_order_number:EI, unique_document_file_name, document_completion_status,
document_confidentiality_status, document_availability_status, document_storage_status, document_change_reason,
authentication_person_time_stamp:XCN*, distributed_copies:XCN*, folder_assignment:CWE*, document_title:st*,
agreed_due_datetime:dtm, creating_facility:HD, creating_specialty:CWE
"""

SEGMENTS = {
    "MSH": MSH, "EVN": EVN, "PID": PID, "PD1": PD1, "PV1": PV1, "PV2": PV2, "NK1": NK1, "MRG": MRG, "AL1": AL1, "IAM": IAM,
    "DG1": DG1, "PR1": PR1, "ORC": ORC, "OBR": OBR, "OBX": OBX, "NTE": NTE, "SPM": SPM, "IN1": IN1, "GT1": GT1, "FT1": FT1,
    "RXA": RXA, "SCH": SCH, "TXA": TXA,
}
