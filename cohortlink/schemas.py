"""Explicit schemas of the input and output tables.

Column names are fixed values: they are those of the files and tables read and
published.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
}


def _schema(text: str) -> T.StructType:
    """Build a schema from ``type: name name ...`` lines, keeping their order."""
    out = T.StructType()
    for line in text.strip().splitlines():
        kind, names = line.split(":")
        for name in names.split():
            out = out.add(name, _TYPES[kind.strip()])
    return out


PHI_PERSON = _schema("""
    long: master_id
    string: mrn first_name middle_name surname
    date: birth_date
    string: qualifications honorifics title source_system
""")

PHI_TELECOM = _schema("""
    long: master_id
    string: value
    long: use_concept_id
""")

PHI_LOCATION = PHI_TELECOM

PHI_IDENTIFIER = _schema("""
    int: preferred_record
    long: master_id source_id id_use_concept_id
    string: id_use_source_value
    long: id_use_source_concept_id
    string: identifier
    long: id_type_concept_id
    string: id_type_source_value
    long: id_type_source_concept_id
    string: system
    date: period_start_date period_end_date
    string: assigner
""")

CONCEPT = _schema("""
    long: concept_id
    string: concept_name domain_id vocabulary_id concept_class_id standard_concept concept_code
    date: valid_start_date valid_end_date
    string: invalid_reason
""")

DOMAIN = _schema("""
    string: domain_id domain_name
    long: domain_concept_id
""")

VOCABULARY = _schema("""
    string: vocabulary_id vocabulary_name vocabulary_reference vocabulary_version
    long: vocabulary_concept_id
""")

CONCEPT_CLASS = _schema("""
    string: concept_class_id concept_class_name
    long: concept_class_concept_id
""")

WORKQUEUE = _schema("""
    string: pmi_id first_name last_name
    date: birth_date
    string: email phone street_address city state zip
    string: physical_measurements_location biospecimens_location
""")

ROSTER_STAGING = _schema("""
    string: study_id
    int: duplicate_record___yes
    string: mrn first_name last_name
    date: dob
    string: street_address_line_1 street_address_line_2 city state zip_code
    string: email_address phone_number pmi_id
    int: withdrawn___yes
    date: withdrawn_date
    string: withdrawn_recorded_in_healthpro
""")

ROSTER_MASTER = T.StructType(
    ROSTER_STAGING.fields
    + [
        T.StructField("update_date", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("deleted_in_CTRI_Redcap", T.StringType()),
    ]
)

PATIENT_SRC = _schema("""
    string: mrn pat_first_name pat_last_name
    date: birth_date
""")

PERSON = _schema("""
    long: person_id gender_concept_id
    int: year_of_birth month_of_birth day_of_birth
    long: race_concept_id ethnicity_concept_id location_id provider_id care_site_id
    string: person_source_value gender_source_value
    long: gender_source_concept_id
    string: race_source_value
    long: race_source_concept_id
    string: ethnicity_source_value
    long: ethnicity_source_concept_id
""")

VISIT_OCCURRENCE = _schema("""
    long: visit_occurrence_id person_id visit_concept_id
    date: visit_start_date visit_end_date
    long: visit_type_concept_id provider_id care_site_id
    string: visit_source_value
    long: visit_source_concept_id admitting_source_concept_id
    string: admitting_source_value
    long: discharge_to_concept_id
    string: discharge_to_source_value
    long: preceding_visit_occurrence_id
""")

CONDITION_OCCURRENCE = _schema("""
    long: condition_occurrence_id person_id condition_concept_id
    date: condition_start_date
    timestamp: condition_start_datetime
    date: condition_end_date
    timestamp: condition_end_datetime
    long: condition_type_concept_id
    string: stop_reason
    long: visit_occurrence_id
    string: condition_source_value
    long: condition_source_concept_id
    string: condition_status_source_value
    long: condition_status_concept_id
""")

PROCEDURE_OCCURRENCE = _schema("""
    long: procedure_occurrence_id person_id procedure_concept_id
    date: procedure_date
    timestamp: procedure_datetime
    long: procedure_type_concept_id
    double: quantity
    long: visit_occurrence_id
    string: procedure_source_value
    long: procedure_source_concept_id
    string: qualifier_source_value
""")

MEASUREMENT = _schema("""
    long: measurement_id person_id measurement_concept_id
    date: measurement_date
    timestamp: measurement_datetime
    long: measurement_type_concept_id
    double: value_as_number
    long: unit_concept_id
    double: range_low range_high
    long: visit_occurrence_id
    string: measurement_source_value
    long: measurement_source_concept_id
    string: unit_source_value value_source_value
""")

DRUG_EXPOSURE = _schema("""
    long: drug_exposure_id person_id drug_concept_id
    date: drug_exposure_start_date
    timestamp: drug_exposure_start_datetime
    date: drug_exposure_end_date
    timestamp: drug_exposure_end_datetime
    date: verbatim_end_date
    long: drug_type_concept_id
    string: stop_reason
    int: refills
    double: quantity
    int: days_supply
    string: sig
    long: route_concept_id
    string: lot_number
    long: visit_occurrence_id
    string: drug_source_value
    long: drug_source_concept_id
    string: route_source_value dose_unit_source_value
""")

PII_NAME = _schema("""
    long: person_id
    string: first_name middle_name last_name suffix prefix
""")

PII_EMAIL = _schema("""
    long: person_id
    string: email
""")

PII_PHONE_NUMBER = _schema("""
    long: person_id
    string: phone_number
""")

PII_ADDRESS = _schema("""
    long: person_id location_id
""")

PII_MRN = _schema("""
    long: person_id
    string: health_system mrn
""")

# Declared text lengths of the published tables, checked by quality.too_long.
PII_LENGTHS = {
    "pii_name": {"first_name": 50, "middle_name": 50, "last_name": 50, "suffix": 50, "prefix": 50},
    "pii_email": {"email": 100},
    "pii_phone_number": {"phone_number": 50},
    "pii_mrn": {"health_system": 50, "mrn": 50},
}
