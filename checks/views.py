"""Input views derived from the given tables, in SQL that Spark and DuckDB both run.

``{name}`` stands for a given table or another view. Spark gets it as a
DataFrame, the check SQL as a common table expression.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "supplier", "orders", "lineitem", "events", "part", "region")

_DOB_C = "make_date(cast(1940 + c_custkey % 60 as int), cast(1 + c_custkey % 12 as int), cast(1 + c_custkey % 28 as int))"
_DOB_S = _DOB_C.replace("c_custkey", "s_suppkey")
_FOUR_C = "lpad(cast(c_custkey % 10000 as string), 4, '0')"
_FOUR_S = _FOUR_C.replace("c_custkey", "s_suppkey")

VIEWS = {
    "phi_person": f"""
        select c_custkey as master_id, '0' || cast(1000000 + c_custkey as string) as mrn,
               'F' || cast(c_custkey % 97 as string) as first_name,
               case when c_custkey % 3 = 0 then null else 'M' || cast(c_custkey % 5 as string) end as middle_name,
               'L' || cast(c_custkey % 211 as string) as surname, {_DOB_C} as birth_date,
               case when c_custkey % 6 = 0 then 'MD' end as qualifications,
               case when c_custkey % 4 = 0 then 'Hon' end as honorifics,
               case when c_custkey % 2 = 0 then 'Dr' else 'Mx' end as title,
               'EHR_' || cast(c_nationkey as string) as source_system
        from {{customer}}
        union all
        select 1000000 + s_suppkey, '0' || cast(5000000 + s_suppkey as string),
               'F' || cast(s_suppkey % 97 as string), cast(null as string),
               'L' || cast(s_suppkey % 211 as string), {_DOB_S},
               cast(null as string), cast(null as string), cast(null as string), 'EHR_dup'
        from {{supplier}}""",
    "phi_telecom": f"""
        select c_custkey as master_id, '(858) 555-' || {_FOUR_C} as value, cast(2000000400 as bigint) as use_concept_id
        from {{customer}} where c_custkey % 5 <> 4
        union all
        select c_custkey, '858 557-' || {_FOUR_C}, cast(2000000400 as bigint) from {{customer}} where c_custkey % 30 = 2
        union all
        select c_custkey, '858-556-' || {_FOUR_C}, cast(2000000401 as bigint) from {{customer}} where c_custkey % 2 = 0
        union all
        select c_custkey, 'u' || cast(c_custkey as string) || '@ex.org', cast(2000000405 as bigint)
        from {{customer}} where c_custkey % 7 <> 6
        union all
        select 1000000 + s_suppkey, '(858) 555-' || {_FOUR_S}, cast(2000000400 as bigint) from {{supplier}}""",
    "phi_location": """
        select c_custkey as master_id,
               cast(c_custkey as string) || ' Main St City' || cast(c_nationkey as string) || ' CA 92'
                 || lpad(cast(c_custkey % 1000 as string), 3, '0') as value,
               cast(2000000511 as bigint) as use_concept_id
        from {customer} where c_custkey % 8 <> 7""",
    "phi_identifier": """
        select 0 as preferred_record, master_id, source_id, id_use_concept_id,
               'use ' || cast(id_use_concept_id as string) as id_use_source_value,
               id_use_concept_id as id_use_source_concept_id, identifier, id_type_concept_id,
               'type ' || cast(id_type_concept_id as string) as id_type_source_value,
               id_type_concept_id as id_type_source_concept_id, 'registry' as system,
               make_date(1970, 1, 1) as period_start_date, make_date(2099, 12, 31) as period_end_date,
               'registry' as assigner
        from (
          select master_id, 700000 + master_id as source_id, mrn as identifier,
                 cast(2000000803 as bigint) as id_type_concept_id, cast(2000000713 as bigint) as id_use_concept_id
          from {phi_person}
          union all
          select c_custkey, 700000 + c_custkey, cast(500000 + c_custkey as string),
                 cast(2000000812 as bigint), cast(2000000706 as bigint)
          from {customer} where c_custkey % 10 <> 9
          union all
          select c_custkey, 700000 + c_custkey, 'P' || cast(100000 + c_custkey as string),
                 cast(2000000813 as bigint), cast(2000000704 as bigint)
          from {customer} where c_custkey % 4 = 0
          union all
          select case when c_custkey % 14 = 0 then null else c_custkey end,
                 case when c_custkey % 14 = 0 then null else 700000 + c_custkey end,
                 cast(c_custkey as string), cast(2000000814 as bigint), cast(2000000720 as bigint)
          from {customer} where c_custkey % 7 = 0
          union all
          select c_custkey, 700000 + c_custkey, 'P' || cast(7000000 + c_custkey as string),
                 cast(2000000813 as bigint), cast(2000000704 as bigint)
          from {customer} where c_custkey % 40 = 0
          union all
          select c_custkey, 700000 + c_custkey, 'A' || cast(100000 + c_custkey as string),
                 cast(2000000813 as bigint), cast(2000000704 as bigint)
          from {customer} where c_custkey % 60 = 0
          union all
          select c_custkey, 800000 + c_custkey, '0' || cast(9000000 + c_custkey as string),
                 cast(2000000803 as bigint), cast(2000000713 as bigint)
          from {customer} where c_custkey % 50 = 1
        ) ids""",
    "workqueue": f"""
        select 'P' || cast(100000 + c_custkey as string) as pmi_id,
               case when c_custkey % 10 = 1 then 'X' when c_custkey % 16 = 5 then 'f' else 'F' end
                 || cast(c_custkey % 97 as string) as first_name,
               case when c_custkey % 10 = 3 then 'Y' else 'L' end || cast(c_custkey % 211 as string)
                 || case when c_custkey % 14 = 3 then '  ' else '' end as last_name,
               {_DOB_C} as birth_date,
               case when c_custkey % 5 = 0 then '' else 'u' || cast(c_custkey as string) || '@ex.org' end as email,
               case when c_custkey % 6 = 0 then null
                    when c_custkey % 6 = 1 then '858 556 ' || {_FOUR_C}
                    else '858555' || {_FOUR_C} end as phone,
               cast(c_custkey as string) || ' Main St' as street_address,
               case when c_custkey % 9 = 0 then null else 'City' || cast(c_nationkey as string) end as city,
               case when c_custkey % 2 = 0 then 'CA' else 'CA,' end as state,
               '92' || lpad(cast(c_custkey % 1000 as string), 3, '0') as zip,
               case c_custkey % 5 when 0 then 'home_biobank' when 1 then '' when 2 then 'partner_biobank'
                    when 3 then 'home_gateway' else 'other' end as physical_measurements_location,
               case c_custkey % 4 when 0 then '' when 1 then 'partner_clinic' when 2 then 'home_clinic'
                    else 'other' end as biospecimens_location
        from {{customer}} where c_custkey % 3 <> 2""",
    "roster_master": f"""
        select cast(c_custkey as string) as study_id, 0 as duplicate_record___yes,
               case when c_custkey % 5 = 0 then null
                    when c_custkey % 111 = 7 then '0' || cast(8000000 + c_custkey as string)
                    when c_custkey % 5 = 1 then cast(1000000 + c_custkey as string)
                    else '0' || cast(1000000 + c_custkey as string) end as mrn,
               'F' || cast(c_custkey % 97 as string) as first_name, 'L' || cast(c_custkey % 211 as string) as last_name,
               case when c_custkey % 45 = 0 then make_date(1900, 1, 1) else {_DOB_C} end as dob,
               cast(c_custkey as string) || ' Main St' as street_address_line_1, cast(null as string) as street_address_line_2,
               'City' || cast(c_nationkey as string) as city, 'CA' as state,
               '92' || lpad(cast(c_custkey % 1000 as string), 3, '0') as zip_code,
               case when c_custkey % 20 = 0 then 'x' else 'u' end || cast(c_custkey as string) || '@ex.org' as email_address,
               case when c_custkey % 15 = 0 then null else '858-555-' || {_FOUR_C} end as phone_number,
               case when c_custkey % 3 = 0 then null else 'P' || cast(100000 + c_custkey as string) end as pmi_id,
               0 as withdrawn___yes, cast(null as date) as withdrawn_date,
               cast(null as string) as withdrawn_recorded_in_healthpro,
               cast(null as timestamp) as update_date, 'first load' as source,
               cast(null as string) as deleted_in_CTRI_Redcap
        from {{customer}} where c_custkey % 4 <> 3""",
    "roster_staging": f"""
        select cast(c_custkey as string) as study_id, case when c_custkey % 50 = 1 then 1 else 0 end as duplicate_record___yes,
               case when c_custkey % 5 = 0 then null else '0' || cast(1000000 + c_custkey as string) end as mrn,
               case when c_custkey % 40 = 39 then null else 'F' || cast(c_custkey % 97 as string) end as first_name,
               'L' || cast(c_custkey % 211 as string) as last_name, {_DOB_C} as dob,
               cast(c_custkey as string) || ' Main St' as street_address_line_1,
               case when c_custkey % 17 = 0 then 'Apt ' || cast(c_custkey % 30 as string) end as street_address_line_2,
               'City' || cast(c_nationkey as string) as city, 'CA' as state,
               '92' || lpad(cast(c_custkey % 1000 as string), 3, '0') as zip_code,
               'u' || cast(c_custkey as string) || '@ex.org' as email_address,
               case when c_custkey % 11 = 0 then null else '(858) 555-' || {_FOUR_C} end as phone_number,
               'P' || cast(100000 + c_custkey as string) as pmi_id,
               case when c_custkey % 13 = 0 then 1 else 0 end as withdrawn___yes,
               case when c_custkey % 13 = 0 then make_date(2018, 5, cast(1 + c_custkey % 28 as int)) end as withdrawn_date,
               case when c_custkey % 13 = 0 then 'yes' end as withdrawn_recorded_in_healthpro
        from {{customer}} where c_custkey % 6 <> 5
        union all
        select cast(900000 + s_suppkey as string), 0, '0' || cast(1000000 + s_suppkey as string),
               'F' || cast(s_suppkey % 97 as string), 'L' || cast(s_suppkey % 211 as string), {_DOB_S},
               cast(s_suppkey as string) || ' Side St', cast(null as string), 'City' || cast(s_nationkey as string), 'CA',
               '92' || lpad(cast(s_suppkey % 1000 as string), 3, '0'),
               'u' || cast(s_suppkey as string) || '@ex.org',
               case when s_suppkey % 11 = 0 then null else '(858) 555-' || {_FOUR_S} end,
               'P' || cast(100000 + s_suppkey as string), 0, cast(null as date), cast(null as string)
        from {{supplier}}""",
    "patient_src": """
        select mrn, first_name as pat_first_name, surname as pat_last_name, birth_date from {phi_person}""",
    "person": """
        select 500000 + c_custkey as person_id,
               cast(case when c_custkey % 2 = 0 then 8507 else 8532 end as bigint) as gender_concept_id,
               cast(1940 + c_custkey % 60 as int) as year_of_birth, cast(1 + c_custkey % 12 as int) as month_of_birth,
               case when c_custkey % 25 = 0 then null else cast(1 + c_custkey % 31 as int) end as day_of_birth,
               8500 + c_custkey % 7 as race_concept_id, 38003563 + c_custkey % 2 as ethnicity_concept_id,
               cast(c_nationkey as bigint) as location_id, c_custkey % 13 as provider_id, c_custkey % 3 as care_site_id,
               c_mktsegment as person_source_value, case when c_custkey % 2 = 0 then 'M' else 'F' end as gender_source_value,
               cast(0 as bigint) as gender_source_concept_id, 'R' || cast(c_custkey % 7 as string) as race_source_value,
               cast(0 as bigint) as race_source_concept_id, 'E' || cast(c_custkey % 2 as string) as ethnicity_source_value,
               cast(0 as bigint) as ethnicity_source_concept_id
        from {customer}""",
    "visit_occurrence": """
        select o_orderkey as visit_occurrence_id, 500000 + o_custkey as person_id, 9201 + o_orderkey % 3 as visit_concept_id,
               cast(o_orderdate as date) as visit_start_date,
               cast(o_orderdate as date) + cast(o_orderkey % 5 as int) as visit_end_date,
               cast(44818517 as bigint) as visit_type_concept_id, o_orderkey % 13 as provider_id,
               o_orderkey % 3 as care_site_id, o_orderpriority as visit_source_value,
               cast(0 as bigint) as visit_source_concept_id, cast(8870 as bigint) as admitting_source_concept_id,
               o_orderstatus as admitting_source_value, cast(8536 as bigint) as discharge_to_concept_id,
               'home' as discharge_to_source_value,
               case when o_orderkey > 1 then o_orderkey - 1 end as preceding_visit_occurrence_id
        from {orders}""",
    "condition_occurrence": """
        select event_id as condition_occurrence_id, 500000 + user_id as person_id, 31967 + event_id % 5 as condition_concept_id,
               cast(ts as date) as condition_start_date, ts as condition_start_datetime,
               cast(ts as date) + 1 as condition_end_date, ts as condition_end_datetime,
               cast(38000175 as bigint) as condition_type_concept_id,
               case when event_id % 9 = 0 then 'resolved' end as stop_reason, event_id % 1000 as visit_occurrence_id,
               event_type as condition_source_value, cast(0 as bigint) as condition_source_concept_id,
               'final' as condition_status_source_value, cast(4230359 as bigint) as condition_status_concept_id
        from {events}""",
    "procedure_occurrence": """
        select event_id as procedure_occurrence_id, 500000 + user_id as person_id, 4000000 + event_id % 7 as procedure_concept_id,
               cast(ts as date) as procedure_date, ts as procedure_datetime,
               cast(38000275 as bigint) as procedure_type_concept_id, value as quantity,
               event_id % 1000 as visit_occurrence_id, event_type as procedure_source_value,
               cast(0 as bigint) as procedure_source_concept_id, 'none' as qualifier_source_value
        from {events}""",
    "measurement": """
        select l_orderkey * 10 + l_linenumber as measurement_id, 500000 + o_custkey as person_id,
               3000000 + l_partkey as measurement_concept_id, cast(l_shipdate as date) as measurement_date,
               l_shipdate as measurement_datetime, cast(44818702 as bigint) as measurement_type_concept_id,
               l_extendedprice as value_as_number, cast(8840 as bigint) as unit_concept_id,
               l_discount as range_low, l_tax as range_high, l_orderkey as visit_occurrence_id,
               cast(l_partkey as string) as measurement_source_value, l_suppkey as measurement_source_concept_id,
               l_returnflag as unit_source_value, l_linestatus as value_source_value
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "drug_exposure": """
        select l_partkey * 10 + l_linenumber as drug_exposure_id, 500000 + o_custkey as person_id,
               1000000 + l_partkey as drug_concept_id, cast(l_shipdate as date) as drug_exposure_start_date,
               l_shipdate as drug_exposure_start_datetime, cast(l_shipdate as date) + 30 as drug_exposure_end_date,
               l_shipdate as drug_exposure_end_datetime, cast(l_shipdate as date) + 31 as verbatim_end_date,
               cast(38000177 as bigint) as drug_type_concept_id,
               case when l_linenumber = 1 then 'done' end as stop_reason, l_linenumber as refills,
               l_quantity as quantity, l_linenumber * 30 as days_supply, 'daily' as sig,
               cast(4132161 as bigint) as route_concept_id, cast(l_suppkey as string) as lot_number,
               l_orderkey as visit_occurrence_id, cast(l_partkey as string) as drug_source_value,
               cast(0 as bigint) as drug_source_concept_id, l_linestatus as route_source_value, 'mg' as dose_unit_source_value
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "concept": """
        select p_partkey as concept_id, p_name as concept_name, 'Drug' as domain_id, 'Local' as vocabulary_id,
               p_type as concept_class_id, 'S' as standard_concept, cast(p_partkey as string) as concept_code,
               make_date(2000, 1, 1) as valid_start_date, make_date(2099, 12, 31) as valid_end_date,
               case when p_size > 45 then 'D' end as invalid_reason
        from {part}
        union all
        select 2000000299 + r_regionkey, 'Seeded ' || r_name, 'Identity Management', 'IDENTITY', 'System ID',
               cast(null as string), r_name, make_date(2014, 1, 1), make_date(2099, 12, 31), cast(null as string)
        from {region}""",
}


def placeholders(text: str) -> list[str]:
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(text) if name))


class Inputs:
    """The given tables under a directory and the views on them, made when asked for."""

    def __init__(self, spark: SparkSession, directory: str):
        self._spark = spark
        self._directory = directory
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                frame = self._spark.read.parquet(f"{self._directory}/{name}.parquet")
            elif name in VIEWS:
                text = VIEWS[name]
                frame = self._spark.sql(text, **{n: getattr(self, n) for n in placeholders(text)})
            else:
                raise AttributeError(name)
            self._frames[name] = frame
        return self._frames[name]


def as_sql(text: str, extra: dict[str, str]) -> str:
    """One statement for DuckDB: the views that ``text`` needs as CTEs, then the query."""
    known = {**VIEWS, **extra}
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for inner in placeholders(known[name]):
            add(inner)
        ordered.append(name)

    for name in placeholders(text):
        add(name)
    ctes = ",\n".join(
        f"{name} as ({known[name].format(**{n: n for n in placeholders(known[name])})})" for name in ordered
    )
    query = text.format(**{n: n for n in placeholders(text)})
    return f"with {ctes}\n{query}" if ctes else query
