"""Schemas of the target tables (types of the reference's sinks, in Spark terms)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(spec: str) -> StructType:
    kinds = {"STRING": StringType(), "INTEGER": LongType(), "FLOAT": DoubleType(), "BOOLEAN": BooleanType(),
             "DATE": DateType()}
    fields = []
    for part in spec.split(","):
        name, kind = part.strip().split(":")
        fields.append(StructField(name, kinds[kind], True))
    return StructType(fields)


# Fixed values that must equal the reference's: names and types of the target tables' columns.
EMPLOYER = _schema(
    "employer_id:STRING,employer_name:STRING,employer_address:STRING,employer_city:STRING,employer_state:STRING,"
    "employer_postal_code:STRING,employer_country:STRING,employer_province:STRING,employer_phone:STRING,"
    "h1b_dependent:BOOLEAN,willful_violator:BOOLEAN")
JOB = _schema(
    "job_id:STRING,employer_id:STRING,employment_start_year:INTEGER,employment_start_date:DATE,"
    "employment_end_date:DATE,job_title:STRING,wage_rate_of_pay_from:FLOAT,wage_rate_of_pay_to:FLOAT,"
    "wage_unit_of_pay:STRING,worksite_city:STRING,worksite_county:STRING,worksite_state:STRING,"
    "worksite_postal_code:STRING,soc_code:STRING,soc_name:STRING,total_workers:INTEGER,full_time_position:BOOLEAN,"
    "prevailing_wage:FLOAT,pw_unit_of_pay:STRING,pw_source:STRING,pw_source_year:STRING,pw_source_other:STRING")
APPLICATION = _schema(
    "case_number:STRING,case_status:STRING,case_submitted:DATE,decision_date:DATE,visa_class:STRING,"
    "employer_id:STRING,attorney_id:STRING")
ATTORNEY = _schema("attorney_id:STRING,attorney_name:STRING,attorney_city:STRING,attorney_state:STRING")
REGISTRATIONS = _schema(
    "corporation_id:STRING,corporation_name:STRING,corporation_city:STRING,corporation_state:STRING,"
    "registration_date:DATE")
WAGES = _schema("area:INTEGER,year:INTEGER,soc_code:STRING,annual_salary:FLOAT")
GEOGRAPHY = _schema("area:INTEGER,year:INTEGER,state:STRING,county:STRING")
NEW_APPLICATION = _schema(
    "case_number:STRING,case_status:STRING,case_submitted:DATE,decision_date:DATE,visa_class:STRING,"
    "employer_name:STRING,employer_city:STRING,employer_state:STRING,agent_representing_employer:STRING,"
    "agent_attorney_name:STRING,agent_attorney_city:STRING,agent_attorney_state:STRING")
NEW_JOB = _schema(
    "employment_start_date:DATE,employment_end_date:DATE,job_title:STRING,soc_code:STRING,soc_name:STRING,"
    "total_workers:INTEGER,full_time_position:BOOLEAN,prevailing_wage:FLOAT,pw_unit_of_pay:STRING,pw_source:STRING,"
    "pw_source_year:STRING,pw_source_other:STRING,wage_rate_of_pay_from:FLOAT,wage_rate_of_pay_to:FLOAT,"
    "wage_unit_of_pay:STRING,worksite_city:STRING,worksite_county:STRING,worksite_state:STRING,"
    "worksite_postal_code:STRING,employer_name:STRING,employer_city:STRING,employer_state:STRING")
NEW_EMPLOYER = _schema(
    "employer_name:STRING,employer_address:STRING,employer_city:STRING,employer_state:STRING,"
    "employer_postal_code:STRING,employer_country:STRING,employer_province:STRING,employer_phone:STRING,"
    "h1b_dependent:BOOLEAN,willful_violator:BOOLEAN")
NEW_ATTORNEY = _schema(
    "agent_representing_employer:STRING,agent_attorney_name:STRING,agent_attorney_city:STRING,"
    "agent_attorney_state:STRING")


def conform(df: DataFrame, schema: StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Select the schema's columns by name, cast to its types.

    A missing column raises, unless it is named in ``optional``: then it is null.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns and f.name not in optional]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
