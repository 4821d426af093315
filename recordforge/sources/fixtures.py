"""Adapters: staging-shaped inputs derived from the driver's tables.

The reference's raw inputs (yearly application tables, 13 state registries, wage and
geography tables, one wide TSV extract) are not available, so each is derived here from
``orders`` / ``customer`` with plain column expressions.  Every derived frame grows with
the tables it is read from: applications are one row per order, registrations one row per
customer, geography 4 rows and wages 24 rows per customer.

Notation used in the comments: k = o_orderkey, c = customer key, b = c div 3 (three
customers share a company name), i = b % 25 (city number), yr = 2015 + k % 4,
w = floor(o_totalprice / 5), ST(x) = two-letter state number x % 15 of STATE_CODES.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.operators.branches import SharedTables

# Fixed values of the fixtures: 13 registry states followed by TX and FL, two letters each.
STATE_CODES = "AZCACOCTGAMAMNMONCNYOHVAWATXFL"
REGISTRY_STATES = ("AZ", "CA", "CO", "CT", "GA", "MA", "MN", "MO", "NC", "NY", "OH", "VA", "WA")
YEARS = (2015, 2016, 2017, 2018)
SOC_NAMES = (
    "SOFTWARE DEVELOPERS, APPLICATIONS",
    "COMPUTER SYSTEMS ANALYSTS",
    "ELECTRONICS ENGINEERS, EXCEPT COMPUTER",
    "ACCOUNTANTS",
    "DATABASE ADMINISTRATORS",
    "REGISTERED NURSES",
)
NAME_SUFFIXES = (", INC.", " LLC", " CORPORATION", " CORP.", " LTD", " (USA) LP", " &QUOT;PC&QUOT;", "")
USA = "UNITED STATES OF AMERICA"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; read anew on every call, so that a plan always sees the files present now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def on_all_cores(df: DataFrame) -> DataFrame:
    """Rows of a source with fewer splits than the session has cores, dealt over all cores; others as they are.

    A source of many files is not shuffled.  One small file is a single task, whatever is computed from its rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def state_code(x: Column) -> Column:
    """ST(x): the two letters at position x % 15 of STATE_CODES."""
    return F.substr(F.lit(STATE_CODES), (x % 15) * 2 + 1, F.lit(2))


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    out = F.lit(None).cast("string")
    for pos in range(len(values) - 1, -1, -1):
        out = F.when(index == pos, F.lit(values[pos])).otherwise(out)
    return out


def _s(x: Column) -> Column:
    return x.cast("string")


def _named(*kept: str, **columns: Column) -> dict[str, Column]:
    """Columns by name: those taken as they are, then the computed ones."""
    return {**{n: F.col(n) for n in kept}, **columns}


# --------------------------------------------------------------------------------------
# Applications (one row per order), then the four yearly tables with their schema drift.
# --------------------------------------------------------------------------------------

def applications_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All application fields in clean types, one row per order (before year drift)."""
    # every row becomes some forty columns
    o = on_all_cores(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))
    k, c = F.col("k"), F.col("c")
    b = F.expr("c div 3")
    i = b % 25
    base = o.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c"),
        F.floor(F.col("o_totalprice") / 5).cast("double").alias("w"),
    ).withColumns({"b": b, "yr": (F.lit(2015) + F.col("k") % 4).cast("int")}).withColumn("i", i)
    b, i, yr, w = F.col("b"), F.col("i"), F.col("yr"), F.col("w")
    start = F.make_date(yr, (k % 12 + 1).cast("int"), (k % 28 + 1).cast("int"))
    end = F.make_date(yr + 3, (k % 12 + 1).cast("int"), (k % 28 + 1).cast("int"))
    soc_name = _pick(k % 6, SOC_NAMES)
    soc_code = F.concat(F.lit("15-113"), _s(k % 6), F.lit(".00"))
    swap = k % 19 == 0
    ws_shift = k % 17 == 0
    return base.select(
        "k", "c", "b", "i", "yr", "w",
        F.concat(F.lit("I-200-"), _s(k)).alias("case_number"),
        F.when(k % 3 == 0, "CERTIFIED").otherwise("DENIED").alias("case_status"),
        F.when(k % 10 == 0, "E-3 Australian").otherwise("H-1B").alias("visa_class"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .when(k % 89 == 0, F.lit("1"))
        .otherwise(F.concat(F.lit("CUSTOMER "), _s(b), _pick(c % 8, NAME_SUFFIXES))).alias("employer_name"),
        F.concat(_s(k % 200), F.lit(" MAIN ST")).alias("employer_address"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("SUITE "), _s(k % 9))).alias("employer_address2"),
        F.when(k % 101 == 0, F.lit(None).cast("string"))
        .when(c % 23 == 0, F.lit("78701"))
        .when(c % 29 == 0, F.lit("12 MAIN ST"))
        .when(c % 7 == 0, F.concat(F.lit(" CITY "), _s(i), F.lit(", ")))
        .when(c % 67 == 0, F.lit(" , "))
        .otherwise(F.concat(F.lit("CITY "), _s(i))).alias("employer_city"),
        F.when(c % 31 == 0, F.lit("AUSTIN"))
        .when(c % 37 == 0, F.lit(None).cast("string"))
        .otherwise(state_code(i)).alias("employer_state"),
        F.when(c % 41 == 0, F.lit("TX"))
        .when(c % 43 == 0, F.lit(None).cast("string"))
        .otherwise(_s(b + 70000)).alias("employer_postal_code"),
        F.when(c % 47 == 0, F.lit("78799")).otherwise(F.lit(USA)).alias("employer_country"),
        F.when(c % 53 == 0, F.lit(USA)).otherwise(F.lit(None).cast("string")).alias("employer_province"),
        F.when(c % 59 == 0, F.lit(None).cast("bigint")).otherwise(F.lit(5125550000) + b % 10000).alias("phone_number"),
        (c % 2 == 0).alias("h1b_dependent"),
        (c % 5 == 0).alias("willful_violator"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("ATTORNEY "), _s(k % 60))).alias("agent_attorney_name"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("CITY "), _s(k % 12))).alias("agent_attorney_city"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(state_code(k % 24)).alias("agent_attorney_state"),
        F.when(k % 113 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("TITLE "), _s(k % 50))).alias("job_title"),
        start.alias("employment_start_date"),
        end.alias("employment_end_date"),
        F.date_sub(start, 90).alias("case_submitted"),
        F.date_sub(start, 30).alias("decision_date"),
        F.when(k % 7 == 0, "Hour").otherwise("Year").alias("wage_unit_of_pay"),
        F.when(ws_shift, F.lit("SHIFT")).otherwise(F.concat(F.lit("CITY "), _s(i))).alias("worksite_city"),
        F.when(ws_shift, F.concat(F.lit("CITY "), _s(i)))
        .when(k % 43 == 0, F.concat(state_code(c), F.lit(" COUNTY")))
        .when(k % 67 == 0, F.lit("1234"))
        .otherwise(F.concat(F.lit("KING "), _s(c), F.lit(" COUNTY"))).alias("worksite_county"),
        F.when(ws_shift, F.concat(F.lit("KING "), _s(c), F.lit(" COUNTY"))).otherwise(state_code(c)).alias("worksite_state"),
        F.when(ws_shift, state_code(c))
        .when(k % 61 == 0, F.lit(None).cast("string"))
        .otherwise(_s(b + 70000)).alias("worksite_postal_code"),
        F.when(swap, soc_name).otherwise(soc_code).alias("soc_code"),
        F.when(swap, soc_code).otherwise(soc_name).alias("soc_name"),
        w.alias("wage_rate_of_pay_from"),
        F.when(k % 3 == 0, F.lit(0.0).cast("double")).otherwise(w + 5000).alias("wage_rate_of_pay_to"),
        F.when(k % 71 == 0, F.lit("65000"))
        .when(k % 73 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("Year")).alias("pw_unit_of_pay"),
        (w - 1000).alias("prevailing_wage"),
        F.lit("OES").alias("pw_source"),
        (F.lit(2015) + k % 3).cast("bigint").alias("pw_source_year"),
        F.lit("OFLC ONLINE DATA CENTER").alias("pw_source_other"),
        (k % 9 + 1).cast("bigint").alias("total_workers"),
        (k % 4 != 0).alias("full_time_position"),
    )


def shared_applications(spark: SparkSession, sf_dir: str) -> SharedTables:
    """The four yearly application tables, each with its own column names and types, over one scan of the orders."""
    k = F.col("k")
    common = [
        "case_number", "case_status", "visa_class", "employer_name", "employer_city", "employer_state",
        "employer_postal_code", "employer_country", "employer_province", "willful_violator",
        "agent_attorney_name", "agent_attorney_city", "agent_attorney_state", "job_title", "wage_unit_of_pay",
        "worksite_city", "worksite_county", "worksite_state", "worksite_postal_code", "soc_code", "soc_name",
        "total_workers", "pw_unit_of_pay",
    ]
    phone_text = F.concat(_s(F.col("phone_number")), F.lit(".0"))
    date_text = {n: _s(F.col(n)) for n in ("employment_start_date", "employment_end_date")}
    case_text = {n: F.when(k % 83 == 0, F.lit("N/A")).otherwise(_s(F.col(n))) for n in ("case_submitted", "decision_date")}
    ftp_text = (
        F.when(k % 8 == 1, F.lit("Y"))
        .when(F.col("full_time_position"), F.lit("true"))
        .otherwise(F.lit("false"))
    )
    out: dict[int, dict[str, Column]] = {}
    out[2018] = _named(
        *common, "employer_address", "employment_start_date", "employment_end_date", "wage_rate_of_pay_to",
        "pw_source", "pw_source_year", "pw_source_other", "case_submitted", "decision_date",
        employer_phone=F.col("phone_number"),
        h1b_dependent=F.when(F.col("h1b_dependent"), "Y").otherwise("N"),
        wage_rate_of_pay_from=F.when(k % 79 == 0, F.lit("abc")).otherwise(_s(F.col("wage_rate_of_pay_from"))),
        full_time_position=ftp_text,
        prevailing_wage=_s(F.col("prevailing_wage")),
    )
    out[2017] = _named(
        *common, "employer_address", "h1b_dependent", "wage_rate_of_pay_from", "wage_rate_of_pay_to", "full_time_position",
        "prevailing_wage", "pw_source", "pw_source_other",
        employer_phone=phone_text,
        pw_source_year=_s(F.col("pw_source_year")),
        **date_text, **case_text,
    )
    out[2016] = _named(
        *common, "employer_address", "h1b_dependent", "wage_rate_of_pay_from", "wage_rate_of_pay_to", "prevailing_wage",
        employer_phone=phone_text,
        full_time_position=ftp_text,
        pw_wage_source=F.col("pw_source"),
        pw_wage_source_year=_s(F.col("pw_source_year")),
        pw_wage_source_other=F.col("pw_source_other"),
        **date_text, **case_text,
    )
    frm = _s(F.col("wage_rate_of_pay_from").cast("bigint"))
    to = _s(F.col("wage_rate_of_pay_to").cast("bigint"))
    wage_range = (
        F.when(k % 11 == 0, frm)
        .when(k % 79 == 0, F.concat(F.lit("x - "), to))
        .when(k % 3 == 0, F.concat(frm, F.lit(" -")))
        .otherwise(F.concat(frm, F.lit(" - "), to))
    )
    out[2015] = _named(
        *common, "employer_address2", "h1b_dependent", "full_time_position", "prevailing_wage", "pw_source", "pw_source_other",
        employer_address1=F.col("employer_address"),
        employer_phone=phone_text,
        wage_rate_of_pay=wage_range,
        pw_wage_source_year=F.col("pw_source_year"),
        **date_text, **case_text,
    )
    return SharedTables(applications_base(spark, sf_dir), {y: F.col("yr") == y for y in out}, out)


def yearly_applications(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """The four yearly application tables as frames of their own."""
    return shared_applications(spark, sf_dir).tables()


# --------------------------------------------------------------------------------------
# Wage statistics and geography (per customer "area"), one table per year.
# --------------------------------------------------------------------------------------

def _areas_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = F.array(*[F.lit(y) for y in YEARS])
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Area"), F.explode(years).alias("yr")
    )


def _by_year(rows: DataFrame, columns: tuple[str, ...]) -> SharedTables:
    return SharedTables(rows, {y: F.col("yr") == y for y in YEARS}, {y: _named(*columns) for y in YEARS})


def yearly_wages(spark: SparkSession, sf_dir: str) -> SharedTables:
    """All_Industries_Wages_{year}: Area, SocCode, Average (hourly, annual or junk averages)."""
    socs = F.array(*[F.lit(j) for j in range(len(SOC_NAMES))])
    g = _areas_by_year(spark, sf_dir).select("Area", "yr", F.explode(socs).alias("j"))
    area, j, yr = F.col("Area"), F.col("j"), F.col("yr")
    avg = (
        F.when((area + j) % 7 == 0, (j + 20).cast("double"))
        .when((area + j) % 7 == 1, F.lit(5000.0))
        .when((area + j) % 13 == 2, F.lit(15000.0))
        .when((area + j) % 13 == 3, F.lit(300.0))
        .when((area + j) % 17 == 4, F.lit(299.5))
        .otherwise(((area * 977 + j * 131 + yr * 7) % 60000 + 30000).cast("double"))
    )
    w = g.select("yr", "Area", F.concat(F.lit("15-113"), _s(j)).alias("SocCode"), avg.alias("Average"))
    return _by_year(w, ("Area", "SocCode", "Average"))


def yearly_geography(spark: SparkSession, sf_dir: str) -> SharedTables:
    """Geography_{year}: Area, StateAb, CountyTownName."""
    g = _areas_by_year(spark, sf_dir).select(
        "yr", "Area",
        state_code(F.col("Area")).alias("StateAb"),
        F.concat(F.lit("KING "), _s(F.col("Area"))).alias("CountyTownName"),
    )
    return _by_year(g, ("Area", "StateAb", "CountyTownName"))


# --------------------------------------------------------------------------------------
# Company registrations: one row per customer, then 13 state-shaped sources.
# --------------------------------------------------------------------------------------

def registrations_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"))
    c = F.col("c")
    b = F.expr("c div 3")
    i = b % 25
    name = F.concat(F.lit("Customer "), _s(b), _pick(c % 3, (", Inc.", " L.L.C.", "")))
    city = (
        F.when(c % 23 == 0, F.lit("80202"))
        .when(c % 29 == 0, F.lit("1 Oak Ave"))
        .when(c % 31 == 0, F.concat(F.lit("City "), _s(i), F.lit(", XX")))
        .when(c % 37 == 0, state_code(i))
        .when(c % 53 == 0, F.lit("   "))
        .otherwise(F.concat(F.lit("City "), _s(i)))
    )
    ct_addr = (
        F.when(c % 11 == 0, F.concat(F.lit("12 Main St, City "), _s(i), F.lit(", NY, 10001")))
        .when(c % 13 == 0, F.concat(F.lit("City "), _s(i), F.lit(", CT, 06101")))
        .otherwise(F.concat(F.lit("Apt 4, 12 Main St, City "), _s(i), F.lit(", CT, 06101")))
    )
    reg = F.make_date((c % 30 + 1990).cast("int"), (c % 12 + 1).cast("int"), (c % 28 + 1).cast("int"))
    return cust.select(
        "c",
        name.alias("name"),
        city.alias("city"),
        ct_addr.alias("address"),
        state_code(i).alias("state"),
        F.when(c % 11 == 0, F.lit("XX")).otherwise(state_code(i)).alias("filter_state"),
        reg.alias("reg_date"),
        F.when(c % 41 == 0, F.lit("unknown")).otherwise(_s(reg)).alias("reg_text"),
    )


def shared_registries(spark: SparkSession, sf_dir: str) -> SharedTables:
    """The registries kept as one table each, every one with its own column names, over one scan of the customers."""
    c, fs = F.col("c"), F.col("filter_state")
    name, city, reg_date, reg_text = (F.col(x) for x in ("name", "city", "reg_date", "reg_text"))
    out = {
        "AZ": _named(File_Number=_s(c), Corporation_Name=name, First_Address_City=city, First_Address_State=fs,
                     Date_of_Incorporation=reg_date),
        "CA": _named(corporation_number=c, corporation_name=name, mail_address_city=city, mail_address_state_or_country=fs,
                     corporation_type=F.when(c % 13 == 0, "Statement of Information").otherwise("Articles of Incorporation"),
                     incorporation_date=reg_date),
        "CO": _named(entity_id=c, entity_name=name, entity_principal_city=city, entity_principal_state=fs,
                     entity_formation_date=reg_date),
        "CT": _named(business_id=c, business_name=name, business_address=F.col("address"),
                     registration_date=F.when(c % 19 == 0, F.lit(None).cast("string")).otherwise(reg_text)),
        "MA": _named(FEIN=_s(c), EntityName=name, City=city, State=fs, DateOfOrganization=reg_text),
        "NC": _named(sosid=_s(c), corpname=name, princity=city, prinstate=fs, dateformed=reg_text),
        "NY": _named(dos_id=c, current_entity_name=name, dos_process_city=city,
                     jurisdiction=F.when(c % 11 == 0, "DELAWARE").otherwise("NEW YORK"), initial_dos_filing_date=reg_date),
        "OH": _named(charter_num=_s(c), business_name=name, business_location_name=city, business_state=fs,
                     effective_date_time=reg_text),
        "VA": _named(corporation_id=_s(c), corporation_name=name, prinicipal_city=city, principal_state=fs,
                     incorporation_date=reg_text),
        "WA": _named(UBI=c, BusinessName=name, RegisteredAgentCity=city, StateOfIncorporation=fs, DateOfIncorporation=reg_text),
    }
    return SharedTables(registrations_base(spark, sf_dir), {x: F.col("state") == x for x in out}, out)


def two_part_registries(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The registries kept in two tables (GA, MN, MO), each table a frame of its own."""
    r = registrations_base(spark, sf_dir)
    c = F.col("c")
    fs = F.col("filter_state")

    def of(state: str) -> DataFrame:
        return r.filter(F.col("state") == state)

    dup = F.explode(F.when(c % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return {
        "GA_1": of("GA").select(
            c.alias("bizentityid"), F.col("name").alias("businessname"), F.col("reg_text").alias("commencementdate")),
        "GA_2": of("GA").select(
            c.alias("bizentityid"), F.when(c % 17 == 0, F.lit("0")).otherwise(F.col("city")).alias("city"),
            fs.alias("state"), dup.alias("copy")).drop("copy"),
        "MN_1": of("MN").select(
            _s(c).alias("master_id"), F.col("name").alias("minnesota_business_name"), F.col("reg_text").alias("filing_date")),
        "MN_2": of("MN").select(
            _s(c).alias("master_id"), F.col("city").alias("city_name"), fs.alias("region_code"), dup.alias("copy")).drop("copy"),
        "MO_1": of("MO").select(c.alias("corporation_id"), F.col("name").alias("name")),
        "MO_2": of("MO").select(
            c.alias("corporation_id"), F.col("city").alias("city"), fs.alias("state"),
            F.col("reg_text").alias("date_formed"), dup.alias("copy")).drop("copy"),
    }


def registry_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The registries of the 13 states as frames of their own (GA, MN, MO in two parts)."""
    return {**shared_registries(spark, sf_dir).tables(), **two_part_registries(spark, sf_dir)}


# --------------------------------------------------------------------------------------
# The wide tab-separated extract: one text line per application (no header line).
# --------------------------------------------------------------------------------------

def _us_date(d: Column, padded: bool) -> Column:
    if padded:
        return F.date_format(d, "MM/dd/yyyy")
    return F.concat_ws("/", _s(F.month(d)), _s(F.dayofmonth(d)), _s(F.year(d)))


def extract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``value`` line per application: 52 tab-separated fields, 41 when k % 3 = 0, 40 when k % 83 = 0."""
    a = applications_base(spark, sf_dir)
    k, c = F.col("k"), F.col("c")
    n = F.col("w").cast("bigint")
    wage_text = F.when(
        n >= 1000,
        F.concat(_s(F.expr("cast(w as bigint) div 1000")), F.lit(","), F.lpad(_s(n % 1000), 3, "0"), F.lit(".00")),
    ).otherwise(F.concat(_s(n), F.lit(".00")))
    ftp = _pick(k % 4, ("N", "Yes", "Y", "Y"))
    yn = lambda cond: F.when(cond, F.lit("Y")).otherwise(F.lit("N"))
    fields = [
        F.col("case_number"), F.col("case_status"),
        _us_date(F.col("case_submitted"), False), _us_date(F.col("decision_date"), False),
        F.col("visa_class"),
        _us_date(F.col("employment_start_date"), True), _us_date(F.col("employment_end_date"), True),
        F.col("employer_name"), F.lit(""), F.col("employer_address"), F.col("employer_city"),
        F.col("employer_state"), F.col("employer_postal_code"), F.col("employer_country"),
        F.col("employer_province"), _s(F.col("phone_number")), F.lit(""),
        yn(F.col("agent_attorney_name").isNotNull()),
        F.col("agent_attorney_name"), F.col("agent_attorney_city"), F.col("agent_attorney_state"),
        F.col("job_title"), F.col("soc_code"), F.col("soc_name"), F.lit("541511"), _s(F.col("total_workers")),
        F.lit("1"), F.lit("0"), F.lit("0"), F.lit("0"), F.lit("0"), F.lit("0"),
        ftp, wage_text, F.col("pw_unit_of_pay"), F.lit("Level II"), F.col("pw_source"),
        _s(F.col("pw_source_year")), F.col("pw_source_other"),
        F.when(k % 79 == 0, F.lit("abc")).otherwise(_s(n)),
        _s(F.col("wage_rate_of_pay_to").cast("bigint")),
        F.col("wage_unit_of_pay"), yn(c % 2 == 0), yn(c % 5 == 0), F.lit("Y"), F.lit("Y"), F.lit(""),
        F.col("worksite_city"), F.col("worksite_county"), F.col("worksite_state"), F.col("worksite_postal_code"),
        F.lit(""),
    ]
    arr = F.array(*[F.coalesce(f.cast("string"), F.lit("")) for f in fields])
    count = F.when(k % 83 == 0, F.lit(40)).when(k % 3 == 0, F.lit(41)).otherwise(F.lit(52))
    return a.select(F.array_join(F.slice(arr, F.lit(1), count), "\t").alias("value"))
