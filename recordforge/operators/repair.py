"""Field-repair operators.

Each rule reads what the previous rule wrote, so every step is its own ``withColumns``;
Catalyst collapses the chain into one projection.  Empty strings are treated like nulls
where a rule would look at the first character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions.text import (
    is_all_digits,
    normalize_org_name,
    number_without_commas,
    starts_with_digit,
    strip,
)

USA = "UNITED STATES OF AMERICA"
def null_str() -> Column:
    return F.lit(None).cast("string")


def _col(name: str) -> Column:
    return F.col(name)


def city_without_commas(col: Column) -> Column:
    return strip(F.replace(col, F.lit(","), F.lit("")))


def repair_employer_fields(df: DataFrame, city_col: str = "_repaired_city") -> DataFrame:
    """D1 + D2 on Employer_Temp rows; the repaired city is left in ``city_col`` (null = reject)."""
    city, state, postal = _col(city_col), _col("employer_state"), _col("employer_postal_code")
    # D1, and step 1: city without commas, stripped
    df = df.withColumns({
        "employer_name": normalize_org_name(_col("employer_name")),
        city_col: city_without_commas(_col("employer_city")),
    })
    # 1: a city of digits is a postal code, one starting with a digit is an address
    digits, lead = is_all_digits(city), starts_with_digit(city)
    df = df.withColumns({
        "employer_postal_code": F.when(digits, city).otherwise(postal),
        "employer_address": F.when(~digits & lead, city).otherwise(_col("employer_address")),
        city_col: F.when(lead | (city == ""), null_str()).otherwise(city),
    })
    # 2: a state longer than two letters is the city (even over a good city)
    long_state = state.isNotNull() & (F.length(state) > 2)
    df = df.withColumns({
        city_col: F.when(long_state, state).otherwise(city),
        "employer_state": F.when(long_state, null_str()).otherwise(state),
    })
    # 3: a two-letter, non-numeric postal code is the state
    two_letter = postal.isNotNull() & (F.length(postal) == 2) & ~is_all_digits(postal)
    df = df.withColumns({
        "employer_state": F.when(two_letter, postal).otherwise(_col("employer_state")),
        "employer_postal_code": F.when(two_letter, null_str()).otherwise(postal),
    })
    # 4: phone numbers lose every '.0'
    df = df.withColumn("employer_phone", F.replace(_col("employer_phone"), F.lit(".0"), F.lit("")))
    # 5: a numeric country is the postal code
    country = _col("employer_country")
    num_country = country.isNotNull() & is_all_digits(country)
    df = df.withColumns({
        "employer_postal_code": F.when(num_country, country).otherwise(_col("employer_postal_code")),
        "employer_country": F.when(num_country, null_str()).otherwise(country),
    })
    # 6: the country written in the province field
    usa_prov = _col("employer_province") == USA
    df = df.withColumns({
        "employer_country": F.when(usa_prov, F.lit(USA)).otherwise(_col("employer_country")),
        "employer_province": F.when(usa_prov, null_str()).otherwise(_col("employer_province")),
    })
    return df


def repair_employers(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows with a city, rejected input rows as they came, with a reason)."""
    tmp, before = "_repaired_city", "_before"
    fixed = repair_employer_fields(df.withColumn(before, F.struct(*df.columns)), tmp)
    accepted = fixed.filter(F.col(tmp).isNotNull()).withColumn("employer_city", F.col(tmp))
    rejected = fixed.filter(F.col(tmp).isNull()).select(f"{before}.*", F.lit("no city after repair").alias("reject_reason"))
    return accepted.select(*df.columns), rejected


def link_city(city: Column, state: Column) -> Column:
    """D3: clean city used to link jobs and applications to employers (null = drop row).

    City without commas, stripped; empty or starting with a digit means no city; a missing
    city is then taken from a state longer than two letters.
    """
    c1 = F.nullif(city_without_commas(city), F.lit(""))
    c2 = F.when(starts_with_digit(c1), null_str()).otherwise(c1)
    return F.coalesce(c2, F.when(F.length(state) > 2, state))


def repair_worksite(df: DataFrame) -> DataFrame:
    """Worksite fields, only where the original postal code is present.

    Rules, in order, all guarded by a present postal code: (1) a postal code not starting
    with a digit means the fields sit one place to the right, so shift them left; (2) drop
    ' COUNTY' from the county; (3) a county equal to the state is no county; (4) nor is a
    numeric one.  Each output is written as one expression over the original fields in
    which every input appears once per branch, so that filters Catalyst pushes below this
    projection stay small after inlining.
    """
    city, county, state, postal = (_col(f"worksite_{n}") for n in ("city", "county", "state", "postal_code"))
    g = postal.isNotNull() & (postal != "")
    shift = g & ~starts_with_digit(postal)
    new_state = F.when(shift, postal).otherwise(state)
    county_shifted = F.when(shift, state).otherwise(county)
    county_clean = F.nullif(F.replace(county_shifted, F.lit(" COUNTY"), F.lit("")), new_state)
    county_final = F.when(~g, county).otherwise(
        F.when(is_all_digits(county_clean), null_str()).otherwise(county_clean))
    return df.withColumns({
        "worksite_city": F.when(shift, county).otherwise(city),
        "worksite_county": county_final,
        "worksite_state": new_state,
        "worksite_postal_code": F.when(shift, null_str()).otherwise(postal),
    })


def repair_soc(df: DataFrame) -> DataFrame:
    """When both are present, swap code and name if the name is the code; drop '.00' from the code."""
    code, name = _col("soc_code"), _col("soc_name")
    both = code.isNotNull() & name.isNotNull()
    swap = both & starts_with_digit(name)
    no_suffix = F.replace(F.when(swap, name).otherwise(code), F.lit(".00"), F.lit(""))
    return df.withColumns({
        "soc_code": F.when(both, no_suffix).otherwise(code),
        "soc_name": F.when(swap, code).otherwise(name),
    })


def repair_wage_fields(df: DataFrame) -> DataFrame:
    """A pay unit that is a number is the prevailing wage; a zero 'to' wage is null.

    A unit that starts with a digit but is no number (commas aside) stays, and so does the wage.
    """
    unit = _col("pw_unit_of_pay")
    wage = F.when(starts_with_digit(unit), number_without_commas(unit))
    to = _col("wage_rate_of_pay_to")
    return df.withColumns({
        "prevailing_wage": F.coalesce(wage, _col("prevailing_wage")),
        "pw_unit_of_pay": F.when(wage.isNull(), unit),
        "wage_rate_of_pay_to": F.when(to == 0.0, F.lit(None).cast("double")).otherwise(to),
    })
