"""Company registrations: merge the state registries (D11) and clean the result.

The merge is a table of per-state specs; Spark plans every branch in one job (one scan per source),
instead of one INSERT statement per state.  Registries that are rows of one frame (``SharedTables``) are
read in one pass for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions.text import (
    normalize_org_name,
    rsplit_second,
    safe_date,
    starts_with_digit,
    strip,
)

from recordforge.operators.branches import Accessor, SharedTables, one_pass

MERGED_COLUMNS = ("corporation_id", "corporation_name", "corporation_city", "corporation_state", "registration_date")


@dataclass(frozen=True)
class RegistrySpec:
    """How one state's registry maps onto the merged table."""

    state: str
    sources: tuple[str, ...]          # one source, or two joined on ``join_key``
    id: str
    name: str
    city: tuple[str, ...]             # accepted spellings of the city column, first match wins
    date: str
    where: Callable[[Accessor], Column]
    date_is_text: bool = True
    join_key: str | None = None
    right_where: Callable[[Accessor], Column] | None = None   # filter of the second source (ON clause)
    distinct: bool = False


REGISTRY_SPECS: tuple[RegistrySpec, ...] = (
    RegistrySpec("AZ", ("AZ",), "File_Number", "Corporation_Name", ("First_Address_City",), "Date_of_Incorporation",
                 lambda c: c("First_Address_State") == "AZ", date_is_text=False, distinct=True),
    RegistrySpec("CA", ("CA",), "corporation_number", "corporation_name", ("mail_address_city",), "incorporation_date",
                 lambda c: (c("corporation_type") == "Articles of Incorporation") & (c("mail_address_state_or_country") == "CA"),
                 date_is_text=False),
    RegistrySpec("CO", ("CO",), "entity_id", "entity_name", ("entity_principal_city",), "entity_formation_date",
                 lambda c: c("entity_principal_state") == "CO", date_is_text=False),
    RegistrySpec("CT", ("CT",), "business_id", "business_name", ("business_address",), "registration_date",
                 lambda c: c("business_address").contains(", CT, ") & c("registration_date").isNotNull()),
    RegistrySpec("GA", ("GA_1", "GA_2"), "bizentityid", "businessname", ("city",), "commencementdate",
                 lambda c: F.lit(True), join_key="bizentityid",
                 right_where=lambda c: c("city").isNotNull() & (c("city") != "0") & (c("city") != "1") & (c("state") == "GA")),
    RegistrySpec("MA", ("MA",), "FEIN", "EntityName", ("City",), "DateOfOrganization",
                 lambda c: c("EntityName").isNotNull() & c("City").isNotNull() & (c("State") == "MA")),
    RegistrySpec("MN", ("MN_1", "MN_2"), "master_id", "minnesota_business_name", ("city_name",), "filing_date",
                 lambda c: c("minnesota_business_name").isNotNull() & c("city_name").isNotNull()
                 & (c("region_code") == "MN") & c("filing_date").isNotNull(),
                 join_key="master_id", distinct=True),
    RegistrySpec("MO", ("MO_1", "MO_2"), "corporation_id", "name", ("city",), "date_formed",
                 lambda c: c("state") == "MO", join_key="corporation_id", distinct=True),
    RegistrySpec("NC", ("NC",), "sosid", "corpname", ("princity",), "dateformed",
                 lambda c: c("corpname").isNotNull() & c("princity").isNotNull() & (c("prinstate") == "NC"), distinct=True),
    RegistrySpec("NY", ("NY",), "dos_id", "current_entity_name", ("dos_process_city",), "initial_dos_filing_date",
                 lambda c: (c("jurisdiction") == "NEW YORK") & c("dos_process_city").isNotNull()
                 & c("current_entity_name").isNotNull() & c("initial_dos_filing_date").isNotNull(),
                 date_is_text=False, distinct=True),
    RegistrySpec("OH", ("OH",), "charter_num", "business_name", ("business_location_name",), "effective_date_time",
                 lambda c: c("business_state") == "OH", distinct=True),
    RegistrySpec("VA", ("VA",), "corporation_id", "corporation_name", ("prinicipal_city", "principal_city"), "incorporation_date",
                 lambda c: c("principal_state") == "VA", distinct=True),
    RegistrySpec("WA", ("WA",), "UBI", "BusinessName", ("RegisteredAgentCity",), "DateOfIncorporation",
                 lambda c: c("StateOfIncorporation") == "WA", distinct=True),
)
SPECS_BY_STATE = {s.state: s for s in REGISTRY_SPECS}


def _merged_columns(spec: RegistrySpec, c: Accessor, known: Mapping) -> list[Column]:
    city = next(n for n in spec.city if n in known)
    date = safe_date(c(spec.date)) if spec.date_is_text else c(spec.date).cast("date")
    return [
        c(spec.id).cast("string").alias("corporation_id"),
        c(spec.name).alias("corporation_name"),
        c(city).alias("corporation_city"),
        F.lit(spec.state).alias("corporation_state"),
        date.alias("registration_date"),
    ]


def registry_branch(spec: RegistrySpec, sources: Mapping[str, DataFrame], apply_distinct: bool = True) -> DataFrame:
    """One state's rows in the merged shape (J1/J2 for the two-part registries)."""
    if spec.join_key is None:
        df = sources[spec.sources[0]]
    else:
        left, right = sources[spec.sources[0]], sources[spec.sources[1]]
        if spec.right_where is not None:
            right = right.filter(spec.right_where(F.col))
        df = left.join(right, on=spec.join_key, how="inner")
    out = df.filter(spec.where(F.col)).select(*_merged_columns(spec, F.col, dict.fromkeys(df.columns)))
    return out.distinct() if (spec.distinct and apply_distinct) else out


def _shared_branches(specs: list[RegistrySpec], shared: SharedTables) -> DataFrame:
    """The branches of registries that share their rows, in one pass; ``_copy`` is what a DISTINCT tells rows apart by.

    It is null for the states whose rows are made distinct; every row of the others has a number of its
    own there, so that one DISTINCT leaves all of them.
    """
    numbered = shared.rows.withColumn("_row", F.monotonically_increasing_id())
    branches = []
    for s in specs:
        c, source = shared.accessor(s.sources[0]), s.sources[0]
        copy = F.lit(None).cast("bigint") if s.distinct else F.col("_row")
        branches.append((shared.where[source] & s.where(c), [*_merged_columns(s, c, shared.columns[source]), copy.alias("_copy")]))
    return one_pass(numbered, branches)


def merge_registrations(sources: Mapping[str, DataFrame], specs: tuple[RegistrySpec, ...] = REGISTRY_SPECS,
                        states: tuple[str, ...] | None = None, shared: SharedTables | None = None) -> DataFrame:
    """Corporate_Registrations_Merged = UNION ALL of the state branches (all, or the ``states`` named).

    A source is taken from ``shared`` if it has it, else from ``sources``; a missing source raises.

    Every branch carries its own state literal, so no row of one branch equals a row of
    another: DISTINCT per branch equals one DISTINCT over the union of the distinct branches.
    That is one aggregate and one shuffle instead of one per state.
    """
    usable = [s for s in specs if states is None or s.state in states]
    known = {*sources, *(shared or ())}
    missing = sorted({n for s in usable for n in s.sources if n not in known}
                     | {f"state {x}" for x in states or () if x not in {s.state for s in specs}})
    if missing:
        raise ValueError(f"registry sources missing: {', '.join(missing)}; name the states to merge a subset")
    union = lambda frames: reduce(lambda a, b: a.unionByName(b), frames)
    together = [s for s in usable if s.join_key is None and shared is not None and s.sources[0] in shared]
    alone = [s for s in usable if s not in together]
    deduped = [registry_branch(s, sources, apply_distinct=False) for s in alone if s.distinct]
    kept = [registry_branch(s, sources) for s in alone if not s.distinct]
    if together:
        deduped = [df.withColumn("_copy", F.lit(None).cast("bigint")) for df in deduped]
        deduped.append(_shared_branches(together, shared))
    parts = ([union(deduped).distinct().select(*MERGED_COLUMNS)] if deduped else []) + kept
    return union(parts)


def _with_usable_city(merged: DataFrame) -> DataFrame:
    """Adds ``_city``: the city to keep, null where the row has no name or no usable city."""
    state, raw = F.col("corporation_state"), F.col("corporation_city")
    df = merged.withColumn("_city", F.when(F.col("corporation_name").isNotNull(), F.when(state == "CT", rsplit_second(raw)).otherwise(raw)))
    city = F.col("_city")
    unusable = starts_with_digit(city) | (city == state)
    parts = F.split(city, F.lit(","), -1)
    return df.withColumn("_city", F.nullif(
        F.when(F.length(city) <= 1, city).when(~F.coalesce(unusable, F.lit(False)), F.when(F.size(parts) == 2, F.get(parts, 0)).otherwise(city)),
        F.lit("")))


def clean_registrations(merged: DataFrame) -> DataFrame:
    """Corporate_Registrations_Cleaned."""
    present = merged.filter(F.col("corporation_name").isNotNull() & F.col("corporation_city").isNotNull())  # reaches the scans
    kept = _with_usable_city(present).filter(F.col("_city").isNotNull())
    return kept.withColumns({
        "corporation_name": normalize_org_name(F.col("corporation_name"), upper=True),
        "corporation_city": F.upper(strip(F.col("_city"))),
    }).select(*MERGED_COLUMNS)


def registration_rejects(merged: DataFrame) -> DataFrame:
    """The rows ``clean_registrations`` leaves out, as they came, with a reason."""
    missing = F.col("corporation_name").isNull() | F.col("corporation_city").isNull()
    return _with_usable_city(merged).filter(F.col("_city").isNull()).select(
        *MERGED_COLUMNS, F.when(missing, "no name or no city").otherwise("no city after repair").alias("reject_reason"))


def ct_city(address: Column) -> Column:
    """the city of a CT business address."""
    return rsplit_second(address)
