"""DuckDB text of the input adapters (the SQL side of ``sources/fixtures.py``).

Written as SQL common table expressions from the derivation rules, not generated from the
Spark code, so the oracle checks the Spark plans against an independent statement of the
same inputs.  ``with_ctes(names, body)`` assembles a statement that defines only the CTEs the
body needs (plus their dependencies).
"""

from __future__ import annotations

ST = "substr('AZCACOCTGAMAMNMONCNYOHVAWATXFL', CAST(({x}) % 15 * 2 + 1 AS BIGINT), 2)"


def st(x: str) -> str:
    return ST.format(x=x)


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (sql, deps)


cte("apps", f"""
SELECT k, c, b, i, yr, w,
  'I-200-' || CAST(k AS VARCHAR) AS case_number,
  CASE WHEN k % 3 = 0 THEN 'CERTIFIED' ELSE 'DENIED' END AS case_status,
  CASE WHEN k % 10 = 0 THEN 'E-3 Australian' ELSE 'H-1B' END AS visa_class,
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN '1'
       ELSE 'CUSTOMER ' || CAST(b AS VARCHAR) ||
            CASE c % 8 WHEN 0 THEN ', INC.' WHEN 1 THEN ' LLC' WHEN 2 THEN ' CORPORATION' WHEN 3 THEN ' CORP.'
                       WHEN 4 THEN ' LTD' WHEN 5 THEN ' (USA) LP' WHEN 6 THEN ' &QUOT;PC&QUOT;' ELSE '' END
  END AS employer_name,
  CAST(k % 200 AS VARCHAR) || ' MAIN ST' AS employer_address,
  CASE WHEN k % 13 = 0 THEN NULL ELSE 'SUITE ' || CAST(k % 9 AS VARCHAR) END AS employer_address2,
  CASE WHEN k % 101 = 0 THEN NULL WHEN c % 23 = 0 THEN '78701' WHEN c % 29 = 0 THEN '12 MAIN ST'
       WHEN c % 7 = 0 THEN ' CITY ' || CAST(i AS VARCHAR) || ', ' WHEN c % 67 = 0 THEN ' , '
       ELSE 'CITY ' || CAST(i AS VARCHAR) END AS employer_city,
  CASE WHEN c % 31 = 0 THEN 'AUSTIN' WHEN c % 37 = 0 THEN NULL ELSE {st('i')} END AS employer_state,
  CASE WHEN c % 41 = 0 THEN 'TX' WHEN c % 43 = 0 THEN NULL ELSE CAST(b + 70000 AS VARCHAR) END AS employer_postal_code,
  CASE WHEN c % 47 = 0 THEN '78799' ELSE 'UNITED STATES OF AMERICA' END AS employer_country,
  CASE WHEN c % 53 = 0 THEN 'UNITED STATES OF AMERICA' ELSE NULL END AS employer_province,
  CASE WHEN c % 59 = 0 THEN NULL ELSE CAST(5125550000 + b % 10000 AS BIGINT) END AS phone_number,
  c % 2 = 0 AS h1b_dependent,
  c % 5 = 0 AS willful_violator,
  CASE WHEN k % 5 = 0 THEN NULL ELSE 'ATTORNEY ' || CAST(k % 60 AS VARCHAR) END AS agent_attorney_name,
  CASE WHEN k % 5 = 0 THEN NULL ELSE 'CITY ' || CAST(k % 12 AS VARCHAR) END AS agent_attorney_city,
  CASE WHEN k % 5 = 0 THEN NULL ELSE {st('k % 24')} END AS agent_attorney_state,
  CASE WHEN k % 113 = 0 THEN NULL ELSE 'TITLE ' || CAST(k % 50 AS VARCHAR) END AS job_title,
  make_date(yr, k % 12 + 1, k % 28 + 1) AS employment_start_date,
  make_date(yr + 3, k % 12 + 1, k % 28 + 1) AS employment_end_date,
  make_date(yr, k % 12 + 1, k % 28 + 1) - 90 AS case_submitted,
  make_date(yr, k % 12 + 1, k % 28 + 1) - 30 AS decision_date,
  CASE WHEN k % 7 = 0 THEN 'Hour' ELSE 'Year' END AS wage_unit_of_pay,
  CASE WHEN k % 17 = 0 THEN 'SHIFT' ELSE 'CITY ' || CAST(i AS VARCHAR) END AS worksite_city,
  CASE WHEN k % 17 = 0 THEN 'CITY ' || CAST(i AS VARCHAR)
       WHEN k % 43 = 0 THEN {st('c')} || ' COUNTY'
       WHEN k % 67 = 0 THEN '1234'
       ELSE 'KING ' || CAST(c AS VARCHAR) || ' COUNTY' END AS worksite_county,
  CASE WHEN k % 17 = 0 THEN 'KING ' || CAST(c AS VARCHAR) || ' COUNTY' ELSE {st('c')} END AS worksite_state,
  CASE WHEN k % 17 = 0 THEN {st('c')} WHEN k % 61 = 0 THEN NULL ELSE CAST(b + 70000 AS VARCHAR) END AS worksite_postal_code,
  CASE WHEN k % 19 = 0 THEN sn ELSE sc END AS soc_code,
  CASE WHEN k % 19 = 0 THEN sc ELSE sn END AS soc_name,
  w AS wage_rate_of_pay_from,
  CASE WHEN k % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE w + 5000 END AS wage_rate_of_pay_to,
  CASE WHEN k % 71 = 0 THEN '65000' WHEN k % 73 = 0 THEN NULL ELSE 'Year' END AS pw_unit_of_pay,
  w - 1000 AS prevailing_wage,
  'OES' AS pw_source,
  CAST(2015 + k % 3 AS BIGINT) AS pw_source_year,
  'OFLC ONLINE DATA CENTER' AS pw_source_other,
  CAST(k % 9 + 1 AS BIGINT) AS total_workers,
  k % 4 <> 0 AS full_time_position
FROM (
  SELECT o_orderkey AS k, o_custkey AS c, o_custkey // 3 AS b, (o_custkey // 3) % 25 AS i,
         CAST(2015 + o_orderkey % 4 AS INTEGER) AS yr, CAST(floor(o_totalprice / 5) AS DOUBLE) AS w,
         '15-113' || CAST(o_orderkey % 6 AS VARCHAR) || '.00' AS sc,
         CASE o_orderkey % 6 WHEN 0 THEN 'SOFTWARE DEVELOPERS, APPLICATIONS' WHEN 1 THEN 'COMPUTER SYSTEMS ANALYSTS'
              WHEN 2 THEN 'ELECTRONICS ENGINEERS, EXCEPT COMPUTER' WHEN 3 THEN 'ACCOUNTANTS'
              WHEN 4 THEN 'DATABASE ADMINISTRATORS' ELSE 'REGISTERED NURSES' END AS sn
  FROM orders
) o
""")

_COMMON = """case_number, case_status, visa_class, employer_name, employer_city, employer_state,
  employer_postal_code, employer_country, employer_province, willful_violator,
  agent_attorney_name, agent_attorney_city, agent_attorney_state, job_title, wage_unit_of_pay,
  worksite_city, worksite_county, worksite_state, worksite_postal_code, soc_code, soc_name,
  total_workers, pw_unit_of_pay"""
_FTP_TEXT = "CASE WHEN k % 8 = 1 THEN 'Y' WHEN full_time_position THEN 'true' ELSE 'false' END"
_CASE_TEXT = """CASE WHEN k % 83 = 0 THEN 'N/A' ELSE CAST(case_submitted AS VARCHAR) END AS case_submitted,
  CASE WHEN k % 83 = 0 THEN 'N/A' ELSE CAST(decision_date AS VARCHAR) END AS decision_date"""

cte("apps_2018", f"""
SELECT {_COMMON}, employer_address, phone_number AS employer_phone,
  CASE WHEN h1b_dependent THEN 'Y' ELSE 'N' END AS h1b_dependent,
  employment_start_date, employment_end_date,
  CASE WHEN k % 79 = 0 THEN 'abc' ELSE CAST(wage_rate_of_pay_from AS VARCHAR) END AS wage_rate_of_pay_from,
  wage_rate_of_pay_to, {_FTP_TEXT} AS full_time_position,
  CAST(prevailing_wage AS VARCHAR) AS prevailing_wage,
  pw_source, pw_source_year, pw_source_other, case_submitted, decision_date
FROM apps WHERE yr = 2018
""", ("apps",))

cte("apps_2017", f"""
SELECT {_COMMON}, employer_address, CAST(phone_number AS VARCHAR) || '.0' AS employer_phone, h1b_dependent,
  CAST(employment_start_date AS VARCHAR) AS employment_start_date,
  CAST(employment_end_date AS VARCHAR) AS employment_end_date,
  wage_rate_of_pay_from, wage_rate_of_pay_to, full_time_position, prevailing_wage,
  pw_source, CAST(pw_source_year AS VARCHAR) AS pw_source_year, pw_source_other, {_CASE_TEXT}
FROM apps WHERE yr = 2017
""", ("apps",))

cte("apps_2016", f"""
SELECT {_COMMON}, employer_address, CAST(phone_number AS VARCHAR) || '.0' AS employer_phone, h1b_dependent,
  CAST(employment_start_date AS VARCHAR) AS employment_start_date,
  CAST(employment_end_date AS VARCHAR) AS employment_end_date,
  wage_rate_of_pay_from, wage_rate_of_pay_to, {_FTP_TEXT} AS full_time_position, prevailing_wage,
  pw_source AS pw_wage_source, CAST(pw_source_year AS VARCHAR) AS pw_wage_source_year,
  pw_source_other AS pw_wage_source_other, {_CASE_TEXT}
FROM apps WHERE yr = 2016
""", ("apps",))

cte("apps_2015", f"""
SELECT {_COMMON}, employer_address AS employer_address1, employer_address2,
  CAST(phone_number AS VARCHAR) || '.0' AS employer_phone, h1b_dependent,
  CAST(employment_start_date AS VARCHAR) AS employment_start_date,
  CAST(employment_end_date AS VARCHAR) AS employment_end_date,
  CASE WHEN k % 11 = 0 THEN CAST(CAST(wage_rate_of_pay_from AS BIGINT) AS VARCHAR)
       WHEN k % 79 = 0 THEN 'x - ' || CAST(CAST(wage_rate_of_pay_to AS BIGINT) AS VARCHAR)
       WHEN k % 3 = 0 THEN CAST(CAST(wage_rate_of_pay_from AS BIGINT) AS VARCHAR) || ' -'
       ELSE CAST(CAST(wage_rate_of_pay_from AS BIGINT) AS VARCHAR) || ' - ' || CAST(CAST(wage_rate_of_pay_to AS BIGINT) AS VARCHAR)
  END AS wage_rate_of_pay,
  full_time_position, prevailing_wage,
  pw_source, pw_source_year AS pw_wage_source_year, pw_source_other, {_CASE_TEXT}
FROM apps WHERE yr = 2015
""", ("apps",))

cte("areas", """
SELECT c_custkey AS Area, yr FROM customer, (VALUES (2015), (2016), (2017), (2018)) y(yr)
""")

cte("wages_src", """
SELECT yr, Area, '15-113' || CAST(j AS VARCHAR) AS SocCode,
  CASE WHEN (Area + j) % 7 = 0 THEN CAST(j + 20 AS DOUBLE)
       WHEN (Area + j) % 7 = 1 THEN 5000.0
       WHEN (Area + j) % 13 = 2 THEN 15000.0
       WHEN (Area + j) % 13 = 3 THEN 300.0
       WHEN (Area + j) % 17 = 4 THEN 299.5
       ELSE CAST((Area * 977 + j * 131 + yr * 7) % 60000 + 30000 AS DOUBLE) END AS Average
FROM areas, (VALUES (0), (1), (2), (3), (4), (5)) s(j)
""", ("areas",))

cte("geo_src", f"""
SELECT yr, Area, {st('Area')} AS StateAb, 'KING ' || CAST(Area AS VARCHAR) AS CountyTownName FROM areas
""", ("areas",))

cte("corp", f"""
SELECT c, name, city, address, state, filter_state, reg_date,
  CASE WHEN c % 41 = 0 THEN 'unknown' ELSE CAST(reg_date AS VARCHAR) END AS reg_text
FROM (
  SELECT c,
    'Customer ' || CAST(b AS VARCHAR) || CASE c % 3 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' L.L.C.' ELSE '' END AS name,
    CASE WHEN c % 23 = 0 THEN '80202' WHEN c % 29 = 0 THEN '1 Oak Ave'
         WHEN c % 31 = 0 THEN 'City ' || CAST(i AS VARCHAR) || ', XX'
         WHEN c % 37 = 0 THEN {st('i')} WHEN c % 53 = 0 THEN '   '
         ELSE 'City ' || CAST(i AS VARCHAR) END AS city,
    CASE WHEN c % 11 = 0 THEN '12 Main St, City ' || CAST(i AS VARCHAR) || ', NY, 10001'
         WHEN c % 13 = 0 THEN 'City ' || CAST(i AS VARCHAR) || ', CT, 06101'
         ELSE 'Apt 4, 12 Main St, City ' || CAST(i AS VARCHAR) || ', CT, 06101' END AS address,
    {st('i')} AS state,
    CASE WHEN c % 11 = 0 THEN 'XX' ELSE {st('i')} END AS filter_state,
    make_date(c % 30 + 1990, c % 12 + 1, c % 28 + 1) AS reg_date
  FROM (SELECT c_custkey AS c, c_custkey // 3 AS b, (c_custkey // 3) % 25 AS i FROM customer) x
) y
""")

cte("corp_dup", """
SELECT corp.*, d.copy FROM corp, (VALUES (0), (1)) d(copy) WHERE d.copy = 0 OR corp.c % 5 = 0
""", ("corp",))


def with_ctes(names: tuple[str, ...] | list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` the named CTEs (dependencies first), then any extra (name, sql) pairs, then body."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][0].strip()})" for n in order]
    parts += [f"{n} AS ({sql.strip()})" for n, sql in (extra or [])]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


cte("tsv_lines", f"""
SELECT array_to_string(list_slice([
    case_number, case_status,
    CAST(month(case_submitted) AS VARCHAR) || '/' || CAST(day(case_submitted) AS VARCHAR) || '/' || CAST(year(case_submitted) AS VARCHAR),
    CAST(month(decision_date) AS VARCHAR) || '/' || CAST(day(decision_date) AS VARCHAR) || '/' || CAST(year(decision_date) AS VARCHAR),
    visa_class, strftime(employment_start_date, '%m/%d/%Y'), strftime(employment_end_date, '%m/%d/%Y'),
    coalesce(employer_name, ''), '', employer_address, coalesce(employer_city, ''), coalesce(employer_state, ''),
    coalesce(employer_postal_code, ''), employer_country, coalesce(employer_province, ''),
    coalesce(CAST(phone_number AS VARCHAR), ''), '',
    CASE WHEN agent_attorney_name IS NOT NULL THEN 'Y' ELSE 'N' END,
    coalesce(agent_attorney_name, ''), coalesce(agent_attorney_city, ''), coalesce(agent_attorney_state, ''),
    coalesce(job_title, ''), soc_code, soc_name, '541511', CAST(total_workers AS VARCHAR),
    '1', '0', '0', '0', '0', '0',
    CASE k % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'Yes' ELSE 'Y' END,
    CASE WHEN CAST(w AS BIGINT) >= 1000
         THEN CAST(CAST(w AS BIGINT) // 1000 AS VARCHAR) || ',' || lpad(CAST(CAST(w AS BIGINT) % 1000 AS VARCHAR), 3, '0') || '.00'
         ELSE CAST(CAST(w AS BIGINT) AS VARCHAR) || '.00' END,
    coalesce(pw_unit_of_pay, ''), 'Level II', pw_source, CAST(pw_source_year AS VARCHAR), pw_source_other,
    CASE WHEN k % 79 = 0 THEN 'abc' ELSE CAST(CAST(w AS BIGINT) AS VARCHAR) END,
    CAST(CAST(wage_rate_of_pay_to AS BIGINT) AS VARCHAR),
    wage_unit_of_pay, CASE WHEN c % 2 = 0 THEN 'Y' ELSE 'N' END, CASE WHEN c % 5 = 0 THEN 'Y' ELSE 'N' END,
    'Y', 'Y', '', worksite_city, worksite_county, worksite_state, coalesce(worksite_postal_code, ''), ''
  ], 1, CASE WHEN k % 83 = 0 THEN 40 WHEN k % 3 = 0 THEN 41 ELSE 52 END), chr(9)) AS value
FROM apps
""", ("apps",))
