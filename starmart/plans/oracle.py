"""DuckDB SQL that computes every catalogued query from the base tables.

Written from the semantics, independently of the Spark code: the people and
run-history derivations of ``fixtures.py`` are restated in SQL here, and
dimensions, lookups and facts are computed with plain joins and window
functions. Column names and types match the Spark results.
"""

from __future__ import annotations

AS_OF = "DATE '1998-03-01'"

PEOPLE = """
src AS (
  SELECT o.o_orderkey AS ok, o.o_orderstatus, o.o_orderdate, o.o_orderpriority,
         c.c_custkey AS ck, c.c_name, c.c_mktsegment, n.n_nationkey AS nk, n.n_name, r.r_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
people AS (
  SELECT
    CAST(ok AS VARCHAR) AS employee_number,
    c_name AS full_name,
    CASE WHEN ok % 53 = 0 THEN NULL
         WHEN o_orderstatus = 'F' THEN 'Employee'
         WHEN o_orderstatus = 'O' THEN 'Contingent Worker'
         WHEN o_orderstatus = 'P' AND ok % 2 = 0 THEN 'Ex-Employee'
         WHEN o_orderstatus = 'P' THEN 'EX-CONTINGENT WORKER' END AS user_type,
    CASE WHEN ok % 11 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS gender,
    o_orderpriority AS grade,
    CASE WHEN ck % 10 = 0 THEN NULL ELSE n_name END AS nationality,
    CASE WHEN ck % 43 = 0 OR ck % 37 = 0 THEN NULL ELSE n_name END AS location_code,
    CASE WHEN ck % 43 = 0 OR ck % 37 = 0 THEN NULL
         WHEN ok % 13 = 0 THEN lower(r_name) ELSE r_name END AS location_country,
    CASE WHEN ck % 29 = 0 THEN NULL
         ELSE DATE '1930-01-01' + CAST((ck * 7919) % 25000 AS INTEGER) END AS date_of_birth,
    DATE '1998-03-01' + CAST(ok % 61 - 30 AS INTEGER) AS hire_date,
    CASE WHEN ok % 5 = 0 THEN NULL ELSE DATE '1998-03-01' + CAST(ok % 47 - 15 AS INTEGER) END AS end_date,
    CASE WHEN ok % 97 = 0 THEN NULL ELSE ok % 7 <> 0 END AS is_active,
    CASE ok % 3 WHEN 0 THEN 'E' WHEN 1 THEN 'c' ELSE 'X' END AS worker_type,
    CASE ok % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'B' WHEN 2 THEN 'Z' ELSE NULL END AS assignment_status,
    'BU' || CAST(ck % 2 AS VARCHAR) AS org_business_unit,
    CASE WHEN ck % 13 = 0 THEN NULL ELSE 'SL' || CAST(ck % 3 AS VARCHAR) END AS org_service_line,
    'FN' || CAST(nk % 4 AS VARCHAR) AS org_function,
    CASE WHEN ok % 17 = 0 THEN lower(r_name) ELSE r_name END AS org_department,
    'DS' || CAST(ok % 5 AS VARCHAR) AS org_discipline,
    r_name AS business_group,
    CASE WHEN nk % 5 = 4 THEN NULL ELSE 'OU' || CAST(nk % 5 AS VARCHAR) END AS operating_unit,
    'emp' || CAST(ok AS VARCHAR) || '@corp.example' AS email,
    'Manager ' || n_name AS manager_name,
    CAST(nk AS VARCHAR) AS manager_number,
    CASE WHEN ck % 19 = 0 OR ck % 4 = 0 THEN NULL
         WHEN ck % 4 = 1 THEN 'head@corp.example'
         WHEN ck % 4 = 2 THEN 'lead.' || lower(r_name) || '@corp.example'
         ELSE 'mgr.' || CAST(nk AS VARCHAR) || '@corp.example' END AS manager_email,
    CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(CASE WHEN day(o_orderdate) < 16 THEN 1 ELSE 16 END AS INTEGER) AS day
  FROM src
)"""


def derived(src: str = "people", name: str = "derived") -> str:
    return f"""
{name} AS (
  SELECT *,
    CASE WHEN a_years >= 55 THEN '55+'
         WHEN a_years >= 45 THEN '45-54'
         WHEN a_years >= 35 THEN '35-44'
         WHEN a_years >= 25 THEN '25-34'
         WHEN a_years >= 18 THEN '18-24' END AS age_group,
    CASE WHEN hire_date = {AS_OF} THEN 1 ELSE 0 END AS is_new_hire,
    CASE WHEN end_date = {AS_OF} THEN 1 ELSE 0 END AS is_separation
  FROM (
    SELECT *, CAST(trunc(age) AS INTEGER) AS a_years
    FROM (SELECT *, CAST(date_diff('day', date_of_birth, {AS_OF}) AS DOUBLE) / 365 AS age FROM {src})
  )
)"""


FACT_FILTER = (
    "is_active AND lower(assignment_status) IN ('a', 'b') AND lower(worker_type) IN ('e', 'c')"
)
NOT_DENIED = "NOT (lower(user_type) IN ('ex-employee', 'ex-contingent worker'))"

# dimension -> (key, [(attr, people expression)], member filter)
DIMS = {
    "location": ("LocationKey", [("country", "location_country")], None),
    "person_type": ("PersonTypeKey", [("name", "user_type")], NOT_DENIED),
    "gender": ("GenderKey", [("name", "gender")], None),
    "grade": ("GradeKey", [("name", "grade")], None),
    "nationality": ("NationalityKey", [("name", "nationality")], None),
    "informal_org": (
        "InformalOrgKey",
        [
            ("BusinessUnit", "org_business_unit"),
            ("ServiceLine", "org_service_line"),
            ("Function", "org_function"),
            ("Department", "org_department"),
        ],
        None,
    ),
    "formal_org": ("FormalOrgKey", [("BusinessGroup", "business_group"), ("OperatingUnit", "operating_unit")], None),
}


def members(dim: str, src: str, folded: bool = True, where: str | None = None) -> str:
    """SELECT of the dimension's members from ``src`` (one per folded value by default)."""
    _, cols, keep = DIMS[dim]
    conds = [c for c in (keep, where) if c]
    w = (" WHERE " + " AND ".join(conds)) if conds else ""
    if folded:
        row = "struct_pack(" + ", ".join(f"{a} := {e}" for a, e in cols) + ")"
        sel = ", ".join(f"m.{a} AS {a}" for a, _ in cols)
        grp = ", ".join(f"lower({e})" for _, e in cols)
        return f"SELECT {sel} FROM (SELECT min({row}) AS m FROM {src}{w} GROUP BY {grp})"
    sel = ", ".join(f"{e} AS {a}" for a, e in cols)
    return f"SELECT DISTINCT {sel} FROM {src}{w}"


def _order(dim: str) -> str:
    return ", ".join(f"{a} NULLS FIRST" for a, _ in DIMS[dim][1])


def keyed(dim: str, members_sql: str, start: str = "0") -> str:
    key, cols, _ = DIMS[dim]
    attrs = ", ".join(a for a, _ in cols)
    return (
        f"SELECT CAST({start} + row_number() OVER (ORDER BY {_order(dim)}) AS INTEGER) AS {key}, {attrs} "
        f"FROM ({members_sql})"
    )


def folded_match(dim: str, left: str, right: str, left_is_people: bool) -> str:
    cols = DIMS[dim][1]
    parts = []
    for a, e in cols:
        lhs = f"{left}.{e}" if left_is_people else f"{left}.{a}"
        parts.append(f"lower({lhs}) IS NOT DISTINCT FROM lower({right}.{a})")
    return " AND ".join(parts)


def dim_ctes(src: str, prefix: str = "d_", spellings: bool = False) -> str:
    """Every regular dimension as a first merge from ``src`` builds it.

    ``spellings``: merged with every spelling, then seen as lookups see it, one
    row a folded value with the smallest key.
    """
    if not spellings:
        return ",\n".join(f"{prefix}{dim} AS ({keyed(dim, members(dim, src))})" for dim in DIMS)
    out = []
    for dim, (key, cols, _) in DIMS.items():
        low = ", ".join(f"lower({a}) AS {a}" for a, _ in cols)
        by = ", ".join(f"lower({a})" for a, _ in cols)
        out.append(f"{prefix}{dim} AS (SELECT min({key}) AS {key}, {low} FROM ({keyed(dim, members(dim, src, folded=False))}) GROUP BY {by})")
    return ",\n".join(out)


def two_step_merge(dim: str, src: str, first_where: str, compat: bool = False) -> str:
    """Dimension rows after merging the rows matching ``first_where``, then all rows."""
    key, cols, _ = DIMS[dim]
    attrs = ", ".join(a for a, _ in cols)
    match = " AND ".join(f"lower(k1.{a}) IS NOT DISTINCT FROM lower(m2.{a})" for a, _ in cols)
    return f"""
k1 AS ({keyed(dim, members(dim, src, folded=not compat, where=first_where))}),
m2 AS ({members(dim, src, folded=not compat)}),
n2 AS (SELECT * FROM m2 WHERE NOT EXISTS (SELECT 1 FROM k1 WHERE {match})),
k2 AS ({keyed(dim, "SELECT * FROM n2", start="(SELECT coalesce(max(" + key + "), 0) FROM k1)")})
SELECT {key}, {attrs} FROM k1 UNION ALL SELECT {key}, {attrs} FROM k2"""


def age_group_key(col: str) -> str:
    return (
        f"CAST(CASE {col} WHEN '18-24' THEN 1 WHEN '25-34' THEN 2 WHEN '35-44' THEN 3 "
        f"WHEN '45-54' THEN 4 WHEN '55+' THEN 5 ELSE 0 END AS INTEGER)"
    )


def day_key(t: str) -> str:
    return f"CAST({t}.year * 10000 + {t}.month * 100 + {t}.day AS INTEGER)"


def lookup_joins(alias: str, dims: list[str], prefix: str = "d_", folded: bool = True) -> str:
    out = []
    for dim in dims:
        if folded:
            cond = folded_match(dim, alias, f"{prefix}{dim}", True)
        else:
            cond = " AND ".join(
                f"{alias}.{e} IS NOT DISTINCT FROM {prefix}{dim}.{a}" for a, e in DIMS[dim][1]
            )
        out.append(f"JOIN {prefix}{dim} ON {cond}")
    return "\n".join(out)


FACT1_DIMS = ["location", "person_type", "gender", "grade", "nationality", "informal_org", "formal_org"]


def headcount_sql(src: str, spellings: bool = False) -> str:
    """Fact 1 from a people-like relation ``src`` (dimensions built from it, unfiltered)."""
    return f"""
{derived(src, "f1_src")},
{dim_ctes(src, spellings=spellings)},
f1 AS (
  SELECT d_location.LocationKey, d_person_type.PersonTypeKey, d_gender.GenderKey, d_grade.GradeKey,
         d_nationality.NationalityKey, d_informal_org.InformalOrgKey, d_formal_org.FormalOrgKey,
         {age_group_key("p.age_group")} AS AgeGroupKey, {day_key("p")} AS DayKey,
         p.is_new_hire, p.is_separation
  FROM (SELECT * FROM f1_src WHERE {FACT_FILTER}) p
  {lookup_joins("p", FACT1_DIMS)}
)
SELECT AgeGroupKey, LocationKey, GradeKey, PersonTypeKey, NationalityKey, GenderKey, DayKey,
       InformalOrgKey, FormalOrgKey,
       count(*) AS EmployeeCount,
       CAST(sum(is_new_hire) AS BIGINT) AS NewHireCount,
       CAST(sum(is_separation) AS BIGINT) AS SeparationCount
FROM f1
GROUP BY ALL"""


def organization_sql(src: str) -> str:
    return f"""
{dim_ctes(src)},
f2 AS (
  SELECT {day_key("p")} AS DayKey, d_informal_org.InformalOrgKey, d_formal_org.FormalOrgKey
  FROM (SELECT * FROM {src} WHERE {FACT_FILTER}) p
  {lookup_joins("p", ["informal_org", "formal_org"])}
)
SELECT DayKey, InformalOrgKey, FormalOrgKey, count(*) AS OrganizationCount FROM f2 GROUP BY ALL"""


DETAIL_SELECT = """
  employee_number AS EmployeeNumber, full_name AS EmployeeName, user_type AS PersonType,
  org_function AS "Function", org_department AS Department, org_discipline AS Discipline,
  org_business_unit AS BusinessUnit, org_service_line AS ServiceLine,
  location_code AS Location, location_country AS Country, email AS Email,
  worker_type AS EmploymentType, assignment_status AS AssignmentStatus,
  business_group AS BusinessGroup, operating_unit AS OperatingUnit,
  manager_name AS ManagerName, manager_number AS ManagerNumber, manager_email AS ManagerEmail"""


def detail_sql(src: str) -> str:
    """Detail rows: people surviving fact 1's filters and lookups on the latest day."""
    return f"""
{derived(src, "f1_src")},
{dim_ctes(src)},
looked AS (
  SELECT p.*, make_date(p.year, p.month, p.day) AS ExactDate
  FROM (SELECT * FROM f1_src WHERE {FACT_FILTER}) p
  {lookup_joins("p", FACT1_DIMS)}
)
SELECT {DETAIL_SELECT}
FROM looked WHERE ExactDate = (SELECT max(ExactDate) FROM looked)"""


# ---------------------------------------------------------------------------
# Run histories
# ---------------------------------------------------------------------------

EVENT_RUNS = """
ev AS (
  SELECT event_id, event_type, user_id % 4 AS batch,
         ts + to_days(CAST((user_id % 3) * 31 AS INTEGER)) AS rts
  FROM events
),
ev_runs AS (
  SELECT CAST(rts AS DATE) AS run_date, hour(rts) - hour(rts) % 6 AS slot, batch,
         min(event_id) AS first_event, count(*) AS n,
         count(*) FILTER (WHERE event_type = 'error') AS n_err, min(rts) AS first_ts
  FROM ev GROUP BY ALL
),
ev_named AS (
  SELECT *, 'r' || strftime(run_date, '%Y%m%d') || lpad(CAST(slot AS VARCHAR), 2, '0') || '-' || CAST(batch AS VARCHAR) AS guid
  FROM ev_runs
),
event_history AS (
  SELECT
    CASE WHEN n_err * 2 > n THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN batch % 2 = 0 THEN 'Model' ELSE 'Report' END AS datasource_name,
    CASE WHEN first_event % 7 = 0 THEN 'Other' ELSE 'FullUserInfo' END AS etl_name,
    CASE WHEN batch = 3 THEN
      '/landing/report/year=' || CAST(year(run_date) AS VARCHAR) || '/month=' || CAST(month(run_date) AS VARCHAR)
      || '/day=' || CAST(day(run_date) AS VARCHAR) || '/etlid=' || guid || '/hour=' || CAST(slot AS VARCHAR)
    ELSE
      '/landing/events/year=' || CAST(year(run_date) AS VARCHAR)
      || '/month=' || lpad(CAST(month(run_date) AS VARCHAR), 2, '0')
      || '/day=' || lpad(CAST(day(run_date) AS VARCHAR), 2, '0')
      || '/hour=' || lpad(CAST(slot AS VARCHAR), 2, '0') || '/etlid=' || guid || '/'
    END AS data_path,
    CASE WHEN first_event % 10 = 0 THEN NULL ELSE date_trunc('minute', first_ts) END AS start,
    guid AS run_guid
  FROM ev_named
)"""

PEOPLE_RUNS = """
p_days AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(CASE WHEN day(o_orderdate) < 16 THEN 1 ELSE 16 END AS INTEGER) AS day
  FROM orders
),
p_runs AS (
  SELECT *, 'a' AS tag, 6 AS hour, 'Model' AS ds FROM p_days
  UNION ALL SELECT *, 'b', 18, 'Model' FROM p_days
  UNION ALL SELECT *, 'c', 20, 'Report' FROM p_days
),
people_history AS (
  SELECT
    CASE WHEN tag = 'b' AND month % 4 = 0 AND day = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    ds AS datasource_name,
    'FullUserInfo' AS etl_name,
    '/landing/people/year=' || CAST(year AS VARCHAR) || '/month=' || lpad(CAST(month AS VARCHAR), 2, '0')
      || '/day=' || lpad(CAST(day AS VARCHAR), 2, '0') || '/hour=' || lpad(CAST(hour AS VARCHAR), 2, '0')
      || '/etlid=' || guid || '/' AS data_path,
    CASE WHEN tag = 'b' AND month = 7 AND day = 16 THEN NULL
         ELSE make_timestamp(year, month, day, hour, 5, 0) END AS start,
    guid AS run_guid
  FROM (SELECT *, 'p' || CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0')
                  || lpad(CAST(day AS VARCHAR), 2, '0') || tag AS guid FROM p_runs)
),
landing AS (
  SELECT people.*, 6 AS hour, 'p' || CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0')
         || lpad(CAST(day AS VARCHAR), 2, '0') || 'a' AS etlid FROM people
  UNION ALL
  SELECT people.*, 18 AS hour, 'p' || CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0')
         || lpad(CAST(day AS VARCHAR), 2, '0') || 'b' AS etlid FROM people
)"""


def path_parts(src: str, compat: bool = False) -> str:
    if compat:
        parts = ", ".join(
            f"regexp_extract(data_path, '{p}=(\\d+)\\S', 1) AS {p}" for p in ("year", "month", "day", "hour")
        )
    else:
        parts = ", ".join(
            f"TRY_CAST(NULLIF(regexp_extract(data_path, '{p}=(\\d+)', 1), '') AS INTEGER) AS {p}"
            for p in ("year", "month", "day", "hour")
        )
    return f"SELECT *, {parts} FROM {src}"


def successful(src: str) -> str:
    return f"SELECT * FROM {src} WHERE status = 'SUCCESS' AND datasource_name = 'Model' AND etl_name = 'FullUserInfo'"


def latest(src_sql: str) -> str:
    return f"""SELECT * EXCLUDE (rk) FROM (
  SELECT *, rank() OVER (PARTITION BY year, month, day ORDER BY hour DESC NULLS LAST, start DESC NULLS LAST) AS rk
  FROM ({src_sql})
) WHERE rk = 1 AND start IS NOT NULL AND hour IS NOT NULL"""


def watermark(y: str, m: str, d: str, compat: bool) -> str:
    if compat:
        return f"year >= '{y}' AND month >= '{m}' AND day > '{d}'"
    y_, m_, d_ = int(y), int(m), int(d)
    return f"(year > {y_} OR (year = {y_} AND month > {m_}) OR (year = {y_} AND month = {m_} AND day > {d_}))"


def chosen_people_runs(compat: bool = False, since: tuple[str, str, str] | None = None) -> str:
    sql = latest(path_parts(f"({successful('people_history')})", compat))
    if since:
        sql = f"SELECT * FROM ({sql}) WHERE {watermark(*since, compat)}"
    cast = "TRY_CAST(NULLIF({c}, '') AS INTEGER)" if compat else "{c}"
    cols = ", ".join(cast.format(c=c) + f" AS {c}" for c in ("year", "month", "day", "hour"))
    return f"SELECT {cols}, run_guid AS etlid FROM ({sql})"


def loaded_people(compat: bool = False, since: tuple[str, str, str] | None = None) -> str:
    return f"""
chosen AS ({chosen_people_runs(compat, since)}),
loaded AS (SELECT l.* FROM landing l JOIN chosen c ON l.year = c.year AND l.month = c.month
           AND l.day = c.day AND l.hour = c.hour AND l.etlid = c.etlid)"""
