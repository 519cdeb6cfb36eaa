"""Fixed values that define the published measures, and table names.

Everything here is a value the results depend on; keep it in one place.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay exactly as written for results to match)
# ---------------------------------------------------------------------------

# Allow-lists, compared case-insensitively.
WORKER_TYPES = ("E", "C")
ASSIGNMENT_STATUSES = ("A", "B")

# Deny-list of person types (already lower case), compared case-insensitively.
DENIED_PERSON_TYPES = ("ex-employee", "ex-contingent worker")

# Age bands: (label, lowest age, highest age or None); below 18 is no band.
AGE_BANDS = (
    ("18-24", 18, 24),
    ("25-34", 25, 34),
    ("35-44", 35, 44),
    ("45-54", 45, 54),
    ("55+", 55, None),
)
DAYS_PER_YEAR = 365

# Run history defaults.
HISTORY_TABLE = "dbo.ingest_data_history"
FULL_USER_INFO_ETL = "FullUserInfo"
REPORT_DATA_SOURCE = "Report"
MODEL_DATA_SOURCE = "Model"
SUCCESS_STATUS = "SUCCESS"

# Path patterns of the compatibility mode.
COMPAT_PATH_PART = r"=(\d+)\S"
COMPAT_WATERMARK = r"year=(\d+)\Smonth=(\d+)\Sday=(\d+)\S"

# Partition keys shared by run history and snapshot trees.
PARTITION_KEYS = ("year", "month", "day", "hour", "etlid")
DAY_PARTS = ("year", "month", "day")

# Table names.
FACT_HEADCOUNT = "reporting.EmployeeHeadcountFact"
FACT_ORGANIZATION = "reporting.OrganizationCountFact"

DIM_PERSON_TYPE = "reporting.PersonTypeDim"
DIM_GENDER = "reporting.GenderDim"
DIM_GRADE = "reporting.GradeDim"
DIM_NATIONALITY = "reporting.NationalityDim"
DIM_LOCATION = "reporting.LocationDim"
DIM_AGE_GROUP = "reporting.AgeGroupDim"
DIM_DAY = "reporting.DayDim"
DIM_INFORMAL_ORG = "reporting.InformalOrgDim"
DIM_FORMAL_ORG = "reporting.FormalOrgDim"
EMPLOYEE_DETAIL = "reporting.EmployeeDetail"

# ---------------------------------------------------------------------------
# Own settings
# ---------------------------------------------------------------------------

# The as-of date every query and test uses, so results are repeatable.
QUERY_AS_OF = _dt.date(1998, 3, 1)

# Lookup sides above this many rows are joined by shuffle instead of broadcast.
BROADCAST_MAX_ROWS = 1_000_000
