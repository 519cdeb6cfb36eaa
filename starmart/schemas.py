"""Declared schemas: the people snapshot and the employee detail."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()

WORK_LOCATION = T.StructType(
    [
        T.StructField("code", S),
        T.StructField("country", T.StructType([T.StructField("name", S)])),
    ]
)

MANAGERS = T.StructType(
    [
        T.StructField("name", T.StructType([T.StructField("full_name", S)])),
        T.StructField("id", T.StructType([T.StructField("employee_number", S)])),
    ]
)

# One row per employee per snapshot run (without the directory partition columns).
PEOPLE_COLUMNS = T.StructType(
    [
        T.StructField("id", T.StructType([T.StructField("employee_number", S)])),
        T.StructField("employee_name", T.StructType([T.StructField("full_name", S)])),
        T.StructField("user_type", S),
        T.StructField("gender", S),
        T.StructField("grade", S),
        T.StructField("nationality", S),
        T.StructField("work_location", T.ArrayType(WORK_LOCATION)),
        T.StructField("date_of_birth", T.DateType()),
        T.StructField("hire_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("worker_type", S),
        T.StructField("assignment_status", S),
        T.StructField("org_business_unit", S),
        T.StructField("org_service_line", S),
        T.StructField("org_function", S),
        T.StructField("org_department", S),
        T.StructField("org_discipline", S),
        T.StructField("business_group", S),
        T.StructField("operating_unit", S),
        T.StructField("email", S),
        T.StructField("managers", MANAGERS),
        T.StructField("managers_hierarchy", T.ArrayType(T.StructType([T.StructField("email", S)]))),
    ]
)

DAY_PARTITIONS = [T.StructField("year", I), T.StructField("month", I), T.StructField("day", I)]
RUN_PARTITIONS = DAY_PARTITIONS + [T.StructField("hour", I), T.StructField("etlid", S)]

# The snapshot tree as read: people columns plus the directory partitions.
PEOPLE_SNAPSHOT = T.StructType(PEOPLE_COLUMNS.fields + RUN_PARTITIONS)

DETAIL_COLUMNS = (
    "EmployeeNumber",
    "EmployeeName",
    "PersonType",
    "Function",
    "Department",
    "Discipline",
    "BusinessUnit",
    "ServiceLine",
    "Location",
    "Country",
    "Email",
    "EmploymentType",
    "AssignmentStatus",
    "BusinessGroup",
    "OperatingUnit",
    "ManagerName",
    "ManagerNumber",
    "ManagerEmail",
)
EMPLOYEE_DETAIL = T.StructType([T.StructField(c, S) for c in DETAIL_COLUMNS])
