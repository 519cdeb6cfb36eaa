"""Employee detail: the latest snapshot day's people, flattened to 18 columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.nested import first_location_code, first_location_country, last_manager_email


def detail_columns() -> list[Column]:
    """Output columns in their declared order (rows are not de-duplicated)."""
    return [  # FIXED VALUES (output schema)
        F.col("id.employee_number").alias("EmployeeNumber"),
        F.col("employee_name.full_name").alias("EmployeeName"),
        F.col("user_type").alias("PersonType"),
        F.col("org_function").alias("Function"),
        F.col("org_department").alias("Department"),
        F.col("org_discipline").alias("Discipline"),
        F.col("org_business_unit").alias("BusinessUnit"),
        F.col("org_service_line").alias("ServiceLine"),
        first_location_code().alias("Location"),
        first_location_country().alias("Country"),
        F.col("email").alias("Email"),
        F.col("worker_type").alias("EmploymentType"),
        F.col("assignment_status").alias("AssignmentStatus"),
        F.col("business_group").alias("BusinessGroup"),
        F.col("operating_unit").alias("OperatingUnit"),
        F.col("managers.name.full_name").alias("ManagerName"),
        F.col("managers.id.employee_number").alias("ManagerNumber"),
        last_manager_email().alias("ManagerEmail"),
    ]
