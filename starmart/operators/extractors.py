"""Dimension members read off the people frame.

An extractor names the dimension's attribute columns and the people expression
for each; the same expressions are the left side of the dimension's lookup.
``dimensions.dimension_members`` collects the members of all of them in one pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.nested import first_location_country
from .filters import not_denied_person_type


@dataclass(frozen=True)
class Extractor:
    attrs: tuple[str, ...]
    sources: tuple[Callable[[], Column], ...]
    keep: Callable[[], Column] | None = None

    def columns(self) -> list[Column]:
        """People expressions, one per attribute (unaliased)."""
        return [s() for s in self.sources]


def _col(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


LOCATION = Extractor(("country",), (first_location_country,))
NATIONALITY = Extractor(("name",), (_col("nationality"),))
GENDER = Extractor(("name",), (_col("gender"),))
GRADE = Extractor(("name",), (_col("grade"),))
PERSON_TYPE = Extractor(("name",), (_col("user_type"),), keep=not_denied_person_type)

# FIXED VALUES (output schema): people column -> dimension column
INFORMAL_ORG_COLUMNS = (
    ("org_business_unit", "BusinessUnit"),
    ("org_service_line", "ServiceLine"),
    ("org_function", "Function"),
    ("org_department", "Department"),
)
FORMAL_ORG_COLUMNS = (
    ("business_group", "BusinessGroup"),
    ("operating_unit", "OperatingUnit"),
)

INFORMAL_ORG = Extractor(
    tuple(d for _, d in INFORMAL_ORG_COLUMNS), tuple(_col(s) for s, _ in INFORMAL_ORG_COLUMNS)
)
FORMAL_ORG = Extractor(tuple(d for _, d in FORMAL_ORG_COLUMNS), tuple(_col(s) for s, _ in FORMAL_ORG_COLUMNS))
