"""Roster layouts: 25 positional string fields under two name sets, and sides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType

# The 25 intake field names, in file order.
INTAKE_NAMES: tuple[str, ...] = (
    "sfa_name", "aun9_3", "school_name", "school_code4", "pasecureid",
    "student_first_name", "student_middle_name", "student_last_name", "student_dob",
    "student_address1", "student_address2", "student_apt_no", "student_city",
    "student_state", "student_zip", "eligibility", "county",
    "case_number", "parent_first_name", "parent_last_name", "parent_phone", "parent_email",
    "enrollment_begin", "enrollment_end", "validation_output",
)

# The same 25 positions under the consolidated names.
CONSOLIDATED_NAMES: tuple[str, ...] = (
    "LEAname", "AUN", "sitename", "siteID", "studentID", "studentfirstname",
    "studentmiddlename", "studentlastname", "studentDOB", "studentaddress1",
    "studentaddress2", "aptnum", "city", "state", "zip", "eligibility",
    "addresscounty", "casenumber", "parentfirstname", "parentlastname",
    "parentphone", "parentemail", "enrollbegin", "enrollend", "validationoutput",
)

# The seven fields cleaned at intake (trim + lower case).
KEY_FIELDS: tuple[str, ...] = (
    "aun9_3", "pasecureid", "student_dob", "student_last_name",
    "student_first_name", "parent_first_name", "parent_last_name",
)

ROSTER_WIDTH = len(INTAKE_NAMES)


def roster_schema(names=INTAKE_NAMES, corrupt_column: str | None = None) -> StructType:
    """All-string positional schema; optionally with the reader's corrupt-row column."""
    fields = [StructField(n, StringType(), True) for n in names]
    if corrupt_column:
        fields.append(StructField(corrupt_column, StringType(), True))
    return StructType(fields)


@dataclass(frozen=True)
class Side:
    """One roster of the pair: a label for outputs and a prefix for its columns."""

    name: str
    prefix: str

    def col(self, field: str) -> str:
        return self.prefix + field

    def cols(self, fields) -> list[str]:
        return [self.prefix + f for f in fields]


# The two rosters: the student upload (S) and the meal system (P).
STUDENT = Side("student_upload", "s_")
MEAL = Side("meal_system", "p_")
