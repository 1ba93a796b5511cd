"""Code dictionaries and their lookups."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayline.functions.columns import as_col

# ---- fixed values: code dictionaries ---------------------------------------
PROFESSION_NAMES = {
    10: "Merchants",
    15: "ServiceProviders",
    20: "ManagingPartners",
    25: "Pension",
    30: "SeniorMgmt_Private",
    31: "MiddleMgmt_Private",
    32: "HealthProfessional",
    33: "Nurse",
    34: "Doctor",
    35: "Teacher",
    40: "SeniorMgmt_Public",
    41: "MiddleMgmt_Public",
    60: "OfficeCommerce",
    70: "PublicEmployees",
    74: "Military_Police",
    80: "Workers",
    81: "Driver_Security",
    86: "CleaningStaff",
    90: "Retired_Private",
    91: "Retired_Public",
    92: "Unemployed",
    96: "TemporaryContractor",
    99: "Indeterminate",
}
PROFESSION_DISPLAY = {
    10: "Merchants",
    15: "Service Providers",
    20: "Managing Partners",
    25: "Pension Income",
    30: "Private Directors",
    31: "Private Dept Heads",
    32: "Health Professional",
    33: "Nurse",
    34: "Doctor",
    35: "Teacher",
    40: "Public Directors",
    41: "Public Dept Heads",
    60: "Office Employees",
    70: "Public Employees",
    74: "Military/Police",
    80: "Workers",
    81: "Driver-Security",
    86: "Cleaning Staff",
    90: "Retired Private",
    91: "Retired Public",
    92: "Unemployed",
    96: "Fixed-term Contract",
    99: "Indeterminate",
    56: "Other (56)",
}
FAMILY_DISPLAY = {
    "C": "Married",
    "D": "Divorced",
    "F": "Other (F)",
    "P": "Other (P)",
    "S": "Single",
    "U": "Cohabiting/Partnered",
    "V": "Widowed",
    "X": "Other/Unknown",
}
HOUSING_DISPLAY = {
    "A": "Property Loan",
    "E": "Employer Housing",
    "F": "Family Home",
    "L": "Tenant/Rental",
    "O": "Other",
    "P": "Owner",
    "X": "Unknown",
}
HOUSING_STABILITY = {"P": 3, "A": 2, "F": 2, "L": 1, "O": 0, "X": 0}
PARTNERED_CODES = ("C", "U")
# ----------------------------------------------------------------------------


def lookup(c: Column | str, mapping: dict) -> Column:
    """Value for the code, null for an unknown or missing code."""
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(entries, as_col(c))


def profession_name(code: Column | str) -> Column:
    """Name of a profession code, ``Other_<code>`` when unlisted, ``Unknown`` when null."""
    code = as_col(code)
    whole = F.floor(code).cast("int")
    return F.coalesce(
        lookup(F.when(whole == code, whole), PROFESSION_NAMES),
        F.concat(F.lit("Other_"), whole.cast("string")),
        F.lit("Unknown"),
    )


def display_label(code: Column | str, mapping: dict) -> Column:
    """Readable label; the code itself as text when unlisted, ``Unknown`` when null."""
    code = as_col(code)
    keyed = code if isinstance(next(iter(mapping)), str) else F.floor(code).cast("int")
    return F.coalesce(lookup(keyed, mapping), code.cast("string"), F.lit("Unknown"))
