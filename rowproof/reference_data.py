"""Values fixed by the file formats and by the error repository."""

from __future__ import annotations

# Error codes and their messages.
ERROR_MESSAGES = {
    1001: "Missing required field",
    1002: "Null value encountered in non-nullable column",
    1003: "Data type mismatch",
    1004: "Value exceeds maximum allowable length",
    1005: "Invalid date format",
    1006: "Invalid numeric format",
    1007: "Foreign key constraint violation",
    1008: "Duplicate primary key",
    1009: "Unique constraint violation",
    1010: "Invalid value in enum field",
    1011: "Failed to parse JSON structure",
    1012: "Value out of allowable range",
    1013: "Inconsistent data between source and target",
    1014: "Missing foreign key reference",
    1015: "Duplicate record detected",
    1016: "Failed to connect to source system",
    1017: "Failed to connect to target database",
    1018: "Insufficient privileges for data access",
    1019: "Failed data validation against schema",
    1020: "Data truncation warning",
    1021: "Invalid currency code format",
    1022: "Failed data transformation",
    1023: "Record exceeds allowable file size",
    1024: "Unsupported file format",
    1025: "Required file missing in source",
    1026: "Row processing timeout",
    1027: "Header row missing in CSV file",
    1028: "Unsupported character encoding",
    1029: "Aggregation function error",
    1030: "Failed to load record into target database",
}

MISSING_REQUIRED = ERROR_MESSAGES[1001]
NULL_VALUE = ERROR_MESSAGES[1002]
WRONG_TYPE = ERROR_MESSAGES[1003]
BAD_DATE = ERROR_MESSAGES[1005]
BAD_NUMBER = ERROR_MESSAGES[1006]
BAD_ENUM = ERROR_MESSAGES[1010]
OUT_OF_RANGE = ERROR_MESSAGES[1012]
MISSING_REFERENCE = ERROR_MESSAGES[1014]
DUPLICATE_RECORD = ERROR_MESSAGES[1015]

# The ledger entry that stands for all duplicates of a file.
DUPLICATE_RECORD_TEXT = '{"error": "Duplicate records found"}'
DUPLICATE_COLUMN_NAME = "N/A"

# Date text of the registration file.
REGISTRATION_DATE_FORMAT = "MMMM dd yyyy"

# Money columns summed into total_financials.
LOBBYING_MONEY_COLUMNS = [
    "compensation",
    "reimbursed_expenses",
    "expenses_less_than_75",
    "lobbying_expenses_for_non",
    "itemized_expenses",
]

# Columns a registration must fill, in the order they are tested.
MANDATORY_REGISTRATION_COLUMNS = [
    "County",
    "City",
    "State",
    "Postal Code",
    "Legislative District",
    "Model",
]

# Fee flags of the registration file and their names in the fee dimension.
FEE_COLUMNS = {
    "Electric Vehicle Fee Paid": "electric_vehicle_fee",
    "Transportation Electrification Fee Paid": "transportation_electrification_fee",
    "Hybrid Vehicle Electrification Fee Paid": "hybrid_vehicle_fee",
}

# Transaction types whose empty sale date takes the transaction date. The
# data spells the last one "Transfer Title"; both spellings are accepted.
SALE_DATE_FILL_TYPES = [
    "Original Title",
    "Original Registration",
    "Title Transfer",
    "Transfer Title",
]

# Latest plausible model year; first and last day of the calendar.
LATEST_MODEL_YEAR = 2025
CALENDAR_START = "2010-01-01"
CALENDAR_END = "2025-12-31"

# Columns common to the yearly registration files, in target order.
YEARLY_COLUMNS = [
    "Model",
    "Make",
    "Clean Alternative Fuel Vehicle Type",
    "VIN (1-10)",
    "DOL Vehicle ID",
    "Model Year",
    "Primary Use",
    "Electric Range",
    "Odometer Reading",
    "Odometer Reading Description",
    "New or Used Vehicle",
    "Sale Price",
    "Sale Date",
    "Base MSRP",
    "Transaction Type",
    "Transaction Date",
    "Year",
    "County",
    "City",
    "State",
    "Postal Code",
    "2019 HB 2042: Clean Alternative Fuel Vehicle (CAFV) Eligibility",
    "Meets 2019 HB 2042 Electric Range Requirement",
    "Meets 2019 HB 2042 Sale Date Requirement",
]
