"""Declared schemas of the inputs, the targets and the repository tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES = {
    "int": IntegerType(),
    "bigint": LongType(),
    "money": DecimalType(15, 2),
    "string": StringType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
}


def schema_of(text: str) -> StructType:
    """Schema from ``name type, name type, ...``; needs no running session."""
    result = StructType()
    for column in text.split(","):
        name, kind = column.split()
        result = result.add(name, _TYPES[kind])
    return result


# Columns of the lobbying file, as read.
LOBBYING_FILE = schema_of(
    """
    form_submission_id int, reporting_year int, filing_type string, reporting_period string,
    principal_lobbyist_name string, contractual_client_name string,
    beneficial_client_name string, individual_lobbyist_name string,
    compensation money, reimbursed_expenses money,
    expenses_less_than_75 money, lobbying_expenses_for_non money,
    itemized_expenses money, expense_type string, expense_paid_to string,
    expense_reimbursed_by_client string, expense_purpose string, expense_date timestamp,
    lobbying_subjects string, level_of_government string, lobbying_focus_type string,
    focus_identifying_number string, type_of_lobbying_communication string,
    government_body string, monitoring_only string, party_name string, unique_id string
    """
)

# Columns of the processed records; record_id and created_at are added on load.
LOBBYING_TARGET = schema_of(
    """
    form_submission_id int, reporting_year int, filing_type string, reporting_period string,
    principal_lobbyist_name string, contractual_client_name string,
    beneficial_client_name string, individual_lobbyist_name string,
    compensation money, reimbursed_expenses money,
    expenses_less_than_75 money, lobbying_expenses_for_non money,
    itemized_expenses money, total_financials money, expense_type string,
    expense_paid_to string, expense_reimbursed_by_client string, expense_purpose string,
    expense_date date, lobbying_subjects string, level_of_government string,
    lobbying_focus_type string, focus_identifying_number string,
    type_of_lobbying_communication string, government_body string, monitoring_only boolean,
    party_name string, unique_id string
    """
)

# Numeric columns of the registration file; the others are text.
REGISTRATION_TYPES = {
    "DOL Vehicle ID": "bigint",
    "Model Year": "int",
    "Year": "int",
    "Electric Range": "int",
    "Odometer Reading": "int",
    "Sale Price": "int",
    "Base MSRP": "int",
}

# Error and run repository. Run events are append-only; the state of a run is its newest
# value per field.
RECORD_ERRORS = schema_of("record_id string, processing_file_id bigint, record_text string")
COLUMN_ERRORS = schema_of(
    "record_id string, processing_file_id bigint, column_name string, error_code int"
)
FILE_NAMES = schema_of("processing_file_id bigint, processing_file_name string")
FILE_SCHEMAS = schema_of("file_schema_id int, file_category_name string, schema_text string")
RUN_EVENTS = schema_of(
    """
    processing_file_id bigint, event_time timestamp, file_schema_id int,
    time_of_arrival timestamp, process_start_time timestamp, process_end_time timestamp,
    input_file_size bigint, initial_count bigint, processed_count bigint,
    error_count bigint, distinct_error_count bigint
    """
)

# Star schema.
MAKE_DIM = schema_of("make_id bigint, make string")
MODEL_DIM = schema_of("model_id bigint, model string")
PRIMARY_USE_DIM = schema_of("primary_use_id bigint, primary_use string")
ELECTRIC_UTILITY_DIM = schema_of("electric_utility_id bigint, electric_utility_name string")
STATE_DIM = schema_of("state_id bigint, state string")
TRANSACTION_TYPE_DIM = schema_of("transaction_type_id bigint, transaction_type string")
FEE_DIM = schema_of(
    """
    fee_id bigint, electric_vehicle_fee string, transportation_electrification_fee string,
    hybrid_vehicle_fee string
    """
)
CITY_DIM = schema_of("city_id bigint, city string, state_id bigint")
LOCATION_DIM = schema_of("location_id bigint, city_id bigint, state_id bigint, county string")
TIME_DIM = schema_of("full_date date, year int, quarter int, month int, day_of_week string")
VEHICLE_DIM = schema_of(
    """
    vehicle_id bigint, dol_vehicle_id bigint, vin_prefix string, model_year int,
    make_id bigint, model_id bigint, primary_use_id bigint, electric_utility_id bigint
    """
)
FACTS = schema_of(
    """
    vehicle_id bigint, transaction_date date, sale_date date, location_id bigint,
    transaction_type_id bigint, base_msrp int, sale_price int, odometer_reading int,
    electric_range int, fee_id bigint
    """
)
FACTS_BY_TYPE_NAME = schema_of(
    """
    vehicle_id bigint, transaction_date date, sale_date date, location_id bigint,
    transaction_type string, base_msrp int, sale_price int, odometer_reading int,
    electric_range int, fee_id bigint
    """
)
