"""Synthetic rows in the layouts of the input files."""

import csv

from rowproof.schemas import LOBBYING_FILE

MONEY = ["compensation", "reimbursed_expenses", "expenses_less_than_75",
         "lobbying_expenses_for_non", "itemized_expenses"]

# Totals of the four complete records, and the gaps of the two others.
TOTALS = {3: 482630, 5: 481526, 6: 497366, 7: 483305}
GAPS = {2: ["principal_lobbyist_name", "expense_paid_to"], 4: ["reporting_period"]}


def lobbying_rows():
    rows = []
    for line in range(2, 8):
        row = {name: f"{name} {line}" for name in LOBBYING_FILE.names}
        row.update(form_submission_id=line, reporting_year=2023, monitoring_only="No",
                   expense_date="2023-01-05T00:00:00.000")
        row["expense_purpose"] = 'a "quoted", text'
        total = TOTALS.get(line, 1000)
        row.update(dict(zip(MONEY, [total - 100, 10, 20, 30, 40])))
        row.update({name: "" for name in GAPS.get(line, [])})
        rows.append(row)
    return rows


def write_rows(path, rows, columns):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.DictWriter(file, columns)
        writer.writeheader()
        writer.writerows(rows)


REGISTRATION = {
    "VIN (1-10)": "VIN1", "DOL Vehicle ID": "100", "Model Year": "2019", "Make": "M1",
    "Model": "X", "Primary Use": "Passenger", "Electric Utility": "U1", "Electric Range": "50",
    "Odometer Reading": "7", "Sale Price": "30000.00", "Base MSRP": "0",
    "Transaction Type": "Original Title", "Transaction Date": "May 04 2020",
    "Sale Date": "May 01 2020", "Year": "2020", "County": "K", "City": "C1", "State": "WA",
    "Postal Code": "98000", "Legislative District": "1",
    "Electric Vehicle Fee Paid": "Yes", "Transportation Electrification Fee Paid": "No",
    "Hybrid Vehicle Electrification Fee Paid": "Not Applicable",
}


def registration(**changes):
    names = {name.lower().replace(" ", "_"): name for name in REGISTRATION}
    return {**REGISTRATION, **{names[key]: value for key, value in changes.items()}}


def registration_rows():
    plain = registration()
    return [
        plain,
        plain,
        registration(dol_vehicle_id="101", transaction_date="January 02 2999"),
        registration(dol_vehicle_id="102", sale_date="January 02 2999", county=""),
        registration(dol_vehicle_id="103", transaction_date="someday"),
        registration(dol_vehicle_id="104", transaction_date="May 4 2020"),
        registration(dol_vehicle_id="105", city=""),
        registration(dol_vehicle_id="106", city="", model=""),
        registration(dol_vehicle_id="107", electric_range="0"),
        registration(dol_vehicle_id="108", electric_range="0", model="Y"),
        registration(dol_vehicle_id="109", electric_range="0", make=""),
        registration(dol_vehicle_id="110", model_year="2031"),
        registration(dol_vehicle_id="111", sale_date="", transaction_type="Transfer Title"),
        registration(dol_vehicle_id="112", sale_date="", transaction_type="Registration Renewal"),
        registration(dol_vehicle_id="113", electric_vehicle_fee_paid="YES",
                     transportation_electrification_fee_paid="",
                     hybrid_vehicle_electrification_fee_paid="Unknown"),
    ]
