"""Table schemas, file layouts and staging constraints."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


CLINIC_MAP = _struct(
    id=_I, phc_id=_I, epic_id=_I, clinic_key=_S, clinic=_S, county=_S, is_active=_I
)
MEASURES_MAP = _struct(id=_I, measure_key=_S, measure=_S, is_active=_I)
MEMBERSHIP = _struct(
    cin=_S, mpi=_I, epic_pat_id=_S, clinic_id=_I, first_name=_S, last_name=_S, dob=_D,
    sex=_S, phone_number=_S, address=_S, city=_S, state=_S, zip_code=_S,
    record_number=_S, rp=_S, eff_date=_D, end_date=_D, other_insurance=_S,
    new_member=_I, date_new_member=_D, months_enrolled=_I, months_missed=_I,
    is_enrolled=_I, is_qip_eligible=_I, download_date=_D, updated_at=_TS,
)
MEMBERSHIP_HISTORY = _struct(
    cin=_S, clinic_id=_I, year=_I, month=_I, is_qip_eligible=_I, download_date=_D,
    inserted_at=_TS,
)
MEASURES_HISTORY = _struct(
    cin=_S, clinic_id=_I, measure_id=_I, year=_I, month=_I, is_compliant=_I,
    is_qip_eligible=_I, download_date=_D, inserted_at=_TS,
)
MEASURES_SUMMARY_HISTORY = _struct(
    clinic_id=_I, measure_id=_I, year=_I, month=_I, qip_numerator=_I,
    qip_denominator=_I, numerator=_I, denominator=_I, download_date=_D, inserted_at=_TS,
)
MEASURE_GOALS = _struct(measure_id=_I, year=_I, percentage=T.DecimalType(5, 2))
MEMBERSHIP_LOG = _struct(
    logged_at=_TS, year=_I, month=_I, update_count=T.LongType(), insert_count=T.LongType(),
    enrolled_count=T.LongType(), qip_eligible_count=T.LongType(), failure_step=_S, is_success=_I,
)
MEASURES_LOG = _struct(
    logged_at=_TS, file_name=_S, download_date=_D, insert_count=T.LongType(),
    delete_count=T.LongType(), warning_message=_S, failure_step=_S, is_success=_I,
)
MATCHING_LOG = _struct(
    epic_pat_id=_S, cin=_S, dob=_D, phc_name=_S, epic_name=_S, fuzzy_score=T.DoubleType()
)

# The fields of a roster page, in file order.
ROSTER_FIELDS = [
    "BIC#/HIK#", "First Name", "Last Name", "Birth", "Sex", "Record#", "RP", "Eff Date",
    "End Date", "Other Insurnace", "New Member", "Residential Address1",
    "Residential Address2", "Residential City", "Residential State", "Residential Zip",
    "Residential Phone#",
]

# The columns of a processed roster file, in file order. "Month" stands for
# the column that a file names after its own month (Jan ... Dec).
PROCESSED_FIELDS = [
    "BIC_HIK", "Clinic", "LastName", "FirstName", "DOB", "Sex", "PhoneNumber", "Address",
    "City", "State", "ZipCode", "FullAddress", "RecordNumber", "RP", "EffDate", "EndDate",
    "OtherInsurance", "NewMember", "Month", "PHPCurrentFlag", "SpecialMemberFlag",
    "LastUpdated",
]

# Processed roster column -> membership column.
PROCESSED_TO_MEMBERSHIP = {
    "BIC_HIK": "cin", "Clinic": "clinic_id", "FirstName": "first_name",
    "LastName": "last_name", "DOB": "dob", "Sex": "sex", "PhoneNumber": "phone_number",
    "Address": "address", "City": "city", "State": "state", "ZipCode": "zip_code",
    "RecordNumber": "record_number", "RP": "rp", "EffDate": "eff_date",
    "EndDate": "end_date", "OtherInsurance": "other_insurance", "NewMember": "new_member",
    "PHPCurrentFlag": "is_enrolled", "LastUpdated": "download_date",
}

# Measures sheet column -> staged column, in file order.
SHEET_TO_MEASURES = {
    "CIN": "cin", "PCP": "clinic_id", "Member First Name": "first_name",
    "Member Last Name": "last_name", "DOB": "dob", "Age": "age", "Gender": "sex",
    "NewMember": "new_member", "Member Phone": "phone_number",
    "Measure Name": "measure_id", "QIP Result": "is_compliant",
}

# The attributes a roster row overwrites on a known member.
ROSTER_ATTRIBUTES = [
    "clinic_id", "first_name", "last_name", "dob", "sex", "phone_number", "address", "city",
    "state", "zip_code", "record_number", "rp", "eff_date", "end_date", "other_insurance",
    "new_member",
]

# The attributes a measures file overwrites on a member it re-activates.
SHEET_ATTRIBUTES = [
    "clinic_id", "first_name", "last_name", "dob", "sex", "phone_number", "new_member",
]


@dataclass(frozen=True)
class Constraints:
    """What a staged frame must satisfy before it may change a table."""

    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    exact_length: dict[str, int] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)


ROSTER_CONSTRAINTS = Constraints(
    key=("cin",),
    not_null=(
        "cin", "clinic_id", "first_name", "last_name", "dob", "new_member", "download_date",
        "is_enrolled",
    ),
    exact_length={"cin": 10},
    max_length={
        "first_name": 50, "last_name": 50, "sex": 12, "phone_number": 12, "address": 500,
        "city": 500, "state": 20, "zip_code": 10, "record_number": 20, "rp": 4,
        "other_insurance": 4,
    },
)
MEASURE_MEMBER_CONSTRAINTS = Constraints(
    key=("cin",),
    not_null=("cin", "clinic_id", "first_name", "last_name", "dob"),
    exact_length={"cin": 10},
    max_length={"first_name": 50, "last_name": 50, "sex": 12, "phone_number": 12},
)
