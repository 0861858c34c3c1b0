"""Explicit schemas for the ticket tables.

The original reads CSVs with inferred types; inference costs a full extra
pass over the files and is unstable across partitions, so every read here
takes an explicit ``StructType``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampNTZType()

_COMMON = [
    ("ticket_id", _L),
    ("agency_name", _S),
    ("inspector_name", _S),
    ("violator_name", _S),
    ("violation_street_number", _S),
    ("violation_street_name", _S),
    ("violation_zip_code", _S),
    ("mailing_address_str_number", _S),
    ("mailing_address_str_name", _S),
    ("city", _S),
    ("state", _S),
    ("zip_code", _S),
    ("non_us_str_code", _S),
    ("country", _S),
    ("ticket_issued_date", _TS),
    ("hearing_date", _TS),
    ("violation_code", _S),
    ("violation_description", _S),
    ("disposition", _S),
    ("fine_amount", _D),
    ("admin_fee", _D),
    ("state_fee", _D),
    ("late_fee", _D),
    ("discount_amount", _D),
    ("clean_up_cost", _D),
    ("judgment_amount", _D),
    ("grafitti_status", _S),
]

_TRAIN_ONLY = [
    ("payment_amount", _D),
    ("payment_date", _TS),
    ("payment_status", _S),
    ("balance_due", _D),
    ("collection_status", _S),
    ("compliance_detail", _S),
    ("compliance", _D),
]


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TRAIN_SCHEMA = _struct(_COMMON + _TRAIN_ONLY)
SCORING_SCHEMA = _struct(_COMMON)
ADDRESS_SCHEMA = _struct([("ticket_id", _L), ("address", _S)])
LATLON_SCHEMA = _struct([("address", _S), ("lat", _D), ("lon", _D)])
SCORE_SCHEMA = _struct([("ticket_id", _L), ("compliance", _D)])
