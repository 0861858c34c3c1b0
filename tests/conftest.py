import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.schema import SCORING_SCHEMA, TRAIN_SCHEMA  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def _ticket(tid, **kw):
    base = dict(ticket_id=tid, agency_name="Buildings, Safety Engineering & Env Department",
                inspector_name="Sims, Martinzie", violator_name="JOHN SMITH",
                violation_street_number="2900", violation_street_name="TYLER",
                violation_zip_code=None, mailing_address_str_number="3",
                mailing_address_str_name="S. WICKER", city="DETROIT", state="MI",
                zip_code="48227", non_us_str_code=None, country="USA",
                ticket_issued_date=datetime(2005, 3, 21, 10, 30),
                hearing_date=datetime(2005, 5, 6, 11, 0), violation_code="9-1-36(a)",
                violation_description="Failure of owner to obtain certificate",
                disposition="Responsible by Default", fine_amount=250.0, admin_fee=20.0,
                state_fee=10.0, late_fee=25.0, discount_amount=0.0, clean_up_cost=0.0,
                judgment_amount=305.0, grafitti_status=None)
    base.update(kw)
    return base


TRAIN_ROWS = [
    _ticket(1, compliance=1.0),
    _ticket(2, compliance=0.0, violator_name="ACME INC", city="Deroit"),
    _ticket(3, compliance=None),
    _ticket(4, compliance=1.0, hearing_date=None, violator_name=None, city="south field"),
    _ticket(5, compliance=0.0, disposition="Responsible (Fine Waived) by Deter",
            mailing_address_str_name="PO BOX 123"),
    _ticket(6, compliance=1.0, hearing_date=datetime(2005, 1, 1), violator_name="PRINCE HALL",
            mailing_address_str_name="8 MILE RD", city="LOS ANGLES"),
    _ticket(7, compliance=0.0, violator_name="PARCEL 12", city=None, zip_code=None,
            violation_code="22-2-88"),
    _ticket(8, compliance=1.0, violator_name="First Church of God", city="BUFFLAO",
            fine_amount=100.0, judgment_amount=140.0),
    _ticket(9, compliance=0.0, disposition="Responsible by Determination"),
]
SCORING_ROWS = [
    _ticket(101, ticket_issued_date=datetime(2013, 1, 1, 9, 0), hearing_date=datetime(2013, 2, 1)),
    _ticket(102, disposition="Responsible by Dismissal"),
    _ticket(103, disposition="Responsible (Fine Waived) by Admis"),
    _ticket(104, city=None, hearing_date=None),
    _ticket(105, city="Detroit1", disposition="Responsible - Compl/Adj by Determi",
            violation_code="9-1-99"),
    _ticket(106, city="NEW YOUR", ticket_issued_date=datetime(2013, 6, 1, 20, 0)),
]


def _train_tuple(r):
    return tuple(r.get(f.name) for f in TRAIN_SCHEMA.fields)


@pytest.fixture(scope="session")
def train_df(spark):
    rows = []
    for r in TRAIN_ROWS:
        d = dict(r)
        d.update(payment_amount=0.0, payment_date=None, payment_status="NO PAYMENT APPLIED",
                 balance_due=0.0, collection_status=None, compliance_detail="x")
        rows.append(tuple(d.get(f.name) for f in TRAIN_SCHEMA.fields))
    return spark.createDataFrame(rows, TRAIN_SCHEMA)


@pytest.fixture(scope="session")
def scoring_df(spark):
    rows = [tuple(r.get(f.name) for f in SCORING_SCHEMA.fields) for r in SCORING_ROWS]
    return spark.createDataFrame(rows, SCORING_SCHEMA)
