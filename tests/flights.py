"""Small flight-shaped fixtures with the 27-field record (built in the tests)."""

import json

from tarmac.schema import FLIGHT_FIELDS

BASE = {
    "MONTH": 1, "DAY_OF_WEEK": 3, "DEP_DEL15": 0, "DISTANCE_GROUP": 2, "DEP_BLOCK": "0800-0859",
    "SEGMENT_NUMBER": 1, "CONCURRENT_FLIGHTS": 20, "NUMBER_OF_SEATS": 150, "CARRIER_NAME": "Delta",
    "AIRPORT_FLIGHTS_MONTH": 1000, "AIRLINE_FLIGHTS_MONTH": 5000, "AIRLINE_AIRPORT_FLIGHTS_MONTH": 300,
    "AVG_MONTHLY_PASS_AIRPORT": 90000, "AVG_MONTHLY_PASS_AIRLINE": 800000, "FLT_ATTENDANTS_PER_PASS": 0.0001,
    "GROUND_SERV_PER_PASS": 0.0002, "PLANE_AGE": 10, "DEPARTING_AIRPORT": "Atlanta", "LATITUDE": 33.6,
    "LONGITUDE": -84.4, "PREVIOUS_AIRPORT": "NONE", "PRCP": 0.0, "SNOW": 0.0, "SNWD": 0.0, "TMAX": 60, "AWND": 5,
    "timestamp": 1704067200,
}


def record(**over):
    r = dict(BASE)
    r.update(over)
    return r


def wire(records):
    """JSON text per record; ``None`` values are dropped, raw strings kept as given."""
    out = []
    for r in records:
        if isinstance(r, str):
            out.append(r)
        else:
            out.append(json.dumps({k: v for k, v in r.items() if v is not None}))
    return out


def edge_records():
    """The edge rows every flight fixture carries (FIXTURES.md section 1)."""
    return [
        record(DEP_DEL15=1, CARRIER_NAME="Delta", DEPARTING_AIRPORT="Atlanta", PLANE_AGE=10, PRCP=0.5, TMAX=70),
        record(DEP_DEL15=1, CARRIER_NAME="Delta", DEPARTING_AIRPORT="Boston", PLANE_AGE=12, PRCP=0.1, TMAX=50),
        record(DEP_DEL15=0, CARRIER_NAME="United", DEPARTING_AIRPORT="Boston", PLANE_AGE=5, PRCP=0.0, TMAX=""),
        record(DEP_DEL15=0, CARRIER_NAME="United", DEPARTING_AIRPORT="Chicago", PLANE_AGE=7, TMAX=65.7),
        record(DEP_DEL15=None, CARRIER_NAME="Delta", DEPARTING_AIRPORT="Atlanta", PLANE_AGE=9),
        record(DEP_DEL15=1, CARRIER_NAME=None, DEPARTING_AIRPORT="Chicago", PLANE_AGE=3),
        record(DEP_DEL15=0, CARRIER_NAME="New Air", DEPARTING_AIRPORT="Denver", PLANE_AGE=1),
        record(DEP_DEL15=1, CARRIER_NAME="Solo", DEPARTING_AIRPORT="Denver", PLANE_AGE=4),
        '{"MONTH": 1, "DEP_DEL15": 1, "CARRIER_NAME": "Del',  # malformed
    ]


FIELD_NAMES = [n for n, _ in FLIGHT_FIELDS]
