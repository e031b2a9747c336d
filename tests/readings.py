"""Readings and topic rows that the tests are built from."""

import json
import os

SEED = {
    "id": "90217",
    "speed": "38.6",
    "travel_time": "112",
    "status": "0",
    "data_as_of": "2024-02-13T07:04:30.000",
    "link_id": "5550123",
    "link_points": "40.7105,-73.9502 40.7121,-73.9476",
    "encoded_poly_line": "wxyzWXYZ",
    "encoded_poly_line_lvls": "BB",
    "owner": "TEST",
    "transcom_id": "77001",
    "borough": "Staten Island",
    "link_name": "HARBOR STREET - RIVER AVENUE N",
}


def variant(**changes):
    """The seed record with some fields changed, or removed where the change is ``...``."""
    record = {**SEED, **changes}
    return {k: v for k, v in record.items() if v is not ...}


def envelope_rows(values, start=0, partitions=2, at="2024-02-13 07:10:00"):
    """Topic rows around JSON texts or records."""
    return [
        {
            "key": str(start + i),
            "value": v if isinstance(v, str) else json.dumps(v),
            "topic": "raw",
            "partition": (start + i) % partitions,
            "offset": start + i,
            "timestamp": at,
        }
        for i, v in enumerate(values)
    ]


def write_envelope(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{name}.json"), "w") as handle:
        handle.writelines(json.dumps(r) + "\n" for r in rows)
