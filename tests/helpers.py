"""Test input shared by modules."""

import os

SF_TINY = "/root/testdata/sf0.001"


def write_text(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding) if isinstance(text, str) else text)
    return path


HEADER = "delivery_id,pickup_lat,pickup_lon,dropoff_lat,dropoff_lon,timestamp\n"
# made up: three deliveries in Queens
THREE_ROWS = HEADER + (
    "1,40.7421,-73.8510,40.7302,-73.8644,2025-03-04 08:15:00\n"
    "2,40.7517,-73.8333,40.7689,-73.8201,2025-03-04 08:40:00\n"
    "3,40.7290,-73.8702,40.7455,-73.8477,2025-03-04 09:05:00\n"
)
