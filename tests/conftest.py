from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermill.session import get_spark  # noqa: E402

# The sample order files of the source system (header + rows).
HEADER = "order_id,customer_id,status,amount_cents,updated_at"
DAY1 = """ORD-1001,CUST-501,PAID,4990,2026-08-01T08:15:00
ORD-1002,CUST-502,SHIPPED,8950,2026-08-01T08:17:00
ORD-1003,,PAID,2500,2026-08-01T08:20:00
ORD-1004,CUST-504,CANCELLED,0,2026-08-01T08:22:00
ORD-1005,CUST-505,UNKNOWN,1799,2026-08-01T08:25:00
ORD-1006,CUST-506,PAID,-500,2026-08-01T08:30:00
ORD-1007,CUST-507,PAID,12000,not-a-date
ORD-1008,CUST-508,PENDING,1550,2026-08-01T08:35:00"""
DAY2 = """ORD-1001,CUST-501,SHIPPED,4990,2026-08-01T08:10:00
ORD-1002,CUST-502,SHIPPED,8950,2026-08-02T09:00:00
ORD-1008,CUST-508,PAID,1550,2026-08-02T09:05:00
ORD-1009,CUST-509,PENDING,3200,2026-08-02T09:10:00
ORD-1010,,PAID,2500,2026-08-02T09:15:00"""
DAY3 = """ORD-1001,CUST-501,SHIPPED,4990,2026-08-03T09:00:00
ORD-1009,CUST-509,PAID,3200,2026-08-03T09:05:00
ORD-1011,CUST-511,PAID,6500,2026-08-03T09:10:00
ORD-1012,,PAID,2100,2026-08-03T09:15:00
ORD-1002,CUST-502,CANCELLED,8950,2026-08-01T07:00:00"""


@pytest.fixture(scope="session")
def spark():
    s = get_spark("ordermill-tests", master="local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def write_csv(folder, name: str, body: str, header: str = HEADER) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    p = folder / name
    p.write_text(header + "\n" + body + "\n", encoding="utf-8")
    return str(p)


@pytest.fixture
def order_files(tmp_path):
    raw = tmp_path / "raw"
    return {
        "day1": write_csv(raw, "orders_2026-08-01.csv", DAY1),
        "day2": write_csv(raw, "orders_2026-08-02.csv", DAY2),
        "day3": write_csv(raw, "orders_2026-08-03.csv", DAY3),
        "dir": str(raw),
    }
