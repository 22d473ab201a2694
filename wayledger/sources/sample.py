"""A small sample file: a position, an identity report and an invalid message."""

from __future__ import annotations

import csv
import random
from pathlib import Path

from wayledger.contracts import SOURCE_COLUMNS


def sample_rows(day: str = "2021-06-15", serial: str = "MDEMO000001", seed: int = 7) -> list[dict[str, str]]:
    """One telemetry row, one identity report and one row of an invalid type.

    Their values are drawn from plausible ranges by the seed.
    """
    rnd = random.Random(seed)
    number = lambda lo, hi, places=1: f"{rnd.uniform(lo, hi):.{places}f}"
    digits = lambda n: str(rnd.randrange(10 ** (n - 1), 10**n))
    second = rnd.randrange(50)
    base = dict.fromkeys(SOURCE_COLUMNS, "") | {"DATA_SERVIDOR": f"{day} 08:30:{second + 9:02d}", "TM_STAMP": f"{day} 08:30:{second:02d}", "TIPO_LOG": "demo", "REPT_TYPE": digits(1), "PRT_VER": f"V{digits(2)}.{digits(2)}.{digits(3)}", "S/N ou IMEI": serial}
    position = base | {
        "MESS_TYPE": f"T{rnd.randrange(2, 9)}", "BAT_VOLT": number(23, 29), "LOC_STATUS": "F", "LAT": number(45, 50, 5), "LONT": number(5, 15, 5), "SPEED": number(0, 90), "DIR": number(0, 359, 0), "INT_BATT": number(3.3, 4.0, 2),
        "ODO_TRIP": number(1, 90), "ODO_TOTAL": number(1e3, 1e5, 0), "HDOP": number(0.6, 2.5), "RX_LEVEL": number(-105, -55, 0), "SER_COUNT": digits(3),
    }
    report = base | {"MESS_TYPE": "T1", "BAT_VOLT": digits(19), "LOC_STATUS": "demo", "LAT": digits(15), "LONT": digits(15)}
    return [position, report, base | {"MESS_TYPE": "HELLO"}]


def write_sample(path: Path, **kw: str) -> Path:
    """Write the sample as CSV."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, SOURCE_COLUMNS)
        w.writeheader()
        w.writerows(sample_rows(**kw))
    return path
