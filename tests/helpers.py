"""Small inputs and a plain-Python model of the panel to compare with."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from monthspan.sources.dictionary import MONTHLY

LEASE = 2004417306
COLUMNS = [name for name, *_ in MONTHLY]
SAMPLE = dict(
    zip(
        COLUMNS,
        "2004417306,HOLLOWAY,730915,15-777-31415,MIRADOR,Cedar Bench,Tallgrass Oil Co,Chase,"
        "7,N,9,W,22,SWSWNE,38.125,-96.75,1-2024,O,2,143.5".split(","),
    )
)


def month(n: int, year: int = 2024) -> dt.date:
    """The n-th month counted from January of the year, from 1 on."""
    return dt.date(year + (n - 1) // 12, (n - 1) % 12 + 1, 1)


def line(columns=COLUMNS, **changes) -> str:
    row = SAMPLE | {k.replace("MONTH_YEAR", "MONTH-YEAR"): v for k, v in changes.items()}
    return ",".join(row.get(c, "") for c in columns)


def write_file(directory: Path, name: str, lines: list[str], columns=COLUMNS, end: str = "\n") -> None:
    directory.mkdir(parents=True, exist_ok=True)
    (directory / name).write_bytes((end.join([",".join(columns), *lines]) + end).encode())


def panel(spark, rows, lease: int = LEASE):
    """Rows of (month number, volume, product) as a panel of one lease."""
    data = [(lease, month(n), None if v is None else float(v), p) for n, v, p in rows]
    return spark.createDataFrame(
        data, "LEASE_KID bigint, production_date date, PRODUCTION double, PRODUCT string"
    )


def oil(spark, *volumes):
    return panel(spark, [(i + 1, v, "O") for i, v in enumerate(volumes)])


def values(frame, column: str) -> list:
    order = [c for c in ("LEASE_KID", "production_date") if c in frame.columns]
    order += [frame["PRODUCT"].desc()] if "PRODUCT" in frame.columns else []
    return [row[column] for row in frame.orderBy(*order).collect()]


# A model of the whole chain in plain Python: rows are (lease, date, product, volume, extra)


def model_unique(rows: list[tuple]) -> list[tuple]:
    seen: dict[tuple, tuple] = {}
    for row in rows:
        seen.setdefault(row[:2], row)
    return sorted(seen.values(), key=lambda r: r[:2])


def model_filled(rows: list[tuple]) -> list[tuple]:
    out = []
    for lease in sorted({r[0] for r in rows}):
        mine = {r[1]: r for r in rows if r[0] == lease}
        day, last = min(mine), max(mine)
        product = extra = None
        while day <= last:
            row = mine.get(day)
            if row:
                product = product if row[2] is None else row[2]
                extra = extra if row[4] is None else row[4]
            out.append((lease, day, product, (row and row[3]) or 0.0, extra))
            day = dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)
    return out


def model_features(rows: list[tuple]) -> list[dict]:
    out = []
    for lease in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == lease]
        own = {p: [r[3] if r[2] == p else None for r in mine] for p in "OG"}
        for i, row in enumerate(mine):
            result = {}
            for p, name in (("O", "oil"), ("G", "gas")):
                result[f"cum_{name}"] = float(sum(v for v in own[p][: i + 1] if v is not None))
                result[f"lag1_{name}"] = own[p][i - 1] if i else None
                for n in (3, 6):
                    last = own[p][i - n + 1 : i + 1] if i + 1 >= n else [None]
                    full = all(v is not None for v in last)
                    result[f"rolling_{n}m_{name}"] = sum(last) / n if full else None
            oil_volume = own["O"][i] or 0.0
            result["gor"] = (own["G"][i] or 0.0) / oil_volume if oil_volume else None
            before = mine[i - 1][3] if i else None
            rate = (row[3] - before) / before if before else None
            result["decline_rate"] = None if rate is None else max(-1.0, min(10.0, rate))
            result["cum_water"] = result["water_cut"] = None
            out.append(result)
    return out
