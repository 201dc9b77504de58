from __future__ import annotations

import datetime
import random

from tiffin.operators import sketches


def test_exact_rolling_counts(spark):
    """Values that stay away, come back within and after the window, and missing ones; no row is made for each day of a window."""
    rng = random.Random(3)
    first = datetime.date(2024, 1, 1)
    rows = [(first + datetime.timedelta(rng.randrange(0, 90)), rng.choice([None, 1, 2, 3, 4, 5])) for _ in range(60)]
    rows += [(first + datetime.timedelta(200), None), (None, 1)]
    df = spark.createDataFrame(rows, "day date, v int")
    found = sketches.exact_rolling_distinct(df, "day", "v", 7)
    days = {d for d, _ in rows if d}
    want = {d: len({v for e, v in rows if e and v is not None and 0 <= (d - e).days < 7}) for d in days}
    assert {r["day"]: r["distinct"] for r in found.collect()} == want
    assert "sequence(" not in found._jdf.queryExecution().optimizedPlan().toString()
