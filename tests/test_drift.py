"""Drift of scores: against a plain count, on a stream in order of arrival, and on odd rows."""

import math
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest

from farol.streaming import drift as D

START = datetime(2024, 3, 1, tzinfo=timezone.utc)
SCHEMA = "id long, time timestamp, arrival timestamp, score double, site string, stability string"
AGAINST = D.Baseline((0.25, 0.5, 0.75), (40, 30, 20, 10))


def rows_of(n=1200, seed=3):
    """Three days of scores; on the third they move up. One row in ten arrives four to thirty hours late. The table has a column with a clashing name."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        hours = 72 * i / n
        score = float(rng.beta(1.2, 2.0) if hours < 48 else rng.beta(4.0, 1.5))
        wait = float(rng.uniform(4, 30) if i % 10 == 0 else rng.uniform(0, 1.9))
        time = START + timedelta(hours=hours)
        out.append((i, time, time + timedelta(hours=wait), score, "a" if i % 3 else "b", "x"))
    return sorted(out, key=lambda r: r[2])


def expected(rows, delay=7200):
    """The same windows by counting rows one by one."""
    days = {}
    for _, time, arrival, score, site, _ in rows:
        late = time is None or (arrival is not None and arrival > time + timedelta(seconds=delay))
        at = arrival if late else time
        if at is None:
            continue
        day = days.setdefault(((at - START).days, site), {"late": 0, "n": 0, "unscored": 0, "scores": []})
        if late:
            day["late"] += 1
        else:
            day["n"] += 1
            if score is None or math.isnan(score):
                day["unscored"] += 1
            else:
                day["scores"].append(score)
    out = {}
    for key, d in days.items():
        counts = np.bincount([sum(e < s for e in AGAINST.edges) for s in d["scores"]], minlength=4)
        seen, base = (counts + 0.5) / (counts.sum() + 2), (np.array(AGAINST.rows) + 0.5) / (sum(AGAINST.rows) + 2)
        some = bool(d["scores"])
        out[key] = (d["n"], d["late"], d["unscored"], round(float(((seen - base) * np.log(seen / base)).sum()), 9) if some else None,
                    round(float(np.abs(np.cumsum(seen - base)).max()), 9) if some else None)
    return out


def shown(table):
    got = {}
    for r in table.collect():
        start = r["window_start"].astimezone(timezone.utc)
        key = ((start - START).days, r["site"])
        assert key not in got
        got[key] = (r["n"], r["late"], r["unscored"], *(None if r[c] is None else round(r[c], 9) for c in ("stability", "distance")))
    return got


def test_windows_equal_a_plain_count(spark):
    rows = rows_of()
    table = D.drift(spark.createDataFrame(rows, SCHEMA), AGAINST, 0.5, by=["site"])
    assert shown(table) == expected(rows)


def test_planted_drift_is_seen_where_it_is(spark):
    table = D.drift(spark.createDataFrame(rows_of(), SCHEMA), AGAINST, 0.5)
    states = {(r["window_start"].astimezone(timezone.utc) - START).days: r["state"] for r in table.where("n > 100").collect()}
    assert states[2] == "drifted" and states[0] != "drifted" and states[1] != "drifted"


@pytest.mark.parametrize("files", [1, 6])
def test_a_stream_in_order_of_arrival_loses_no_row(spark, tmp_path, files):
    rows = rows_of()
    for k, part in enumerate(np.array_split(np.arange(len(rows)), files)):
        spark.createDataFrame([rows[i] for i in part], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/k={k}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/k=*"))
    run = D.stream_drift(D.drift(stream, AGAINST, 0.5, by=["site"]), str(tmp_path / "out"), str(tmp_path / "ck"))
    run.awaitTermination(120)
    assert sum(s["numRowsDroppedByWatermark"] for p in run.recentProgress for s in p["stateOperators"]) == 0
    last = max(a if a > t + timedelta(hours=2) else t for _, t, a, *_ in rows) - timedelta(hours=2)
    closed = {k: v for k, v in expected(rows).items() if START + timedelta(days=k[0] + 1) <= last}
    assert closed and shown(spark.read.parquet(str(tmp_path / "out"))) == closed


def test_odd_rows(spark):
    at, later = START + timedelta(hours=1), START + timedelta(hours=9)
    rows = [(1, at, at, None, "a", None), (2, at, at, float("nan"), "a", None), (3, None, at, 0.9, "a", None), (4, at, None, 0.9, "a", None),
            (5, None, None, 0.9, "a", None), (6, at, later, 0.9, None, None), (7, at, at, 0.5, None, None), (7, at, at, 0.5, None, None)]
    table = D.drift(spark.createDataFrame(rows, SCHEMA), AGAINST, 0.5, by=["site"])
    assert shown(table) == expected(rows) == {(0, "a"): (3, 1, 2, *expected(rows)[0, "a"][3:]), (0, None): (2, 1, 0, *expected(rows)[0, None][3:])}
    only_late = D.drift(spark.createDataFrame(rows[5:6], SCHEMA), AGAINST, 0.5).first()
    assert (only_late["n"], only_late["late"], only_late["stability"], only_late["state"], only_late["mean_score"]) == (0, 1, None, None, None)
    assert D.drift(spark.createDataFrame([], SCHEMA), AGAINST, 0.5).collect() == []


def test_baseline_of_ties_and_of_nothing(spark):
    some = spark.createDataFrame([(s,) for s in [0.1] * 60 + [0.2] * 25 + [0.9] * 15 + [None, float("nan")]], "score double")
    found = D.baseline(some, bins=4)
    assert found == D.Baseline((0.1, 0.2), (60, 25, 15))
    assert abs(sum(found.shares) - 1) < 1e-12
    assert D.baseline(some.where("score > 5 AND NOT isnan(score)")) == D.Baseline((), (0,))
