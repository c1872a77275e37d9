from datetime import datetime, timezone

import pytest

from pavelens.operators.timestamps import TimestampRules, normalise_timestamps


def us(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1_000_000)


CASES = [
    ("2024-02-10T12:25:45.077811+01:00", us(2024, 2, 10, 11, 25, 45, 77811)),
    (" '2024-07-01 08:00:00' ", us(2024, 7, 1, 6)),
    (" 2025-01-04t04:33:03.279z", us(2025, 1, 4, 4, 33, 3, 279000)),
    ("07.09.2024 16:58:40,793", us(2024, 9, 7, 14, 58, 40, 793000)),
    ("01.09.2024 09:24:06.79 MEZ", us(2024, 9, 1, 8, 24, 6, 790000)),
    ("27.10.2024 02:27:19,070 CEST", us(2024, 10, 27, 0, 27, 19, 70000)),
    ("05/06/2024 03:40:38.059 PM", us(2024, 5, 6, 13, 40, 38, 59000)),
    ("12/31/2023 12:47:24 AM", us(2023, 12, 30, 23, 47, 24)),
    ("Fri, 15 Dec 2023 17:27:32 +0100", us(2023, 12, 15, 16, 27, 32)),
    ("20250918T174711.926+0200", us(2025, 9, 18, 15, 47, 11, 926000)),
    ("2024-09-16T15:46:08.540113984+00", us(2024, 9, 16, 15, 46, 8, 540113)),
    ("2024-07-07T16:40:24+01:00[Europe/Berlin]", us(2024, 7, 7, 15, 40, 24)),
    ("2024-07-07T16:40:24[Europe/Berlin]", us(2024, 7, 7, 14, 40, 24)),
    ("1715001968.9309999", 1715001968930999),
    ("1708581738292", 1708581738292000),
    ("1692962173434971", 1692962173434971),
    ("1708581040043079669", 1708581040043079),
    ("2024-10-27T02:30:00", None),  # twice
    ("2024-03-31T02:30:00", None),  # never
    ("31.04.2024 08:15:00", None), ("2024-06-12T25:10:00Z", None), ("2024-07-10T12:61:00+02:00", None), ("2023-13-05T10:00:00+01:00", None),
    ("13:00:00 PM", None), ("12/31/2023 13:47:24 PM", None), ("2024-05", None), ("12:44:09", None), ("0000-00-00T00:00:00", None), ("17", None), ("", None), (None, None), ("x" * 100_000, None),
    ("9" * 40, None), ("2024-01-01T00:00:00+25:00", None), ("2024-01-01T00:00:00+01:75", None),
]


def test_every_written_form(spark):
    df = spark.createDataFrame([(i, t, None) for i, (t, _) in enumerate(CASES)] * 2, "id long, t string, fmt string")
    got = normalise_timestamps(df, "t").collect()
    assert len(got) == 2 * len(CASES)  # repeated rows stay, a clashing column name passes through
    for r in got:
        assert r["utc_us"] == CASES[r["id"]][1], (CASES[r["id"]], r)
    status = {CASES[r["id"]][0]: r["ts_status"] for r in got}
    assert status["2024-10-27T02:30:00"] == "ambiguous" and status["2024-03-31T02:30:00"] == "unparsable" and status[None] == "unparsable"


def test_the_source_decides_the_order_of_the_date(spark):
    rows = [("us", f"01/{d}/2024 10:00:00Z") for d in range(13, 29)] + [("de", f"{d}/01/2024 10:00:00Z") for d in range(13, 29)]
    rows += [("us", "03/04/2024 10:00:00Z"), ("de", "03/04/2024 10:00:00Z"), ("new", "03/04/2024 10:00:00Z"), (None, "05/05/2024 10:00:00Z")]
    rules = TimestampRules(day_first={".": True, "/": None})
    got = {(r["s"], r["t"]): r for r in normalise_timestamps(spark.createDataFrame(rows, "s string, t string"), "t", "s", rules).collect()}
    assert got["us", "03/04/2024 10:00:00Z"]["utc_us"] == us(2024, 3, 4, 10)
    assert got["de", "03/04/2024 10:00:00Z"]["utc_us"] == us(2024, 4, 3, 10)
    assert got["new", "03/04/2024 10:00:00Z"]["ts_status"] == "ambiguous"
    assert got[None, "05/05/2024 10:00:00Z"]["utc_us"] == us(2024, 5, 5, 10)  # both orders mean one instant


def test_the_posterior_decides(spark):
    rows = [(f"12/{d}/2024 10:00:00Z",) for d in range(13, 29)] + [("25/12/2024 10:00:00Z",), ("12/13/2024 10:00:00",), ("05.06.2024 10:00:00",), ("170000000",), ("1700000000",)]
    df = spark.createDataFrame(rows, "t string")
    read = lambda **k: {r["t"]: r for r in normalise_timestamps(df, "t", rules=TimestampRules(**k)).collect()}
    got = read()
    assert got["25/12/2024 10:00:00Z"]["ts_status"] == "unparsable" and got["170000000"]["ts_status"] == "unparsable"
    assert got["05.06.2024 10:00:00"]["ts_format"] == "dotted_dmy" and got["1700000000"]["ts_format"] == "unix_s"
    got = read(noise=1e-40)  # if nothing else is likely, what is against the rules is taken
    assert got["25/12/2024 10:00:00Z"]["ts_format"] == "slashed_dmy" and got["170000000"]["ts_format"] == "unix_s"
    assert read(rival=1.0)["05.06.2024 10:00:00"]["ts_status"] == "ambiguous"  # without the stated rules nobody knows the order


def test_empty_table_and_clash(spark):
    assert normalise_timestamps(spark.createDataFrame([], "t string"), "t").count() == 0
    with pytest.raises(ValueError):
        normalise_timestamps(spark.createDataFrame([], "t string, utc_us long"), "t")
