"""Dates of every form, on both sides of clock changes, and what is no date."""

from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo, available_timezones

import pytest

from paperloom.operators import timestamps as T


def micros(*parts, more=0):
    return int(datetime(*parts, tzinfo=UTC).timestamp()) * 1_000_000 + more


NY, BERLIN, KOLKATA = ("America/New_York", "MDY"), ("Europe/Berlin", "DMY"), ("Asia/Kolkata", "DMY")
CASES = [
    ("2024-01-02T03:04:05Z", None, micros(2024, 1, 2, 3, 4, 5), "offset"),
    ("  2024-01-02t03:04:05z ", None, micros(2024, 1, 2, 3, 4, 5), "offset"),
    ("2024-01-02T03:04:05.123456789Z", None, micros(2024, 1, 2, 3, 4, 5, more=123_456), "offset"),
    ("2024-01-02T03:04:05,9Z", None, micros(2024, 1, 2, 3, 4, 5, more=900_000), "offset"),
    ("2024-01-02T03:04+0530", None, micros(2024, 1, 1, 21, 34), "offset"),
    ("2024-01-02 03:04:05 -03:30", None, micros(2024, 1, 2, 6, 34, 5), "offset"),
    ("2024-01-02 03:04:05+05", NY, micros(2024, 1, 1, 22, 4, 5), "offset"),
    ("20240102T030405Z", None, micros(2024, 1, 2, 3, 4, 5), "offset"),
    ("2024-07-01 12:00:00 EST", BERLIN, micros(2024, 7, 1, 17), "offset"),
    ("Tue, 02 Jan 2024 03:04:05 +0100", None, micros(2024, 1, 2, 2, 4, 5), "offset"),
    ("02 January 2024 03:04:05 GMT", None, micros(2024, 1, 2, 3, 4, 5), "offset"),
    ("2024-07-01T12:00:00 [Europe/Berlin]", None, micros(2024, 7, 1, 10), "single"),
    ("2024-07-01 12:00:00 America/New_York", BERLIN, micros(2024, 7, 1, 16), "single"),
    ("2024-07-01 12:00", NY, micros(2024, 7, 1, 16), "single"),
    ("02.01.2024 03:04:05", BERLIN, micros(2024, 1, 2, 2, 4, 5), "single"),
    ("2-Jan-2024 03:04:05", KOLKATA, micros(2024, 1, 1, 21, 34, 5), "single"),
    ("January 2, 2024 12:04:05 AM", NY, micros(2024, 1, 2, 5, 4, 5), "single"),
    ("3/4/2024 1:05 PM", NY, micros(2024, 3, 4, 18, 5), "single"),
    ("3/4/24 1:05 PM", BERLIN, micros(2024, 4, 3, 11, 5), "single"),
    ("2024-11-03 01:30:00", NY, micros(2024, 11, 3, 5, 30), "ambiguous"),
    ("2024-10-27T02:30:00", BERLIN, micros(2024, 10, 27, 0, 30), "ambiguous"),
    ("2024-03-10 02:30:00", NY, micros(2024, 3, 10, 7, 30), "skipped"),
    ("2024-03-31T02:30:00 [Europe/Berlin]", None, micros(2024, 3, 31, 1, 30), "skipped"),
    ("1700000000", None, 1_700_000_000_000_000, "epoch"),
    ("1700000000123", None, 1_700_000_000_123_000, "epoch"),
    ("1700000000123456", None, 1_700_000_000_123_456, "epoch"),
    ("2000-10-10 12:00", ("America/Recife", "DMY"), micros(2000, 10, 10, 14), "single"),
    ("2024-07-01 12:00", ("Japan", "DMY"), micros(2024, 7, 1, 3), "single"),
    ("2024-07-01 12:00 [Egypt]", None, micros(2024, 7, 1, 9), "single"),
    ("1950-07-01 12:00", NY, micros(1950, 7, 1, 16), "single"),
    ("1700-01-01 00:00", ("Europe/Berlin", "DMY"), micros(1699, 12, 31, 23, 6, 32), "single"),
    ("9000-07-01 12:00", NY, micros(9000, 7, 1, 16), "single"),
    ("2860-07-01 12:00", BERLIN, micros(2860, 7, 1, 10), "single"),
    *[(t, NY, None, None) for t in ("2024-04-31 09:30:00+02:00", "2023-02-29T01:00:00Z", "2024-01-02", "20240102", "22 May 2024", "2024-05", "pending", "", "--", "yesterday 14:00",
                                    "2024-01-02T24:00:00Z", "2024-01-02T23:60:00Z", "13/13/2024 10:00", "1/2/2024 13:05 PM", "12345", "2024-01-02 03:04:05 XYZ", None)],
    ("2024-07-01 12:00", None, None, None),
    ("3/4/2024 1:05 PM", None, None, None),
    ("2024-07-01 12:00:00 [Mars/Base]", NY, None, None),
]


@pytest.fixture(scope="module")
def placed(spark):
    rows = [(k, text, *(place or (None, None))) for k, (text, place, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "k int, text string, zone string, ord string")
    return {r["k"]: r for r in T.to_instants(df, "text", "zone", "ord").collect()}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_instants(placed, k):
    _, _, instant, kind = CASES[k]
    assert (placed[k]["utc_micros"], placed[k]["utc_micros_kind"]) == (instant, kind)


def test_tables_with_repeats_clashing_columns_and_no_rows(spark):
    kind = "change_id bigint, author string, change_date string, ord string, _zone string, table_name string"
    changes = spark.createDataFrame([(1, "a", "2024-07-01 12:00", "x", "y", "z")] * 2 + [(2, None, "2024-07-01T12:00:00Z", "x", None, None), (3, "nobody", "2024-07-01 12:00", "", "", "")], kind)
    comments = spark.createDataFrame([], "comment_key bigint, author string, comment_date string")
    locales = spark.createDataFrame([("a", "Europe/Berlin", "DMY"), ("a", "Europe/Berlin", "DMY")], "author string, zone_name string, date_order string")
    dates = T.normalised_dates(changes, comments, locales)
    assert dates.count() == 3
    assert [tuple(r) for r in T.found_dates(dates).collect()] == [("tracked_change", 1, micros(2024, 7, 1, 10))]
    empty = T.normalised_dates(changes.where("false"), comments, locales.where("false"))
    assert T.found_dates(empty).count() == 0


def test_segments_equal_the_zone_rules_at_every_recorded_change():
    for zone in sorted(available_timezones()):
        rules, seen = ZoneInfo(zone), {}
        places = [datetime(1970, 1, 1) + timedelta(seconds=t) for t, _ in T.recorded_changes(zone) if abs(t) < 4_200_000_000]
        places += [datetime(y, m, 15, 12) for y in range(1880, 2101, 7) for m in (1, 7)]
        for at in places:
            for minutes in (-45, 0, 45):
                local = at + rules.utcoffset(at) + timedelta(minutes=minutes)
                key = max(local.year, T.FIRST_YEAR)
                if key not in seen:
                    seen[key] = T.local_segments(zone, key)
                now = (local - datetime(1970, 1, 1)) // timedelta(microseconds=1)
                hit = [s for s in seen[key] if s[0] <= now < s[1]]
                assert len(hit) == 1 and hit[0][3] == rules.utcoffset(local) // timedelta(microseconds=1), (zone, local)


def test_segments_of_a_year_with_two_changes():
    assert [s[2] for s in T.local_segments("Europe/Berlin", 2024)] == [1, 0, 1, 2, 1]
    assert [s[2:] for s in T.local_segments("UTC", 2024)] == [(1, 0)]
