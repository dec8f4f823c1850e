"""Dates of many forms and zones, brought to one instant in UTC.

Every accepted form is parsed by built-in regular expressions into a local time and, where the text names
one, a zone. The offset intervals of every zone and year that occur are exploded to rows and cut where they overlap
or leave a gap, so that a local time falls into exactly one row: two intervals that hold it mean that it occurs twice,
none that it is skipped, one gives its offset. An as-of join on zone, year and start of the row finds it.
"""

from __future__ import annotations

import struct
import zoneinfo
from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache, reduce
from importlib import resources
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import materialize

#: Offsets of zone abbreviations, in minutes.
ABBREVIATIONS = {"UTC": 0, "GMT": 0, "Z": 0, "EST": -300, "EDT": -240, "PST": -480, "PDT": -420, "CET": 60, "CEST": 120}
#: English month names; the first three letters decide.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
MONTH_PATTERN = "|".join(sorted({m for name in MONTHS for m in (name, name[:3])} | {"sept"}, key=len, reverse=True))
DAY_PATTERN = "(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*"

#: Local years before the first and after the last are looked up as these: no clock was changed before, and the calendar
#: repeats every 400 years, so that rules which hold for ever do, too.
FIRST_YEAR, LAST_YEAR, CYCLE_YEARS, CYCLE_DAYS = 1800, 2437, 400, 146_097
SECOND, DAY = 1_000_000, 86_400_000_000

_ZONE = r"\s*(z|[+-]\d{2}(?::?\d{2})?|utc|gmt|est|edt|pst|pdt|cet|cest|\[[a-z0-9_+\-/]+\]|[a-z_]+(?:/[a-z0-9_+\-]+)+)?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_HALF = r"(?:\s*([ap])\.?m\.?)?"
#: Each form: its pattern and the group numbers of year, month, day, hour, minute, second, fraction, half of the day, zone (0: absent).
FORMS: dict[str, tuple[str, tuple[int, ...]]] = {
    "iso": (rf"(?i)^(\d{{4}})-(\d{{2}})-(\d{{2}})[t ]\s*{_CLOCK}{_ZONE}$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    "compact": (rf"(?i)^(\d{{4}})(\d{{2}})(\d{{2}})t(\d{{2}})(\d{{2}})(\d{{2}})(?:[.,](\d{{1,9}}))?{_ZONE}$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    "dots": (rf"(?i)^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}|\d{{2}}),?\s+{_CLOCK}{_ZONE}$", (3, 2, 1, 4, 5, 6, 7, 0, 8)),
    "slashes": (rf"(?i)^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}}),?\s+{_CLOCK}{_HALF}{_ZONE}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
    "month_first": (rf"(?i)^(?:{DAY_PATTERN},?\s+)?({MONTH_PATTERN})\.?\s+(\d{{1,2}}),?\s+(\d{{4}}),?\s+{_CLOCK}{_HALF}{_ZONE}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
    "day_first": (rf"(?i)^(?:{DAY_PATTERN},?\s+)?(\d{{1,2}})[\s\-]({MONTH_PATTERN})\.?[\s\-](\d{{4}}|\d{{2}}),?\s+{_CLOCK}{_HALF}{_ZONE}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
}
_EPOCH_SCALE = {10: SECOND, 13: 1_000, 16: 1}


_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_ALWAYS = 1 << 62


@lru_cache(maxsize=1)
def _zone_names() -> dict[str, str]:
    return {name.lower(): name for name in zoneinfo.available_timezones()}


def _zone_file(zone: str) -> bytes:
    for folder in zoneinfo.TZPATH:
        file = Path(folder, zone)
        if file.is_file():
            return file.read_bytes()
    return resources.files("tzdata").joinpath("zoneinfo", zone).read_bytes()


@lru_cache(maxsize=700)
def recorded_changes(zone: str) -> list[tuple[int, int]]:
    """(second of the change, offset from then on) as the zone's file lists them, in order."""
    data, at = _zone_file(zone), 0
    counts = struct.unpack_from(">6l", data, 20)
    width = 4
    if data[4:5] >= b"2":  # the second table has times of 64 bits
        at = 44 + counts[3] * 5 + counts[4] * 6 + counts[5] + counts[2] * 8 + counts[1] + counts[0]
        counts, width = struct.unpack_from(">6l", data, at + 20), 8
    n = counts[3]
    times = struct.unpack_from(f">{n}{'q' if width == 8 else 'l'}", data, at + 44)
    kinds = data[at + 44 + n * width : at + 44 + n * (width + 1)]
    offset = lambda kind: struct.unpack_from(">l", data, at + 44 + n * (width + 1) + 6 * kind)[0]
    return [(t, offset(k)) for t, k in zip(times, kinds, strict=True)]


def _offset(rules: zoneinfo.ZoneInfo, second: int) -> int:
    return int((_EPOCH + timedelta(seconds=second)).astimezone(rules).utcoffset().total_seconds())


def clock_changes(zone: str, begin: int, end: int) -> list[tuple[int, int, int]]:
    """Intervals (first second, last second + 1, offset) of a zone's clock that cover the seconds from ``begin`` to ``end``.

    Changes come from the zone's file; after the last one there, its rule for ever gives at most a few a year, and
    steps of a week look for them.
    """
    rules, known = zoneinfo.ZoneInfo(zone), recorded_changes(zone)
    times = [t for t, _ in known]
    changes = [(t, o) for t, o in known[max(0, bisect_right(times, begin) - 1) :] if t < end]
    if not times or begin < times[0]:
        first = times[0] - 1 if times else begin
        changes = [(-_ALWAYS, _offset(rules, max(first, -62_000_000_000))), *changes]
    now = max(begin, times[-1] if times else begin)
    current = _offset(rules, now)
    if now == begin:
        changes = [*changes[:1], *([(begin, current)] if changes and changes[-1][1] != current else [])]
    while now < end:
        ahead = now + 7 * 86_400
        if _offset(rules, ahead) != current:
            low, high = now, ahead
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if _offset(rules, middle) == current else (low, middle)
            ahead, current = high, _offset(rules, high)
            changes.append((high, current))
        now = ahead
    ends = [t for t, _ in changes[1:]] + [_ALWAYS]
    return [(a, b, o) for (a, o), b in zip(changes, ends, strict=True) if a < b]


def local_segments(zone: str, year: int) -> list[tuple[int, int, int, int]]:
    """(start, end, matches, offset): the local times of a year, in microseconds, cut where intervals begin and end.

    ``matches`` intervals hold the times of a segment. Of two, the offset of the earlier instant is given; of none,
    the one in force before the change. The first year holds all times before it, too.
    """
    start, end = (int((datetime(y, 1, 1, tzinfo=timezone.utc) - _EPOCH).total_seconds()) for y in (year, year + 1))
    local = [(a + o if a > -_ALWAYS else a, b + o, o) for a, b, o in clock_changes(zone, start - 3 * 86_400, end + 3 * 86_400)]
    first = -_ALWAYS if year == FIRST_YEAR else start
    cuts = sorted({first, end, *(t for a, b, _ in local for t in (a, b) if first < t < end)})
    out: list[tuple[int, int, int, int]] = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        held = [o for lo, hi, o in local if lo <= a and b <= hi]
        offset = max(held) if held else max((hi, o) for lo, hi, o in local if hi <= a)[1]
        out.append((a, b, len(held), offset))
    micros = lambda t: max(t, -(_ALWAYS // SECOND)) * SECOND
    return [(micros(a), micros(b), n, o * SECOND) for a, b, n, o in out]


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for zone, year in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            name = _zone_names().get(zone)
            rows += [(zone, year, *segment) for segment in (local_segments(name, year) if name else ())]
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        names = ["iv_zone", "iv_year", "iv_start", "iv_end", "iv_matches", "iv_offset"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [()] * 6, kinds, strict=True)], names=names)


def zone_intervals(wanted: DataFrame) -> DataFrame:
    """Segments of ``local_segments`` for rows (zone in lower case, year): (iv_zone, iv_year, iv_start, iv_end,
    iv_matches, iv_offset). An unknown zone has none. At most some 600 zones times 638 years with a few rows each.
    """
    return wanted.distinct().mapInArrow(_segment_rows, "iv_zone string, iv_year int, iv_start bigint, iv_end bigint, iv_matches int, iv_offset bigint")


def _month(text: Column) -> Column:
    named = F.element_at(F.create_map(*[F.lit(x) for k, m in enumerate(MONTHS) for x in (m[:3], k + 1)]), F.lower(F.substring(text, 1, 3)))
    return F.coalesce(F.when(text.rlike(r"^\d+$"), F.expr("null").cast("int")).otherwise(named), text.try_cast("int"))


def parse_dates(df: DataFrame, text: str, order: str) -> DataFrame:
    """Add ``pd_local`` (microseconds of the wall time), ``pd_zone`` (zone text in lower case, a name in brackets with
    them) and ``pd_epoch``.

    ``order`` is a column with DMY, MDY or null and decides day and month between slashes only. A text of no
    known form, an impossible date or time, a date without a time of day, and null give null in all three.
    """
    s = F.regexp_replace(F.col(text), r"^[\s ]+|[\s ]+$", "")
    hit = reduce(lambda rest, kv: F.when(F.col("_s").rlike(kv[1][0]), F.lit(kv[0])).otherwise(rest), reversed(FORMS.items()), F.lit(None).cast("string"))
    df = df.withColumn("_s", s).withColumn("_f", hit)
    in_order = {name: "|".join(f"${g}" if g else "" for g in groups) for name, (_, groups) in FORMS.items()}  # all parts in one pass; no form holds a "|"
    packed = F.coalesce(*[F.when(F.col("_f") == name, F.regexp_replace("_s", pattern, in_order[name])) for name, (pattern, _) in FORMS.items()])
    names = ("_y", "_a", "_b", "_h", "_mi", "_sec", "_fr", "_half", "_z")
    df = df.withColumn("_p", F.split(packed, r"\|"))
    df = df.withColumns({n: F.nullif(F.get("_p", F.lit(k)), F.lit("")) for k, n in enumerate(names)})
    slashed, swapped = F.col("_f") == "slashes", F.col(order) == "DMY"
    known = ~slashed | F.col(order).isin("DMY", "MDY")
    year = F.when(F.length("_y") == 2, F.col("_y").try_cast("int") + 2000).otherwise(F.col("_y").try_cast("int"))
    month = F.when(slashed & swapped, F.col("_b").try_cast("int")).otherwise(_month(F.col("_a")))
    day = F.when(slashed & swapped, F.col("_a").try_cast("int")).otherwise(F.col("_b").try_cast("int"))
    hour = F.col("_h").try_cast("int")
    half = F.lower("_half")
    df = df.withColumns({"_yy": year, "_mm": month, "_dd": day, "_hh": F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))})
    leap = ((F.col("_yy") % 4 == 0) & (F.col("_yy") % 100 != 0)) | (F.col("_yy") % 400 == 0)
    length = F.when(F.col("_mm") == 2, F.when(leap, 29).otherwise(28)).when(F.col("_mm").isin(4, 6, 9, 11), 30).otherwise(31)
    minute, second = F.col("_mi").cast("int"), F.coalesce(F.col("_sec").cast("int"), F.lit(0))
    valid = (
        known & F.col("_yy").between(1, 9999) & F.col("_mm").between(1, 12) & F.col("_dd").between(1, length)
        & F.col("_hh").between(0, 23) & minute.between(0, 59) & second.between(0, 59)
    )
    days = F.unix_date(F.make_date("_yy", "_mm", "_dd")).cast("bigint")
    micros = F.rpad(F.coalesce(F.col("_fr"), F.lit("0")), 6, "0").cast("bigint")
    wall = days * DAY + (F.col("_hh").cast("bigint") * 3600 + minute * 60 + second) * SECOND + micros
    digits = F.when(F.col("_s").rlike(r"^\d+$"), F.length("_s"))
    epoch = reduce(lambda rest, kv: F.when(digits == kv[0], F.col("_s").try_cast("bigint") * kv[1]).otherwise(rest), _EPOCH_SCALE.items(), F.lit(None).cast("bigint"))
    return df.withColumns(
        {
            "pd_local": F.when(valid, wall),
            "pd_zone": F.when(valid, F.lower("_z")),
            "pd_epoch": epoch,
        }
    ).drop("_s", "_f", "_p", *names, "_yy", "_mm", "_dd", "_hh")


def to_instants(df: DataFrame, text: str, zone: str, order: str, out: str = "utc_micros") -> DataFrame:
    """Add ``out``: the instant that ``text`` denotes, in microseconds since 1970-01-01 UTC, else null.

    A zone written in the text goes before the column ``zone`` (a tz database name, in any case). A wall time that
    occurs twice is its earlier instant, a skipped one is read with the offset before the change; neither zone, and an
    unknown one, give null. All years from 1 to 9999 are covered. ``<out>_kind`` says which case held: ``epoch``,
    ``offset``, ``single``, ``ambiguous``, ``skipped`` or null. Repeated rows keep their repeats. The parsed rows are
    written into the shared folder, as the zones and years in them are read first.
    """
    df = parse_dates(df, text, order)
    named = F.regexp_replace("pd_zone", r"[\[\]]", "")
    z = F.col("_z0")
    sign = F.when(z.startswith("-"), -1).otherwise(1)
    hours, minutes = F.substring(z, 2, 2).try_cast("int"), F.coalesce(F.nullif(F.regexp_extract(z, r"^[+-]\d{2}:?(\d{2})$", 1), F.lit("")).try_cast("int"), F.lit(0))
    numeric = F.when(z.rlike(r"^[+-]\d{2}(:?\d{2})?$") & (hours <= 18) & (minutes <= 59), sign * (hours * 60 + minutes))
    fixed = F.coalesce(numeric, F.element_at(F.create_map(*[F.lit(x) for k, v in ABBREVIATIONS.items() for x in (k.lower(), v)]), z))
    year = F.year(F.date_from_unix_date(F.floor(F.col("pd_local") / DAY).cast("int")))
    turns = F.when(year > LAST_YEAR, F.ceil((year - LAST_YEAR) / CYCLE_YEARS)).otherwise(0).cast("bigint")
    df = df.withColumn("_z0", named).withColumns(
        {
            "_fixed": fixed.cast("bigint") * 60 * SECOND,
            "_zone": F.when(z.isNull(), F.lower(F.col(zone))).when(z.contains("/") | F.col("pd_zone").startswith("["), z),
            "_year": F.greatest(year - (turns * CYCLE_YEARS).cast("int"), F.lit(FIRST_YEAR)),
            "_turned": turns * CYCLE_DAYS * DAY,
        }
    )
    df = materialize(df.withColumn("_zone", F.when(F.col("_fixed").isNull() & F.col("pd_local").isNotNull(), F.col("_zone"))).drop("_z0"))
    table = F.broadcast(zone_intervals(df.where("_zone is not null").select("_zone", "_year")))  # its size is bounded, see there
    at = F.col("pd_local") - F.col("_turned")
    joined = df.join(table, (df["_zone"] == table["iv_zone"]) & (df["_year"] == table["iv_year"]) & (at >= table["iv_start"]) & (at < table["iv_end"]), "left")
    matches = F.col("iv_matches")
    kind = (
        F.when(F.col("pd_epoch").isNotNull(), "epoch").when(F.col("pd_local").isNull(), None).when(F.col("_fixed").isNotNull(), "offset")
        .when(matches == 1, "single").when(matches > 1, "ambiguous").when(matches == 0, "skipped")
    )
    instant = F.coalesce(F.col("pd_epoch"), F.col("pd_local") - F.col("_fixed"), F.col("pd_local") - F.col("iv_offset"))
    return joined.withColumns({out: instant, f"{out}_kind": kind}).drop("_fixed", "_zone", "_year", "_turned", *[c for c in table.columns], "pd_local", "pd_zone", "pd_epoch")


#: A date that is stored in the target form already.
STORED_FORM = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def normalised_dates(changes: DataFrame, comments: DataFrame, locales: DataFrame) -> DataFrame:
    """One row (table_name, record_id, stored, utc_micros, kind) for each distinct record of both tables.

    Null dates, unreadable dates and dates of unknown zone have a null instant. ``locales`` (author, zone_name,
    date_order) is joined on author; Spark broadcasts it by its measured size.
    """
    rows = changes.select(F.lit("tracked_change").alias("table_name"), F.col("change_id").cast("bigint").alias("record_id"), "author", F.col("change_date").alias("stored")).unionByName(
        comments.select(F.lit("review_comment").alias("table_name"), F.col("comment_key").cast("bigint").alias("record_id"), "author", F.col("comment_date").alias("stored"))
    ).distinct()
    places = locales.select(F.col("author").alias("_author"), F.col("zone_name").alias("_zn"), F.upper("date_order").alias("_do")).dropDuplicates(["_author"])
    rows = rows.join(places, rows["author"] == places["_author"], "left")
    done = to_instants(rows, "stored", "_zn", "_do")
    return done.select("table_name", "record_id", "stored", "utc_micros", F.col("utc_micros_kind").alias("kind"))


def found_dates(dates: DataFrame) -> DataFrame:
    """The rows of ``normalised_dates`` that denote an instant and are not stored in the target form."""
    return dates.where(F.col("utc_micros").isNotNull() & ~F.col("stored").rlike(STORED_FORM)).select("table_name", "record_id", "utc_micros")
