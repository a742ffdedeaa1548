"""Keys, numbers, dates, states and distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapweave.functions.text import trimmed

# Cells that mean "no value" and words that tell a state.
DASH_CELLS = ("---", "-")
UNKNOWN_CELLS = ("不明", "未入力")
CLOSED_WORDS = ("閉鎖", "未開設", "閉設", "解除", "終了", "休止")
OPEN_WORDS = ("開設", "開所")
LATITUDES = (31.0, 34.0)
LONGITUDES = (129.0, 132.5)
EARTH_RADIUS_M = 6371008.8
ERA_BASE_YEAR = 2018  # year 1 of the era is 2019


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def hash_key(columns: list[Column], length: int = 64, separator: str = "|") -> Column:
    """The first characters of the SHA-256 of columns joined by a separator; null counts as empty."""
    return F.substring(F.sha2(F.concat_ws(separator, *(text_or_empty(c) for c in columns)), 256), 1, length)


def stable_id(municipality: Column, name: Column, address: Column) -> Column:
    """20 hex digits of an identity whose parts are already normalised and case-folded."""
    return hash_key([municipality, name, address], 20)


def record_hash(columns: list[Column]) -> Column:
    return hash_key(columns)


def match_key(municipality: Column, name: Column, address: Column) -> Column:
    return hash_key([municipality, name, address], 24)


def tracking_id(ids: Column, web_id: Column) -> Column:
    """ref:<id> for one master id, refgroup:<hash of the sorted ids> for several, web:<id> for none."""
    ids = F.array_sort(F.array_distinct(F.filter(F.coalesce(ids, F.array().cast("array<string>")), lambda v: v != "")))
    return F.when(F.size(ids) == 1, F.concat(F.lit("ref:"), F.element_at(ids, 1))).when(F.size(ids) > 1, F.concat(F.lit("refgroup:"), F.substring(F.sha2(F.array_join(ids, "|"), 256), 1, 20))).otherwise(F.concat(F.lit("web:"), web_id))


def web_prefixed(c: Column) -> Column:
    c = text_or_empty(c)
    return F.when((c == "") | F.startswith(c, F.lit("web:")), c).otherwise(F.concat(F.lit("web:"), c))


def parse_int(c: Column) -> Column:
    """The first signed integer with its commas dropped; null for none and for cells without a value."""
    c = trimmed(c)
    found = F.replace(F.regexp_extract(c, r"-?[0-9][0-9,]*", 0), F.lit(","), F.lit(""))
    return F.when(~c.isin(*DASH_CELLS, *UNKNOWN_CELLS), found.try_cast("long"))


def parse_integer(c: Column) -> Column:
    """A whole cell of digits and commas; anything else raises under ANSI."""
    c = F.replace(trimmed(c), F.lit(","), F.lit(""))
    return F.when(F.rlike(c, F.lit("^[0-9]+$")), c.try_cast("long")).otherwise(F.raise_error(F.concat(F.lit("not an integer: "), c)).cast("long"))


def parse_capacity(c: Column) -> Column:
    """struct(persons, raw, status): parsed, missing, missing_zero, invalid or invalid_negative."""
    raw = trimmed(c)
    digits = F.replace(raw, F.lit(","), F.lit(""))
    number = F.when(F.rlike(digits, F.lit("^-?[0-9]+$")), digits.try_cast("long"))
    status = F.when(raw == "", "missing").when(number.isNull(), "invalid").when(number == 0, "missing_zero").when(number < 0, "invalid_negative").otherwise("parsed")
    return F.struct(F.when(number > 0, number).alias("persons"), raw.alias("raw"), status.alias("status"))


def parse_coordinate(c: Column, low: float, high: float) -> Column:
    """A decimal number within a range, else null; forms that only one parser takes are refused."""
    c = trimmed(c)
    number = F.when(F.rlike(c, F.lit(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$")), c.try_cast("double"))
    return F.when(number.between(low, high), number)


def valid_pair(latitude: Column, longitude: Column) -> Column:
    """struct(latitude, longitude) of the original texts if both are in range, else null."""
    ok = parse_coordinate(latitude, *LATITUDES).isNotNull() & parse_coordinate(longitude, *LONGITUDES).isNotNull()
    return F.when(ok, F.struct(trimmed(latitude).alias("latitude"), trimmed(longitude).alias("longitude")))


def score_text(c: Column) -> Column:
    """Three decimals, rounded half to even on the binary value; zero and null are blank."""
    return F.when(F.coalesce(c, F.lit(0.0)) == 0, "").otherwise(F.format_number(c, 3))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    t = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(t)))


def same_coordinate(a: Column, b: Column, tolerance: float = 1e-10) -> Column:
    return F.abs(a - b) <= tolerance


def _time(c: Column, pattern: str, groups: int = 5) -> list[Column]:
    return [F.regexp_extract(c, pattern, k + 1).try_cast("int") for k in range(groups)]


def parse_datetime(c: Column) -> Column:
    """A timestamp in one of two written forms, years of two digits after 2000; null if none or not a date."""
    c = trimmed(c)
    out = []
    for pattern in (r"([0-9]{2,4})/([0-9]{1,2})/([0-9]{1,2})\s+([0-9]{1,2}):([0-9]{2})", r"([0-9]{2,4})年([0-9]{1,2})月([0-9]{1,2})日\s*([0-9]{1,2})時([0-9]{1,2})分"):
        year, month, day, hour, minute = _time(c, pattern)
        out.append(F.try_make_timestamp(F.when(year < 100, year + 2000).otherwise(year), month, day, hour, minute, F.lit(0)))
    return F.coalesce(*out)


def era_datetime(c: Column, default_year: Column | None = None) -> Column:
    """A timestamp with an era year, or month and day with a western or default year and 午前/午後 hours."""
    c = trimmed(c)
    year, month, day, hour, minute = _time(c, r"令和\s*([0-9]+)\s*年\s*([0-9]+)\s*月\s*([0-9]+)\s*日.*?([0-9]+)\s*時\s*([0-9]+)\s*分")
    by_era = F.try_make_timestamp(year + ERA_BASE_YEAR, month, day, hour, minute, F.lit(0))
    plain = r"([0-9]+)\s*月\s*([0-9]+)\s*日.*?(午前|午後)?\s*([0-9]+)\s*時\s*([0-9]+)\s*分"
    month, day, hour, minute = (F.regexp_extract(c, plain, k).try_cast("int") for k in (1, 2, 4, 5))
    half = F.regexp_extract(c, plain, 3)
    hour = F.when((half == "午後") & (hour < 12), hour + 12).when((half == "午前") & (hour == 12), 0).otherwise(hour)
    western = F.regexp_extract(c, r"(20[0-9]{2})\s*年", 1).try_cast("int")
    year = F.coalesce(western, default_year) if default_year is not None else western
    return F.coalesce(by_era, F.try_make_timestamp(year, month, day, hour, minute, F.lit(0)))


def parse_date(c: Column) -> Column:
    """A date written with - or /; null if it is none."""
    return F.to_date(F.try_to_timestamp(F.replace(trimmed(c), F.lit("/"), F.lit("-")), F.lit("yyyy-M-d")))


def open_state(c: Column) -> Column:
    """true, false or null (unknown); words of closing win over words of opening."""
    c = trimmed(c)
    said = lambda words: F.rlike(c, F.lit("|".join(words)))
    return F.when(c.isin(*DASH_CELLS), False).when((c == "") | c.isin(*UNKNOWN_CELLS), None).when(said(CLOSED_WORDS), False).when(said(OPEN_WORDS), True)


def open_text(state: Column) -> Column:
    return F.when(state.isNull(), "unknown").when(state, "true").otherwise("false")


def congestion_or_unknown(c: Column) -> Column:
    c = trimmed(c)
    return F.when((c == "") | c.isin(*DASH_CELLS, "未入力"), "不明").otherwise(c)


def status_label(state: Column, congestion: Column) -> Column:
    return F.when(state.isNull(), "状態不明").when(state, F.concat(F.lit("開設（"), congestion_or_unknown(congestion), F.lit("）"))).otherwise("未開設")


def congestion_label(state: Column, congestion: Column) -> Column:
    return F.when(state.isNull(), "状態不明").when(state, congestion_or_unknown(congestion)).otherwise("未開設")


def open_flag(state: Column) -> Column:
    """1, 0 or null for unknown."""
    return state.cast("int")
