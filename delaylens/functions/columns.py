"""Column expressions shared by the models and reports."""

from functools import reduce

from pyspark.sql import Column, functions as F

from delaylens import schemas as S


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- clock and calendar ------------------------------------------------------

def hhmm_hour(hhmm, clip=False) -> Column:
    """Hour of an HHMM clock. 2400 gives 24 unless clipped to 0-23 (NULL -> 0)."""
    hour = (col(hhmm).cast("int") / 100).cast("long")
    if clip:
        hour = F.greatest(F.lit(0), F.least(F.lit(23), F.coalesce(hour, F.lit(0)))).cast("long")
    return hour


def hhmm_floor(hhmm) -> Column:
    return F.floor(col(hhmm) / 100).cast("long")


def hhmm_text(hhmm) -> Column:
    padded = F.lpad(col(hhmm).cast("int").cast("string"), 4, "0")
    return F.concat(F.substring(padded, 1, 2), F.lit(":"), F.substring(padded, 3, 2))


def hhmm_timestamp(date, hhmm) -> Column:
    """Date and HHMM clock as one timestamp; 2400 is midnight of the next day."""
    clock = col(hhmm).cast("int")
    return F.timestamp_seconds(
        F.unix_timestamp(col(date).cast("date").cast("timestamp"))
        + F.floor(clock / 100) * 3600 + F.pmod(clock, F.lit(100)) * 60
    )


def weekday_number(date) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(col(date)).cast("long")


def weekday_from_monday_zero(n) -> Column:
    """Form input coding (0 = Monday) to 1 = Sunday ... 7 = Saturday."""
    return F.pmod(col(n) + 1, F.lit(7)) + 1


def weekday_label(n) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in S.WEEKDAYS]), col(n).cast("int"))


def weekday_name(date) -> Column:
    return F.date_format(col(date), "EEEE")


def month_label(year, month) -> Column:
    return F.date_format(F.make_date(col(year), col(month), F.lit(1)), "MMM yyyy")


def display_time(ts) -> Column:
    return F.date_format(col(ts).try_cast("timestamp"), "yyyy-MM-dd  HH:mm 'UTC'")


def hour_start(ts) -> Column:
    return F.date_trunc("hour", col(ts))


# --- keys --------------------------------------------------------------------

def joined_key(parts, sep) -> Column:
    """Concatenated key; NULL when any part is NULL."""
    texts = [col(p).cast("string") for p in parts]
    spaced = [x for t in texts for x in (F.lit(sep), t)][1:]
    return F.concat(*spaced)


def group_token(key) -> Column:
    """Text form of a grouping key in which NULL is a group of its own."""
    c = col(key)
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c.cast("string")))


# --- status and delays -------------------------------------------------------

def cancelled_flag(c) -> Column:
    c = col(c)
    return F.when(c == 1, F.lit(True)).when(c == 0, F.lit(False))


def clamp(c, lo, hi, fill=None) -> Column:
    """Limit to [lo, hi]; NULL stays NULL unless ``fill`` is given."""
    c = col(c)
    limited = F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))
    return limited if fill is None else F.coalesce(limited, F.lit(fill))


def is_delayed(c, threshold=S.DELAY_THRESHOLD) -> Column:
    """1 when above the threshold, 0 otherwise (NULL counts as on time)."""
    return F.when(col(c) > threshold, 1).otherwise(0)


def delay_rate(c="depdelay", threshold=S.DELAY_THRESHOLD) -> Column:
    return F.try_divide(F.count_if(col(c) > threshold), F.count(F.lit(1)))


# --- risk --------------------------------------------------------------------

def risk_label(score) -> Column:
    """Right-closed labels: (0, .3] Low, (.3, .6] Medium, (.6, 1] High, else NULL."""
    s = col(score)
    return (F.when((s > 0) & (s <= S.RISK_LOW), "Low")
            .when((s > S.RISK_LOW) & (s <= S.RISK_HIGH), "Medium")
            .when((s > S.RISK_HIGH) & (s <= 1.0), "High"))


def risk_band(score) -> Column:
    """Left-closed bands: below .3 Low, [.3, .6) Medium, from .6 High."""
    s = col(score)
    return (F.when(s < S.RISK_LOW, "Low").when(s < S.RISK_HIGH, "Medium")
            .when(s.isNotNull(), "High"))


# --- geography ---------------------------------------------------------------

def haversine_miles(lat1, lon1, lat2, lon2, default=S.DEFAULT_DISTANCE_MILES) -> Column:
    """Great-circle miles; ``default`` when a coordinate is missing."""
    a1, o1, a2, o2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    half_lat, half_lon = F.sin((a2 - a1) / 2), F.sin((o2 - o1) / 2)
    chord = half_lat * half_lat + F.cos(a1) * F.cos(a2) * half_lon * half_lon
    return F.coalesce(F.lit(2 * S.EARTH_RADIUS_MILES) * F.asin(F.sqrt(chord)), F.lit(default))


def in_box(lat, lon, south=24, north=50, west=-125, east=-66) -> Column:
    return col(lat).between(south, north) & col(lon).between(west, east)


# --- hashing and bins --------------------------------------------------------

def hash_bucket(key, buckets=100) -> Column:
    """Engine-neutral bucket in [0, buckets) from the md5 of the key."""
    head = F.conv(F.substring(F.md5(col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(buckets))


def histogram_bin(c, lo, hi, bins) -> Column:
    """Equal-width bin number 0..bins-1; the last bin is closed; NULL outside."""
    c = col(c)
    width = (hi - lo) / bins
    return (F.when((c >= lo) & (c < hi), F.least(F.floor((c - lo) / width), F.lit(bins - 1)))
            .when(c == hi, F.lit(bins - 1))).cast("long")


def cut_index(c, edges) -> Column:
    """Right-closed interval number, lowest edge included; NULL outside."""
    c = col(c)
    steps = list(zip(edges[:-1], edges[1:]))
    inside = (c >= edges[0]) & (c <= edges[-1])
    first = F.when(inside & (c <= edges[1]), F.lit(0))
    return reduce(lambda acc, s: acc.when(inside & (c <= s[1][1]), F.lit(s[0])),
                  enumerate(steps[1:], start=1), first)
