"""Column functions: no Python runs in any of them."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def iso_dow(d: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(_c(d)) + 1).cast("long")


def instant_text(ts: Column | str) -> Column:
    """A UTC instant with six digits and its zone, the form used in keys."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'")


def key(*parts: Column | str) -> Column:
    """Parts joined by a bar; null if any is null."""
    out: list[Column] = []
    for p in parts:
        out += [F.lit("|"), _c(p).cast("string")]
    return F.concat(*out[1:])


def latest_of(*ts: Column | str) -> Column:
    """The later of the instants that are there."""
    return F.greatest(*map(_c, ts))


def safe_corr(x: Column | str, y: Column | str, digits: int | None = 9) -> Column:
    """Pearson's r over pairs that are complete; null where a side has no variance."""
    both = _c(x).isNotNull() & _c(y).isNotNull()
    x, y = F.when(both, _c(x).cast("double")), F.when(both, _c(y).cast("double"))
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.round(r, digits) if digits is not None else r


def null_rate(x: Column | str) -> Column:
    """Share of nulls, null on no rows."""
    return F.try_divide(F.count_if(_c(x).isNull()).cast("double"), F.count(F.lit(1)))


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """Complete seconds from a to b, at least 0; null if either is null."""
    s = F.timestamp_diff("SECOND", _c(a), _c(b))
    return F.when(s.isNotNull(), F.greatest(s, F.lit(0))).cast("long")


#: White space of a blank text, without the spaces that don't break: a fixed value.
_WHITE = r"\t-\r\x1c-\x20\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000"


def blank(x: Column | str) -> Column:
    """Whether the text is null or holds white space only, tabs and line breaks among it."""
    return F.coalesce(~_c(x).rlike(f"[^{_WHITE}]"), F.lit(True))


def iso_instant(x: Column | str) -> Column:
    """An ISO-8601 instant with a zone; null for anything else."""
    return F.when(_c(x).rlike(r"T.*(Z|[+-]\d\d:?\d\d)$"), F.try_to_timestamp(_c(x)))


@cache
def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """What characters fold to in ASCII: single ones, and longer ones.

    The rule is compatibility decomposition without what isn't ASCII.  The ranges hold
    every character that it leaves something of: the first plane, modifier letters, and
    the mathematical, enclosed and segmented forms of the second.
    """
    one, more = {}, {}
    for low, high in ((0x80, 0xD7FF), (0xE000, 0xFFFF), (0x10780, 0x107FF), (0x1D400, 0x1FBFF)):
        for c in map(chr, range(low, high + 1)):
            to = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
            if to:
                (one if len(to) == 1 else more)[c] = to
    return one, more


def slug(x: Column | str) -> Column:
    """Lower-case ASCII words joined by underscores, of what the text folds to; ``unknown`` if nothing is left."""
    one, more = _folds()
    x = F.coalesce(_c(x), F.lit(""))
    folded = F.translate(x, "".join(one), "".join(one.values()))
    # few texts hold what folds to several characters; those are looked at one by one
    known = F.create_map(*[F.lit(v) for kv in more.items() for v in kv])
    longer = F.array_join(F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(known, c), c)), "")
    folded = F.when(folded.rlike(f"[{''.join(more)}]"), longer).otherwise(folded)
    # a text of as many bytes as characters is ASCII, and folds to itself
    out = F.when(F.octet_length(x) == F.char_length(x), x).otherwise(F.regexp_replace(folded, "[^\\x00-\\x7f]", ""))
    out = F.btrim(F.regexp_replace(F.lower(out), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(out, F.lit("")), F.lit("unknown"))


def clamp(x: Column | str, low: float, high: float) -> Column:
    return F.least(F.greatest(_c(x), F.lit(low)), F.lit(high))


#: Upper bounds of the air-quality index, the status and the alert level of each band: fixed values.
AQI_BANDS = (
    (50, "good", "none"),
    (100, "moderate", "none"),
    (150, "unhealthy_for_sensitive_groups", "warning"),
    (200, "unhealthy", "alert"),
    (300, "very_unhealthy", "severe"),
    (None, "hazardous", "critical"),
)


def _band(aqi: Column, null: object, negative: object, pick: list) -> Column:
    out = F.when(aqi.isNull(), F.lit(null)).when(aqi < 0, F.lit(negative))
    for (top, _, _), value in zip(AQI_BANDS[:-1], pick[:-1], strict=True):
        out = out.when(aqi <= top, F.lit(value))
    return out.otherwise(F.lit(pick[-1]))


def aqi_status(aqi: Column | str) -> Column:
    return _band(_c(aqi), "unknown", "invalid", [b[1] for b in AQI_BANDS])


def aqi_rank(aqi: Column | str) -> Column:
    return _band(_c(aqi), 0, -1, list(range(1, 7))).cast("int")


def aqi_alert_level(aqi: Column | str) -> Column:
    return _band(_c(aqi), "unknown", "unknown", [b[2] for b in AQI_BANDS])


def aqi_alert(aqi: Column | str) -> Column:
    return F.coalesce(_c(aqi) > 100, F.lit(False))


def alert_severity(rank: Column | str) -> Column:
    return F.when(_c(rank) >= 6, "critical").when(_c(rank) == 5, "severe").when(_c(rank) == 4, "high").otherwise("warning")


def has_precipitation(precipitation: Column | str, rain: Column | str) -> Column:
    return (F.coalesce(_c(precipitation), F.lit(0.0)) > 0) | (F.coalesce(_c(rain), F.lit(0.0)) > 0)


def is_live(processed: Column | str, now: Column, seconds: int = 30) -> Column:
    return F.coalesce(_c(processed) >= now - F.expr(f"INTERVAL {seconds} SECONDS"), F.lit(False))
