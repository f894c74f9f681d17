"""Readings of one timestamp text: every moment it may denote, as (format, microseconds since 1970 UTC)."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

# Zone abbreviations that a text may name, in minutes east of UTC.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "MEZ": 60, "CEST": 120, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420,
}

# Month names and abbreviations in Danish, Norwegian, Swedish, English, German and French.
MONTH_NAMES = [
    "jan january januar januari janvier janv jänner",
    "feb february februar februari février fevrier févr fevr",
    "mar march marts mars märz maerz mrz",
    "apr april avril avr",
    "may maj mai",
    "jun june juni juin",
    "jul july juli juillet juil",
    "aug august augusti août aout",
    "sep sept september septembre",
    "oct october okt oktober octobre",
    "nov november novembre",
    "dec december dez dezember des desember décembre decembre déc",
]
MONTHS = {name: k for k, names in enumerate(MONTH_NAMES, 1) for name in names.split()}

ZONE = r"(?P<zone>Z|[A-Z]{2,4}|[+-]\d{2}(?::?\d{2})?)"
CLOCK = r"(?P<h>\d{1,2})[:.h](?P<mi>\d{2})(?:[:.](?P<s>\d{2})(?:[.,](?P<f>\d+))?)?"
SHAPES = [
    ("ymd", re.compile(r"(?P<y>\d{4})(?P<sep>[-/.])(?P<m>\d{1,2})(?P=sep)(?P<d>\d{1,2})(?:(?:[Tt]|\s+)" + CLOCK + r"(?:\s*" + ZONE + r")?)?")),
    ("compact", re.compile(r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})(?:[T ]?(?P<h>\d{2})(?P<mi>\d{2})(?P<s>\d{2})(?:[.,](?P<f>\d+))?(?:\s*" + ZONE + r")?)?")),
    ("epoch", re.compile(r"(?P<n>\d{10}|\d{13}|\d{16})(?:[.,](?P<f>\d+))?")),
    ("dmy", re.compile(r"(?P<d>\d{1,2})(?P<sep>[-/.])(?P<m>\d{1,2})(?P=sep)(?P<y>\d{4})(?:,?\s+(?:kl\.?\s*|um\s+|à\s+|at\s+)?" + CLOCK + r"(?:\s*Uhr)?(?:\s*" + ZONE + r")?)?")),
    ("named_dmy", re.compile(r"(?:\w+\.?,?\s+)?(?:den\s+)?(?P<d>\d{1,2})(?:\.|er)?\s+(?P<name>[^\W\d_]+)\.?,?\s+(?P<y>\d{4})(?:,?\s+(?:kl\.?\s*|um\s+|à\s+|at\s+)?" + CLOCK + r"(?:\s*Uhr)?(?:\s*" + ZONE + r")?)?")),
    ("named_mdy", re.compile(r"(?:[^\W\d_]+,\s+)?(?P<name>[^\W\d_]+)\.?\s+(?P<d>\d{1,2}),?\s+(?P<y>\d{4})(?:,?\s+(?:at\s+)?" + CLOCK + r"(?:\s*(?P<half>[AaPp])\.?[Mm]\.?)?(?:\s*" + ZONE + r")?)?")),
]
EPOCH = datetime(1970, 1, 1)
EPOCH_UTC = datetime(1970, 1, 1, tzinfo=timezone.utc)
MICRO = timedelta(microseconds=1)


@lru_cache(64)
def _zone(name: str) -> ZoneInfo:
    return ZoneInfo(name)


def _minutes(text: str) -> int | None:
    if text in ZONE_MINUTES:
        return ZONE_MINUTES[text]
    if text[0] not in "+-":
        return None
    digits = text[1:].replace(":", "")
    h, m = int(digits[:2]), int(digits[2:] or 0)
    return None if h > 18 or m > 59 else (60 * h + m) * (-1 if text[0] == "-" else 1)


def _local(wall: datetime, zone: str, fold: int) -> int:
    return (wall.replace(tzinfo=_zone(zone), fold=fold) - EPOCH_UTC) // MICRO


def readings(text: str | None, zone: str, strict: bool = True) -> list[tuple[str, int]]:
    """The readings of ``text`` as (format, microseconds); wall times without zone are in ``zone``.

    strict keeps only the reading that the table's rules allow (day first, the first of two equal wall times, a skipped
    wall time with the offset before the change). Otherwise month-first readings and second occurrences follow it.
    None, blanks, words, days that don't exist and numbers of other lengths have no reading.
    """
    return [(name, us) for name, us, _ in ruled_readings(text, zone, strict)]


def ruled_readings(text: str | None, zone: str, strict: bool = False) -> list[tuple[str, int, bool]]:
    """``readings``, each with whether it follows the table's rules; at most one does, and it comes first."""
    if text is None or not (t := text.strip()) or not any(c.isdigit() for c in t):
        return []
    out: list[tuple[str, int, bool]] = []
    for shape, pattern in SHAPES:
        m = pattern.fullmatch(t)
        if not m:
            continue
        g = m.groupdict()
        if shape == "epoch":
            unit = {10: 1_000_000, 13: 1000, 16: 1}[len(g["n"])]
            digits = {1_000_000: 6, 1000: 3, 1: 0}[unit]
            us = int(g["n"]) * unit + (int(g["f"][:digits].ljust(digits, "0")) if g["f"] and digits else 0)
            return [(f"epoch{len(g['n'])}", us, True)] if us < 253402300800000000 else []
        if "name" in g:
            month = MONTHS.get(g["name"].lower())
            if month is None:
                continue
        else:
            month = int(g["m"])
        orders = [(shape, month, int(g["d"]))]
        if not strict and shape == "dmy":
            orders.append(("mdy", int(g["d"]), month))
        hour, half = int(g.get("h") or 0), g.get("half")
        if half:
            if not 1 <= hour <= 12:
                return []
            hour = hour % 12 + (12 if half in "Pp" else 0)
        minutes = _minutes(g["zone"]) if g.get("zone") else None
        if g.get("zone") and minutes is None:
            continue
        for k, (name, mo, day) in enumerate(orders):
            try:
                wall = datetime(int(g["y"]), mo, day, hour, int(g.get("mi") or 0), int(g.get("s") or 0), int((g.get("f") or "0")[:6].ljust(6, "0")))
                if minutes is not None:
                    out.append((name + "z", (wall - EPOCH) // MICRO - minutes * 60_000_000, k == 0))
                else:
                    first = _local(wall, zone, 0)
                    out.append((name, first, k == 0))
                    if not strict and (second := _local(wall, zone, 1)) > first:
                        out.append((name, second, False))
            except (ValueError, OverflowError):
                pass
        return out
    return out


def utc_text(us: int) -> str:
    return (EPOCH + timedelta(microseconds=us)).isoformat(" ", "microseconds")
