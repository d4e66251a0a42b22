"""Plain, slow restatements of the problems, written independently of the operators. They read pandas frames."""

from __future__ import annotations

import csv
import io
import json
import math
import re
from collections import defaultdict
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal
from zoneinfo import ZoneInfo

LOCAL = ZoneInfo("Africa/Johannesburg")
EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
FORMATS = ("%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%d.%m.%Y", "%d %b %Y", "%d-%b-%Y", "%b %d, %Y")


def none(v):
    return None if v is None or v != v else v


def ident(v):
    s = "".join(c for c in str(v) if c.isalnum()).lower() if none(v) is not None else ""
    return s or None


def readable(v):
    return none(v) is not None and bool(re.fullmatch(r"[ \t]*[+-]?[0-9]{1,16}(\.[0-9]{1,2})?[ \t]*", v))


def blank(v):
    return none(v) is None or not v.strip()


# --- stamps
def day_of(s):
    if re.fullmatch(r"[0-9]{8}", s):
        s = f"{s[:4]}-{s[4:6]}-{s[6:]}"
    for f in FORMATS:
        try:
            return datetime.strptime(s, f).date()
        except ValueError:
            pass
    return None


def clock_of(s):
    """(seconds as timedelta, zone or None) of a time text."""
    zone = None
    if m := re.fullmatch(r"(.*?) ([A-Z]\w+/\w+)", s):
        s, zone = m[1], ZoneInfo(m[2])
    elif m := re.fullmatch(r"(.*?)(Z|[+-]\d\d:?\d\d)", s):
        s, zone = m[1], datetime.strptime(m[2], "%z").tzinfo
    for f in ("%H:%M:%S", "%H:%M:%S.%f", "%H:%M", "%H%M%S", "%I:%M:%S %p"):
        try:
            t = datetime.strptime(s, f)
            return timedelta(hours=t.hour, minutes=t.minute, seconds=t.second, microseconds=t.microsecond), zone
        except ValueError:
            pass
    return None


def at_zone(day, delta, zone):
    wall = datetime(day.year, day.month, day.day) + delta
    return wall.replace(tzinfo=zone or LOCAL, fold=0).astimezone(UTC)


def instant(d, t):
    """UTC instant of a date and a time text, or None."""
    d = (none(d) or "").strip()
    if re.fullmatch(r"[0-9]{10}|[0-9]{13}|[0-9]{16}", d):
        return EPOCH + timedelta(microseconds=int(d) * 10 ** (16 - len(d)))
    if day := day_of(d):
        if blank(t):
            return at_zone(day, timedelta(0), None)
        c = clock_of(t.strip())
        return c and at_zone(day, *c)
    if m := re.fullmatch(r"(\d{4}-\d\d-\d\d)[T ](.+)", d):
        day, c = day_of(m[1]), clock_of(m[2])
        return at_zone(day, *c) if day and c else None
    return None


def local_date(s):
    s = (none(s) or "").strip()
    if m := re.fullmatch(r"(\d{4}-\d\d-\d\d)[T ]([\d:.]+)", s):
        return day_of(m[1]) if clock_of(m[2]) else None
    i = day_of(s)
    if i:
        return i
    i = instant(s, None)
    return i and i.astimezone(LOCAL).date()


def p7(transactions, accounts):
    out = set()
    for r in transactions.itertuples():
        d, t = none(r.transaction_date), none(r.transaction_time)
        if d and re.fullmatch(r"\d{4}-\d\d-\d\d", d) and t and re.fullmatch(r"\d\d:\d\d:\d\d", t):
            continue
        if i := instant(d, t):
            out.add(("transactions", r.row_id, "transaction_ts", i.strftime("%Y-%m-%dT%H:%M:%S.%fZ")))
    for r in accounts.itertuples():
        for c in ("open_date", "last_activity_date"):
            s = none(getattr(r, c))
            if s and not re.fullmatch(r"\d{4}-\d\d-\d\d", s) and (d := local_date(s)):
                out.add(("accounts", r.row_id, c, d.isoformat()))
    return out


# --- deliveries
def p5(transactions):
    first, out = {}, set()
    for r in sorted(transactions.itertuples(), key=lambda r: (r.ingested_at, r.row_id)):
        if (k := ident(r.transaction_id)) and first.setdefault(k, r.row_id) != r.row_id:
            out.add(r.row_id)
    return out


# --- trailing totals
def p2(transactions, accounts):
    gone = p5(transactions)
    known = {ident(a): a for a in accounts["account_id"] if ident(a)}
    days = defaultdict(lambda: defaultdict(lambda: [Decimal(0), 0]))
    for r in transactions.itertuples():
        if r.row_id in gone or not readable(r.amount) or ident(r.account_id) not in known:
            continue
        if i := instant(r.transaction_date, r.transaction_time):
            cell = days[ident(r.account_id)][i.astimezone(LOCAL).date()]
            cell[0] += Decimal(r.amount.strip())
            cell[1] += 1
    out = set()
    for a, by in days.items():
        d, last = min(by) + timedelta(29), max(by)
        while d <= last:
            t7, n7, t30 = Decimal(0), 0, Decimal(0)
            for k in range(30):
                total, n = by.get(d - timedelta(k), (Decimal(0), 0))
                t30 += total
                if k < 7:
                    t7, n7 = t7 + total, n7 + n
            if t7 >= 25000 and t7 >= t30 * Decimal("0.7"):
                out.add((known[a], d.isoformat(), "surge"))
            if not n7 and t30 >= 25000:
                out.add((known[a], d.isoformat(), "lull"))
            d += timedelta(1)
    return out


# --- places
def point(s):
    s = none(s)
    if s is None:
        return None
    s = s.strip()
    num = r"[+-]?\d+(?:\.\d+)?"
    lat = lon = None
    if m := re.fullmatch(rf"(?i)POINT\s*\(({num}) ({num})\)", s):
        lon, lat = float(m[1]), float(m[2])
    else:
        if m := re.fullmatch(r"\((.*)\)", s):
            s = m[1]
        if ";" in s:
            s = s.replace(",", ".").replace(";", " ; ")
            parts = [x.strip() for x in s.split(";")]
        elif "," in s:
            parts = [x.strip() for x in s.split(",")]
        else:
            parts = s.split()
        if len(parts) != 2:
            return None
        values = []
        for p in parts:
            if m := re.fullmatch(r"(\d+)°(\d+)'([\d.]+)\"([NSEW])", p):
                v, letter = int(m[1]) + int(m[2]) / 60 + float(m[3]) / 3600, m[4]
            elif m := re.fullmatch(r"([NSEW]?)(\d+(?:\.\d+)?)([NSEW]?)", p):
                v, letter = float(m[2]), m[1] + m[3]
            elif re.fullmatch(num, p):
                v, letter = float(p), ""
            else:
                return None
            values.append((-v if letter in ("S", "W") else v, letter))
        if values[0][1] in ("E", "W"):
            values.reverse()
        lat, lon = values[0][0], values[1][0]
    return (lat, lon) if -35 <= lat <= -22 and 16 <= lon <= 33 else None


def contains(ring, lat, lon):
    inside = False
    for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
        (y1, x1), (y2, x2) = a, b
        if (y1 > lat) != (y2 > lat) and lon < x1 + (lat - y1) / (y2 - y1) * (x2 - x1):
            inside = not inside
    return inside


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371000 * math.asin(math.sqrt(h))


def p1(transactions, places):
    letters = lambda s: "".join(c for c in s if c.isalpha()).lower()
    sites = [(p.place_id, p.lat, p.lon, p.radius_m) for p in places.itertuples() if p.place_kind == "site"]
    rings = [(p.place_id, p.place_kind, letters(p.place_label), [(q["lat"], q["lon"]) for q in p.boundary]) for p in places.itertuples() if p.place_kind != "site"]
    out = set()
    for r in transactions.itertuples():
        if not (p := point(r.location["coordinates"])):
            continue
        for i, lat, lon, radius in sites:
            if abs(lat - p[0]) < 0.1 and metres(*p, lat, lon) <= radius:
                out.add((r.row_id, i))
        stated = none(r.location["province"])
        for i, kind, label, ring in rings:
            if (kind == "zone" or not stated or letters(stated) != label) and contains(ring, *p):
                out.add((r.row_id, i))
    return out


# --- lines
def csv_fault(line):
    """Reads RFC 4180 by a regular expression of whole records, not by a machine."""
    field = r'(?:"(?:[^"]|"")*"|[^",\r\n]*)'
    if not re.fullmatch(rf"{field}(?:,{field})*", line):
        return "bad_quoting", None
    rows = list(csv.reader(io.StringIO(line, newline="")))
    fields = rows[0] if rows and rows[0] else [""]
    return ("column_count", None) if len(fields) != 11 else (None, fields)


def p4(raw, transactions, accounts):
    out = set()

    def values(table, row, main, limit=None):
        if blank(main):
            out.add((table, row, "missing_value"))
        elif not readable(main) or (not blank(limit) and not readable(limit)):
            out.add((table, row, "bad_number"))

    def refuse(_):
        raise ValueError

    for r in raw.itertuples():
        if r.file_name == "accounts.csv":
            fault, fields = csv_fault(r.line_text)
            if fault:
                out.add(("raw_lines", r.line_id, fault))
            else:
                values("raw_lines", r.line_id, fields[9], fields[8])
        else:
            try:
                o = json.loads(r.line_text, parse_float=str, parse_int=str, parse_constant=refuse)
                assert isinstance(o, dict)
            except (ValueError, AssertionError):
                out.add(("raw_lines", r.line_id, "bad_json"))
                continue
            a = o.get("amount")
            values("raw_lines", r.line_id, a if a is None or isinstance(a, str) else "bad")
    for r in transactions.itertuples():
        values("transactions", r.row_id, r.amount)
    for r in accounts.itertuples():
        values("accounts", r.row_id, r.current_balance, r.credit_limit)
    return out


__all__ = ["date", "p1", "p2", "p4", "p5", "p7"]
