"""The whole of three date fields against a second parser, written with datetime and zoneinfo."""

import datetime as dt
import re
import zoneinfo

import pyarrow.parquet as pq

from siltstone import queries
from siltstone.operators.timestamps import ABBREVIATIONS, MONTHS

D = "/root/testdata/sf0.01"
FIELDS = (("citations", "citation_date"), ("fuji_score", "evaluationDate"), ("raw_datacite", "publication_date"))
DATES = [
    (r"(\d{4})[-/](\d\d)[-/](\d\d)", lambda a, b, c: (a, b, c)), (r"(\d{4})(\d\d)(\d\d)(?=T)", lambda a, b, c: (a, b, c)),
    (r"(\d{1,2})/(\d{1,2})/(\d{4})", lambda a, b, c: (c, a, b)), (r"(\d{1,2})\.(\d{1,2})\.(\d{4})", lambda a, b, c: (c, b, a)),
    (r"(?:[A-Z][a-z]{2}, )?(\d{1,2})[- ]([A-Za-z]{3})[- ](\d{4})", lambda a, b, c: (c, month(b), a)), (r"([A-Z][a-z]+) (\d{1,2}), (\d{4})", lambda a, b, c: (c, month(a), b)),
]


def month(name):
    return MONTHS.index(name[:3].lower()) + 1 if name[:3].lower() in MONTHS else 99


def day(y, m, d):
    try:
        return dt.datetime(int(y), int(m), int(d))
    except ValueError:
        return None


def instant(v):
    s = (v or "").strip()
    if s.isdigit():
        n = len(s)
        seconds = {10: 1, 13: 1000}.get(n)
        return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=int(s) // seconds) if seconds else day(s, 1, 1) if n == 4 else day(s[:4], s[4:6], s[6:]) if n == 8 else None
    if m := re.fullmatch(r"(\d{4})-(\d\d)", s):
        return day(m[1], m[2], 1)
    if m := re.fullmatch(r"(\d{4})-W(\d\d)-(\d)", s):
        try:
            return dt.datetime.combine(dt.date.fromisocalendar(*map(int, m.groups())), dt.time())
        except ValueError:
            return None
    got = next(((f(*m.groups()), s[m.end() :]) for p, f in DATES if (m := re.match(p, s))), None)
    if not got or not got[1]:
        return day(*got[0]) if got else None
    m = re.fullmatch(r"[T ](\d{1,2}):?(\d\d)(?::?(\d\d)(?:\.\d+)?)?(?: ([AP]M)(?!e))?\s*(.*)", got[1], re.I)
    d = day(*got[0])
    if not m or d is None:
        return None
    h, mi, sec, zone = int(m[1]), int(m[2]), int(m[3] or 0), m[5]
    if m[4]:
        h = h % 12 + 12 * (m[4].upper() == "PM")
    if h > 24 or mi > 59 or sec > 59 or (h == 24 and mi + sec):
        return None
    d += dt.timedelta(hours=h, minutes=mi, seconds=sec)
    if o := re.match(r"([+-])(\d\d):?(\d\d)?", zone):
        off = (int(o[2]) * 60 + int(o[3] or 0)) * (-1 if o[1] == "-" else 1)
        return d - dt.timedelta(minutes=off if abs(off) <= 840 else 0)
    if zone.upper() in ABBREVIATIONS or not zone:
        return d - dt.timedelta(minutes=ABBREVIATIONS.get(zone.upper(), 0))
    return d.replace(tzinfo=zoneinfo.ZoneInfo(zone.strip("[]")), fold=0).astimezone(dt.timezone.utc).replace(tzinfo=None)


def test_whole_tables(spark):
    got = {(r.tab, r.row_key): r.utc for r in queries.p1_found(spark, D).collect()}
    want = {}
    for tab, field in FIELDS:
        t = pq.read_table(f"{D}/{tab}.parquet", columns=["seq", field]).to_pydict()
        for seq, v in zip(t["seq"], t[field]):
            u = instant(v)
            u = u and u.strftime("%Y-%m-%dT%H:%M:%SZ")
            if u and u != v:
                want[(tab, seq)] = u
    assert got == want
