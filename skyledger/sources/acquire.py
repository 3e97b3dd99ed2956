"""Thin download clients: addresses of each source, retries with doubling pauses, files written aside and renamed."""

from __future__ import annotations

import base64
import json
import re
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta
from pathlib import Path
from urllib.parse import urlencode, urlsplit


Request = str | urllib.request.Request


def fetch(url: Request, to: str, *, tries: int = 3, timeout: int = 600, pause: Callable[[float], None] = time.sleep, opener=urllib.request.urlopen, overwrite: bool = False) -> bool:
    """Whether the file is there afterwards; False if the server has none (404)."""
    dest = Path(to)
    if dest.exists() and not overwrite:
        return True
    dest.parent.mkdir(parents=True, exist_ok=True)
    part = dest.with_name(dest.name + ".part")
    for k in range(tries):
        try:
            with opener(url, timeout=timeout) as r, part.open("wb") as f:
                while block := r.read(1 << 20):
                    f.write(block)
            part.rename(dest)
            return True
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return False
            if k == tries - 1:
                raise
            wait = retry_after(e)
        except OSError:
            if k == tries - 1:
                raise
            wait = 0.0
        pause(max(2.0**k, wait))
    return False


def retry_after(e: urllib.error.HTTPError) -> float:
    """The seconds that a busy server asks to wait for."""
    text = (e.headers or {}).get("Retry-After") or ""
    return float(text) if text.isdigit() else 0.0


class Pace:
    """An opener that leaves so many seconds between two requests to one host, whichever thread asks."""

    def __init__(self, seconds: float, opener=urllib.request.urlopen, clock: Callable[[], float] = time.monotonic, pause: Callable[[float], None] = time.sleep):
        self.seconds, self.opener, self.clock, self.pause = seconds, opener, clock, pause
        self._next: dict[str, float] = {}
        self._lock = threading.Lock()

    def __call__(self, url: Request, timeout: int | None = None):
        host = urlsplit(url if isinstance(url, str) else url.full_url).netloc
        with self._lock:
            now = self.clock()
            at = max(now, self._next.get(host, now))
            self._next[host] = at + self.seconds
        if at > now:
            self.pause(at - now)
        return self.opener(url, timeout=timeout)


def fetch_all(jobs: list[tuple[str, str]], *, threads: int = 8, **how) -> dict[str, bool]:
    """{destination: there} for (url, destination) pairs."""
    with ThreadPoolExecutor(threads) as pool:
        return dict(zip((d for _, d in jobs), pool.map(lambda j: fetch(*j, **how), jobs)))


def year_chunks(first: int, last: int, years: int = 5) -> list[tuple[int, int]]:
    """Spans of years that a slow service is asked for one at a time."""
    return [(y, min(y + years - 1, last)) for y in range(first, last + 1, years)]


@dataclass(frozen=True)
class Job:
    """A file to be had from the first address that has it."""

    key: str
    urls: tuple[Request, ...]
    to: str


def run_jobs(jobs: Iterable[Job], *, threads: int = 8, **how) -> list[tuple[str, str, str]]:
    """(key, state, message) of each job, for the manifest: done, missing or failed."""

    def one(job: Job) -> tuple[str, str, str]:
        try:
            return (job.key, "done", job.to) if any(fetch(u, job.to, **how) for u in job.urls) else (job.key, "missing", "")
        except (OSError, ValueError) as e:
            return job.key, "failed", f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(one, jobs))


def days(start: date, end: date) -> list[date]:
    return [start + timedelta(k) for k in range((end - start).days + 1)]


# Addresses of the public archives.
MADIS_URL = "https://madis-data.ncep.noaa.gov/madisResearch/data"
ISD_URL = "https://noaa-isd-pds.s3.amazonaws.com"
GHCNH_URL = "https://www.ncei.noaa.gov/data/global-historical-climatology-network-hourly/v1beta/access"
GDAS_URL = "https://osdf-director.osg-htc.org/ncar/gdex/d337000/tarfiles"
NDBC_TABLE_URL = "https://www.ndbc.noaa.gov/data/stations/station_table.txt"
NDBC_HISTORY_URL = "https://www.ndbc.noaa.gov/data/historical/stdmet"
NDBC_LATEST_URL = "https://www.ndbc.noaa.gov/data/l_stdmet"
RAWS_URL = "https://raws.dri.edu"
RAWS_DATA_URL = "https://wrcc.dri.edu/cgi-bin/wea_dysimts2.pl"
SNOTEL_URL = "https://wcc.sc.egov.usda.gov/awdbRestApi/services/v1"
# The archive's list pages of stations.
RAWS_REGIONS = (
    "wa", "or", "sid", "nidwmt", "emt", "wy", "nca", "cca", "sca", "nvut", "co", "az", "nm", "nd", "sd", "ne", "ks", "ok", "tx", "mn", "ia", "mo", "ar", "la", "ak",
)
# The service's names of measures and of a station's fields.
SNOTEL_ELEMENTS = ("WTEQ", "SNWD", "PREC", "TOBS")
SNOTEL_FIELDS = ("stationTriplet", "name", "latitude", "longitude", "elevation", "stationDataTimeZone", "beginDate", "endDate")
RAWS_YEARS, SNOTEL_YEARS = 5, 5  # of one request


def madis_jobs(start: date, end: date, root: str, dataset: str = "LDAD/mesonet/netCDF") -> list[Job]:
    """24 hourly files of each day."""
    names = [(d, f"{d:%Y%m%d}_{h:02d}00.gz") for d in days(start, end) for h in range(24)]
    return [Job(n.removesuffix(".gz"), (f"{MADIS_URL}/archive/{d:%Y/%m/%d}/{dataset}/{n}",), f"{root}/{d:%Y}/{n}") for d, n in names]


def basic_auth(url: str, user: str, password: str) -> urllib.request.Request:
    token = base64.b64encode(f"{user}:{password}".encode()).decode()
    return urllib.request.Request(url, headers={"Authorization": f"Basic {token}"})


def isd_listing(year: int, after: str | None = None) -> str:
    """The address of a page of the archive's file list, and of the next one after a key."""
    return f"{ISD_URL}/?" + urlencode({"list-type": 2, "prefix": f"data/{year}/"} | ({"start-after": after} if after else {}))


def isd_keys(page: str) -> tuple[list[str], bool]:
    """Keys of a page of the list, and whether there are more."""
    return re.findall(r"<Key>([^<]+\.gz)</Key>", page), "<IsTruncated>true" in page


def isd_jobs(keys: list[str], root: str) -> list[Job]:
    return [Job(k.removeprefix("data/"), (f"{ISD_URL}/{k}",), f"{root}/{k.removeprefix('data/')}") for k in keys]


def ghcnh_files(index: str) -> list[str]:
    """Station files that the archive's index page links to."""
    return sorted(set(re.findall(r'href="([^"/]+\.psv)"', index)))


def ghcnh_jobs(names: list[str], root: str) -> list[Job]:
    return [Job(n.removesuffix(".psv"), (f"{GHCNH_URL}/{n}",), f"{root}/{n}") for n in names]


def gdas_jobs(start: date, end: date, root: str) -> list[Job]:
    """A day's archive of either form."""
    return [
        Job(f"{d:%Y%m%d}", tuple(f"{GDAS_URL}/{d:%Y}/prepbufr.{d:%Y%m%d}.{form}.tar.gz" for form in ("nr", "wo40")), f"{root}/{d:%Y}/prepbufr.{d:%Y%m%d}.tar.gz") for d in days(start, end)
    ]


def ndbc_location(text: str) -> tuple[float | None, float | None]:
    """Latitude and longitude of a place such as 30.517 N 152.127 E (30 31'2" N 152 7'38" E), or of its second form alone."""
    found = re.match(r"\s*([\d.]+)\s*([NS])\s+([\d.]+)\s*([EW])", text)
    if not found:  # degrees, minutes and seconds alone
        sides = {h: (int(d) + int(m) / 60 + int(s) / 3600) * (-1 if h in "SW" else 1) for d, m, s, h in re.findall(r"(\d+)\D+?(\d+)\D+?(\d+)[^\dNSEW]*([NSEW])", text)}
        lat, lon = ([v for h, v in sides.items() if h in pair] for pair in ("NS", "EW"))
        return (lat[0], lon[0]) if lat and lon else (None, None)
    lat, lon = float(found[1]), float(found[3])
    return -lat if found[2] == "S" else lat, -lon if found[4] == "W" else lon


def ndbc_stations(table: str) -> list[dict]:
    """Stations of the archive's table of fields between bars: id, owner, type, hull, name, payload, location."""
    rows = []
    for line in table.splitlines():
        f = [x.strip() for x in line.split("|")]
        if line.startswith("#") or len(f) < 7 or not f[0]:
            continue
        lat, lon = ndbc_location(f[6])
        rows.append({"source_station_id": f[0].upper(), "name": f[4], "lat": lat, "lon": lon})
    return rows


def ndbc_jobs(stations: list[str], years: tuple[int, int], root: str, latest: bool = True) -> list[Job]:
    jobs = [Job(f"{s.upper()}/{y}", (f"{NDBC_HISTORY_URL}/{s.lower()}h{y}.txt.gz",), f"{root}/{s.lower()}h{y}.txt.gz") for s in stations for y in range(years[0], years[1] + 1)]
    return jobs + [Job(f"{s.upper()}/latest", (f"{NDBC_LATEST_URL}/{s.upper()}.txt",), f"{root}/{s.lower()}_latest.txt") for s in stations if latest]


def raws_stations(page: str) -> list[str]:
    """Station codes of a region's list page."""
    return sorted(set(re.findall(r"rawMAIN\.pl\?([A-Za-z0-9]+)", page)))


def raws_jobs(station: str, start: date, end: date, root: str) -> list[Job]:
    """Daily tables of a station, some years at a time, as forms that are posted."""
    jobs, at = [], start
    while at <= end:
        to = min(date(at.year + RAWS_YEARS, 12, 31), end)
        form = {
            "stn": station[-4:].lower(), "smon": f"{at:%m}", "sday": f"{at:%d}", "syea": f"{at:%y}", "emon": f"{to:%m}", "eday": f"{to:%d}", "eyea": f"{to:%y}",
            "qBasic": "ON", "unit": "M", "Ofor": "A", "Datareq": "A", "qc": "Y", "miss": "08", "obs": "N", "WsMon": "01", "WsDay": "01", "WeMon": "12", "WeDay": "31", "Submit Info": "Submit Info",
        }  # fixed values but for station and dates
        request = urllib.request.Request(RAWS_DATA_URL, urlencode(form).encode(), method="POST")
        jobs.append(Job(f"{station}/{at:%Y%m%d}", (request,), f"{root}/{station}_{at:%Y%m%d}.html"))
        at = to + timedelta(1)
    return jobs


def snotel_inventory() -> str:
    return f"{SNOTEL_URL}/stations?" + urlencode({"activeOnly": "true", "networkCds": "SNTL", "returnFields": ",".join(SNOTEL_FIELDS), "logicalAnd": "true"})


def snotel_jobs(triplet: str, start: date, end: date, root: str, elements: tuple[str, ...] = SNOTEL_ELEMENTS) -> list[Job]:
    """Hourly measures of a station, some years at a time."""
    jobs, at = [], start
    while at <= end:
        try:
            then = at.replace(year=at.year + SNOTEL_YEARS)
        except ValueError:  # 29 February
            then = at.replace(year=at.year + SNOTEL_YEARS, day=28)
        to = min(then - timedelta(1), end)
        ask = {"stationTriplets": triplet, "elements": ",".join(elements), "duration": "HOURLY", "beginDate": f"{at:%Y-%m-%d}", "endDate": f"{to:%Y-%m-%d}"}
        name = triplet.replace(":", "_")
        jobs.append(Job(f"{name}/{at:%Y%m%d}", (f"{SNOTEL_URL}/data?{urlencode(ask)}",), f"{root}/{name}_{at:%Y%m%d}.json"))
        at = to + timedelta(1)
    return jobs


def text_of(url: Request, opener=urllib.request.urlopen) -> str:
    with opener(url, timeout=60) as r:
        return r.read().decode("utf-8", "replace")


def isd_archive(years: Iterable[int], opener=urllib.request.urlopen) -> list[str]:
    """All keys of some years, page by page: each page begins after the last key of the one before."""
    out = []
    for y in years:
        after, more = None, True
        while more:
            keys, more = isd_keys(text_of(isd_listing(y, after), opener))
            out += keys
            more, after = more and bool(keys), keys[-1] if keys else None
    return out


def listed_stations(source: str, opener=urllib.request.urlopen, *, regions: Iterable[str] = RAWS_REGIONS) -> list[str]:
    """The stations that a source's own listing names: what ``ingest`` takes without any."""
    if source == "ghcnh":
        return ghcnh_files(text_of(f"{GHCNH_URL}/", opener))
    if source == "ndbc":
        return [s["source_station_id"] for s in ndbc_stations(text_of(NDBC_TABLE_URL, opener))]
    if source == "raws":
        return sorted({s for r in regions for s in raws_stations(text_of(f"{RAWS_URL}/wraws/{r}lst.html", opener))})
    if source == "snotel":
        return sorted(s["stationTriplet"] for s in json.loads(text_of(snotel_inventory(), opener)) if s.get("networkCode", "SNTL") == "SNTL")
    raise KeyError(f"{source!r} has no listing")


RAWS_FACTS = {"location": "Location", "lat": "Latitude", "lon": "Longitude", "elev_m": "Elevation", "ness_id": "NESS ID", "nws_id": "NWS ID", "agency": "Agency"}  # fixed values: labels of the page


def raws_facts(page: str) -> dict[str, str | float]:
    """What a station's page says of it: cells after bold labels; degrees west are negative, feet become metres."""
    cells = {k.strip().lower(): v.strip() for k, v in re.findall(r"<b>([^<]+)</b>\s*</td>\s*<td>([^<\n]*)", page, re.I)}
    out: dict[str, str | float] = {}
    for name, label in RAWS_FACTS.items():
        text = cells.get(label.lower(), "")
        numbers = [float(x) for x in re.findall(r"\d+(?:\.\d+)?", text)]
        if name in ("lat", "lon") and numbers:
            degrees = sum(x / 60**k for k, x in enumerate(numbers[:3]))
            out[name] = -degrees if name == "lon" else degrees
        elif name == "elev_m" and numbers:
            out[name] = numbers[0] * 0.3048
        elif text and name not in ("lat", "lon", "elev_m"):
            out[name] = text
    return out


def snotel_rows(answer: str) -> list[dict]:
    """(triplet, datetime_local, element, value) of an answer."""
    out = []
    for station in json.loads(answer):
        for series in station.get("data", []):
            code = series["stationElement"]["elementCode"]
            out += [{"triplet": station["stationTriplet"], "datetime_local": v["date"], "element": code, "value": v.get("value")} for v in series.get("values", [])]
    return out
