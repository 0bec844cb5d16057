"""Downloads with resume, dump dates and the cache's layout. Driver-side utilities."""

from __future__ import annotations

import json
import re
import urllib.error
import urllib.request
from collections.abc import Callable
from pathlib import Path

CHUNK = 1 << 20
CONNECT_S, READ_S = 10, 60
JOB = "articlesdumprecombine"


def download(url: str, out: str | Path, opener: Callable = urllib.request.urlopen) -> Path:
    """Fetch a file; a ".part" left behind is continued if the server agrees, and kept if the transfer breaks."""
    out = Path(out)
    part = out.with_name(f"{out.name}.part")
    have = part.stat().st_size if part.exists() else 0
    request = urllib.request.Request(url, headers={"Range": f"bytes={have}-"} if have else {})
    try:
        with opener(request, timeout=READ_S) as response, part.open("ab" if have and response.status == 206 else "wb") as file:
            while chunk := response.read(CHUNK):
                file.write(chunk)
    except urllib.error.HTTPError as error:
        if error.code != 416 or not have:
            raise
    return part.replace(out)


def latest_date(index: str, status: Callable[[str], str | None]) -> str:
    """The newest date of an index page whose dump is finished. status gives a date's status document, or None."""
    for date in sorted(set(re.findall(r'href="(\d{8})/', index)), reverse=True):
        try:
            jobs = json.loads(status(date) or "null")
        except ValueError:
            continue
        if isinstance(jobs, dict) and jobs.get("jobs", {}).get(JOB, {}).get("status") == "done":
            return date
    raise LookupError("no dump is finished")


def fetched_date(cache: str | Path, date: str = "latest") -> str:
    """A date that the cache has; the newest for "latest"."""
    found = sorted(p.name for p in Path(cache).glob("*") if p.is_dir() and re.fullmatch(r"\d{8}", p.name)) if Path(cache).is_dir() else []
    if date == "latest" and found:
        return found[-1]
    if date in found:
        return date
    raise FileNotFoundError(f"{cache} has no dump of {date}")


def dump_dir(cache: str | Path, date: str) -> Path:
    return Path(cache) / date


def resource_dir(cache: str | Path, date: str) -> Path:
    return dump_dir(cache, date) / "resources"


def alignment_dir(cache: str | Path, date: str) -> Path:
    return dump_dir(cache, date) / "alignment"


def migrate_resources(cache: str | Path, date: str, names: list[str]) -> list[Path]:
    """Move side tables of the older layout, which kept them beside the dump."""
    target = resource_dir(cache, date)
    moved = []
    for name in names:
        old = dump_dir(cache, date) / name
        if old.is_file() and not (target / name).exists():
            target.mkdir(parents=True, exist_ok=True)
            moved.append(old.replace(target / name))
    return moved
