"""Catalog search and partial downloads over HTTP; the opener is a parameter, so tests need no network."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator

from cellweave.errors import FormatError

Opener = Callable[..., object]


def search(url: str, body: dict, limit: int | None = None, opener: Opener = urllib.request.urlopen, timeout: float = 60) -> Iterator[dict]:
    """Features of a STAC search, page by page along its ``next`` links."""
    seen, request = 0, {"href": url.rstrip("/") + "/search", "body": body, "method": "POST"}
    while request:
        data = json.dumps(request.get("body") or {}).encode() if request.get("method", "GET").upper() == "POST" else None
        with opener(urllib.request.Request(request["href"], data=data, headers={"Content-Type": "application/json"}), timeout=timeout) as r:
            page = json.load(r)
        if "features" not in page:
            raise FormatError("no features in the answer")
        for f in page["features"]:
            if limit is not None and seen >= limit:
                return
            seen += 1
            yield f
        request = next((x for x in page.get("links", []) if x.get("rel") == "next"), None) if page["features"] else None


def listing(url: str, what: str, opener: Opener = urllib.request.urlopen, timeout: float = 60) -> dict:
    """``collections`` or ``collections/ID/queryables`` of a catalog."""
    with opener(urllib.request.Request(f"{url.rstrip('/')}/{what}"), timeout=timeout) as r:
        return json.load(r)


def fetch(url: str, opener: Opener = urllib.request.urlopen, timeout: float = 60) -> bytes:
    """A whole file: by range if a probe of its first byte tells its size, else plainly."""
    try:
        with opener(urllib.request.Request(url, headers={"Range": "bytes=0-0"}), timeout=timeout) as r:
            total = (r.headers.get("Content-Range") or "").rpartition("/")[2]
            if getattr(r, "status", 200) == 206 and total.isdigit():
                with opener(urllib.request.Request(url, headers={"Range": f"bytes=0-{int(total) - 1}"}), timeout=timeout) as whole:
                    return whole.read()
    except OSError:
        pass
    with opener(urllib.request.Request(url), timeout=timeout) as r:
        return r.read()
