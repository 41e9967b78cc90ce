"""Files of a remote folder: its listing as rows, and their download, a part of the list a task."""

from __future__ import annotations

import json
import os
import time
import urllib.request
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TRIES, WAIT_BASE, CHUNK, TIMEOUT = 3, 2.0, 1 << 20, 60
_LISTED = "path string, size long, url string"


def open_url(url: str, start: int = 0) -> tuple[Any, bool]:
    """(open reply, whether it begins at `start`)."""
    request = urllib.request.Request(url, headers={"Range": f"bytes={start}-"} if start else {})  # noqa: S310
    reply = urllib.request.urlopen(request, timeout=TIMEOUT)  # noqa: S310
    return reply, start > 0 and getattr(reply, "status", None) == 206


def list_files(spark: SparkSession, listing_url: str, base_url: str, opener: Callable = open_url) -> DataFrame:
    """(path, size, url) of the entries of type `file` in a JSON listing: an array of objects with `type`, `path` and `size`. One listing is one reply, so the driver reads it."""
    reply, _ = opener(listing_url)
    with reply:
        entries = json.loads(reply.read())
    rows = [(e["path"], e.get("size"), f"{base_url.rstrip('/')}/{e['path']}") for e in entries if isinstance(e, dict) and e.get("type") == "file" and e.get("path")]
    return spark.createDataFrame(sorted(rows), _LISTED)


def fetch(files: DataFrame, folder: str, opener: Callable = open_url, tries: int = TRIES, wait_base: float = WAIT_BASE) -> DataFrame:
    """(path, status, bytes, message) of downloading (path, size, url) rows to `folder`, which all executors must share.

    A file already there with the listed size is skipped. A download goes to `<name>.part` and goes on from where it stopped; it is tried `tries` times, with waits of
    wait_base ** attempt seconds. A size other than the listed one is only reported. A path that would leave the folder fails, as does one that can't be had; the others go on.
    """

    def one(path: str, size: float | None, url: str) -> tuple[str, str, int, str]:
        target = os.path.normpath(os.path.join(folder, path))
        if not target.startswith(os.path.normpath(folder) + os.sep):
            return path, "failed", 0, "path leaves the folder"
        size = None if size is None or size != size else int(size)
        if os.path.exists(target) and (size is None or os.path.getsize(target) == size):
            return path, "skipped", os.path.getsize(target), ""
        os.makedirs(os.path.dirname(target), exist_ok=True)
        part, why = f"{target}.part", ""
        for attempt in range(1, tries + 1):
            try:
                start = os.path.getsize(part) if os.path.exists(part) else 0
                reply, resumed = opener(url, start)
                with reply, open(part, "ab" if resumed else "wb") as out:
                    while block := reply.read(CHUNK):
                        out.write(block)
                os.replace(part, target)
                got = os.path.getsize(target)
                return path, "fetched", got, "" if size in (None, got) else f"{got} bytes instead of {size}"
            except Exception as e:  # noqa: BLE001
                why = str(e) or type(e).__name__
                if attempt < tries:
                    time.sleep(wait_base**attempt)
        return path, "failed", 0, why

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame([one(*r) for r in p.itertuples(index=False)], columns=["path", "status", "bytes", "message"])

    return files.select("path", "size", "url").mapInPandas(run, "path string, status string, bytes long, message string")
