"""Landed fetches as a data source of their own: `spark.read.format("landed_pages")`.

What a fetcher left lies in one folder a source (`source_id=<id>`) as JSON lines of url, status, body and fetched_at. A source's
URLs are tried in order: the first one with a good fetch that is long enough for its kind is its page, and of several good
fetches of a URL the latest. Every source has one row: `present` with its page, `unreadable` where something landed but no
page reads, `absent` where nothing did. A line that is no JSON object costs only itself.

Sources are read where they lie, one partition each up to `partitions` and dealt evenly beyond, so a broken source fails nobody else's read.
The list of sources (JSON lines of source_id, wire and urls) is small and read when the scan is planned.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyboard.sources.folders import by_source, files_of, lines_of
from tallyboard.sources.landing import LEAST_HTML


def _record(line: bytes) -> dict | None:
    try:
        found = json.loads(line)
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def _time(text) -> datetime | None:
    try:
        return datetime.fromisoformat(text)
    except (TypeError, ValueError):
        return None


class _Share(InputPartition):
    def __init__(self, sources: list[tuple[str, str | None, list[str], str | None]]):
        super().__init__(None)
        self.sources = sources


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.listed, self.most = options["path"], options["sources"], int(options.get("partitions", 512))

    def partitions(self) -> list[_Share]:
        folders = by_source(*files_of(self.path))
        sources = [r for r in map(_record, lines_of(*files_of(self.listed))) if r and r.get("source_id") is not None]
        rows = [(str(r["source_id"]), r.get("wire"), [u for u in r.get("urls") or [] if u], folders.get(str(r["source_id"]))) for r in sources]
        n = max(1, min(self.most, len(rows)))
        return [_Share(rows[k::n]) for k in range(n)]

    def read(self, partition: _Share) -> Iterator[tuple]:
        files, _ = files_of(self.path)
        for source_id, wire, urls, folder in partition.sources:
            if folder is None:
                yield source_id, "absent", None, None, None, None
                continue
            best, place = None, {u: k for k, u in reversed(list(enumerate(urls)))}
            for r in map(_record, lines_of(files, folder)):
                body, status = (r or {}).get("body"), (r or {}).get("status")
                if not r or r.get("url") not in place or not isinstance(body, str) or not isinstance(status, int) or not 200 <= status < 300 or (wire != "json" and len(body) < LEAST_HTML):
                    continue
                at = _time(r.get("fetched_at"))
                rank = (-place[r["url"]], at.timestamp() if at else float("-inf"), body)
                if best is None or rank > best[0]:
                    best = rank, r["url"], body, at
            yield (source_id, "present", -best[0][0], best[1], best[2], best[3]) if best else (source_id, "unreadable", None, None, None, None)


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "source_id string, state string, place int, url string, body string, fetched_at timestamp"

    def reader(self, schema) -> _Reader:
        for name in ("path", "sources"):
            if name not in self.options:
                raise ValueError(f"landed_pages needs the option {name}")
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LandedPages)
