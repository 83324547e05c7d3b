"""Captured reviews as a Spark data source: ``spark.read.format("review_files")`` and ``readStream``.

One schema for every adapter, a partition a file, and for each why its reading stopped; completeness follows from that and from nothing else. What can't be
read is a row that says so, not an error. Options: ``path`` (a folder, by any scheme that pyarrow knows), ``adapter`` and, for captured
pages, ``pack`` (the JSON document of a selector pack).

A stream's offset is the change time and name of the last file it has taken, so files must arrive in order of their times.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "file string, document int, ordinal int, author_name string, rating string, text string, relative_date string, date string, advertised_total long, advertised_rating double, stop_reason string"
# Ratings as words, and the most reviews that place details hold.
WORDS = {"ONE": "1", "TWO": "2", "THREE": "3", "FOUR": "4", "FIVE": "5"}
MOST_PLACE = 5


@dataclass(frozen=True)
class Review:
    author_name: str | None = None
    rating: str | None = None
    text: str | None = None
    relative_date: str | None = None
    date: str | None = None


@dataclass(frozen=True)
class Harvest:
    """What one document holds."""

    reviews: list[Review]
    stop_reason: str
    total: int | None = None
    mean: float | None = None


def _text(x) -> str | None:
    return None if x is None else str(x)


def place(line: str) -> Harvest:
    """Place details: the first five reviews with a rating or a text, never all there are."""
    found = json.loads(line)["result"]
    rows = [r for r in (found.get("reviews") or [])[:MOST_PLACE] if r.get("rating") is not None or r.get("text") is not None]
    reviews = [Review(r.get("author_name"), _text(r.get("rating")), r.get("text"), r.get("relative_time_description")) for r in rows]
    return Harvest(reviews, "cap_reached", found.get("user_ratings_total"), found.get("rating"))


def profile(line: str) -> Harvest:
    """A page of a business profile; a page with a token for the next one isn't the last."""
    found = json.loads(line)
    reviews = [Review((r.get("reviewer") or {}).get("displayName"), WORDS.get(r.get("starRating")), r.get("comment"), None, r.get("createTime")) for r in found.get("reviews") or []]
    return Harvest(reviews, "budget_exceeded" if found.get("nextPageToken") else "exhausted", found.get("totalReviewCount"), found.get("averageRating"))


class Page:
    """A captured page, read by a pack."""

    def __init__(self, pack: str):
        from .extraction import _Reader, read_pack

        self.reader = _Reader(read_pack(json.loads(pack)))

    def __call__(self, html: str) -> Harvest:
        rows = self.reader.page(html)
        if rows[0][-1]:
            return Harvest([], "error")
        fields = [dict(r[1]) for r in rows]
        return Harvest([Review(f.get("author_name"), f.get("rating") or f.get("rating_numeric") or (None if r[3] is None else str(r[3])), f.get("text"), f.get("relative_date")) for f, r in zip(fields, rows, strict=True)], "target_reached")


#: By adapter: what reads a document, and whether each line is one (else the file is).
ADAPTERS = {"places": (lambda options: place, True), "profile": (lambda options: profile, True), "pages": (lambda options: Page(options["pack"]), False)}


class UnknownAdapter(ValueError):
    """ERR-CONFIG-INVALID: no such adapter."""


def _files(path: str) -> list[tuple[int, str]]:
    """(change time, path) of the folder's files, in order; hidden ones are left out."""
    from pyarrow import fs

    store, base = _store(path)
    found = store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    return sorted((int(f.mtime_ns or 0), f.path) for f in found if f.is_file and not f.base_name.startswith(("_", ".")))


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class File(InputPartition):
    path: str

    def __init__(self, path: str):
        self.path = path


class _Reading:
    def __init__(self, options: dict):
        self.options = options

    def read(self, partition: File) -> Iterator[tuple]:
        if partition is None:  # a folder without files
            return
        make, by_line = ADAPTERS[self.options["adapter"]]
        store, _ = _store(self.options["path"])
        parse = make(self.options)
        with store.open_input_stream(partition.path) as stream:
            documents = _lines(stream) if by_line else [stream.read().decode("utf-8", "replace")]
            for number, document in enumerate(documents):
                try:
                    harvest = parse(document)
                except (ValueError, KeyError, TypeError, AttributeError):
                    harvest = Harvest([], "error")
                tail = (harvest.total, None if harvest.mean is None else float(harvest.mean), harvest.stop_reason)
                for k, r in enumerate(harvest.reviews):
                    yield (partition.path, number, k, r.author_name, r.rating, r.text, r.relative_date, r.date, *tail)
                if not harvest.reviews:
                    yield (partition.path, number, None, None, None, None, None, None, *tail)


def _lines(stream) -> Iterator[str]:
    """A file's lines, a block at a time."""
    rest = b""
    while block := stream.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from (x.decode("utf-8", "replace") for x in whole if x.strip())
    if rest.strip():
        yield rest.decode("utf-8", "replace")


class _Batch(_Reading, DataSourceReader):
    def partitions(self) -> list[File]:
        return [File(p) for _, p in _files(self.options["path"])]


class _Stream(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"at": -1, "file": ""}

    def latestOffset(self) -> dict:
        files = _files(self.options["path"])
        return {"at": files[-1][0], "file": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[File]:
        return [File(p) for t, p in _files(self.options["path"]) if (start["at"], start["file"]) < (t, p) <= (end["at"], end["file"])]

    def commit(self, end: dict) -> None:
        pass


class ReviewFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "review_files"

    def schema(self) -> str:
        return SCHEMA

    def _checked(self) -> dict:
        options = dict(self.options)
        if options.get("adapter") not in ADAPTERS:
            raise UnknownAdapter(f"ERR-CONFIG-INVALID: adapter {options.get('adapter')!r} is none of {', '.join(ADAPTERS)}")
        return options

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self._checked())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self._checked())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ReviewFiles)
