"""CSV files of any size, read in parallel by blocks.

A quote toggles quoting wherever it stands, and a doubled one toggles twice, so whether a place is quoted is the parity of
the quotes before it. One scan gives each block's parity; a prefix over a file's blocks tells how each begins. A second scan cuts each block
into rows. What a block leaves open is put together with what the next ones hold of it; only a row that crosses blocks is ever gathered.
Blocks are Spark's own splits of text files (``spark.sql.files.maxPartitionBytes``), so there are as many as bytes over that size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..lineage import cut_lineage

#: Characters that are split into rows together.
CHUNK = 1 << 20


def split_rows(text: str) -> list[list[str]]:
    """Rows of fields: a quote toggles quoting anywhere, a doubled one inside is itself; LF, CR or CRLF end a row; blank rows go."""
    rows, row, field, quoted, i = [], [], [], False, 0
    text = text.removeprefix("﻿")
    while i < len(text):
        c = text[i]
        if quoted:
            if c == '"' and text[i + 1 : i + 2] == '"':
                field.append('"')
                i += 1
            elif c == '"':
                quoted = False
            else:
                field.append(c)
        elif c == '"':
            quoted = True
        elif c == ",":
            row.append("".join(field))
            field = []
        elif c in "\r\n":
            i += text[i : i + 2] == "\r\n"
            rows.append([*row, "".join(field)])
            row, field = [], []
        else:
            field.append(c)
        i += 1
    if field or row:
        rows.append([*row, "".join(field)])
    return [r for r in rows if any(x.strip() for x in r)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """Lines of a partition as they come, with their file and block; a block may come in several pieces."""
    for batch in batches:
        path, start, lines = (batch.column(c).to_pylist() for c in ("path", "start", "line"))
        a = 0
        for k in range(1, len(path) + 1):
            if k == len(path) or path[k] != path[a] or start[k] != start[a]:
                yield path[a], start[a], lines[a:k]
                a = k


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, lineSep="\n")
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _parities(lines: DataFrame) -> DataFrame:
    """By block, whether it holds an odd number of quotes (odd), and whether a row that it begins inside of ends in it (closes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[bool]] = {}
        for path, start, part in _blocks(batches):
            state = found.setdefault((path, start), [False, False])
            for line in part:
                state[0] ^= line.count('"') & 1 == 1
                state[1] |= state[0]
        if found:
            yield pa.RecordBatch.from_pydict({"path": [p for p, _ in found], "start": [s for _, s in found], "odd": [v[0] for v in found.values()], "closes": [v[1] for v in found.values()]})

    return lines.mapInArrow(run, "path string, start long, odd boolean, closes boolean")


def block_states(parities: DataFrame) -> DataFrame:
    """By block: whether it begins inside quotes (quoted) and in which block that row began (opener)."""
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = parities.withColumn("quoted", F.coalesce(F.sum(F.col("odd").cast("long")).over(before) % 2 == 1, F.lit(False)))
    opens = (F.col("quoted") != F.col("odd")) & (~F.col("quoted") | F.col("closes"))
    return states.withColumn("opener", F.last(F.when(opens, F.col("start")), ignorenulls=True).over(before)).select("path", "start", "quoted", F.when(F.col("quoted"), F.col("opener")).alias("opener"))


_ROWS = pa.schema([("path", pa.string()), ("start", pa.int64()), ("place", pa.int64()), ("fields", pa.list_(pa.string())), ("piece", pa.string()), ("block", pa.int64())])


def _cut(lines: DataFrame) -> DataFrame:
    """Rows that a block holds whole (place and fields), and pieces (place null) of those that cross blocks, under the block where they begin.

    lines has path, start, line, quoted and opener, in the order of the files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size, quoted, opener, place = None, [], 0, False, None, 0

        def whole() -> pa.RecordBatch:
            nonlocal place
            rows = split_rows("\n".join(held) if at[1] else "\n".join(held).removeprefix("﻿"))
            out = pa.RecordBatch.from_pydict({"path": [at[0]] * len(rows), "start": [at[1]] * len(rows), "place": list(range(place, place + len(rows))), "fields": rows, "piece": [None] * len(rows), "block": [at[1]] * len(rows)}, schema=_ROWS)
            place += len(rows)
            return out

        def piece(start: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [at[0]], "start": [start], "place": [None], "fields": [None], "piece": ["\n".join(held)], "block": [at[1]]}, schema=_ROWS)

        def end() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if not held:
                return
            if opener is not None:  # nothing that began before has ended here
                yield piece(opener)
                return
            if not quoted:
                yield whole()
                return
            last = held[keep:]
            held = held[:keep]
            if held:
                yield whole()
            held = last
            yield piece(at[1])

        keep = 0  # lines held that are whole rows
        for batch in batches:
            states = zip(*(batch.column(c).to_pylist() for c in ("path", "start", "line", "quoted", "opener")), strict=True)
            for path, start, line, begins, began in states:
                if at != (path, start):
                    if at is not None:
                        yield from end()
                    at, held, size, quoted, opener, place, keep = (path, start), [], 0, begins, began if begins else None, 0, 0
                held.append(line)
                size += len(line)
                quoted ^= line.count('"') & 1 == 1
                if not quoted:
                    if opener is not None:
                        yield piece(opener)
                        held, size, opener, keep = [], 0, None, 0
                        continue
                    keep = len(held)
                    if size >= CHUNK:
                        yield whole()
                        held, size, keep = [], 0, 0
        if at is not None:
            yield from end()

    return lines.mapInArrow(run, "path string, start long, place long, fields array<string>, piece string, block long")


def _joined(pieces: DataFrame) -> DataFrame:
    """The rows that cross blocks, from their pieces in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, parts in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "parts")), strict=True):
                rows = split_rows("\n".join(p["piece"] for p in parts))
                yield pa.RecordBatch.from_pydict({"path": [path] * len(rows), "start": [start] * len(rows), "place": list(range(len(rows))), "fields": rows}, schema=pa.schema(list(_ROWS)[:4]))

    whole = pieces.groupBy("path", "start").agg(F.array_sort(F.collect_list(F.struct("block", "piece"))).alias("parts"))
    return whole.mapInArrow(run, "path string, start long, place long, fields array<string>")


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, fields): the rows of every file, numbered from 1 in each; blank rows are left out and not counted.

    As split_rows on the whole file, but that a line feed at the very end of a file whose last quote is never closed is no part of its last field.
    """
    lines = _lines(spark, path)
    states = cut_lineage(block_states(_parities(lines)))
    # A row a block; joined on the map side, so that lines stay in order.
    marked = lines.join(F.broadcast(states), ["path", "start"])
    cut = cut_lineage(_cut(marked.select("path", "start", "line", "quoted", "opener")))
    whole = cut.where("place IS NOT NULL").select("path", "start", F.lit(0).alias("late"), "place", "fields")
    late = _joined(cut.where("place IS NULL")).select("path", "start", F.lit(1).alias("late"), "place", "fields")
    rows = whole.unionByName(late)
    counts = rows.groupBy("path", "start").agg(F.count_if(F.col("late") == 0).alias("own"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.join(counts.select("path", "start", "own", before.alias("before")), ["path", "start"])
    return placed.select("path", (F.col("before") + F.col("place") + 1 + F.when(F.col("late") == 1, F.col("own")).otherwise(0)).alias("line"), "fields")
