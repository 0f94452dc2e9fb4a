"""CSV with quoted fields, read in parallel.

A quoted field may hold line breaks, so whether a line begins a record depends
on all lines before it. Spark's multi-line mode reads such a file in one task.
Here the file is read as lines, in as many tasks as it has splits:

1. A line is a step of a small automaton with two states, outside and inside a
   quoted field. A split's lines compose to one step, found without knowing
   where the split begins: the end for a start outside, and for one inside.
2. The steps of a file's splits, composed in order, tell each split's start.
   That is a row per split, as many as the driver plans anyway.
3. Each task puts its lines together to records. Where a record crosses the end
   of a split, its pieces are sent on, and only those are shuffled and joined.

A field is quoted if it begins with a quote; two quotes in it are one, and
quotes elsewhere are text. Line breaks in a field come back as a line feed.
Empty lines between records are left out. Lines without quotes, in splits that
begin outside, pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Whole quoted fields, and one that the line leaves open; what follows a closing quote belongs to the field.
_WHOLE = re.compile(r'(^|,)"(?:[^"]|"")*"(?!")')
_OPEN = re.compile(r'(?:^|,)"')
_CLOSING = re.compile(r'^(?:[^"]|"")*"(?!")')

_PLACE = ["file", "block"]
_PIECES = "file string, block long, kind string, record string"


def inside_after(line: str, inside: bool) -> bool:
    """Whether the end of ``line`` lies inside a quoted field, if its beginning does or doesn't."""
    if inside:
        closing = _CLOSING.match(line)
        if not closing:
            return True
        line = "x" + line[closing.end() :]  # the field goes on until the next comma
    if '"' not in line:
        return False
    return bool(_OPEN.search(_WHOLE.sub(r"\1", line)))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The lines of a batch by split, in order."""
    blocks, files = batch.column(1), batch.column(0)
    start, n = 0, batch.num_rows
    while start < n:
        place = (files[start].as_py(), blocks[start].as_py())
        same = pc.and_(pc.equal(blocks.slice(start), place[1]), pc.equal(files.slice(start), place[0]))
        end = pc.index(same, False).as_py()
        end = n if end < 0 else start + end
        yield place, batch.column(2).slice(start, end - start)
        start = end


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: the state after it for a start outside and for one inside."""
    steps: dict[tuple[str, int], list[bool]] = {}
    for batch in batches:
        for place, lines in _runs(batch):
            step = steps.setdefault(place, [False, True])
            for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
                step[:] = [inside_after(line, state) for state in step]
    rows = [(*place, *step) for place, step in steps.items()]
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.bool_(), pa.bool_()))]
    yield pa.RecordBatch.from_arrays(columns, [*_PLACE, "out", "inn"])


def starts_inside(spark: SparkSession, path: str) -> set[tuple[str, int]]:
    """The splits ``(file, first byte)`` that begin inside a quoted field."""
    steps = _lines(spark, path).mapInArrow(_steps, "file string, block long, out boolean, inn boolean").collect()  # a row per split
    found, state, last = set(), False, None
    for file, block, out, inn in sorted(steps):
        state = state if file == last else False
        if state:
            found.add((file, block))
        state, last = (inn if state else out), file
    return found


def _records(inside: set[tuple[str, int]]):
    """Whole records, and the pieces of those that cross the ends of splits: ``head`` (the rest of an earlier one),
    ``tail`` (the beginning of one) and ``middle`` (a split that lies inside one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, state, first = None, [], False, False

        def row(where: tuple[str, int], kind: str, records: pa.Array | list) -> pa.RecordBatch:
            records = records if isinstance(records, pa.Array) else pa.array(records, pa.string())
            n = len(records)
            columns = [pa.array([where[0]] * n, pa.string()), pa.array([where[1]] * n, pa.int64()), pa.array([kind] * n, pa.string()), records]
            return pa.RecordBatch.from_arrays(columns, [*_PLACE, "kind", "record"])

        def closed() -> Iterator[pa.RecordBatch]:
            if held:
                yield row(place, "middle" if first else "tail", ["\n".join(held)])

        for batch in batches:
            for where, lines in _runs(batch):
                if where != place:
                    yield from closed()
                    place, held, state = where, [], where in inside
                    first = state
                if not state and not pc.any(pc.match_substring(lines, '"')).as_py():
                    yield row(place, "whole", lines.filter(pc.greater(pc.utf8_length(lines), 0)))
                    continue
                whole, head = [], []
                for line in lines.to_pylist():
                    after = inside_after(line, state) if state or '"' in line else False
                    held.append(line)
                    state = after
                    if after:
                        continue
                    if first:
                        head.append("\n".join(held))
                    elif len(held) > 1 or held[0]:
                        whole.append("\n".join(held))
                    held, first = [], False
                if head:
                    yield row(place, "head", head)
                if whole:
                    yield row(place, "whole", whole)
        yield from closed()

    return run


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the records of CSV files (headers too), each as its text."""
    pieces = _lines(spark, path).mapInArrow(_records(starts_inside(spark, path)), _PIECES)
    whole = pieces.where("kind = 'whole'").select("record")
    # Two pieces a split at most.
    parts = pieces.where("kind <> 'whole'")
    order = Window.partitionBy("file").orderBy("block", F.expr("kind = 'tail'"))
    numbered = parts.withColumn("number", F.sum(F.expr("CAST(kind = 'tail' AS INT)")).over(order))
    joined = numbered.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", F.expr("kind = 'tail'").alias("t"), "record"))).alias("p"))
    return whole.unionAll(joined.select(F.array_join(F.col("p.record"), "\n").alias("record")))


def read_quoted_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The rows of CSV files with this header, every column as text; short rows are filled with nulls.

    Records that equal the header are taken for headers and left out.
    """
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    records = read_records(spark, path)
    parsed = records.select(F.from_csv(F.regexp_replace("record", "^\\x{FEFF}", ""), schema, options).alias("r"))
    header = F.lit(True)
    for c in columns:
        header = header & F.col("r")[c].eqNullSafe(c)
    return parsed.where(~header).select("r.*")
