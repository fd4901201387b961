"""JSON Lines by position (S1, S2, S4): a sparse index of byte ranges.

``build_index`` reads a corpus once and keeps, for every ``EVERY`` lines, the file, the byte
range and the position of the first line.  Positions count the lines that are not blank, in the
order of files and of lines in them.  Then

* ``read_indexed`` reads all ranges, which begin and end with a line, and numbers lines while
  it reads them: nothing is counted again and nothing is shuffled but the index;
* ``fetch`` opens only the files and ranges that hold the wanted positions.

Lines end with ``\\n``; a last line may lack it.  The index is a table, so it may be as large as
it likes; a task holds one range at a time.  Ranges are read with pyarrow's file systems (local
folders, HDFS, object stores); files that compress lines cannot be cut and are not indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from samplewright.sources.readers import CORRUPT

#: Lines of a range.
EVERY = 1024
#: Positions of a cell, by which wanted positions meet the ranges that hold them.
CELL = 4096
#: Bytes that a task reads.
TASK_BYTES = 64 << 20
INDEX = "first bigint, n_lines bigint, file string, start bigint, n_bytes bigint"
_BLANK = b" \t\r"


def _ranges(every: int):
    """Task function: ranges (file, block, place in the block, lines, bytes) of splits read in order."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, place, lines, size = None, 0, 0, 0
        for batch in parts:
            files, block = batch.column(0).dictionary_encode(), batch.column(1).to_numpy(zero_copy_only=False)
            code, names = files.indices.to_numpy(zero_copy_only=False), files.dictionary.to_pylist()
            n, counts = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            turn = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1
            out = []
            for a, b in zip([0, *turn.tolist()], [*turn.tolist(), len(batch)]):
                split = (names[code[a]], int(block[a]))
                if split != here:
                    if here and size:
                        out.append((*here, place, lines, size))
                    here, place, lines, size = split, 0, 0, 0
                while a < b:
                    seen = np.cumsum(counts[a:b])
                    stop = min(a + int(np.searchsorted(seen, every - lines)) + 1, b)
                    lines, size = lines + int(counts[a:stop].sum()), size + int(n[a:stop].sum())
                    a = stop
                    if lines >= every:
                        out.append((*here, place, lines, size))
                        place, lines, size = place + 1, 0, 0
            if out:
                yield _index_batch(out)
        if here and size:
            yield _index_batch([(*here, place, lines, size)])
    return run


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["file", "block", "place", "n_lines", "n_bytes"])


def build_index(spark: SparkSession, path: str, index_path: str, every: int = EVERY) -> DataFrame:
    """The index of the lines under ``path``, written to ``index_path`` in order of position.

    Only lengths reach Python.  A split's first line begins where the lines of the splits before
    it in its file end, so offsets are sums over splits, in two levels, and inside a split.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    has = F.length(F.trim(F.col("value"), F.lit(" \t\r"))) > 0
    sized = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        (F.octet_length("value") + 1).cast("bigint").alias("n_bytes"), has.cast("bigint").alias("n_lines"))
    ranges = sized.mapInArrow(_ranges(every), "file string, block bigint, place bigint, n_lines bigint, n_bytes bigint")
    draft = f"{index_path.rstrip('/')}-draft"
    ranges.write.parquet(draft)
    ranges = spark.read.schema(ranges.schema).parquet(draft)

    def before(column: str, *keys: str, order: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(w), F.lit(0))

    splits = ranges.groupBy("file", "block").agg(F.sum("n_lines").alias("l"), F.sum("n_bytes").alias("b"))
    files = splits.groupBy("file").agg(F.sum("l").alias("l")).select("file", before("l", order="file").alias("file_first"))  # a row for each file
    splits = splits.select("file", "block", before("l", "file", order="block").alias("split_first"), before("b", "file", order="block").alias("split_start"))
    inside = ranges.select("file", "block", "n_lines", "n_bytes", before("n_lines", "file", "block", order="place").alias("l"),
                           before("n_bytes", "file", "block", order="place").alias("b"))
    index = inside.join(splits, ["file", "block"]).join(files, "file").select(
        (F.col("file_first") + F.col("split_first") + F.col("l")).alias("first"), "n_lines", "file",
        (F.col("split_start") + F.col("b")).alias("start"), "n_bytes")
    index.repartitionByRange("first").sortWithinPartitions("first").write.parquet(index_path)
    return spark.read.schema(INDEX).parquet(index_path)


class _Files:
    """Opens a file once for ranges that follow each other."""

    def __init__(self):
        self.name, self.file = None, None

    def lines(self, name: str, start: int, size: int) -> list[bytes]:
        """The lines of a byte range that are not blank."""
        if name != self.name:
            fs, path = pafs.FileSystem.from_uri(name)
            self.name, self.file = name, fs.open_input_file(path)
        raw = self.file.read_at(size, start)
        return [line for line in raw.split(b"\n") if line.strip(_BLANK)]


def _read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files = _Files()
    for batch in parts:
        for r in batch.to_pylist():
            lines = files.lines(r["file"], r["start"], r["n_bytes"])
            if len(lines) != r["n_lines"]:
                raise ValueError(f"{r['file']} has changed since it was indexed")
            if r["wanted"] is None:
                places = np.arange(len(lines))
            else:
                places = np.unique(np.array(r["wanted"], np.int64)) - r["first"]
                lines = [lines[i] for i in places.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(places + r["first"]), pa.array(lines, pa.binary()).cast(pa.string())], ["position", "value"])


LINES = "position bigint, value string"


def read_indexed(index: DataFrame) -> DataFrame:
    """``position, value`` of every line, each task a run of consecutive ranges of about ``TASK_BYTES``."""
    total = index.agg(F.sum("n_bytes")).first()[0] or 0
    rows = index.withColumn("wanted", F.lit(None).cast("array<bigint>"))
    return rows.repartitionByRange(-(-total // TASK_BYTES) or 1, "first").sortWithinPartitions("first").mapInArrow(_read, LINES)


def wanted_ranges(index: DataFrame, positions: DataFrame, position_col: str = "position") -> DataFrame:
    """The ranges that hold ``positions``, with those in each (``wanted``); positions outside the corpus have none."""
    cells = index.filter("n_lines > 0").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("first") / CELL), F.floor((F.col("first") + F.col("n_lines") - 1) / CELL))))
    asked = positions.select(F.col(position_col).cast("bigint").alias("p")).filter("p >= 0").distinct()
    met = asked.withColumn("cell", F.floor(F.col("p") / CELL)).join(cells, "cell").filter("p >= first and p < first + n_lines")
    return met.groupBy("first", "n_lines", "file", "start", "n_bytes").agg(F.collect_list("p").alias("wanted"))  # a range's lines at most


def fetch(index: DataFrame, positions: DataFrame, position_col: str = "position") -> DataFrame:
    """``position, value`` of the wanted lines, one row a position; no other range is opened."""
    return wanted_ranges(index, positions, position_col).mapInArrow(_read, LINES)


def parsed(lines: DataFrame, schema: str, id_col: str) -> DataFrame:
    """The lines as JSON of ``schema`` by position; a bad line keeps its text in ``_corrupt_record``."""
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    row = F.from_json("value", f"{schema}, {CORRUPT} string", how)
    return lines.select(F.col("position").alias(id_col), row.alias("r")).select(id_col, "r.*")
