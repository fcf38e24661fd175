"""Splittable scan of CSV whose quoted fields hold line breaks.

Spark reads such files (``multiLine``) as one task each.  Here a file is read by line, in as
many blocks as any text file:

1. The quotes of each block are counted.  In a file where every quote opens, closes or is
   doubled, their parity before a block tells whether the block begins inside a quoted field.
2. A second scan goes through the lines of each block with that parity known and joins the
   lines of a record.  The pieces of records that cross a border come from the blocks on both
   sides of it, and are put together by one small shuffle.
3. Each record is parsed by Spark's own CSV parser (``from_csv``), with the options of a plain scan.

What stands for a block on the driver is a number (its parity); a table of them goes to the
tasks, a few bytes for each block of ``spark.sql.files.maxPartitionBytes``.  Files with an odd
number of quotes break the rule of step 1; they are read whole, by one task each, as before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PIECES = "path string, record string, block long, part int, text string"
#: Parts of a record that crosses borders: its begin, whole blocks and its end.
_BEGIN, _WITHIN, _END = 0, 1, 2


def _lines(spark: SparkSession, path: str, file_glob: str | None, encoding: str) -> DataFrame:
    """(path, block, line): every line of every file, in order within its block."""
    read = spark.read.option("lineSep", "\n")
    if file_glob:
        read = read.option("pathGlobFilter", file_glob)
    line = F.col("value")
    if encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8", "US-ASCII"):
        line = F.decode(line.cast("binary"), encoding)
    return read.text(path).select(F.col("_metadata.file_path").alias("path"),
                                  F.col("_metadata.file_block_start").alias("block"), line.alias("line"))


def _quotes(quote: str):
    return F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))


Block = tuple[str, int]


class _Joiner:
    """Joins the lines of each block to records.

    ``inside`` are the blocks that begin within quotes, ``skip`` files that are left out; with ``only`` just
    the pieces of records that cross borders are given, of those blocks.
    """

    def __init__(self, quote: str, header: bool, inside: set[Block], skip: set[str], only: set[Block] | None = None):
        self.quote, self.header, self.inside, self.skip, self.only = quote, header, inside, skip, only

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: Block | None = None
        held: list[str] = []  # lines of the record that is open
        is_open = ended = False  # within quotes; a record has ended in this block
        for batch in batches:
            path, block = pc.dictionary_encode(batch.column("path")), np.asarray(batch.column("block"))
            of, line = np.asarray(path.indices), batch.column("line")
            odd = np.asarray(pc.count_substring(line, self.quote)) & 1
            edges = np.flatnonzero((of[1:] != of[:-1]) | (block[1:] != block[:-1])) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(of)], strict=True):
                if s == e:
                    continue
                here = path.dictionary[int(of[s])].as_py(), int(block[s])
                if here != at:
                    yield self._rest(at, held, ended)
                    at, held, is_open, ended = here, [], here in self.inside, False
                if at[0] in self.skip or self.only is not None and at not in self.only:
                    continue
                own, open_after = line.slice(s, e - s), (is_open + np.cumsum(odd[s:e])) & 1
                ends = np.flatnonzero(open_after == 0)
                begins = np.concatenate(([0], ends + 1))
                is_open, tail = bool(open_after[-1]), own.slice(int(begins[-1])).to_pylist()
                if not len(ends):
                    held += tail
                    continue
                # the first record of the run may go on from before; the others begin in it
                first = "\n".join(held + own.slice(0, int(ends[0]) + 1).to_pylist())
                if not ended and at in self.inside:
                    yield self._batch([(at[0], None, at[1], _END, first)])
                elif (ended or at[1] > 0 or not self.header) and self.only is None:
                    yield self._batch([(at[0], first, at[1], None, None)])
                held, ended = tail, True
                if self.only is None and len(ends) > 1:
                    yield self._records(at, own, begins[1:-1], ends[1:])
        yield self._rest(at, held, ended)

    def _records(self, at: Block, line: pa.Array, begins: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        alone = begins == ends
        records = line.take(pa.array(begins[alone]))
        more = ["\n".join(line.slice(s, e - s + 1).to_pylist())
                for s, e in zip(begins[~alone].tolist(), ends[~alone].tolist(), strict=True)]
        records = pa.concat_arrays([records, pa.array(more, type=records.type)])
        n = len(records)
        return pa.RecordBatch.from_arrays([pa.repeat(at[0], n), records, pa.repeat(at[1], n), pa.nulls(n, pa.int32()),
                                           pa.nulls(n, pa.string())], ["path", "record", "block", "part", "text"])

    def _rest(self, at: Block | None, held: list[str], ended: bool) -> pa.RecordBatch:
        """The block ends: its open record goes on in the next one."""
        if not held:
            return self._batch([])
        part = _BEGIN if ended or at not in self.inside else _WITHIN
        in_header = self.header and at[1] == 0 and not ended  # to be left out when it is whole
        return self._batch([(at[0], None, -1 if in_header else at[1], part, "\n".join(held))])

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        kinds = pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string()
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)],
                                          ["path", "record", "block", "part", "text"])


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", encoding: str = "UTF-8",
                    header: bool = False, quote: str = '"', file_glob: str | None = None,
                    corrupt_column: str | None = None, path_column: str = "_path") -> DataFrame:
    """The records of the files under ``path`` with the columns of ``schema`` and the file's path.

    Rows equal those of a ``multiLine`` scan in ``PERMISSIVE`` mode: short rows are padded with NULL, further
    fields ignored, blank lines skipped; ``corrupt_column`` keeps the text of such rows.  With ``header`` the first
    record of each file is skipped.
    """
    options = {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE", "multiLine": "true"}
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    lines = _lines(spark, path, file_glob, encoding)
    counts = lines.groupBy("path", "block").agg(F.sum(_quotes(quote)).alias("n"))
    order = Window.partitionBy("path").orderBy("block")  # of one row for each block
    odd = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1
    unbalanced = F.sum("n").over(Window.partitionBy("path")) % 2 == 1
    blocks = counts.select("path", "block", odd.alias("inside"), unbalanced.alias("whole")).withColumn(
        "goes_on", F.coalesce(F.lead("inside").over(order), F.lit(False)))
    special = blocks.where("inside or goes_on or whole").collect()  # a few bytes for each block
    whole = sorted({r["path"] for r in special if r["whole"]})
    inside = {(r["path"], r["block"]) for r in special if r["inside"]}
    records = lines.mapInArrow(_Joiner(quote, header, inside, set(whole)), _PIECES).where("record is not null").select(
        "path", "record")
    if inside:
        borders = {(r["path"], r["block"]) for r in special if not r["whole"]}
        crossing = lines.mapInArrow(_Joiner(quote, header, inside, set(whole), borders), _PIECES)
        # from a begin up to the next end, in the order of blocks; in a block the end of one comes before the begin of another
        begun = F.sum((F.col("part") == _BEGIN).cast("int")).over(Window.partitionBy("path").orderBy("block", F.desc("part")))
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "\n")
        stitched = crossing.withColumn("nth", begun).groupBy("path", "nth").agg(
            text.alias("record"), F.min("block").alias("block"))
        records = records.unionAll(stitched.where("block >= 0").select("path", "record"))
    ended = F.regexp_replace("record", r"\r$", "")
    parsed = records.where(F.length(ended) > 0).select(
        F.from_csv(ended, _ddl(schema), options).alias("r"),
        F.col("path").alias(path_column))
    out = parsed.select("r.*", path_column)
    if whole:
        out = out.unionByName(_read_whole(spark, whole, schema, options, encoding, header, path_column))
    return out


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _read_whole(spark: SparkSession, files: list[str], schema: T.StructType, options: dict[str, str], encoding: str,
                header: bool, path_column: str) -> DataFrame:
    from urllib.parse import unquote

    read = spark.read.schema(schema).options(**options).option("multiLine", "true").option("encoding", encoding)
    return read.option("header", str(header).lower()).option("enforceSchema", "true").csv(
        [unquote(f) for f in files]).select("*", F.col("_metadata.file_path").alias(path_column))
