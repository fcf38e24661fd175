"""Unpacking landed ZIP archives on the executors.

One archive per row (the ``binaryFile`` source: ``path``, ``content``); a
``mapInPandas`` task opens it, checks every member's CRC, skips directory
entries and emits the member's text lines in bounded batches.  A corrupt or
truncated archive becomes one failed row, never an exception.  ``binaryFile``
holds an archive in one row, so archives above ~2 GB must be split upstream.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

OUT_SCHEMA = "archive string, member string, line_no long, line string, ok boolean, error string"
BATCH = 20_000


def _rows(path: str, content: bytes, encoding: str, base_names: bool) -> Iterator[dict]:
    try:
        zf = zipfile.ZipFile(io.BytesIO(content))
        broken = zf.testzip()
        if broken is not None:
            raise zipfile.BadZipFile(f"CRC mismatch in {broken}")
    except Exception as e:  # noqa: BLE001 - a bad archive is data, not a crash
        yield {"archive": path, "member": None, "line_no": None, "line": None, "ok": False,
               "error": f"{type(e).__name__}: {e}"}
        return
    for info in zf.infolist():
        if info.is_dir():
            continue
        member = posixpath.basename(info.filename) if base_names else info.filename
        with zf.open(info) as fh:
            text = io.TextIOWrapper(fh, encoding=encoding, newline="")
            for i, line in enumerate(text):
                yield {"archive": path, "member": member, "line_no": i, "line": line.rstrip("\r\n"), "ok": True,
                       "error": None}


def _unpack_batches(encoding: str, base_names: bool):
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                buf = []
                for row in _rows(path, bytes(content), encoding, base_names):
                    buf.append(row)
                    if len(buf) >= BATCH:
                        yield pd.DataFrame(buf)
                        buf = []
                if buf:
                    yield pd.DataFrame(buf)
    return fn


def unpack(archives: DataFrame, encoding: str = "ISO-8859-1", base_names: bool = False) -> DataFrame:
    """S10 on a frame of (path, content) rows."""
    return archives.select("path", "content").mapInPandas(_unpack_batches(encoding, base_names), OUT_SCHEMA)


def read_archives(spark: SparkSession, glob: str, encoding: str = "ISO-8859-1", base_names: bool = False) -> DataFrame:
    """Every ``*.zip`` matched by ``glob``, unpacked to lines (one archive per task row)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(glob)
    return unpack(files, encoding, base_names)


def pack(files: DataFrame, archive_name: str = "path", encoding: str = "ISO-8859-1") -> DataFrame:
    """Build one ZIP per input file row (path, content) -> (path, content); used to
    land archives from data Spark produced (each task zips its own rows)."""
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
                    zf.writestr("dados/", b"")
                    zf.writestr("dados/" + posixpath.basename(path), bytes(content))
                out.append({"path": path + ".zip", "content": buf.getvalue()})
            yield pd.DataFrame(out)
    return files.select("path", "content").mapInPandas(fn, "path string, content binary")
