"""Files made by this library: bytes on the session's file system, and workbooks."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Mapping, Sequence
from xml.sax.saxutils import escape

from pyspark.sql import SparkSession

_XML = "http://schemas.openxmlformats.org"


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share; on one machine without one, below a temporary folder."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not shared:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='statlas-')}"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def put(spark: SparkSession, path: str, content: bytes | str) -> str:
    """Write a small file; returns its path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(content.encode() if isinstance(content, str) else content))
    finally:
        out.close()
    return path


def column_name(n: int) -> str:
    """0 -> A, 26 -> AA."""
    out = ""
    n += 1
    while n:
        n, rest = divmod(n - 1, 26)
        out = chr(65 + rest) + out
    return out


def workbook(sheets: Mapping[str, Sequence[Sequence[object]]]) -> bytes:
    """A workbook of sheets, each a list of rows; None is an empty cell, text goes to the shared strings."""
    shared: dict[str, int] = {}
    made = io.BytesIO()
    parts, links = [], []
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as book:
        for i, (name, rows) in enumerate(sheets.items(), 1):
            xml = []
            for r, row in enumerate(rows, 1):
                cells = []
                for c, v in enumerate(row):
                    at = f"{column_name(c)}{r}"
                    if isinstance(v, str):
                        cells.append(f'<c r="{at}" t="s"><v>{shared.setdefault(v, len(shared))}</v></c>')
                    elif v is not None:
                        cells.append(f'<c r="{at}"><v>{v}</v></c>')
                xml.append(f'<row r="{r}">{"".join(cells)}</row>')
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{_XML}/spreadsheetml/2006/main"><sheetData>{"".join(xml)}</sheetData></worksheet>')
            parts.append(f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>')
            links.append(f'<Relationship Id="rId{i}" Type="{_XML}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>')
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_XML}/spreadsheetml/2006/main" xmlns:r="{_XML}/officeDocument/2006/relationships"><sheets>{"".join(parts)}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_XML}/package/2006/relationships">{"".join(links)}</Relationships>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_XML}/spreadsheetml/2006/main">{"".join(f"<si><t>{escape(s)}</t></si>" for s in shared)}</sst>')
    return made.getvalue()
