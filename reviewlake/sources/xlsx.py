"""A spreadsheet reader without other packages: zip and XML, one file a task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _opened(content: bytes):
    import io

    return io.BytesIO(bytes(content))


def rows_of(content: bytes, sheet: str | None = None):
    """The rows of a sheet (the first by default) as lists of texts; missing cells are None."""
    import io
    import posixpath
    import zipfile
    from xml.etree import ElementTree as ET

    book = zipfile.ZipFile(io.BytesIO(content))
    names = book.namelist()
    shared = []
    if "xl/sharedStrings.xml" in names:
        shared = ["".join(t.text or "" for t in x.iter(f"{SPACE}t")) for x in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{SPACE}si")]
    sheets = [(x.get("name"), x.get(LINK)) for x in ET.fromstring(book.read("xl/workbook.xml")).iter(f"{SPACE}sheet")]
    targets = {x.get("Id"): x.get("Target") for x in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    wanted = next((r for n, r in sheets if sheet is None or n == sheet), None)
    if wanted is None:
        return
    target = targets[wanted]
    path = target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
    for row in ET.fromstring(book.read(path)).iter(f"{SPACE}row"):
        out: list = []
        for cell in row.iter(f"{SPACE}c"):
            at = _column(cell.get("r", "")) if cell.get("r") else len(out)
            out.extend([None] * (at + 1 - len(out)))
            if cell.get("t") == "inlineStr":
                out[at] = "".join(t.text or "" for t in cell.iter(f"{SPACE}t"))
                continue
            value = cell.find(f"{SPACE}v")
            if value is not None and value.text is not None:
                out[at] = shared[int(value.text)] if cell.get("t") == "s" else value.text
        yield out


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None, pattern: str | None = None, skip_unreadable: bool = False) -> DataFrame:
    """All cells as strings, under the header of the first file's first row; files are read by the executors.

    With a pattern all matching files below the folder are read; unreadable ones can be skipped.
    """
    import zipfile

    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    files = reader.load(path)
    # Names alone are sorted; one file's content comes to the driver, for its header.
    first = None
    for row in files.select("path").orderBy("path").toLocalIterator():
        found = spark.read.format("binaryFile").load(row["path"]).select("content").first()
        if not skip_unreadable or zipfile.is_zipfile(_opened(found["content"])):
            first = found
            break
    if first is None:
        raise ValueError(f"no readable workbook in {path}")
    header = [str(c) if c is not None else f"Unnamed: {i}" for i, c in enumerate(next(iter(rows_of(bytes(first["content"]), sheet)), []))]

    def run(batches):
        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                if skip_unreadable and not zipfile.is_zipfile(_opened(content)):
                    continue
                rows = rows_of(content, sheet)
                own = [str(c) if c is not None else f"Unnamed: {i}" for i, c in enumerate(next(rows, []))]
                at = {h: own.index(h) for h in header if h in own}
                out = [[r[at[h]] if h in at and at[h] < len(r) else None for h in header] for r in rows]
                frame = pd.DataFrame(out, columns=[f"c{i}" for i in range(len(header))], dtype=object)
                frame["source_file"] = name.rsplit("/", 1)[-1]
                frame["row_idx"] = range(len(frame))
                yield frame

    schema = ", ".join([*(f"c{i} string" for i in range(len(header))), "source_file string", "row_idx long"])
    df = files.select("path", "content").mapInPandas(run, schema)
    return df.select(*[F.col(f"c{i}").alias(h) for i, h in enumerate(header)], "source_file", "row_idx")
