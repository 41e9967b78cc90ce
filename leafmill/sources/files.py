"""Files in: PDFs as binary rows and as pages, whole text files, tables. Streams of the same."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.schemas import PAGE_INPUT
from leafmill.sources.pdf import Page, Pdf

BINARY = "path string, modificationTime timestamp, length long, content binary"
# The fields of a document's information.
INFO = ("title", "author", "subject", "keywords", "creator", "producer", "creationDate", "modDate")


def pdf_files(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """The PDFs of a folder and those below it, by path, part by part; a missing folder has none."""
    if stream:
        return _pdfs(spark.readStream.schema(BINARY)).load(folder)
    try:
        return _pdfs(spark.read).load(folder).orderBy(F.split("path", "/"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], BINARY)


def _pdfs(reader):
    return reader.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf")


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.text(f"{folder}/*.txt", wholetext=True).select(F.col("_metadata.file_name").alias("filename"), F.col("value").alias("content"))


def text_path(path: Column) -> Column:
    """Where the text of a file goes: its name without folders and with `.txt` in place of its last extension."""
    return F.concat(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", ""), F.lit(".txt"))


def table(spark: SparkSession, folder: str, name: str, status: str | None = None) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.where(F.col("status") == status) if status else df


def _by_library(content: bytes) -> list[tuple[Page, list, str | None]] | None:
    try:
        import pdfplumber
    except ImportError:
        return None
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        return [(Page(p.extract_text() or "", float(p.width), [(float(c["x0"]), float(c["size"])) for c in p.chars], len(p.images)), p.extract_tables(), None) for p in pdf.pages]


def pdf_pages(files: DataFrame, ocr: Callable[[bytes, int], str] | None = None) -> DataFrame:
    """The columns of PAGE_INPUT and `error`, a row a page of (path, content) rows.

    Pages are read by the optional PDF library where it is installed, with their tables; else by the reader of `sources.pdf`, which finds none. `ocr`, called with
    a file's bytes and a page's number where a page has no text layer, gives its text; where it fails, that is empty. A file that can't be read is one row with the error, so one bad file never fails the rest.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in _FIELDS]
        for p in parts:
            rows: list[tuple] = []
            for path, content in p.itertuples(index=False):
                try:
                    pages = _by_library(content) or [(page, [], None) for page in Pdf(content).pages()]
                except Exception as e:  # noqa: BLE001
                    rows.append((path, None, None, None, None, None, None, None, str(e) or type(e).__name__))
                    continue
                for i, (page, tables, _) in enumerate(pages, 1):
                    read = None
                    if ocr and not page.text.strip():
                        try:
                            read = ocr(content, i)
                        except Exception:  # noqa: BLE001
                            read = ""
                    rows.append((path, i, page.text, read, page.width, [{"x0": x, "size": s} for x, s in page.chars], tables, page.images, None))
            yield pd.DataFrame(rows, columns=names).astype({"page_number": "Int32", "n_images": "Int32"})

    return files.select("path", "content").mapInPandas(run, f"{PAGE_INPUT}, error string")


_FIELDS = ("doc_path", "page_number", "text", "ocr_text", "page_width", "chars", "tables", "n_images", "error")


def pdf_metadata(files: DataFrame) -> DataFrame:
    """(path, title, author, subject, keywords, creator, producer, creationDate, modDate, pages, bytes, encrypted, error) of (path, content) rows; where a file can't be read, blanks, no pages, its size and the error."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = []
            for path, content in p.itertuples(index=False):
                blanks = {k: "" for k in INFO} | {"path": path, "pages": 0, "bytes": len(content or b""), "encrypted": False, "error": None}
                try:
                    pdf = Pdf(content)
                    said = {k[:1].lower() + k[1:]: v for k, v in pdf.info().items()}
                    rows.append(blanks | {k: said[k] for k in INFO if k in said} | {"pages": len(pdf.page_objects()), "encrypted": pdf.encrypted})
                except Exception as e:  # noqa: BLE001
                    rows.append(blanks | {"error": str(e) or type(e).__name__})
            yield pd.DataFrame(rows, columns=["path", *INFO, "pages", "bytes", "encrypted", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, " + ", ".join(f"{k} string" for k in INFO) + ", pages int, bytes long, encrypted boolean, error string")
