"""Sources: PDF discovery, inventories of files, page sources and JSON files."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.functions import text as T
from pagewright.operators import routing
from pagewright.operators.ops import is_status_payload
from pagewright.sources import pdf

FILE = "path string, modificationTime timestamp, length long"


def discover_pdfs(spark: SparkSession, roots: list[str], content: bool = False) -> DataFrame:
    """PDF files below the roots, one for each path without case (the last), in the order of their paths; content only if asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]").load(roots)
    columns = ["path", "modificationTime", "length"] + ["content"] * content
    last = Window.partitionBy(F.lower("path")).orderBy(F.desc("path"))
    return files.select(*columns).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n").orderBy(F.lower("path"))


@dataclass(frozen=True)
class Walk:
    """Files below a root with one of the extensions, by path without case, and how many others were passed over."""

    paths: list[str]
    ignored: int
    symlinks: int


def walk(spark: SparkSession, root: str, extensions: list[str], excluded: str | None = None) -> Walk:
    """Lists files without following links; what lies at or below ``excluded`` (a run's own output) is not looked at. Names only: the files are read by tasks."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(conf)
    wanted = tuple("." + e.strip().lstrip(".").lower() for e in extensions)
    skipped = None if excluded is None else fs.makeQualified(jvm.org.apache.hadoop.fs.Path(excluded)).toString()
    link = jvm.java.nio.file.Files.isSymbolicLink
    found, ignored, links, todo = [], 0, 0, [fs.makeQualified(top)]
    while todo:
        for status in fs.listStatus(todo.pop()):
            path = status.getPath()
            name = path.toString()
            uri = path.toUri()
            if skipped is not None and (name == skipped or name.startswith(skipped + "/")):
                continue
            if status.isSymlink() or uri.getScheme() == "file" and link(jvm.java.nio.file.Path.of(jvm.java.net.URI(uri.toString()))):
                links += 1
            elif status.isDirectory():
                todo.append(path)
            elif name.lower().endswith(wanted):
                found.append(name)
            else:
                ignored += 1
    return Walk(sorted(found, key=lambda x: (x.casefold(), x)), ignored, links)


def inventory(spark: SparkSession, root: str, extensions: list[str], count_pages: Callable[[bytes], int | None] | None = pdf.page_count) -> DataFrame:
    """One row per file with one of the extensions: relative path, size, SHA-256, page count and how it was found, and whether it changed between listing and reading.

    Page errors are data; without ``count_pages`` pages are not counted.
    """
    wanted = [("." + e.strip().lstrip(".")).lower() for e in extensions]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    files = files.withColumn("extension", F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))).where(F.col("extension").isin(*wanted))
    relative = F.regexp_replace("path", "^.*?" + re.escape(root.rstrip("/")) + "/", "")
    changed = (F.octet_length("content") != F.col("length")).alias("changed_during_read")
    out = files.select(relative.alias("relative_path"), "extension", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"), changed, F.sha2("content", 256).alias("sha256"), "content")
    if count_pages is None:
        out = out.withColumns({"page_count": F.lit(None).cast("int"), "page_count_method": F.lit("unavailable")})
    else:

        @F.pandas_udf("struct<page_count:int,page_count_method:string>")
        def pages(content: pd.Series) -> pd.DataFrame:
            def one(raw):
                try:
                    return count_pages(bytes(raw)), "parser"
                except Exception as e:  # noqa: BLE001  an unreadable file is a finding, not a failure of the run
                    return None, f"error: {e}"

            return pd.DataFrame([one(x) for x in content], columns=["page_count", "page_count_method"])

        out = out.withColumn("p", pages("content")).select("*", "p.*").drop("p")
    out = out.withColumn("document_id", F.sha2(F.concat("relative_path", F.lit("\0"), F.coalesce("sha256", F.col("size_bytes").cast("string"))), 256))
    return out.drop("content").orderBy(F.lower("relative_path"))


PAGE = (
    "document_id string, page_number int, native_text string, "
    "native_blocks array<struct<text:string,bbox:struct<x0:double,y0:double,x1:double,y1:double,coordinate_space:string>,element_type:string,metadata:map<string,string>>>, "
    "image binary, width double, height double, image_coverage double, table_count int, is_multi_column boolean, "
    "inventory struct<complete:boolean,drawing_count:int,embedded_image_count:int,annotation_count:int,link_count:int>"
)


PAGE_ROW = f"{PAGE}, source_path string, error string"


#: Bytes of pages, about, that are handed on at once.
FRAME = 1 << 20


def read_pages(files: DataFrame, parser: Callable[[bytes], Iterator[dict]] = pdf.pages) -> DataFrame:
    """Pages of files (``content``, and ``path`` where there is one) by a parser that yields a dict per page with the fields of ``PAGE``; the document's id is its content's.

    ``source_path`` and ``error`` follow. A parser that fails is a row with ``error`` and no page number, after the pages that it gave.
    """
    columns = _fields(PAGE_ROW)

    def parsed(raw: bytes) -> Iterator[dict]:
        try:
            yield from parser(raw)
        except Exception as e:  # noqa: BLE001  a file that cannot be read is a finding
            yield {"error": f"{type(e).__name__}: {e}"}

    def parse(frames):
        # Pages of many small files make one frame, as a frame costs more than a page; one of a large file is handed on before the next are read.
        rows: list[list] = []
        held = 0
        for frame in frames:
            for doc, path, raw in zip(frame["document_id"], frame["path"], frame["content"], strict=True):
                for page in parsed(bytes(raw)):
                    rows.append([({"document_id": doc, "source_path": path} | page).get(c) for c in columns])
                    held += 4096 + len(page.get("native_text") or "") + len(page.get("image") or b"")
                    if held > FRAME:
                        yield pd.DataFrame(rows, columns=columns, dtype=object)
                        rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns, dtype=object)

    path = F.col("path") if "path" in files.columns else F.lit(None).cast("string")
    named = files.select(F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("document_id"), path.alias("path"), "content")
    return named.mapInPandas(parse, PAGE_ROW)


def pdf_pages(spark: SparkSession, root: str, bytes_per_task: int = 16 << 20) -> DataFrame:
    """Pages of the PDF files below a root, with their layout (``routing.layout``); what could not be read is a row with ``error``.

    Files are opened in the tasks, several of which share a long file. For stores that only Spark reads, ``read_pages(discover_pdfs(spark, [root], content=True))`` has the same rows.
    """
    spark.dataSource.register(pdf.PdfPages)
    return routing.layout(spark.read.format("pdf_pages").option("bytesPerTask", bytes_per_task).load(root))


def _fields(ddl: str) -> list[str]:
    from pyspark.sql import types

    return [f.name for f in types._parse_datatype_string(ddl)]


def read_json(spark: SparkSession, path: str, schema: str, lines: bool = True) -> DataFrame:
    """JSON of a fixed schema; what does not fit is kept in ``_corrupt_record``."""
    full = f"{schema}, _corrupt_record string"
    return spark.read.schema(full).option("multiLine", str(not lines).lower()).option("mode", "PERMISSIVE").json(path)


def read_status_files(spark: SparkSession, root: str, limit: int) -> tuple[DataFrame, bool]:
    """Status files by path, at most ``limit`` of them, with ``is_status`` (see ``ops.is_status_payload``), and whether there were more. Links are not followed."""
    paths = walk(spark, root, ["json"]).paths
    if not paths[:limit]:
        return spark.createDataFrame([], "path string, payload string, is_status boolean"), bool(paths)
    files = spark.read.option("wholetext", "true").text(paths[:limit]).select(F.input_file_name().alias("path"), F.col("value").alias("payload"))
    return files.withColumn("is_status", is_status_payload(F.col("payload"), F.col("path"))), len(paths) > limit


def contents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents whose text stands for a file's content, with a content-derived id."""
    return docs.withColumn("document_id", F.concat(F.lit("sha256:"), F.sha2(F.coalesce(T._col(text_col), F.lit("")), 256)))
