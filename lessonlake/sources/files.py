"""Reading files as tables: listings, texts, JSON and YAML documents, PDF pages through an optional adapter.

Schemas are always given, never inferred. A folder that does not exist is an empty table where the callers
tolerate that, and an error where they must not.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as X

LISTING = "name string, path string, size bigint"
WAIVERS = "publication_id string, pdf_page int, issue_code string, waived_by string, waived_at timestamp, reason string"
PAGE_LOG = "source_pdf string, page_count int, pages array<struct<pdf_page:int,word_count:int,quality_status:string,quality_issues:array<string>,ocr_applied:boolean>>"
SEGMENTS = "source_structure string, segments array<struct<lesson_number:int,start_line:int,marker:string,end_line:int,page_start:int,page_end:int,expected_title:string,expected_page_start:int,lesson_date:string>>"
REMOTE = "Name string, Path string, Size bigint, IsDir boolean"


def _or_empty(read, spark: SparkSession, schema: str | X.StructType) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def list_pdfs(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """(name, path, size) of the PDFs below a folder, by path. Contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", str(recursive).lower())
    files = _or_empty(lambda: reader.load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", F.col("length").alias("size")), spark, LISTING)
    return files.orderBy("path")


def remote_listing(spark: SparkSession, path: str) -> DataFrame:
    """A remote's JSON listing with each entry's position, for audits.remote_listing."""
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", X.ArrayType(spark.createDataFrame([], REMOTE).schema))
    return text.select(F.posexplode(entries).alias("position", "e")).select("position", "e.*")


def file_digests(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """(path, sha256) of files."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return _or_empty(lambda: reader.load(folder).select("path", F.sha2("content", 256).alias("sha256")), spark, "path string, sha256 string")


def texts(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """(publication_id, path, text): one row per UTF-8 file, keyed by its stem."""
    x = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(folder, wholetext=True).withColumn("path", F.input_file_name())
    return x.select(F.regexp_extract("path", "([^/]+?)\\.[^./]*$", 1).alias("publication_id"), "path", F.col("value").alias("text"))


def json_documents(spark: SparkSession, path: str, schema: str, tolerant: bool = False) -> DataFrame:
    """One row per JSON object file. A root that is no object fails, or is left out if tolerant."""
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", "true").schema(schema).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST")
    read = lambda: reader.json(path).withColumn("path", F.input_file_name())
    return _or_empty(read, spark, schema + ", path string") if tolerant else read()


def yaml_documents(spark: SparkSession, folder: str, schema: str, tolerant: bool = False) -> DataFrame:
    """One row per YAML mapping (path, document). Files without a value give null fields; other roots fail or, if
    tolerant, do too. Spark lists no file of zero bytes, so those give no row: join with the expected files."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.y*ml").option("recursiveFileLookup", "true")

    def parse(batches: Iterator) -> Iterator:
        import yaml

        for pdf in batches:
            out = []
            for text, path in zip(pdf["value"], pdf["path"], strict=True):
                data = yaml.safe_load(text)
                if data is None or (tolerant and not isinstance(data, dict)):
                    data = {}
                if not isinstance(data, dict):
                    raise ValueError(f"{path}: expected a YAML mapping")
                out.append(json.dumps(data, default=str))
            yield pdf.assign(value=out)

    def read():
        x = raw.load(folder).select(F.decode("content", "UTF-8").alias("value"), "path").mapInPandas(parse, "value string, path string")
        return x.select("path", F.from_json("value", schema).alias("document"))

    return _or_empty(read, spark, f"path string, document struct<{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in spark.createDataFrame([], schema).schema)}>")


def waivers(spark: SparkSession, path: str) -> DataFrame:
    """The waivers of a JSON file {"waivers": [...]}; none if the file is missing, an error if it holds no list of them."""
    raw = json_documents(spark, path, "waivers string", tolerant=True)
    fields = f"array<struct<{','.join(':'.join(c.split()) for c in WAIVERS.split(','))}>>"
    said = F.coalesce("waivers", F.lit("[]"))
    checked = F.when(said.startswith("["), said).otherwise(F.raise_error(F.concat("path", F.lit(": waivers must be a list"))))
    return raw.select(F.explode(F.from_json(checked, fields)).alias("w")).select("w.*")


PROFILE = "profile_id string, profile_version string, expected_sections array<string>, section_aliases map<string,array<string>>"


def profiles(spark: SparkSession, folder: str, known: tuple[str, ...] = ("maestro", "alumno", "joven", "adolescente", "nino", "parvulo")) -> dict[str, dict]:
    """The family profiles of a folder of YAML files, in the form of `dictionaries.PROFILES`; a few short files.

    A known family without a file is an error; a missing profile of the unclassified is an empty one.
    """
    rows = yaml_documents(spark, folder, PROFILE).select(F.regexp_extract("path", "([^/]+?)\\.[^./]*$", 1).alias("family"), "document.*").collect()
    found = {r["family"]: r for r in rows}
    missing = [f for f in known if f not in found]
    if missing:
        raise FileNotFoundError(f"no profile of {', '.join(missing)} in {folder}")
    out = {"unclassified": {"version": "0.0.0", "sections": {}}}
    for family, r in found.items():
        aliases = r["section_aliases"] or {}
        out[family] = {"version": r["profile_version"] or "0.0.0", "sections": {s: list(aliases.get(s) or []) for s in dict.fromkeys([*(r["expected_sections"] or []), *aliases])}}
    return out


def logged_pages(logs: DataFrame) -> DataFrame:
    """The pages of processing logs, one row each, keyed by the PDF's stem."""
    stem = F.regexp_extract("source_pdf", "([^/]+?)(?:\\.[^./]*)?$", 1)
    p = logs.select(stem.alias("publication_id"), F.explode("pages").alias("p")).select("publication_id", "p.*")
    return p.select("publication_id", F.col("pdf_page").alias("page_number"), F.coalesce("word_count", F.lit(0)).alias("words"), F.col("quality_status").alias("gate_status"), F.coalesce("quality_issues", F.array().cast("array<string>")).alias("gate_issues"), F.when(F.col("ocr_applied"), "ocr").otherwise("embedded").alias("source"))


def section_metadata(documents: DataFrame) -> DataFrame:
    """The last of equal lesson numbers wins. documents: publication_id, lessons array<struct<lesson_number, sections map>>."""
    x = documents.select("publication_id", F.posexplode("lessons").alias("pos", "l"))
    return x.groupBy("publication_id", F.col("l.lesson_number").alias("lesson_number")).agg(F.max_by("l.sections", "pos").alias("sections"))


def pdf_pages(spark: SparkSession, folder: str, page_limit: int | None = None, language: str | None = None, dpi: int = 300) -> DataFrame:
    """(publication_id, title, page_number, text, ocr_text, ocr_confidence) of PDFs.

    Needs PyMuPDF in the workers, and pytesseract for a language's OCR; without them the call fails at once. A page's
    OCR is a second extraction: `extractions` makes rows of both and `quality.best_source` chooses.
    """
    try:
        import fitz  # noqa: F401
    except ImportError as e:
        raise RuntimeError("reading PDF pages needs PyMuPDF") from e
    if language and not ocr_available():
        raise RuntimeError("OCR needs pytesseract and Pillow")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(folder)

    def recognise(page) -> tuple[str | None, float | None]:
        """The OCR of a page with the mean of the words' confidences (those of 0 and more)."""
        if not language:
            return None, None
        import io

        import pytesseract
        from PIL import Image

        image = Image.open(io.BytesIO(page.get_pixmap(dpi=dpi).tobytes("png")))
        data = pytesseract.image_to_data(image, lang=language, output_type=pytesseract.Output.DICT)
        sure = [float(c) for c in data["conf"] if float(c) >= 0]
        return pytesseract.image_to_string(image, lang=language), sum(sure) / len(sure) if sure else None

    def run(batches: Iterator) -> Iterator:
        import fitz
        import pandas as pd

        names = ["publication_id", "title", "page_number", "text", "ocr_text", "ocr_confidence"]
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                rows, stem = [], path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                with fitz.open(stream=content, filetype="pdf") as doc:
                    title = (doc.metadata or {}).get("title") or None
                    for n, page in enumerate(doc, 1):
                        if page_limit and n > page_limit:
                            break
                        rows.append((stem, title, n, page.get_text("text"), *recognise(page)))
                yield pd.DataFrame(rows, columns=names).astype({"page_number": "int32", "ocr_confidence": "float64"})

    return files.select("path", "content").mapInPandas(run, "publication_id string, title string, page_number int, text string, ocr_text string, ocr_confidence double")


def ocr_available() -> bool:
    """Are the OCR libraries there?"""
    import importlib.util

    return all(importlib.util.find_spec(name) for name in ("pytesseract", "PIL"))


def extractions(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The embedded and the OCR text of each page as rows for the gate."""
    keep = ["publication_id", "page_number"]
    embedded = pages.select(*keep, F.lit("embedded").alias("source"), "text", F.lit(None).cast("double").alias("ocr_confidence"))
    ocr = pages.where("ocr_text is not null").select(*keep, F.lit("ocr").alias("source"), F.col("ocr_text").alias("text"), "ocr_confidence")
    return embedded, ocr
