"""Files in and out: JSON arrays, PDFs by content, CSV exports, JSON backups, and a metadata log."""

from __future__ import annotations

import io

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EXPORT_10 = ["id", "generic_name", "brand_names", "dosage_form", "strength", "notification_number", "notification_date", "ban_reason", "source_pdf", "date_added"]
EXPORT_13 = [*EXPORT_10[:9], "is_fdc", "ingredients", "source_url", "date_added"]


def read_json_array(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """S14/S15. Rows of a JSON array; a missing file gives none, a broken one rows of nulls are dropped from."""
    try:
        rows = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
        return rows.filter(F.coalesce(*[F.col(f"`{c}`").isNotNull() for c in rows.columns], F.lit(False)) if len(rows.columns) == 1 else F.greatest(*[F.col(f"`{c}`").isNotNull() for c in rows.columns]))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def write_json_array(df: DataFrame, path: str, order: list[str]) -> None:
    """K4. JSON lines sorted by ``order``, written in parallel; a reader takes them as one array."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def is_pdf(content: Column) -> Column:
    """K6. Whether the first four bytes are %PDF."""
    return F.coalesce(F.substring(content, 1, 4) == F.lit(bytearray(b"%PDF")), F.lit(False))


def read_pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """``path, content, is_pdf`` of all files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "content", is_pdf(F.col("content")).alias("is_pdf"))


def pdf_text(content: Column) -> Column:
    """S11-S13. Text of PDFs by the first library at hand that finds any: pdfplumber, then pypdf; null without either."""
    return F.pandas_udf(_pdf_texts, "string")(content)


def _pdf_texts(contents: pd.Series) -> pd.Series:

    def plumber(content: bytes) -> str | None:
        import pdfplumber

        with pdfplumber.open(io.BytesIO(content)) as pdf:
            parts = [p.extract_text() or "" for p in pdf.pages]
            tables = [" | ".join(c or "" for c in row) for p in pdf.pages for t in p.extract_tables() for row in t]
        return "\n".join([*parts, *tables])

    def plain(content: bytes) -> str | None:
        import pypdf

        return "\n".join(p.extract_text() or "" for p in pypdf.PdfReader(io.BytesIO(content)).pages)

    def read(content: bytes | None) -> str | None:
        for how in (plumber, plain):
            try:
                text = how(content)
            except Exception:  # a missing library or a broken file: the next way
                continue
            if text and text.strip():
                return text
        return None

    return pd.Series([None if c is None else read(c) for c in contents], dtype=object)


def export_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """K1/K2. Columns as text: arrays joined with ', ', booleans as True/False, times with offset and, if any, six digits of a second; null as ''."""

    def text(name: str) -> Column:
        if name not in df.columns:
            return F.lit("").alias(name)
        kind, c = dict(df.dtypes)[name], F.col(name)
        if kind == "timestamp":
            whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
            c = F.concat(whole, F.when(F.pmod(F.unix_micros(c), F.lit(1_000_000)) == 0, "").otherwise(F.date_format(c, ".SSSSSS")), F.date_format(c, "xxx"))
        c = F.array_join(c, ", ") if kind.startswith("array") else F.initcap(c.cast("string")) if kind == "boolean" else c.cast("string")
        return F.coalesce(c, F.lit("")).alias(name)

    return df.select(*[text(c) for c in columns])


def write_csv(df: DataFrame, path: str, columns: list[str], one_file: bool = False) -> None:
    """K1/K2. CSV with header in the order of ids; part files, or one file where the export is small enough for it."""
    rows = export_rows(df.orderBy("id"), columns)
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def backup(df: DataFrame, path: str) -> None:
    """K3. All columns as JSON lines, dates and times in ISO format, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """K5. New records of the download log."""
    df.write.mode("append").json(path)
