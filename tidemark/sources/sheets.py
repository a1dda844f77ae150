"""Spreadsheets and evidence lines out."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.tables import numbered

#: Headers in their order, and the columns below them. Fixed values.
HEADERS = {
    "Date Announced": "date_announced",
    "Target / Partner": "target",
    "Acquirer / Partner": "acquirer",
    "Upfront Value (M USD)": "upfront_value_usd",
    "Contingent Payment (M USD)": "contingent_payment_usd",
    "Total Deal Value (M USD)": "total_deal_value_usd",
    "Upfront as % of Total Value": "upfront_pct_total",
    "Phase of Lead Asset at Announcement": "stage",
    "Therapeutic Area": "therapeutic_area",
    "Secondary Areas": "secondary_areas",
    "Asset / Focus": "asset_focus",
    "Deal Type (M&A or Partnership)": "deal_type",
    "Geography of Target": "geography",
    "Source URL": "source_url",
    "Needs Review": "needs_review",
}


def sheet_rows(deals: DataFrame, more: list[str] | tuple = ()) -> DataFrame:
    """Deals as the rows of a sheet: 15 columns (and more, as they are), zero amounts blank, flags as TRUE or FALSE, two kinds."""
    kind = F.when(F.col("deal_type_detailed") == "M&A", "M&A").otherwise("Partnership")
    rows = deals.withColumn("deal_type", kind).withColumn("needs_review", F.when(F.col("needs_review"), "TRUE").otherwise("FALSE"))
    money = ("upfront_value_usd", "contingent_payment_usd", "total_deal_value_usd", "upfront_pct_total")
    return rows.select(*(F.nullif(F.col(c).cast("double"), F.lit(0.0)).alias(h) if c in money else F.col(c).cast("string").alias(h) for h, c in HEADERS.items()), *more)


def column_widths(rows: DataFrame) -> DataFrame:
    """header, width: the longest text plus two, at most 50."""
    longest = rows.agg(*(F.max(F.length(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))).alias(c) for c in rows.columns))
    return longest.select(F.explode(F.array(*(F.struct(F.lit(c).alias("header"), F.least(F.greatest(F.coalesce(F.col(f"`{c}`"), F.lit(0)), F.lit(len(c))) + 2, F.lit(50)).cast("bigint").alias("width")) for c in rows.columns))).alias("x")).select("x.*")


def _letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def workbook(headers: list[str], rows: list[tuple], sheet: str = "Deals") -> bytes:
    """An OOXML workbook of one sheet with bold headers."""
    width = [min(max([len(h), *(len(str(r[i])) for r in rows if r[i] is not None)]) + 2, 50) for i, h in enumerate(headers)]

    def cell(r: int, c: int, v: object, style: int = 0) -> str:
        at = f"{_letters(c)}{r}"
        if v is None:
            return ""
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f'<c r="{at}" s="{style}"><v>{v}</v></c>'
        return f'<c r="{at}" s="{style}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    lines = [f'<row r="1">{"".join(cell(1, i, h, 1) for i, h in enumerate(headers))}</row>']
    lines += [f'<row r="{n}">{"".join(cell(n, i, v) for i, v in enumerate(r))}</row>' for n, r in enumerate(rows, 2)]
    cols = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(width, 1))
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/></Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Type="{rel}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'{head}<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf fontId="0"/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'{head}<worksheet xmlns="{main}"><cols>{cols}</cols><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


#: Rows that a sheet holds at most, its header aside; more go to further workbooks.
SHEET_ROWS = 1_000_000


def workbooks(deals: DataFrame, bucket: str | None = None) -> DataFrame:
    """bucket, part, data: the finished workbooks, each of a bucket's rows in order of their dates and urls."""
    of = F.lit("") if bucket is None else F.col(bucket)
    rows = sheet_rows(deals.where(of.isNotNull()).withColumn("_bucket", of), ["_bucket"])
    headers = [c for c in rows.columns if c != "_bucket"]
    by_bucket = numbered(rows, "_bucket", "`Date Announced`", "`Source URL`")
    first = by_bucket.groupBy("_bucket").agg(F.min("position").alias("_first"))
    placed = by_bucket.join(first, "_bucket").withColumn("_part", F.floor((F.col("position") - F.col("_first")) / SHEET_ROWS))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("position")[headers].astype(object)
        rows_ = [tuple(None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else v for v in r) for r in pdf.itertuples(index=False)]
        return pd.DataFrame({"bucket": [key[0]], "part": [int(key[1])], "data": [workbook(headers, rows_)]})

    return placed.groupBy("_bucket", "_part").applyInPandas(build, "bucket string, part bigint, data binary")


def write_sheets(deals: DataFrame, folder: str, bucket: str | None = None, name: str = "{bucket}/part-{part:05d}.xlsx") -> list[str]:
    """One workbook, or one for each value of a column that has rows, through the Hadoop file system; returns their paths.

    The workbooks are made on the executors and come to the driver one at a time, as a sheet is one file of bounded rows.
    """
    spark, out = deals.sparkSession, []
    for r in workbooks(deals, bucket).orderBy("bucket", "part").toLocalIterator():
        path = f"{folder.rstrip('/')}/{name.format(bucket=r.bucket, part=r.part).lstrip('/')}"
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
        try:
            stream.write(r.data)
        finally:
            stream.close()
        out.append(path)
    return out


def evidence_lines(deals: DataFrame) -> DataFrame:
    """value: one JSON line a deal with twelve keys; nulls stay, but evidence holds filled fields only."""
    evidence = F.col("evidence") if "evidence" in deals.columns else F.create_map().cast("map<string,string>")
    rate = F.nullif(F.col("fx_rate").cast("double"), F.lit(0.0))
    record = F.struct("canonical_key", "source_url", "related_urls", evidence.alias("evidence"), "detected_currency", rate.alias("fx_rate"), "fx_source", F.col("confidence").cast("double").alias("confidence"), "inclusion_reason", "exclusion_reason", "parser_version", "timestamp_utc")
    return deals.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))
