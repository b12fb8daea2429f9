"""Readers of registry feeds and artifacts, each with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.operators.keyed import latest

FIRM = """
Info struct<_FirmCrdNb: string, _SECNb: string, _BusNm: string, _LegalNm: string>,
MainAddr struct<_Strt1: string, _Strt2: string, _City: string, _State: string, _Cntry: string, _PostlCd: string, _PhNb: string>,
Rgstn struct<_FirmType: string>, Filing struct<_Dt: string>,
FormInfo struct<Part1A: struct<
  Item1: struct<WebAddrs: struct<WebAddr: array<string>>>, Item3A: struct<_OrgFormNm: string>, Item5A: struct<_TtlEmp: string>,
  Item5D: struct<_Q5DA1: string, _Q5DB1: string, _Q5DB3: string>, Item5F: struct<_Q5F2C: string>, Item5G: struct<_Q5G12Oth: string>, Item5B: struct<_Q5BOth: string>>>
"""


#: Any attribute whose name ends so is free text.
FREE_TEXT = "//@*[substring(name(), string-length(name()) - 2) = 'Oth']"


def xml_firms(spark: SparkSession, path: str) -> DataFrame:
    """Firms of a registry feed in XML (gzip or plain), a row per element; numbers that cannot be read are null.

    The file is cut at the ends of elements, so that a plain one is read in parallel; each element is parsed once for its
    fields and, where an attribute that ends in Oth occurs at all, once for those.
    """
    raw = spark.read.option("lineSep", "</Firm>").text(path)
    element = F.concat(F.regexp_extract("value", "(?s)(<Firm[ >/].*)", 1), F.lit("</Firm>"))
    each = raw.filter(F.col("value").rlike("<Firm[ >/]")).select(F.explode(F.array(element)).alias("x"))
    firm = each.select("x", F.explode(F.array(F.from_xml("x", FIRM))).alias("f"))
    part = F.col("f.FormInfo.Part1A")
    number = lambda x: x.try_cast("bigint")
    field = lambda c: F.col(f"f.{c}")
    other = F.when(F.col("x").rlike("Oth *="), F.array_join(F.filter(F.xpath("x", F.lit(FREE_TEXT)), lambda v: v != ""), " | "))
    crd = field("Info._FirmCrdNb")
    return firm.select(
        crd.alias("crd"), field("Info._SECNb").alias("sec_number"), field("Info._BusNm").alias("business_name"), field("Info._LegalNm").alias("legal_name"), part["Item3A"]["_OrgFormNm"].alias("org_form"),
        F.get(part["Item1"]["WebAddrs"]["WebAddr"], 0).alias("website"), field("MainAddr._Strt1").alias("street1"), field("MainAddr._Strt2").alias("street2"), field("MainAddr._City").alias("city"), field("MainAddr._State").alias("state"),
        field("MainAddr._Cntry").alias("country"), field("MainAddr._PostlCd").alias("postal_code"), field("MainAddr._PhNb").alias("phone"), number(part["Item5A"]["_TtlEmp"]).alias("total_employees"), number(part["Item5F"]["_Q5F2C"]).alias("raum_total"),
        number(part["Item5D"]["_Q5DB1"]).alias("hnw_clients"), number(part["Item5D"]["_Q5DB3"]).alias("hnw_raum"), number(part["Item5D"]["_Q5DA1"]).alias("nonhnw_clients"), field("Rgstn._FirmType").alias("registration_type"),
        field("Filing._Dt").alias("latest_filing_date"), F.coalesce(other, F.lit("")).alias("other_text"), F.concat(F.lit("https://reports.adviserinfo.sec.gov/reports/ADV/"), crd, F.lit("/PDF/"), crd, F.lit(".pdf")).alias("source_url"),
    )


def current_feed(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """(name): the first file of a manifest, a JSON object with `files`, whose name begins with the prefix."""
    files = spark.read.option("multiLine", True).schema("files array<struct<name: string>>").json(path)
    named = F.filter(F.coalesce("files.name", F.array().cast("array<string>")), lambda n: n.startswith(prefix))
    return files.select(F.get(named, F.lit(0)).alias("name")).filter("name is not null")


def form_index(spark: SparkSession, path: str) -> DataFrame:
    """Lines (n, value) of a quarterly form index, numbered in their order."""
    return spark.read.text(path).withColumn("n", F.monotonically_increasing_id())


def profiles(filings: DataFrame) -> DataFrame:
    """Filings (key, text) with the fields of their header, and the error where a header has no address block."""
    parts = submission_profile(F.col("text"))
    error = F.when(F.coalesce("text", F.lit("")) == "", "empty").when(~F.substring("text", 1, 20_000).contains("BUSINESS ADDRESS:"), "no business address")
    return filings.select("key", *(c.alias(n) for n, c in parts.items()), error.alias("error"))


def form_filers(lines: DataFrame) -> DataFrame:
    """Filers from lines (n, value) of a quarterly form index: the newest filing of each, the first line on a tie."""
    row = "^13F-HR(?:/A)?\\s+(.{1,62}?)\\s{2,}(\\d+)\\s+(\\d{4}-\\d{2}-\\d{2})\\s+(\\S+)"
    part = lambda i: F.regexp_extract("value", row, i)
    parsed = lines.filter(F.col("value").rlike(row)).select("n", F.trim(part(1)).alias("business_name"), part(2).alias("cik"), part(3).alias("latest_filing_date"), part(4).alias("filing_path"))
    return latest(parsed, ["cik"], F.desc("latest_filing_date"), F.asc("n")).drop("n")


def submission_profile(text: Column) -> dict[str, Column]:
    """Address, phone and number fields of a submission header; only the first 20,000 characters are read."""
    head = F.substring(text, 1, 20_000)
    block = F.regexp_extract(head, "(?s)BUSINESS ADDRESS:(.*?)(?:MAIL ADDRESS:|FORMER|$)", 1)
    field = lambda source, label: F.nullif(F.trim(F.regexp_extract(source, f"{label}:[ \\t]*([^\\r\\n]*)", 1)), F.lit(""))
    return {"street": field(block, "STREET 1"), "city": field(block, "CITY"), "state": field(block, "STATE"), "zip": field(block, "ZIP"), "phone": field(block, "BUSINESS PHONE"), "ein": field(head, "EIN")}


def registry_snapshot(text: Column) -> Column:
    """(found, firm_name, scope, filed) from a JSON answer that holds a JSON string; not found is an answer, not an error."""
    outer = F.from_json(text, "hits struct<hits: array<struct<_source: struct<iacontent: string>>>>")
    inner = F.from_json(F.get(outer["hits"]["hits"], 0)["_source"]["iacontent"], "basicInformation struct<firmName: string, iaScope: string, advFilingDate: string>")["basicInformation"]
    filed = F.date_format(F.try_to_date(inner["advFilingDate"], "M/d/yyyy"), "yyyy-MM-dd")
    return F.struct(inner.isNotNull().alias("found"), inner["firmName"].alias("firm_name"), inner["iaScope"].alias("scope"), filed.alias("filed"))


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that holds one JSON array; a byte order mark at its start is skipped by the reader."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def csv_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header, or no rows where the file is missing."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
