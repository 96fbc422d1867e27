"""Small filings for the tests of the ingest."""
from pyspark.sql import functions as F

from loanloom.operators import clean

ROW = "<assets><assetNumber>{a}</assetNumber><reportingPeriodBeginningDate>{m}-1-2023</reportingPeriodBeginningDate><reportingPeriodActualEndBalanceAmount>{e}</reportingPeriodActualEndBalanceAmount></assets>"


def filing(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text('<?xml version="1.0"?><assetData xmlns="urn:x">' + "".join(ROW.format(a=a, m=m, e=e) for a, m, e in rows) + "</assetData>")


def prepare(rows):
    typed = clean.typed(rows.select("assetNumber", "reportingPeriodBeginningDate", "reportingPeriodActualEndBalanceAmount", "filename"))
    return typed.withColumn("securitizationKey", F.substring_index("filename", "_", 1)).withColumn("reportDate", F.regexp_extract("filename", r"_(\d+)", 1))
