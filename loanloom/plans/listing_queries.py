"""Listing queries over a listing derived from the tape's trusts and months."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import listing as ls
from .registry import TAPE, query
from .tape import tape

# the same text serves both engines
_BASE = """SELECT DISTINCT nk, vy, mi, sec, month FROM tape"""
_ROWS = """SELECT nk, vy, mi, 1000 * mi + nk AS seq, CASE WHEN (nk + mi) % 5 = 0 THEN upper(sec) ELSE sec END AS secname,
  concat(lpad(CAST(nk AS VARCHAR(10)), 10, '0'), '-', lpad(CAST(vy % 100 AS VARCHAR(2)), 2, '0'), '-', lpad(CAST(mi AS VARCHAR(6)), 6, '0')) AS number,
  CAST(month AS VARCHAR(10)) AS reportdate FROM b
 UNION ALL SELECT nk, vy, mi, 1000 * mi + 500 + nk, concat('Shelf ', lpad(CAST(nk AS VARCHAR(9)), 2, '0'), CASE WHEN nk % 3 = 0 THEN ' Auto Leasing LLC' WHEN nk % 7 = 0 THEN ' Mortgage Corp' ELSE ' Auto Depositor LLC' END),
  concat(lpad(CAST(nk AS VARCHAR(10)), 10, '0'), '-', lpad(CAST(vy % 100 AS VARCHAR(2)), 2, '0'), '-', lpad(CAST(mi AS VARCHAR(6)), 6, '0')), CAST(month AS VARCHAR(10)) FROM b"""
_FULL = """SELECT r.*, concat('https://example.invalid/edgar/data/', CAST(nk AS VARCHAR(9)), '/', number) AS url, CASE WHEN lower(secname) LIKE '%trust%' THEN 'Trust' ELSE 'Depositor' END AS entitytype,
  CASE WHEN lower(secname) LIKE '%leas%' THEN 'Auto Leases' WHEN lower(secname) LIKE '%mortgage%' THEN 'CMBS' ELSE 'Auto Loans' END AS assetclass, concat(number, '.xml') AS filename FROM r"""
L = TAPE + f", b AS ({_BASE}), r AS ({_ROWS}), l AS ({_FULL})"
_NORM = """, best AS (SELECT lower(secname) AS k, arg_min(secname, (CASE WHEN secname = upper(secname) THEN 1 ELSE 0 END) * 1000000000 + seq) AS name FROM l GROUP BY 1),
norm AS (SELECT * FROM (SELECT l.* REPLACE (best.name AS secname), row_number() OVER (PARTITION BY url, best.name ORDER BY seq) AS rn FROM l JOIN best ON lower(l.secname) = best.k) WHERE rn = 1)"""
_SHELF = "CASE WHEN regexp_matches(secname, '\\b(19|20)\\d{2}\\b') THEN rtrim(regexp_replace(secname, '\\b(19|20)\\d{2}\\b.*$', ''), ' -') ELSE secname END"


def n():
    return F.count(F.lit(1)).alias("n")




def _listing(s, d):
    return s.sql(f"WITH b AS ({_BASE.replace('tape', '{t}')}), r AS ({_ROWS}) {_FULL}", t=tape(s, d))


C = F.col
query("l1_l2_classes", L + " SELECT assetclass, entitytype, count(*) AS n FROM l GROUP BY 1, 2")(lambda s, d: _listing(s, d).groupBy(ls.asset_class(C("secname")).alias("assetclass"), ls.entity_type(C("secname")).alias("entitytype")).agg(n()))
query("l3_strip_cik", L + " SELECT DISTINCT secname AS name FROM l")(lambda s, d: _listing(s, d).select(ls.without_cik(F.concat("secname", F.lit(" (CIK 00012)"))).alias("name")).distinct())
query("l4_shelf", L + f" SELECT {_SHELF} AS shelf, count(*) AS n FROM l GROUP BY 1")(lambda s, d: _listing(s, d).groupBy(ls.shelf(C("secname")).alias("shelf")).agg(n()))
query("l5_names", L + " SELECT replace(secname || ' & Co. (x)', ' ', '_') || '_' || reportdate || '_' || number || '.xml' AS file, number AS accession, CAST(nk AS VARCHAR) AS cik FROM l WHERE entitytype = 'Trust'")(
    lambda s, d: _listing(s, d).filter("entitytype = 'Trust'").select(ls.file_name(F.concat("secname", F.lit(" & Co. (x)")), C("reportdate"), ls.accession(C("url"))).alias("file"), ls.accession(C("url")).alias("accession"), ls.cik(C("url")).alias("cik")))
query("l6_pick_files", L + " SELECT url AS filing, CASE WHEN mi % 3 = 0 THEN 'b.xml' ELSE 'a.xml' END AS name FROM l GROUP BY url, mi")(
    lambda s, d: ls.pick_files(_listing(s, d).select(C("url").alias("filing"), F.explode(F.array(*(F.struct(F.lit(f).alias("name"), F.expr(e).cast("long").alias("size")) for f, e in (("a.xml", "100"), ("b.xml", "100 - cast(mi % 3 > 0 as int)"), ("ex103.xml", "999"), ("s.xsd", "999"), ("x.htm", "999"))))).alias("f")).select("filing", "f.*")))
query("l7_filers", L + " SELECT url AS filing, CAST(min(nk) AS VARCHAR) AS cik, secname FROM l GROUP BY url, secname")(
    lambda s, d: ls.filers(_listing(s, d).groupBy("url").agg(F.collect_set(F.concat("secname", F.lit(" (CIK 1)"))).alias("display_names"), F.collect_set(C("nk").cast("string")).alias("ciks")).withColumnRenamed("url", "filing")).select("filing", "cik", "secname"))
query("l8_normalize", L + _NORM + " SELECT secname, count(*) AS n, CAST(min(seq) AS BIGINT) AS first FROM norm GROUP BY 1")(lambda s, d: ls.normalize(_listing(s, d)).groupBy("secname").agg(n(), F.min("seq").alias("first")))
query("l9_difference", L + f", old AS (SELECT * FROM l WHERE mi % 12 < 6 AND vy < 2023) SELECT (SELECT count(*) FROM l WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.url = l.url AND lower(o.secname) = lower(l.secname))) AS new_rows, (SELECT count(*) FROM (SELECT DISTINCT lower(secname) AS k FROM l WHERE entitytype = 'Trust' EXCEPT SELECT lower(secname) FROM old)) AS new_trusts, (SELECT count(*) FROM (SELECT lower({_SHELF}) AS k FROM l EXCEPT SELECT lower({_SHELF}) FROM old)) AS new_shelves")(
    lambda s, d: ls.difference(_listing(s, d).filter("mi % 12 < 6 and vy < 2023"), _listing(s, d)))
query("l10_merge", L + _NORM + " SELECT count(*) AS n, count(DISTINCT secname) AS names FROM norm")(lambda s, d: ls.merge(_listing(s, d).filter("mi % 2 = 0"), _listing(s, d).filter("mi % 2 = 1")).agg(n(), F.count_distinct("secname").alias("names")))
query("l11_select_filings", L + " SELECT secname, count(*) AS n FROM l WHERE entitytype = 'Trust' AND assetclass = 'Auto Loans' AND regexp_matches(lower(secname), 'shelf 0[1-5]') AND reportdate >= '2021-06-01' GROUP BY 1")(lambda s, d: ls.select_filings(_listing(s, d), "shelf 0[1-5]", "2021-06-01").groupBy("secname").agg(n()))
query("l12_vintage", L + " SELECT vy::INT AS vintage, count(*) AS n FROM l WHERE entitytype = 'Trust' GROUP BY 1")(lambda s, d: _listing(s, d).filter("entitytype = 'Trust'").groupBy(ls.vintage(C("secname")).alias("vintage")).agg(n()))
query("l12_n_series", L + " SELECT secname, count(*) AS n FROM l WHERE entitytype = 'Trust' AND nk % 2 = 0 GROUP BY 1")(lambda s, d: _listing(s, d).filter(ls.n_series(C("secname"))).groupBy("secname").agg(n()))
query("l13_panel", L + _NORM + """, deal AS (SELECT secname, CASE WHEN nk < 10 THEN 'shelf 0' WHEN nk < 20 AND nk % 2 = 0 THEN 'Shelf 1' END AS shelf, count(DISTINCT url) AS n, CASE WHEN vy >= 2024 THEN 6 WHEN vy >= 2022 THEN 5 WHEN vy >= 2020 THEN 4 WHEN vy >= 2019 THEN 3 WHEN vy >= 2018 THEN 2 ELSE 1 END AS bucket FROM norm WHERE entitytype = 'Trust' AND assetclass = 'Auto Loans' GROUP BY ALL),
top AS (SELECT secname FROM (SELECT *, row_number() OVER (PARTITION BY shelf, bucket ORDER BY n DESC, secname) AS r FROM deal WHERE shelf IS NOT NULL) WHERE r <= 2) SELECT secname, count(*) AS n FROM norm JOIN top USING (secname) GROUP BY 1""")(
    lambda s, d: ls.select_panel(ls.normalize(_listing(s, d)), ["shelf 0", "Shelf 1"], only_n=("Shelf 1",)).groupBy("secname").agg(n()))
query("l14_seeds", L + " SELECT DISTINCT CAST(nk AS VARCHAR) AS cik FROM l WHERE assetclass = 'Auto Loans' AND regexp_matches(lower(secname), 'shelf 0')")(lambda s, d: ls.seeds(_listing(s, d), "shelf 0"))
query("l15_downloads", L + ", urls AS (SELECT DISTINCT url FROM l WHERE assetclass = 'Auto Loans' AND entitytype IN ('Trust', 'Depositor')) SELECT count(*) AS files, round(count(*) * 0.19, 6) AS gb FROM urls")(
    lambda s, d: ls.download_size(ls.downloads(_listing(s, d), ["Auto Loans"], ["Trust", "Depositor"])).withColumn("gb", F.round("gb", 6)))
query("l16_manifest", L + " SELECT secname, count(DISTINCT filename) AS filings, md5(secname || '|' || string_agg(DISTINCT filename, '|' ORDER BY filename)) AS fingerprint FROM l GROUP BY 1")(lambda s, d: ls.manifest(_listing(s, d)))
