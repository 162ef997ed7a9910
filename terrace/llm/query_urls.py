"""op3: verdicts on the pages' URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.registry import query, table
from terrace.llm.urls import filter_urls, host

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Pages on hosts with one of these words in their name make up the list of URLs.
ADVERTS = r"casino|pills|bets"

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_FITS = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in RULES]
_BY_LENGTH = sorted(range(len(RULES)), key=lambda i: -len(RULES[i][1] + RULES[i][2]))
_RULE = " ".join(f"WHEN {_FITS[i]} THEN '{RULES[i][1]}{RULES[i][2]}'" for i in _BY_LENGTH)
_ACTION = " ".join(f"WHEN {_FITS[i]} THEN '{RULES[i][0]}'" for i in _BY_LENGTH)


@query(f"""
WITH parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path,
         list_sort(list_filter(string_split(regexp_extract(url, '{_PARTS}', 3), '&'), lambda p:
           p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params
  FROM pages),
forms AS (
  SELECT *, CASE WHEN NOT contains(url, '://') THEN url WHEN url IS NOT NULL THEN
           regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
           || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS form
  FROM parts)
SELECT page_id, host, path, CASE {_RULE} END AS rule,
       CASE {_ACTION} ELSE CASE WHEN form IN (
         SELECT form FROM forms WHERE regexp_matches(host, '{ADVERTS}') AND form IS NOT NULL)
         THEN 'block' ELSE 'allow' END END AS verdict
FROM forms
""")
def op3_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    listed = pages.where(host(F.col("url")).rlike(ADVERTS)).select("url")
    return filter_urls(pages, "url", listed, "url", RULES).drop("url")
