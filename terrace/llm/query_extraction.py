"""op8: the main text of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.extraction import extract_main_text
from terrace.llm.registry import query, table


@query()
def op8_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return extract_main_text(pages.select("page_id", "url", F.col("html")), "html").drop("html")
