"""HTML extraction: blocks labelled content or boilerplate by a minimum cut."""

import pandas as pd
from pyspark.sql import functions as F

from harrow.llm import html_tasks as tasks


def extract(pages, text="text", n_chars="n_chars"):
    """pages with the main text of the column html, and its number of code points.

    Text is cut into blocks at block-level tags. A classifier's costs (open
    elements and their names, links, length, headings) tie each block to content
    or boilerplate, neighbours and siblings, also those with other blocks between
    them, are tied to each other, and the minimum cut labels them. Content blocks stand in page order, one to a line,
    character references decoded and white space turned into single spaces.
    Unclosed and cut-off markup is read as far as it goes. A null, empty or
    textless page gives an empty text. Every row gets its own result. Columns
    named like the two results are replaced, others pass through.
    """

    def read(html: pd.Series) -> pd.Series:
        return html.map(tasks.main_text, na_action=None)

    out = pages.withColumn(text, F.pandas_udf(read, "string").asNondeterministic()("html"))
    return out.withColumn(n_chars, F.char_length(text).cast("long"))


def op8_html_extract(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
