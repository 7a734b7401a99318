"""SQL names for the scalar functions, and the table function ``filing_items``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from sheafwork.functions.html import strip_markup
from sheafwork.functions.text import clean_text_py, collapse_lines_py
from sheafwork.operators.items import UnknownForm
from sheafwork.plans.extract import Options, items_of


def _mapped(function):
    """``function`` over a column of strings; null stays null."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: function(v) if isinstance(v, str) else None)

    return F.pandas_udf(run, "string")


@udtf(returnType="ord int, key string, value string")
class FilingItems:
    """``SELECT * FROM filing_items(content, form, date)``: the items of one raw filing."""

    def eval(self, content: str, form: str, date: str) -> Iterator[tuple]:
        if content is None or form is None:
            return
        try:
            found = items_of(content, form, date, Options())
        except UnknownForm:
            return
        for i, (key, value) in enumerate(found or []):
            yield i, key, value


def register(spark: SparkSession) -> None:
    """Register ``strip_markup``, ``clean_filing_text``, ``collapse_lines`` and ``filing_items``."""
    for name, function in (("strip_markup", strip_markup), ("clean_filing_text", clean_text_py), ("collapse_lines", collapse_lines_py)):
        spark.udf.register(name, _mapped(function))
    spark.udtf.register("filing_items", FilingItems)
