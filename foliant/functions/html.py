"""Titles of web pages."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_META = re.compile(r"<meta\b[^>]*>", re.I)
_ATTR = re.compile(r"([a-zA-Z:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")


def title_of(page: str | None) -> str | None:
    """og:title, else the first h1, else title: the first with text, references decoded, white space collapsed."""
    if not page:
        return None
    found = None
    for m in _META.finditer(page):
        a = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(m[0])}
        if a.get("property") == "og:title" and a.get("content", "").strip():
            found = a["content"]
            break
    for tag in ("h1", "title"):
        if found is None and (m := re.search(rf"<{tag}\b[^>]*>(.*?)</{tag}\s*>", page, re.I | re.S)):
            inner = re.sub(r"<[^>]+>", " ", m[1])
            found = inner if inner.strip() else None
    return " ".join(html.unescape(found).split()) if found else None


@F.pandas_udf(StringType())
def page_title(s: pd.Series) -> pd.Series:
    return s.map(title_of)
