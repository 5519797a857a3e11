"""Web pages to corpus lines, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossmill.functions.text import strip

#: Elements whose content is no text of the page.
DROPPED = ["script", "style", "head", "nav"]
LEAST_LINE = 20


def corpus_lines(html: Column, least: int = LEAST_LINE) -> Column:
    """Lines of text of at least `least` characters; every tag ends a line."""
    for name in DROPPED:
        html = F.regexp_replace(html, rf"(?is)<{name}\b.*?</{name}\s*>", "")
    lines = F.split(F.regexp_replace(html, r"(?s)<[^>]*>", "\n"), "\n")
    return F.filter(F.transform(lines, strip), lambda x: F.length(x) >= least)
