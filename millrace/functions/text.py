"""Text columns: JSON paths, message bodies, HTML escaping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters escaped in HTML text, ampersand first.
HTML_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]


def json_path(column: str | Column, path: str) -> Column:
    """Text at a dotted path, as in ``details.user.name``."""
    return F.get_json_object(column, f"$.{path}")


def body_text(column: str | Column = "body") -> Column:
    """A binary message body as text."""
    return F.decode(column, "UTF-8")


def escape_html(column: str | Column) -> Column:
    text = F.col(column) if isinstance(column, str) else column
    for plain, escaped in HTML_ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text
