"""Pages, tables and markdown of text documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import escape_html

# HTML to markdown, applied in this order. The first row of a table is marked a second time
# between <sep> tags, where its cells become the dashes under the header. Each group begins with a pattern that
# every text has in which one of its rules finds something; other texts pass the group as they are.
MARKDOWN_RULES = [
    (
        r"(?i)<(?:script|style|head|!--)",
        [
            (r"(?is)<(script|style|head)\b.*?</(script|style|head)>", ""),
            (r"(?s)<!--.*?-->", ""),
        ],
    ),
    (
        r"(?i)<(?:table|/?tr|/?sep|t[hd])",
        [
            (r"(?is)<table[^>]*>\s*(?:</?t(?:head|body)[^>]*>\s*)*<tr[^>]*>(.*?)</tr>", r"<table><tr>\1</tr><sep>\1</sep>"),
            (
                r"(?i)\s*<t[hd](?:\s[^>]*)?>(?:[^<]++|<(?!/?sep>|t[hd][\s>]|/t[hd]>))*+</t[hd]>\s*(?=(?:[^<]++|<(?!/?sep>))*+</sep>)",
                " --- |",
            ),
            (r"(?i)\s*<sep>", "\n|"),
            (r"(?i)</sep>", ""),
            (r"(?is)\s*<t[hd](\s[^>]*)?>\s*(.*?)\s*</t[hd]>\s*", r" \2 |"),
            (r"(?i)\s*<tr(\s[^>]*)?>", "\n|"),
            (r"(?i)</tr>", ""),
        ],
    ),
    (
        r"(?i)<(?:h[1-6r]|/?(?:i|em|b|strong|code)|a\s|li)",
        [
            (r"(?i)<img\s(?=[^>]*?\balt=\"([^\"]*)\")[^>]*?\bsrc=\"([^\"]*)\"[^>]*>", r"![\1](\2)"),
            (r"(?i)<img\s[^>]*?\bsrc=\"([^\"]*)\"[^>]*>", r"![](\1)"),
            (r"(?i)<h1[^>]*>", "\n\n# "),
            (r"(?i)<h2[^>]*>", "\n\n## "),
            (r"(?i)<h3[^>]*>", "\n\n### "),
            (r"(?i)<h4[^>]*>", "\n\n#### "),
            (r"(?i)<h5[^>]*>", "\n\n##### "),
            (r"(?i)<h6[^>]*>", "\n\n###### "),
            (r"(?i)</?(b|strong)(\s[^>]*)?>", "**"),
            (r"(?i)</?(i|em)(\s[^>]*)?>", "*"),
            (r"(?i)</?code(\s[^>]*)?>", "`"),
            (r"(?is)<a\s[^>]*?href=\"([^\"]*)\"[^>]*>(.*?)</a>", r"[\2](\1)"),
            (r"(?i)<li(\s[^>]*)?>", "\n* "),
            (r"(?i)<br\s*/?>", "  \n"),
            (r"(?i)<hr\s*/?>", "\n\n---\n\n"),
        ],
    ),
    (
        "<",
        [
            (r"(?i)</?(p|div|h[1-6]|ul|ol|article|section|table|blockquote|nav|footer|header)(\s[^>]*)?>", "\n\n"),
            (r"<[^>]*>", ""),
        ],
    ),
]

# Entities turned back into characters, ampersand last.
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#x27;", "'"),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
]

# Blank-line clean-up after the tags are gone.
TIDY_RULES = [(r"[ \t]*\n[ \t]*\n[ \t\n]*", "\n\n"), (r"^[ \t\n]+", ""), (r"[ \t\n]+$", "")]

#: Entries of an array that one fold sums.
BLOCK = 512


def split_pages(documents: DataFrame, key: str, text: str, separator: str = "\n") -> DataFrame:
    """One row per page: ``(key, page, text)``, pages numbered from 0."""
    return documents.select(key, F.posexplode(F.split(text, separator)).alias("page", "text"))


def _sums_before(sizes: Column) -> Column:
    """Per entry of an array of bigint, the sum of the entries before it.

    A fold copies its state in each step, so entries are summed in blocks and a
    block starts from the sum of those before: the work grows with the entries.
    """

    def fold(numbers: Column, start: Column) -> Column:
        def add(seen: Column, size: Column) -> Column:
            return F.struct((seen["end"] + size).alias("end"), F.concat(seen["starts"], F.array(seen["end"])).alias("starts"))

        state = F.struct(start.alias("end"), F.array().cast("array<bigint>").alias("starts"))
        return F.aggregate(numbers, state, add, lambda seen: seen["starts"])

    zero = F.lit(0).cast("bigint")

    def cut(numbers: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(numbers), F.lit(1)), F.lit(BLOCK))
        return F.transform(firsts, lambda i: F.slice(numbers, i, F.lit(BLOCK)))

    def placed(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, zero, lambda total, size: total + size))
        return F.flatten(F.zip_with(blocks, fold(totals, zero), fold))

    # Arrays of one entry bind a value to a name; else each block would compute it again.
    return F.get(F.transform(F.transform(F.array(sizes), cut), placed), F.lit(0))


def page_map(documents: DataFrame, key: str, pages: Column, trailing_space: bool = False) -> DataFrame:
    """``(key, page, offset, text)`` from an array of page texts.

    The offset counts the characters on the document's earlier pages. It is
    summed inside the row, so no text moves.
    """
    if trailing_space:
        pages = F.transform(pages, lambda p: F.concat(p, F.lit(" ")))
    starts = _sums_before(F.transform(pages, lambda p: F.length(p).cast("bigint")))
    zipped = F.zip_with(pages, starts, lambda p, at: F.struct(at.alias("offset"), p.alias("text")))
    placed = documents.select(key, F.posexplode(zipped).alias("page", "_page"))
    return placed.select(key, "page", "_page.offset", "_page.text")


def page_offsets(documents: DataFrame, key: str, text: str, separator: str = "\n", trailing_space: bool = False) -> DataFrame:
    """The page map of documents held as one text per row."""
    return page_map(documents, key, F.split(text, separator), trailing_space)


def tables_to_html(cells: DataFrame, keys: list[str]) -> DataFrame:
    """One HTML table per key from cells ``(row, col, kind, content, row_span, col_span)``.

    Cells are first joined to rows, so a table is put together from row texts.
    A table's HTML is a single value and so has to fit in a row in any case.
    """
    tag = F.when(F.col("kind").isin("columnHeader", "rowHeader"), "th").otherwise("td")
    spans = F.concat(
        F.when(F.col("col_span") > 1, F.concat(F.lit(" colSpan="), F.col("col_span"))).otherwise(""),
        F.when(F.col("row_span") > 1, F.concat(F.lit(" rowSpan="), F.col("row_span"))).otherwise(""),
    )
    cell = F.concat(F.lit("<"), tag, spans, F.lit(">"), escape_html("content"), F.lit("</"), tag, F.lit(">"))
    rows = _joined(cells.withColumn("_html", cell), [*keys, "row"], "col", "<tr>", "</tr>")
    return _joined(rows, keys, "row", "<table>", "</table>").withColumnRenamed("_html", "html")


def _joined(df: DataFrame, keys: list[str], order: str, opening: str, closing: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(order, "_html")))
    text = F.array_join(parts.getField("_html"), "")
    return df.groupBy(*keys).agg(F.concat(F.lit(opening), text, F.lit(closing)).alias("_html"))


def inline_tables(pages: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Page text with table spans replaced by the table's HTML, and a space at the end.

    ``spans`` has ``(keys, table_id, start, length, html)``, start counted from
    0 and spans not overlapping. A table with several spans appears at its
    first one; the others are just cut out.
    """
    span = F.struct("start", "length", "table_id", "html")
    per_page = spans.groupBy(*keys).agg(F.array_sort(F.collect_list(span)).alias("_spans"))
    joined = pages.join(per_page, keys, "left")

    ids = F.col("_spans.table_id")

    def end(i: Column) -> Column:
        previous = F.get("_spans", i - 1)
        return F.when(i == 0, 0).otherwise(previous["start"] + previous["length"])

    def piece(s: Column, i: Column) -> Column:
        kept = F.substring("text", end(i) + 1, s["start"] - end(i))
        return F.concat(kept, F.when(F.array_position(ids, s["table_id"]) == i + 1, s["html"]).otherwise(""))

    count = F.size("_spans")
    tail = F.substring("text", end(count) + 1, F.length("text"))
    replaced = F.concat(F.array_join(F.transform("_spans", piece), ""), tail)
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(replaced)
    return joined.withColumn("text", F.concat(text, F.lit(" "))).drop("_spans")


def _numbered_lists(text: Column) -> Column:
    """Items of ordered lists with their numbers, the other items left as they are."""
    blocks = F.split(text, r"(?i)(?=<ol[\s>])|(?<=</ol>)")

    def block(part: Column) -> Column:
        items = F.split(part, r"(?i)<li(?:\s[^>]*)?>")
        counted = F.transform(items, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit("\n"), i, F.lit(". "), x)))
        return F.when(F.lower(F.substring(part, 1, 3)) == "<ol", F.array_join(counted, "")).otherwise(part)

    has_list = F.contains(F.lower(text), F.lit("<ol"))
    return F.when(has_list, F.array_join(F.transform(blocks, block), "")).otherwise(text)


def to_markdown(html: str | Column) -> Column:
    """HTML as markdown text, in built-in string functions only.

    Tables become pipe rows with their first row as header, ordered lists are
    numbered (a list inside another is not counted on its own).
    """
    text = _bound(F.col(html) if isinstance(html, str) else html, _numbered_lists)
    for sign, rules in MARKDOWN_RULES:
        text = _bound(text, lambda t: F.when(F.regexp_like(t, F.lit(sign)), _replaced(t, rules)).otherwise(t))  # noqa: B023
    for entity, plain in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return _replaced(text, TIDY_RULES)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _replaced(text: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement.replace("\\", "$"))
    return text


def document_markdown(pages: DataFrame, spans: DataFrame, document: str, page: str) -> DataFrame:
    """One markdown row per document from its pages and the tables on them.

    Tables replace their spans, pages are joined in order, and the page map is
    counted over the replaced text: ``(document, content, page_map)``, the map
    an array of ``(page, offset, length)``. A document is one value and has to
    fit in a row; it is put together from its pages with one shuffle.
    """
    inlined = inline_tables(pages, spans, [document, page])
    listed = F.array_sort(F.collect_list(F.struct(F.col(page).cast("int").alias("page"), "text")))
    joined = inlined.groupBy(document).agg(listed.alias("_pages"))
    starts = _sums_before(F.transform("_pages", lambda p: F.length(p["text"]).cast("bigint")))

    def entry(p: Column, at: Column) -> Column:
        return F.struct(p["page"].alias("page"), at.cast("int").alias("offset"), F.length(p["text"]).alias("length"))

    whole = F.array_join(F.transform("_pages", lambda p: p["text"]), "")
    return joined.select(document, to_markdown(whole).alias("content"), F.zip_with("_pages", starts, entry).alias("page_map"))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly before heavy work per row; AQE sets the number of partitions by size."""
    return df.hint("rebalance")
