"""Document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import documents as docs
from millrace.plans.registry import query

_PAGES = """(SELECT doc_id, generate_subscripts(parts, 1) - 1 AS page, unnest(parts) AS text
             FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"""


@query("split_pages", f"SELECT doc_id, page::INTEGER AS page, md5(text) AS text_id FROM {_PAGES}")
def split_pages(t):
    pages = docs.split_pages(t.documents, "doc_id", "text")
    return pages.select("doc_id", "page", F.md5("text").alias("text_id"))


@query(
    "page_offsets",
    f"""SELECT doc_id, page::INTEGER AS page, length(text) AS n_chars,
               coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY page
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM {_PAGES}""",
)
def page_offsets(t):
    pages = docs.page_offsets(t.documents, "doc_id", "text")
    return pages.select("doc_id", "page", F.length("text").cast("bigint").alias("n_chars"), "offset")


@query(
    "page_offsets_spaced",
    f"""SELECT doc_id, page::INTEGER AS page, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY page
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM {_PAGES}""",
)
def page_offsets_spaced(t):
    pages = docs.page_offsets(t.documents, "doc_id", "text", trailing_space=True)
    return pages.select("doc_id", "page", "offset")


def _cells(t):
    """Parts as tables of up to 25 rows and three columns, the first row repeated as a header."""
    key = F.col("p_partkey")
    place = t.part.select(
        F.floor(key / 25).alias("table_id"), (key % 25).cast("int").alias("row"), "p_name", "p_type", "p_brand"
    )

    def cell(col: int, kind: str, content, col_span: int = 1, row=F.col("row") + 1):
        return F.struct(
            row.alias("row"),
            F.lit(col).alias("col"),
            F.lit(kind).alias("kind"),
            content.alias("content"),
            F.lit(1).alias("row_span"),
            F.lit(col_span).alias("col_span"),
        )

    body = place.select(
        "table_id",
        F.inline(
            F.array(
                cell(0, "rowHeader", F.col("p_name")),
                cell(1, "content", F.concat(F.lit('<"'), "p_type", F.lit("'> & more"))),
                cell(2, "content", F.col("p_brand")),
            )
        ),
    )
    head = place.select("table_id").distinct().select(
        "table_id",
        F.inline(
            F.array(
                cell(0, "columnHeader", F.lit("name"), row=F.lit(0)),
                cell(1, "columnHeader", F.lit("type & brand"), 2, row=F.lit(0)),
            )
        ),
    )
    return body.unionByName(head)


@query(
    "tables_to_html",
    """SELECT p_partkey // 25 AS table_id,
              '<table><tr><th>name</th><th colSpan=2>type &amp; brand</th></tr>' || string_agg(
                '<tr><th>' || p_name || '</th><td>&lt;&quot;' || p_type || '&#x27;&gt; &amp; more</td><td>' || p_brand ||
                '</td></tr>', '' ORDER BY p_partkey) || '</table>' AS html
       FROM part GROUP BY 1""",
)
def tables_to_html(t):
    return docs.tables_to_html(_cells(t), ["table_id"])


@query(
    "inline_tables",
    """SELECT doc_id, md5(CASE WHEN length(text) >= 80 THEN
                 substr(text, 1, 10) || '<table>' || lang || '</table>' || substr(text, 31, 10) || substr(text, 51, 10)
                 || '<table>' || source || '</table>' || substr(text, 81) ELSE text END || ' ') AS text_id,
              length(CASE WHEN length(text) >= 80 THEN text ELSE '' END) > 0 AS has_tables FROM documents""",
)
def inline_tables(t):
    pages = t.documents.select("doc_id", "text", "lang", "source")
    html = lambda c: F.concat(F.lit("<table>"), F.col(c), F.lit("</table>"))

    def span(table: int, start: int, length: int, content: str):
        return F.struct(
            F.lit(table).alias("table_id"), F.lit(start).alias("start"), F.lit(length).alias("length"), html(content).alias("html")
        )

    spans = pages.where(F.length("text") >= 80).select(
        "doc_id", F.inline(F.array(span(0, 10, 20, "lang"), span(0, 40, 10, "lang"), span(1, 60, 20, "source")))
    )
    inlined = docs.inline_tables(pages.select("doc_id", "text", (F.length("text") >= 80).alias("has_tables")), spans, ["doc_id"])
    return inlined.select("doc_id", F.md5("text").alias("text_id"), "has_tables")


@query(
    "html_to_markdown",
    r"""WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(html, '<head>.*?</head>', '', 'gs'), '<!--.*?-->', '', 'gs') AS h FROM pages),
         l AS (SELECT page_id, url, regexp_replace(h, '<li><a href="([^"]*)">(.*?)</a></li>', chr(10) || '* [\2](\1)', 'gs') AS h FROM a),
         b AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(l.h, '<h1>', chr(10) || chr(10) || '# ', 'g'),
                 '</?b>', '**', 'g'), '<br>', '  ' || chr(10), 'g') AS h FROM l),
         c AS (SELECT page_id, url, regexp_replace(regexp_replace(h, '</?(p|div|h1|ul|article|nav|footer)( [^>]*)?>', chr(10) || chr(10), 'g'), '<[^>]*>', '', 'g') AS h FROM b),
         d AS (SELECT page_id, url, replace(replace(replace(replace(replace(replace(replace(h, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
                 '&#x27;', chr(39)), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&') AS h FROM c)
       SELECT page_id, url AS filename, trim(regexp_replace(h, '[ \t]*\n[ \t]*\n[ \t\n]*', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10)) AS content FROM d""",
)
def html_to_markdown(t):
    pages = docs.spread(t.pages)
    return pages.select("page_id", F.col("url").alias("filename"), docs.to_markdown("html").alias("content"))


@query(
    "document_markdown",
    rf"""WITH p AS {_PAGES},
        r AS (SELECT doc_id, page, CASE WHEN length(p.text) >= 40 THEN
                       substr(p.text, 1, 10) || chr(10) || chr(10) || '| lang | ' || lang || ' |' || chr(10) || '| --- | --- |' || chr(10) ||
                       '| page | ' || page || ' |' || chr(10) || chr(10) || substr(p.text, 21) ELSE p.text END || ' ' AS md,
                     CASE WHEN length(p.text) >= 40 THEN length(p.text) - 10 + length('<table><tr><th>lang</th><th>' || lang ||
                       '</th></tr><tr><td>page</td><td>' || page || '</td></tr></table>') ELSE length(p.text) END + 1 AS n
              FROM p JOIN documents USING (doc_id)),
        o AS (SELECT *, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY page) - n AS BIGINT) AS pos FROM r)
       SELECT doc_id, md5(trim(regexp_replace(regexp_replace(string_agg(md, '' ORDER BY page), '<[^>]*>', '', 'g'),
                '[ \t]*\n[ \t]*\n[ \t\n]*', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10))) AS text_id,
              string_agg(page || ':' || pos, ',' ORDER BY page) AS page_map
       FROM o GROUP BY doc_id""",
)
def document_markdown(t):
    """Pages with a two-row table each, one markdown row per document."""
    pages = docs.split_pages(t.documents, "doc_id", "text")
    labelled = pages.where(F.length("text") >= 40).join(t.documents.select("doc_id", "lang"), "doc_id")

    def cell(row: int, col: int, kind: str, content):
        named = {"row": F.lit(row), "col": F.lit(col), "kind": F.lit(kind), "content": content, "row_span": F.lit(1), "col_span": F.lit(1)}
        return F.struct(*[c.alias(n) for n, c in named.items()])

    cells = labelled.select(
        "doc_id",
        "page",
        F.inline(
            F.array(
                cell(0, 0, "columnHeader", F.lit("lang")),
                cell(0, 1, "columnHeader", F.col("lang")),
                cell(1, 0, "content", F.lit("page")),
                cell(1, 1, "content", F.col("page").cast("string")),
            )
        ),
    )
    tables = docs.tables_to_html(cells, ["doc_id", "page"])
    spans = tables.select("doc_id", "page", F.lit(0).alias("table_id"), F.lit(10).alias("start"), F.lit(10).alias("length"), "html")
    found = docs.document_markdown(pages, spans, "doc_id", "page")
    entries = F.transform("page_map", lambda m: F.concat_ws(":", m["page"], m["offset"]))
    return found.select("doc_id", F.md5("content").alias("text_id"), F.array_join(entries, ",").alias("page_map"))
