"""Row and table rendering: Markdown, CSV, HTML, ``key: value`` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md_line(cells: Column) -> Column:
    """``| a | b |`` from ``array<string>`` (null cell -> empty)."""
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda c: F.coalesce(c, F.lit(""))), " | "),
                    F.lit(" |"))


def md_separator(n: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), n), " | "), F.lit(" |"))


def table_markdown(table: Column) -> Column:
    """``array<array<string>>`` (first row = header) -> Markdown; fewer than
    two rows gives ``""``."""
    header = F.element_at(table, 1)
    body = F.slice(table, 2, F.greatest(F.size(table) - 1, F.lit(0)))
    lines = F.concat(F.array(md_line(header), md_separator(F.size(header))), F.transform(body, md_line))
    return F.when(F.coalesce(F.size(table), F.lit(0)) < 2, F.lit("")).otherwise(F.array_join(lines, "\n"))


def csv_field(c: Column) -> Column:
    """One CSV field: quoted (quotes doubled) when it holds a comma, quote,
    CR or LF; null is empty."""
    v = F.coalesce(c, F.lit(""))
    needs = v.contains(",") | v.contains('"') | v.contains("\r") | v.contains("\n")
    return F.when(needs, F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))) \
            .otherwise(v)


def csv_line(cells: Column) -> Column:
    return F.array_join(F.transform(cells, csv_field), ",")


def html_escape(c: Column) -> Column:
    v = F.coalesce(c, F.lit(""))
    # literal replacements (no regex engine per cell)
    return F.replace(F.replace(F.replace(v, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def html_row(cells: Column, tag: str = "td") -> Column:
    return F.concat(F.lit("<tr>"), F.array_join(F.transform(
        cells, lambda c: F.concat(F.lit(f"<{tag}>"), html_escape(c), F.lit(f"</{tag}>"))), ""), F.lit("</tr>"))


def table_csv(table: Column) -> Column:
    """Header + rows, each line ending in ``\\n``."""
    return F.concat(F.array_join(F.transform(table, csv_line), "\n"), F.lit("\n"))


def table_html(table: Column) -> Column:
    header = F.element_at(table, 1)
    body = F.slice(table, 2, F.greatest(F.size(table) - 1, F.lit(0)))
    return F.concat(F.lit("<table><thead>"), html_row(header, "th"), F.lit("</thead><tbody>"),
                    F.array_join(F.transform(body, lambda r: html_row(r)), ""), F.lit("</tbody></table>"))
