"""An HTML report from small result tables.

Every figure table is stored whole and linked. The page shows the first rows of each,
up to a parameter: most figure tables are aggregates that fit.
"""

from __future__ import annotations

import html
from pathlib import Path
from string import Template

from pyspark.sql import DataFrame

SHOWN_ROWS = 5000

_PAGE = Template(
    """<!doctype html><html><head><meta charset="utf-8"><title>$title</title>
<style>body{font-family:sans-serif;margin:2em}table{border-collapse:collapse}
td,th{border:1px solid #ccc;padding:2px 8px;text-align:right}</style></head>
<body><h1>$title</h1>$summary$sections</body></html>"""
)


def _table(name: str, description: str, df: DataFrame, stored: str, shown: int) -> str:
    rows = df.limit(shown + 1).collect()
    where = html.escape(stored)
    head = f"<h2>{html.escape(name)}</h2><p>{html.escape(description)}</p>"
    head += f'<p><a href="{where}">whole table</a></p>'
    if len(rows) > shown:
        head += f"<p>The first {shown} rows follow.</p>"
    cells = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join(
        "<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in row) + "</tr>" for row in rows[:shown]
    )
    return head + f"<table><tr>{cells}</tr>{body}</table>"


def write_report(
    path: str,
    title: str,
    figures: dict[str, DataFrame],
    descriptions: dict[str, str] | None = None,
    summary: dict[str, object] | None = None,
    stored_at: str | None = None,
    shown: int = SHOWN_ROWS,
) -> None:
    """Store the figures in ``stored_at`` (default: beside the page) and write the page."""
    stored_at = stored_at or f"{path}.tables"
    export_figures(figures, stored_at)
    descriptions = descriptions or {}
    head = "".join(
        f"<p><b>{html.escape(str(k))}</b>: {html.escape(str(v))}</p>" for k, v in (summary or {}).items()
    )
    sections = "".join(
        _table(name, descriptions.get(name, ""), df, f"{stored_at}/{name}", shown)
        for name, df in figures.items()
    )
    Path(path).write_text(_PAGE.substitute(title=html.escape(title), summary=head, sections=sections))


def export_figures(figures: dict[str, DataFrame], folder: str) -> None:
    """Every figure table as its own file set."""
    for name, df in figures.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
