"""A self-contained HTML report of published tables: the first rows of each, with a search box."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame

ROWS = 200  # a report's tables are extracts


def _table(name: str, df: DataFrame) -> str:
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{'' if x is None else html.escape(str(x))}</td>" for x in r) + "</tr>" for r in df.limit(ROWS).collect())
    return f"<section><h2>{html.escape(name)}</h2><input placeholder='search' oninput='find(this)'><table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table></section>"


def html_report(title: str, tables: dict[str, DataFrame]) -> str:
    script = "function find(i){for(const r of i.parentNode.querySelectorAll('tbody tr'))r.hidden=!r.textContent.toLowerCase().includes(i.value.toLowerCase())}"
    return f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><script>{script}</script><h1>{html.escape(title)}</h1>" + "".join(_table(k, v) for k, v in tables.items())
