"""Tables of HTML pages, by tags and a stack of open elements."""

from __future__ import annotations

import re
from html import unescape

#: A tag from its name to its end; a sign ``>`` within a quoted value doesn't end it.
REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>"""
#: What is no text: comments, scripts and styles to their end or the page's, tags, declarations.
MARKUP = rf"<!--.*?(?:-->|\z)|<(script|style)\b{REST}.*?(?:</\1\s*>|\z)|</?[a-z]{REST}|<[!?][^>]*>"
_MARKUP = re.compile(MARKUP.replace(r"\z", r"\Z"), re.IGNORECASE | re.DOTALL)
_NAME = re.compile(r"<(/?)([a-z][a-z0-9]*)", re.IGNORECASE)
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)


def tables(page: str) -> list[list[dict]]:
    """Tables in the order of their start; a row has cells (kind th or td, text) and the first link in it.

    A table within a cell is a table of its own, and its text is the cell's too. A row or cell ends
    where the next one of its table starts, and all that is open where its table or the page ends.
    """
    out: list[list[dict]] = []
    open_: list[dict] = []  # tables, each with its row and cell, if one is open

    def add(text: str) -> None:
        for t in open_:
            if t["cell"] is not None:
                t["cell"]["text"].append(text)

    at = 0
    for m in [*_MARKUP.finditer(page), None]:
        text = page[at : m.start() if m else len(page)]
        if text:
            add(unescape(text))
        if m is None:
            break
        at = m.end()
        tag = _NAME.match(m[0])
        if not tag:
            continue
        end, name, top = bool(tag[1]), tag[2].lower(), open_[-1] if open_ else None
        if name == "table" and not end:
            rows: list[dict] = []
            out.append(rows)
            open_.append({"rows": rows, "row": None, "cell": None})
        elif top is None:
            continue
        elif name == "table":
            open_.pop()
        elif name == "tr":
            top["row"] = top["cell"] = None
            if not end:
                top["row"] = {"cells": [], "link": None}
                top["rows"].append(top["row"])
        elif name in ("td", "th"):
            top["cell"] = None
            if not end:
                if top["row"] is None:
                    top["row"] = {"cells": [], "link": None}
                    top["rows"].append(top["row"])
                top["cell"] = {"kind": name, "text": []}
                top["row"]["cells"].append(top["cell"])
        elif name == "a" and not end and (link := _HREF.search(m[0])):
            for t in open_:
                if t["row"] is not None and t["row"]["link"] is None:
                    t["row"]["link"] = unescape(next(x for x in link.groups() if x is not None))
        else:
            add(" ")
    for rows in out:
        for row in rows:
            for cell in row["cells"]:
                cell["text"] = " ".join("".join(cell["text"]).split())
    return out


def rows_under(page: str | None, header: str) -> list[dict]:
    """Rows (cells by header name, link) of the first table that has a header cell of that name."""
    if page is None or header not in page:
        return []
    for rows in tables(page):
        names = next((n for r in rows if header in (n := [c["text"] for c in r["cells"] if c["kind"] == "th"])), None)
        if names is not None:
            cells = [([c["text"] for c in r["cells"] if c["kind"] == "td"], r["link"]) for r in rows]
            return [{"cells": dict(zip(names, c, strict=False)), "link": link or None} for c, link in cells if c]
    return []
