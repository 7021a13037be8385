"""The selector families in use, turned into patterns for one opening tag.

Covered: ``tag``, ``.class``, ``#id``, ``[attr]``, ``[attr="v"]``, ``[attr*="v"]`` and compounds of them.
A page is scanned once for the tags that any selector of a cascade could want; each selector is then tested on
that short array, so the page text is not scanned again for every selector.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from curiomill.functions.text import decode_entities, once, strip

_PART = re.compile(r"""\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>\*?=)["'](?P<val>[^"']*)["'])?\]""")


def split_selector(selector: str) -> tuple[str, list[tuple[str, str, str]]]:
    """Tag name and (kind, name, value) conditions of a compound selector."""
    tag = re.match(r"[A-Za-z][A-Za-z0-9]*", selector)
    rest = selector[tag.end():] if tag else selector
    parts, seen = [], 0
    for m in _PART.finditer(rest):
        if m.start() != seen:
            break
        seen = m.end()
        if m["cls"]:
            parts.append(("class", "class", m["cls"]))
        elif m["id"]:
            parts.append(("equals", "id", m["id"]))
        else:
            kind = {None: "has", "=": "equals", "*=": "contains"}[m["op"]]
            parts.append((kind, m["attr"], m["val"] or ""))
    if seen != len(rest) or not (tag or parts):
        raise ValueError(f"unsupported selector: {selector!r}")
    return (tag.group(0) if tag else ""), parts


def tag_pattern(selector: str) -> str:
    """Pattern that an opening tag matching the selector starts with."""
    tag, parts = split_selector(selector)
    pattern = "^<" + (f"(?i:{tag})" if tag else r"[A-Za-z][^\s>/]*") + r"(?=[\s>/])"
    for kind, name, value in parts:
        v = re.escape(value)
        attr = rf"(?=[^>]*\s(?i:{re.escape(name)})"
        if kind == "has":
            pattern += attr + r"(?=[\s=>/]))"
        elif kind == "equals":
            pattern += attr + rf"""\s*=\s*(?:"{v}"|'{v}'|{v}(?=[\s>/])))"""
        elif kind == "contains":
            pattern += attr + rf"""\s*=\s*(?:"[^"]*{v}|'[^']*{v}))"""
        else:
            pattern += attr + rf"""\s*=\s*(?:"(?:[^"]*\s)?{v}(?:\s[^"]*)?"|'(?:[^']*\s)?{v}(?:\s[^']*)?'|{v}(?=[\s>/])))"""
    return pattern


def node_pattern(selectors: Iterable[str]) -> str:
    """Pattern of an opening tag plus its direct text, for tags that some selector may want."""
    tags, hints = set(), set()
    for tag, parts in map(split_selector, selectors):
        if parts:
            kind, name, value = parts[-1]
            hints.add(name if kind == "has" else value)
        else:
            tags.add(tag)
    hints = {h for h in hints if not any(o != h and o in h for o in hints)}
    wanted = []
    if tags:
        wanted.append("(?i:" + "|".join(sorted(tags)) + r")(?=[\s>/])")
    if hints:
        wanted.append("[A-Za-z](?=[^>]*(?:" + "|".join(re.escape(h) for h in sorted(hints)) + "))")
    return "<(?:" + "|".join(wanted) + ")[^>]*>[^<]*"


def nodes(dom: Column, selectors: Iterable[str]) -> Column:
    """Array of (tag, text) in document order; text is what stands before the first child."""
    raw = F.transform(
        F.regexp_extract_all(dom, F.lit(node_pattern(selectors)), F.lit(0)),
        lambda t: F.struct(F.substring_index(t, ">", 1).alias("tag"), F.regexp_extract(t, r"(?s)^[^>]*>(.*)$", 1).alias("text")),
    )
    return F.transform(raw, lambda n: F.struct(n["tag"].alias("tag"), strip(decode_entities(n["text"])).alias("text")))


def matches(node_array: Column, selector: str) -> Column:
    """Texts of the nodes that the selector matches."""
    pattern = tag_pattern(selector)
    hit = F.filter(node_array, lambda n: F.concat(n["tag"], F.lit(">")).rlike(pattern))
    return F.transform(hit, lambda n: n["text"])


def first_text(node_array: Column, selectors: Iterable[str], size: int = 0, longer_than: int | None = None) -> Column:
    """Text of the first node of the first selector that fits.

    Without ``longer_than`` a selector fits as soon as it matches a node, even an empty one.
    """
    options = []
    for selector in selectors:
        text = F.get(matches(node_array, selector), F.lit(0))
        if size:
            text = F.substring(text, 1, size)
        options.append(text if longer_than is None else once(text, lambda t: F.when(F.length(t) > longer_than, t)))
    return F.coalesce(*options)


def joined_text(
    node_array: Column,
    selectors: Iterable[str],
    take: int,
    separator: str = " ",
    size: int = 0,
    longer_than: int = 0,
    drop_empty: bool = True,
) -> Column:
    """Joined texts of the first nodes of the first selector that gives enough text."""
    options = []
    for selector in selectors:
        texts = F.slice(matches(node_array, selector), 1, take)
        if drop_empty:
            texts = F.filter(texts, lambda t: t != "")
        text = F.array_join(texts, separator)
        options.append(once(F.substring(text, 1, size) if size else text, lambda t: F.when(F.length(t) > longer_than, t)))
    return F.coalesce(*options)
