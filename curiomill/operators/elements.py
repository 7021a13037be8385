"""Selectors with combinators, by interval-numbered elements.

Each page becomes rows of elements in pre-order: an element is numbered ``first`` and what it contains ``first + 1`` to
``last``, and its text is a slice of the page's text. Tests of a single tag filter those rows. A descendant is found in
one ordered pass over the rows of a page (some element of the step before, seen earlier, still lasts), a child in one
pass over the rows that share a parent. So a step is a sort of the rows that any selector wants; nested pages give no
pairs of ancestors and descendants, and the page text travels once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curiomill.functions.html import dom
from curiomill.functions.selectors import split_selector, tag_pattern
from curiomill.functions.text import decode_entities, strip

# fixed values: elements without content, and end tags that mark-up may leave out
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {
    "li": ("li",), "option": ("option",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"),
    "tr": ("tr", "td", "th"), **dict.fromkeys("p div ul ol table section article h1 h2 h3 h4 h5 h6 form dl pre".split(), ("p",)),
}
SCOPES = frozenset("ul ol dl table select div section article body".split())

PAGES_A_TASK = 2_000
ELEMENTS = "page string, first int, last int, parent int, start int, size int, head string, text string"
TAG = re.compile(r"</?([A-Za-z][^\s>/]*)")


def number(html: str) -> tuple[list[tuple[int, int, int, int, int, str]], str]:
    """Elements of a page as (first, last, parent, start, size, opening tag without its ``>``), and the page's text.

    Elements without an end tag end with what holds them, or where mark-up lets them; end tags of nothing are left out.
    A ``<`` that opens no tag, or a tag that never ends, is text.
    """
    rows: list[list] = []
    texts: list[str] = []
    open_: list[tuple[str, int]] = []  # tag, row
    held = Counter()
    scopes = [Counter()]  # open tags by the innermost scope that holds them
    at = size = 0

    def close() -> str:
        tag, row = open_.pop()
        if tag in SCOPES:
            scopes.pop()
        held[tag] -= 1
        scopes[-1][tag] -= 1
        rows[row][1], rows[row][4] = len(rows) - 1, size - rows[row][3]
        return tag

    while at < len(html):
        begin = html.find("<", at)
        found = TAG.match(html, begin) if begin >= 0 else None
        mark = begin >= 0 and html[begin + 1 : begin + 2] in ("!", "?")
        end = html.find(">", begin) if found or mark else -1
        upto = len(html) if begin < 0 or ((found or mark) and end < 0) else begin if end >= 0 else begin + 1
        texts.append(html[at:upto])
        size += upto - at
        at = upto if end < 0 else end + 1
        if end < 0 or not found:
            continue
        tag = found[1].lower()
        if html[begin + 1] == "/":
            if held[tag]:
                while close() != tag:
                    pass
            continue
        ends = CLOSES.get(tag, ())
        while any(scopes[-1][t] for t in ends):
            close()
        rows.append([len(rows), len(rows), open_[-1][1] if open_ else -2, size, 0, html[begin:end]])
        if tag not in VOID:
            open_.append((tag, len(rows) - 1))
            held[tag] += 1
            scopes[-1][tag] += 1
            if tag in SCOPES:
                scopes.append(Counter())
    while open_:
        close()
    return [tuple(r) for r in rows], "".join(texts)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each element, and one with the text, numbered -1."""
    names = [c.split()[0] for c in ELEMENTS.split(", ")]
    kinds = [pa.string() if " string" in c else pa.int32() for c in ELEMENTS.split(", ")]
    for batch in batches:
        for page, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows, text = number(html)
            whole = [(page, *r, None) for r in rows] + [(page, -1, -1, -1, 0, 0, None, text)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*whole, strict=True), kinds, strict=True)], names)


def elements(doms: DataFrame) -> DataFrame:
    """Rows ``ELEMENTS`` of the pages (page, html), html without nulls."""
    return doms.select("page", "html").mapInArrow(_number, ELEMENTS)


STEP = re.compile(r"""\s*(>|,|(?<=\S)\s(?=\s*[^\s>,]))\s*|((?:\[[^\]"']*(?:"[^"]*"|'[^']*')?\s*\]|[^\s>,\[])+)""")


def parse_steps(selector: str) -> list[list[tuple[str, str]]]:
    """Alternatives of a selector list, each the steps (combinator, compound): "" first, then " " or ">"."""
    options: list[list[tuple[str, str]]] = [[]]
    link = ""
    seen = 0
    text = selector.strip()
    for m in STEP.finditer(text):
        if m.start() != seen:
            break
        seen = m.end()
        if m[2]:
            split_selector(m[2])
            options[-1].append((link or " " if options[-1] else "", m[2]))
            link = ""
        elif m[1] == ",":
            if link == ">" or not options[-1]:
                break
            options.append([])
        elif link == ">" or (m[1] == ">" and not options[-1]):
            break
        else:
            link = m[1]
    else:
        if seen == len(text) and options[-1] and not link.strip():
            return options
    raise ValueError(f"unsupported selector: {selector!r}")


def _is(compound: str) -> Column:
    return F.coalesce(F.concat("head", F.lit(">")).rlike(tag_pattern(compound)), F.lit(False))


def selected(rows: DataFrame, selectors: dict[str, str], tasks: int | None = None) -> DataFrame:
    """Element rows that a selector gives or needs, and the text rows, with a boolean column for each selector.

    ``tasks`` deals the pages out over so many; else Spark joins tasks by packed bytes, in which mark-up is far smaller.
    """
    options = {name: parse_steps(s) for name, s in selectors.items()}
    compounds = sorted({c for steps in options.values() for option in steps for _, c in option})
    mark = {c: f"is_{i}" for i, c in enumerate(compounds)}
    rows = rows.select("page", "first", "last", "parent", "start", "size", "text", *[_is(c).alias(m) for c, m in mark.items()])
    rows = rows.filter(F.expr(" OR ".join(["first = -1", *mark.values()])))
    if tasks is not None:
        rows = rows.repartition(tasks, "page")
    before = Window.partitionBy("page").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    family = Window.partitionBy("page", "meets")
    columns = [*rows.columns]
    for name, steps in options.items():
        ways = []
        for n, option in enumerate(steps):
            flag = F.col(mark[option[0][1]])
            for k, (link, compound) in enumerate(option[1:]):
                got = f"way_{name}_{n}_{k}"
                if link == " ":
                    lasts = F.max(F.when(flag, F.col("last"))).over(before)
                    rows = rows.withColumn(got, F.coalesce(F.col(mark[compound]) & (lasts >= F.col("first")), F.lit(False)))
                else:
                    # each row twice: as a child among its siblings, and as the parent that they meet
                    both = F.explode(F.array(F.struct(F.lit(True).alias("child"), F.col("parent").alias("meets")), F.struct(F.lit(False).alias("child"), F.col("first").alias("meets"))))
                    rows = rows.withColumn("before", flag).select("*", both.alias("role")).select("*", "role.child", "role.meets").drop("role")
                    fits = F.max(F.when(~F.col("child"), F.col("before"))).over(family)
                    rows = rows.withColumn(got, F.coalesce(F.col(mark[compound]) & fits, F.lit(False))).filter("child").drop("child", "meets", "before")
                flag = F.col(got)
            ways.append(flag)
        any_way = ways[0]
        for way in ways[1:]:
            any_way = any_way | way
        rows = rows.withColumn(name, any_way)
        columns.append(name)
        rows = rows.select(*columns)
    return rows.drop(*mark.values())


def select_texts(pages: DataFrame, selectors: dict[str, str], html_col: str = "html") -> DataFrame:
    """``pages`` with an array of texts for each named selector: the whole text of each element, in page order.

    Selectors are lists of compounds (``tag``, ``.class``, ``#id``, ``[attr]``, ``[attr="v"]``, ``[attr*="v"]``) joined by
    blanks for descendants and ``>`` for children. Texts are decoded, white space is one blank, ends are trimmed. Equal
    pages are read once; a null page gives empty arrays. A tag ends at its first ``>``. A selector may not have the name
    of a column of ``pages``.
    """
    taken = {c.lower() for c in pages.columns} & {n.lower() for n in selectors}
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    names = {f"found_{i}": s for i, s in enumerate(selectors.values())}
    page = F.sha2(F.coalesce(F.col(html_col), F.lit("")), 256)
    doms = pages.filter(F.col(html_col).isNotNull()).select(page.alias("page"), F.col(html_col).alias("html")).dropDuplicates(["page"])
    tasks = max(1, -(-pages.count() // PAGES_A_TASK))
    rows = selected(elements(doms.select("page", dom(F.col("html")).alias("html"))), names, tasks)
    spans = [F.sort_array(F.collect_list(F.when(F.col(n), F.struct("first", "start", "size")))).alias(n) for n in names]
    lists = rows.groupBy("page").agg(F.max("text").alias("text"), *spans)

    def texts(name: str) -> Column:
        return F.transform(
            name, lambda s: strip(F.regexp_replace(decode_entities(F.substring(F.col("text"), s["start"] + 1, s["size"])), r"(?U)\s+", " "))
        )

    key = "_page_of_texts"
    lists = lists.select(F.col("page").alias(key), *[texts(n).alias(n) for n in names])
    out = pages.withColumn(key, F.when(F.col(html_col).isNotNull(), page)).join(lists, key, "left")
    empty = F.array().cast("array<string>")
    return out.select(*pages.columns, *[F.coalesce(F.col(n), empty).alias(name) for n, name in zip(names, selectors, strict=True)])
