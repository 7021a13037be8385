"""Selectors with combinators against a tree walked node by node."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from curiomill.operators.elements import number, parse_steps, select_texts

SELECTORS = {
    "a": "div p", "b": "div > p", "c": ".x .y", "d": "ul.next > a", "e": "div.x > p .y, #k > i", "f": "i", "g": "div div > b.x", "h": "p[t='a > b, c']",
}
CHAINS = {
    "a": [[("div", ""), (" ", "p", "")]], "b": [[("div", ""), (">", "p", "")]], "c": [[("", "x"), (" ", "", "y")]], "d": [[("ul", "next"), (">", "a", "")]],
    "e": [[("div", "x"), (">", "p", ""), (" ", "", "y")], [("", "#k"), (">", "i", "")]], "f": [[("i", "")]], "g": [[("div", ""), (" ", "div", ""), (">", "b", "x")]],
}


def _tree(rng, depth):
    tag = rng.choice(["div", "b", "i", "ul", "a", "p"] if depth else ["div"])
    node = {"tag": tag, "cls": rng.sample(["x", "y", "next"], rng.randrange(3)), "id": rng.choice(["k", ""]), "kids": []}
    for _ in range(rng.randrange(4) if depth < 5 and tag != "p" else rng.randrange(2)):
        if rng.random() < 0.3 or tag == "p":
            node["kids"].append(rng.choice(["one", " two ", "&amp;3", "\n"]))
        else:
            node["kids"].append(_tree(rng, depth + 1))
    return node


def _html(node):
    if isinstance(node, str):
        return node
    return f'<{node["tag"]} class="{" ".join(node["cls"])}" id="{node["id"]}">{"".join(map(_html, node["kids"]))}</{node["tag"]}>'


def _text(node):
    return node.replace("&amp;", "&") if isinstance(node, str) else "".join(map(_text, node["kids"]))


def _fits(node, tag, cls):
    return (not tag or node["tag"] == tag) and (not cls or (node["id"] == cls[1:] if cls[0] == "#" else cls in node["cls"]))


def _match(path, chain):
    *_, last = chain
    if not _fits(path[-1], *last[-2:]):
        return False
    if len(chain) == 1:
        return True
    ups = [path[:-1]] if last[0] == ">" else [path[:i] for i in range(1, len(path))]
    return any(up and _match(up, chain[:-1]) for up in ups)


def _walk(node, path=()):
    path = (*path, node)
    yield path
    for kid in node["kids"]:
        if not isinstance(kid, str):
            yield from _walk(kid, path)


def test_selectors_against_a_tree(spark):
    rng = random.Random(5)
    trees = [_tree(rng, 0) for _ in range(120)]
    rows = [(i, _html(t), "kept") for i, t in enumerate(trees)] + [(900, None, "kept"), (901, "", "kept"), (902, _html(trees[0]), "kept"), (None, "<i>n", "kept")]
    made = select_texts(spark.createDataFrame(rows, "k int, html string, page string"), SELECTORS).collect()
    assert len(made) == len(rows)
    by = {r.k: r for r in made}
    found = 0
    for i, t in [*enumerate(trees), (902, trees[0])]:
        for name, chains in CHAINS.items():
            want = [" ".join(_text(p[-1]).split()) for p in _walk(t) if any(_match(p, c) for c in chains)]
            assert by[i][name] == want, (SELECTORS[name], rows[i % 900])
            found += bool(want)
    assert found > 150
    assert by[900].f == by[901].f == by[0].h == [] and by[None].f == ["n"] and by[900].page == "kept"


@pytest.mark.parametrize(
    ("html", "selector", "texts"),
    [
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "ul > li", ["a", "bc", "c", "d"]),
        ("<p>a<p>b<div>c</div>", "p", ["a", "b"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>x", "tr > td", ["1", "2", "3"]),
        ("<div><b>x</div>y</b>z", "b", ["x"]),
        ("<div><br>a<img src=x>b</div>", "div", ["ab"]),
        ("a < b <i>c</i> <", "i", ["c"]),
        ("<I CLASS='q'>c</I><!-- <i>no</i> -->", "i.q", ["c"]),
        ("<i>a</i><i", "i", ["a"]),
        ("<p t='a'>x</p>", "p[t='a'] , p", ["x"]),
        ("<div><p><b>x &lt; y</b>  z</p></div>", "div>p", ["x < y z"]),
    ],
)
def test_loose_mark_up(spark, html, selector, texts):
    frame = spark.createDataFrame([(html,)], "html string")
    assert select_texts(frame, {"t": selector}).first().t == texts


def test_steps():
    assert parse_steps("ul.next > a, .p  q") == [[("", "ul.next"), (">", "a")], [("", ".p"), (" ", "q")]]
    for bad in ("", "> a", "a >", "a,,b", "a > > b", "a + b", "a:hover", "a,"):
        with pytest.raises(ValueError):
            parse_steps(bad)


def test_column_names_clash(spark):
    with pytest.raises(ValueError):
        select_texts(spark.createDataFrame([("x",)], "html string"), {"HTML": "a"})


def test_no_pages(spark):
    assert select_texts(spark.createDataFrame([], "html string"), {"t": "a b"}).count() == 0


@pytest.mark.parametrize("html", ["<p x=\"" * 100_000, "<a " * 200_000, "<div>" * 100_000, "<li><ul>" + "<b>" * 50_000 + "<li></li>" * 50_000, "</i>" * 200_000, "<" * 500_000])
def test_numbering_is_linear(html):
    begin = time.time()
    number(html)
    assert time.time() - begin < 5


def test_steps_make_no_pairs(spark):
    plan = select_texts(spark.createDataFrame([("x",)], "html string"), {"t": "div div"}).select(F.size("t"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text
