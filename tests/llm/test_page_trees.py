"""Tree matching against the plain recursion, on deep pages and on long flat ones."""

import random

from policylake.llm import pages


def plain_weight(x, y):
    if x.label != y.label:
        return 0
    own = 2 if x.attrs["#text"] == y.attrs["#text"] else 1
    best = [[0] * (len(y.children) + 1) for _ in range(len(x.children) + 1)]
    for i, c in enumerate(x.children):
        for j, d in enumerate(y.children):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + plain_weight(c, d))
    return own + best[-1][-1]


def tree(rng, depth):
    node = pages.Node(rng.choice(["div", "div", "p"]), {"#text": rng.choice("abc")})
    node.children += [tree(rng, depth - 1) for _ in range(rng.randint(0, 5))] if depth else []
    return node


def test_matching_weighs_the_same_as_the_recursion(monkeypatch):
    rng = random.Random(4)
    for cells in (250_000, 2):
        monkeypatch.setattr(pages, "CELLS", cells)
        for _ in range(150):
            a, b = tree(rng, 3), tree(rng, 3)
            b.tag = a.tag
            found = pages.matched(a, b)
            assert sum(2 if x.attrs["#text"] == y.attrs["#text"] else 1 for x, y in found) == plain_weight(a, b)
            assert len({id(x) for x, _ in found}) == len({id(y) for _, y in found}) == len(found)
    assert pages.matched(pages.Node("p", {"#text": ""}), pages.Node("div", {"#text": ""})) == []


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_deep_pages():
    rng = random.Random(1)
    html = [f"<html><body><div>menu of all</div>{'<div>' * 5000}<p>{words(rng, 60)}</p>{'</div>' * 5000}</body></html>" for _ in range(6)]
    template = set(pages.induce(html))
    assert all(len(pages.main_text(h, template).split()) == 60 for h in html)


def test_long_flat_pages():
    """150 fixed lines among 600 blocks and more are template, though the stories begin with a few more blocks on some pages."""
    rng = random.Random(2)
    html, own = [], []
    for page in range(5):
        rows, story = [], []
        for k in range(150):
            new = [words(rng, 12) for _ in range(3 + (page if k == 70 else 0))]
            rows += [f"fixed line {k} of the host", *new]
            story += new
        html.append("<html><body>" + "".join(f"<p>{r}</p>" for r in rows) + "</body></html>")
        own.append(story)
    template = set(pages.induce(html))
    assert [pages.main_text(h, template).split("\n") for h in html] == own
