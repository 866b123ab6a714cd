"""A host's template comes from all of its pages, however their hashes fall."""

import random

import xxhash

from policylake.llm import pages


def eighth(html):
    """The hash that deals pages out, and one of eight parts by it."""
    h = xxhash.xxh64_intdigest(html.encode(), 42)
    h -= (h >> 63) << 64
    return (h >> 8) % 8, h


def page(rng, note):
    story = "".join(f"<p>{' '.join(f'w{rng.randint(0, 5000)}' for _ in range(25))}</p>" for _ in range(3))
    return f"<body><div class=m>Terms of this site</div>{story}<div class=z>{note}</div></body>"


def texts(spark, html):
    rows = [(k, f"http://site.example/{k}", h) for k, h in enumerate(html)]
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(html)
    return {r.page_id: r.text.split("\n") for r in found}


def test_pages_of_one_part_of_the_hashes_have_a_template(spark):
    rng = random.Random(3)
    html = [p for p in (page(rng, "Made by us") for _ in range(200)) if eighth(p)[0] == 5][:6]
    assert len(html) == 6
    assert all("Terms of this site" not in t and "Made by us" not in t and len(t) == 3 for t in texts(spark, html * 2).values())


def test_what_varies_beyond_eight_pages_is_no_template(spark):
    rng = random.Random(4)
    least = {}
    for p in (page(rng, "Sale this week") for _ in range(100)):
        part, h = eighth(p)
        least[part] = min(least.get(part, (h, p)), (h, p))
    others = [page(rng, f"Story number {k} by reporter {rng.randint(0, 9999)}") for k in range(300)]
    html = [p for _, p in least.values()] + [p for p in others if eighth(p)[1] > least[eighth(p)[0]][0]]
    assert len(html) > 100
    found = texts(spark, html)
    assert all("Terms of this site" not in t for t in found.values())
    assert sum("Sale this week" in t for t in found.values()) == 8 and all(len(t) == 4 for t in found.values())
