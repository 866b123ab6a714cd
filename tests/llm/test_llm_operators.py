"""Operators against brute force, on a fixture with nulls, empty and long texts, copies, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from policylake.llm import contamination, language, lines, mixing, neardup, neighbours, pages, quality, recompression, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def gone(tokens, width):
    """Which tokens of each sequence lie in a window that stands anywhere else."""
    count = Counter(tuple(t[i : i + width]) for t in tokens for i in range(len(t) - width + 1))
    out = []
    for t in tokens:
        mark = [False] * len(t)
        for i in range(len(t) - width + 1):
            if count[tuple(t[i : i + width])] > 1:
                mark[i : i + width] = [True] * width
        out.append(mark)
    return out


@pytest.mark.parametrize("width,order", [(60, 5), (90, 7)])
def test_repeated_bytes(docs, rows, width, order):
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter()
    for r, t, mark in zip(rows, texts, gone(texts, width)):
        spans = sum(a and not b for a, b in zip(mark, [False, *mark]))
        want[(r[0], len(t), bytes(c for c, m in zip(t, mark) if not m), spans)] += 1
    got = suffixes.remove_repeated_bytes(docs, width=width, order=order, block_bytes=3000).collect()
    assert Counter((r.doc_id, r.n_bytes, bytes(r.kept), len(r.spans)) for r in got) == want


def test_difference_cover():
    for order in (2, 3, 5, 7, 11, 13):
        v = order * order + order + 1
        places = suffixes.difference_cover(order).tolist()
        assert len(places) == order + 1 and {(a - b) % v for a in places for b in places} == set(range(v))


@pytest.mark.parametrize("width,rounds", [(10, 2), (35, 4)])
def test_repeated_words(docs, rows, width, rounds):
    texts = [WORD.findall(r[1] or "") for r in rows]
    want = Counter((r[0], len(t), sum(m), " ".join(w for w, x in zip(t, m) if not x)) for r, t, m in zip(rows, texts, gone(texts, width)))
    got = recompression.remove_repeated_words(docs, width=width, rounds=rounds, block_bytes=3000).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == want


@pytest.mark.parametrize("lines_a_task", [4, 1 << 20])
def test_lines(docs, rows, lines_a_task, monkeypatch):
    monkeypatch.setattr(lines, "LINES_A_TASK", lines_a_task)
    blank = " \t\n\x0b\x0c\r"
    split = [(r[0], (r[1] or "").split("\n")) for r in rows]
    holders = defaultdict(set)
    for i, own in split:
        for line in own:
            if i is not None and len(line.strip(blank)) >= 10:
                holders[low(line.strip(blank))].add(i)
    want = Counter()
    for i, own in split:
        kept = [x for x in own if i is None or len(holders[low(x.strip(blank))]) < 2 or min(holders[low(x.strip(blank))]) == i]
        want[(i, len(own), len(own) - len(kept), "\n".join(kept))] += 1
    got = lines.drop_repeated_lines(docs, carry=["source", "keys"]).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == want
    assert {(r.doc_id, r.carried["source"], r.carried["keys"]) for r in got} == {(r[0], r[3], "noise") for r in rows}


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    index = lines.PerfectHash.of(keys)
    again = lines.PerfectHash.unpacked(*index.packed())
    assert sorted(again.index(keys).tolist()) == list(range(len(keys)))


def shingle_set(text):
    w = WORD.findall(low(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("crowd", [4, 32])
def test_near_duplicates(docs, rows, crowd, monkeypatch):
    monkeypatch.setattr(neardup, "CROWD", crowd)
    monkeypatch.setattr(neardup, "CROWD_BLOCK", 8)
    sets = [(r[0], shingle_set(r[1])) for r in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    known = [(i, s) for i, s in sets if i is not None and s]
    for a, (i, s) in enumerate(known):
        for j, t in known[:a]:
            if 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    want = Counter((i, len(s), find(i) if i is not None else None) for i, s in sets)
    got = neardup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_mixture(docs, rows):
    got = [r for r in mixing.mixture(docs, target_entropy=None, most_repeats=None, budget=3000).collect()]
    size = {(r[0], r[3]): len(WORD.findall(r[1] or "")) for r in rows if r[0] is not None}
    tokens = Counter()
    for r in rows:
        if r[0] is not None:
            tokens[r[3]] += len(WORD.findall(r[1] or ""))
    total = sum(tokens.values())
    taken = defaultdict(list)
    for r in got:
        assert r.n_tokens == size[(r.doc_id, r.source)]
        taken[r.source].append(r)
    for source, n in tokens.items():
        own = sorted(taken[source], key=lambda r: (r.epoch, r.block_rank, r.rank_in_block))
        goal = int(n / total * 3000)
        sizes = [r.n_tokens for r in own]
        assert sum(sizes) >= goal and sum(sizes[:-1]) < max(goal, 1)


def test_mixture_reaches_entropy_and_limit(spark):
    rows = [(k, "w " * 10, "big" if k < 900 else f"s{k % 5}") for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixture(docs, target_entropy=0.9, most_repeats=None).groupBy("source").agg(F.first("weight").alias("w"), F.sum("n_tokens").alias("n")).collect()
    w = np.array([r.w for r in out])
    assert abs(-(w * np.log(w)).sum() / np.log(6) - 0.9) < 1e-6 and all(abs(r.n - r.w * 10000) <= 10 for r in out)
    out = mixing.mixture(docs, target_entropy=1.0, most_repeats=3.0).groupBy("source").agg(F.max("epoch").alias("e"), F.first("weight").alias("w")).collect()
    share = {"big": 0.9}
    assert max(r.w / share.get(r.source, 0.02) for r in out) <= 3.0 + 1e-6 and max(r.e for r in out) <= 3


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 16))
    x[100:160] = x[100]
    rows = [(int(k), [float(c) for c in v], "noise", "noise") for k, v in enumerate(x)]
    rows += [(900, None, "", ""), (901, [0.0] * 16, "", ""), (902, [None] + [1.0] * 15, "", ""), (903, [float("nan")] * 16, "", ""), (904, [1.0], "", ""), (None, rows[0][1], "", ""), rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string, members string")
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=10, shard_rows=200).collect()
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        found[r.query_id].append(r.vec_id)
        assert abs(r.score - float(x[r.query_id] @ x[r.vec_id])) < 1e-9
    assert set(found) == set(range(0, 600, 20))
    hit = 0
    for q, ids in found.items():
        score = (x * x[q]).sum(axis=1)
        best = [k for k in np.lexsort((np.arange(600), -score)).tolist() if k != q][:10]
        hit += len(set(best) & set(ids))
    assert hit / (10 * len(found)) >= 0.95
    assert found[100] == list(range(101, 111))


LENGTHS = {
    "unit": lambda rng, x: x / np.linalg.norm(x, axis=1, keepdims=True),
    "log-normal": lambda rng, x: x / np.linalg.norm(x, axis=1, keepdims=True) * np.exp(rng.normal(size=(len(x), 1))),
    "outlier": lambda rng, x: np.concatenate((x[:-1], x[-1:] * 1e4)),
    "clustered": lambda rng, x: x * 0.2 + rng.normal(size=(20, x.shape[1]))[np.arange(len(x)) % 20] * rng.uniform(0.2, 3, size=(len(x), 1)),
}


@pytest.mark.parametrize("kind", sorted(LENGTHS))
def test_neighbours_of_any_length(spark, kind):
    """Recall against brute force where lengths differ much."""
    rng = np.random.default_rng(5)
    x = LENGTHS[kind](rng, rng.normal(size=(1500, 32)))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, shard_rows=600).collect():
        found[r.query_id].add(r.vec_id)
    hit = 0
    for q in range(0, 1500, 20):
        score = x @ x[q]
        score[q] = -np.inf
        hit += len(set(np.argsort(-score)[:20].tolist()) & found[q])
    assert hit / (20 * 75) >= 0.9


def test_neighbours_of_extreme_vectors(spark):
    rows = [(0, [1e160, 1.0]), (1, [1e-170, 1e-170]), (2, [1.0, 0.0]), (3, [-1.0, 0.0]), (4, [1.0, 2.0, 3.0]), (5, [2.0, 1.0, 0.0]), (6, [1e-310, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): r.vec_id for r in neighbours.nearest(df, F.col("vec_id") >= 0).collect()}
    assert [got.get((0, k)) for k in range(1, 6)] == [2, 1, 6, 3, None]
    assert [got.get((4, k)) for k in (1, 2)] == [5, None]  # vectors of three components have each other only
    assert [got.get((2, k)) for k in range(1, 5)] == [0, 1, 6, 3]


def test_quality(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice(["alpha", "beta", "gamma", "delta."]) + str(rng.randint(0, 99)) for _ in range(60)) if k % 3 else "SPAM!! " * 60, "x") for k in range(400)]
    rows += [(None, None, "x"), (1000, "", "x")]
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(400)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string")
    got = quality.score_quality(docs, labels)[0].collect()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert 60 < len(held) < 140 and all(r.predicted == int(r.doc_id % 3 > 0) for r in held)


def test_statistics_are_of_whole_texts():
    own, junk = prose(random.Random(3), 8000).encode(), b"buy now " * 400_000
    at = quality.FEATURES.index("squeezed")
    alone, mixed = quality.statistics(own)[at], quality.statistics(own + junk)[at]
    assert alone == len(zlib.compress(own, 1)) / len(own) and len(own) > 1 << 15
    assert abs(mixed - len(zlib.compress(own + junk, 1)) / len(own + junk)) < 1e-4 and mixed < 0.1 * alone
    assert quality.statistics(junk + own)[at] < 0.1 * alone


def test_language(spark):
    rng = random.Random(2)
    letters = {"aa": "abcde", "bb": "vwxyz"}
    def text(l):  # noqa: E306
        return " ".join("".join(rng.choice(letters[l]) for _ in range(5)) for _ in range(40))
    rows = [(k, text("aa" if k % 2 else "bb"), ("aa-X" if k % 2 else "BB") if k % 5 else None, f"h{k % 3}") for k in range(200)]
    rows += [(500, None, "aa", "h0"), (501, "123 !!", None, None), (502, "", None, None), (None, text("aa"), None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string")
    got = {r.doc_id: r for r in language.identify(docs, declared=F.col("lang"), host=F.col("host")).collect()}
    assert len(got) == len(rows)
    assert all(got[k].language == ("aa" if k % 2 else "bb") and got[k].accepted for k in range(200))
    assert all(got[k].language == "und" and not got[k].accepted for k in (500, 501, 502)) and got[None].language == "aa"


def test_rare_language_beside_a_text_copied_everywhere(spark):
    rng = random.Random(12)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(40))
    copied = text("vwxyz") * 20
    rows = [(k, copied, "bb") for k in range(3000)] + [(3000 + k, text("abcde"), "aa") for k in range(300)]
    rows += [(4000 + k, text("абвгд"), "cc") for k in range(12)] + [(5000 + k, text("vwxyz"), "bb") for k in range(300)] + [(6000, text("абвгд"), None), (6001, text("klmno"), "dd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for fit_rows in (60, 20_000):
        got = {r.doc_id: r for r in language.identify(docs, declared=F.col("lang"), fit_rows=fit_rows).collect()}
        assert all(got[k].language == want and got[k].accepted for k, _, want in rows if k < 6000)
        assert got[6000].language == "cc" and got[6000].accepted and got[6001].language == "und"


def test_contamination(spark, docs):
    rng = random.Random(4)
    vocabulary = [f"v{k}" for k in range(500)]
    item = [rng.choice(vocabulary) for _ in range(40)]
    edited = list(item)
    for at in (5, 13, 22, 30):
        edited[at] = "other"
    del edited[17]
    noise = lambda: [rng.choice(vocabulary) for _ in range(80)]
    rows = [(1, " ".join(noise() + item + noise())), (2, " ".join(noise() + edited + noise())), (3, " ".join(noise())), (4, None), (5, ""), (6, " ".join(w.upper() + "," for w in item)), (None, " ".join(item))]
    table = spark.createDataFrame(rows * 2, "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(item), "x"), (10, "too short", "x"), (11, None, "x")], "item_id long, text string, words string")
    got = {(r.doc_id, r.item_id): r.score for r in contamination.contaminated(table, items).collect()}
    assert set(got) == {(1, 9), (2, 9), (6, 9)} and got[(1, 9)] == got[(6, 9)] == 1.0 and 0.7 < got[(2, 9)] < 1.0


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a, b = (rng.integers(0, 4, n).astype(np.uint64) for n in rng.integers(1, 25, 2))
        assert contamination.align(a, b)[0] == smith_waterman(a.tolist(), b.tolist())


def test_edited_copies_beside_verbatim_ones(spark):
    """All pairs against Smith-Waterman, with copies edited at every 4th to 7th word, stretched and cut, next to none, one or five verbatim ones."""
    rng = random.Random(6)
    vocabulary = [f"v{k}" for k in range(3000)]
    noise = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    kinds = [(step, copies) for step in range(3, 8) for copies in (0, 1, 5)]  # 3: two words more after each third one
    items, texts = [noise(42) for _ in kinds], [noise(60) for _ in range(4)]
    for k, (item, (step, copies)) in enumerate(zip(items, kinds)):
        if step == 3:
            edited = [x for n, w in enumerate(item) for x in ([w, "more", "words"] if n % 3 == 2 else [w])]
        else:
            edited = [f"new{k}x{n}" if n % step == step - 1 else w for n, w in enumerate(item)]
        texts += [noise(20) + edited + noise(20), *[noise(9) + item + noise(5)] * copies, noise(9) + item[: 10 + 2 * k] + noise(9)]
    table = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string")
    tests = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    want = {(n, k): smith_waterman(i, t) / 84 for n, t in enumerate(texts) for k, i in enumerate(items)}
    got = {(r.doc_id, r.item_id): r.score for r in contamination.contaminated(table, tests).collect()}
    assert got == {pair: score for pair, score in want.items() if score >= 0.5}


def test_bound_of_alignment():
    rng = np.random.default_rng(9)
    for _ in range(200):
        a, b = (rng.integers(0, 9, n).astype(np.uint64) for n in rng.integers(1, 25, 2))
        assert contamination.align(a, b)[0] <= contamination.most(a, b)


PAGE = """<html><head><title>t</title><style>p{{}}</style></head><body><header>Site</header><nav><a>menu</a></nav><div class="ad-box">buy</div>
<div id=content><h1>{0}</h1><p>First &amp; {0}<p>Second\n  part {1}<br>after {0}</p><div class="x">Read our terms</div></div>
<div class="comments"><p>nice</p></div><form>f</form><script>var a = "<p>no</p>";</script><aside>s</aside><footer>end</footer></body></html>"""


def test_pages(spark):
    rows = [(k, f"http://site.example/{k}", PAGE.format(f"topic {k}", f"word{k} " * 9)) for k in range(8)]
    rows += [(20, "http://other.example/", "<article><header><h2>H</h2></header><p>A<b>B</b> c</article><p>out</p>"), (21, None, None), (22, "x", ""), (23, None, "plain &lt;text&gt;"), (None, "http://site.example/n", "<main><p>m</main>")]
    df = spark.createDataFrame([(*r, "noise", "noise") for r in rows], "page_id long, url string, html string, host string, template string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    for k in range(8):
        assert got[k] == f"topic {k}\nFirst & topic {k}\nSecond part {('word%d ' % k * 9).strip()}\nafter topic {k}", got[k]
    assert got[20] == "H\nAB c" and got[21] == "" and got[22] == "" and got[23] == "plain <text>" and got[None] == "m"


def prose(rng, n):
    return " ".join(f"w{rng.randint(0, 5000)}" for _ in range(n))


def test_template_of_pages_that_are_mostly_boilerplate():
    rng = random.Random(7)
    page = lambda own: "<body>" + "".join(f"<div class=b{k}>Fixed {k}</div>" for k in range(5)) + own + "".join(f"<div class=c{k}>Fixed {k}</div>" for k in range(5))
    own = [[prose(rng, 20) for _ in range(6)] for _ in range(7)] + [[prose(rng, 20)]]
    html = [page("".join(f"<p>{t}</p>" for t in o)) for o in own[::-1]][::-1]
    for order in (html, html[::-1]):
        template = set(pages.induce(order))
        assert len(template) == 10
        assert [pages.main_text(h, template) for h in html] == ["\n".join(o) for o in own]


def test_region_holds_most_of_the_text():
    rng = random.Random(10)
    one, two, three = (prose(rng, n) for n in (60, 50, 30))
    card = "<article class=c><p>A card</p></article>"
    read = lambda body: pages.main_text(f"<body>{body}</body>", set()).split("\n")
    assert read(f"<div><p>{one}</p><p>{two}</p></div>{card}") == [one, two, "A card"]
    assert read(f"<main><p>{one}</p><p>{two}</p></main><div>{card}</div>") == [one, two]
    assert read(f"<main></main><p>{one}</p>") == [one]
    assert read(f"<article><h1>T</h1><div itemprop=articleBody><p>{one}</p></div></article>") == ["T", one]
    assert read(f"<div><article><p>{one}</p></article><article><p>{three}</p></article></div>{card}<p>x</p>") == [one, three]
    assert read(f"<article><p>{one}</p></article><article class=n><p>{two}</p></article><article><p>{three}</p></article>x") == [one, two, three]
    assert read(f"<article><h1>T</h1><p>{one}</p></article>{card}<p>rest</p>") == ["T", one]


def test_edited_copies_are_no_template():
    rng = random.Random(8)
    story = [prose(rng, 30) for _ in range(8)]
    edited = [[f"{t} more{k}" if n == k else t for n, t in enumerate(story)] for k in range(6)]
    others = [[prose(rng, 30) for _ in range(3)] for _ in range(2)]
    for own in (edited, edited + others):
        html = ["<body><div class=m>Fixed</div>" + "".join(f"<p>{t}</p>" for t in o) for o in own]
        template = set(pages.induce(html))
        assert all(t in pages.main_text(h, template) for h, o in zip(html, own) for t in o)


def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    outs = [
        suffixes.remove_repeated_bytes(no_docs), recompression.remove_repeated_words(no_docs), lines.drop_repeated_lines(no_docs), neardup.near_duplicates(no_docs),
        mixing.mixture(no_docs), language.identify(no_docs, declared=F.col("lang"), host=F.col("source")), quality.score_quality(no_docs, labels)[0],
        contamination.contaminated(no_docs, items), neighbours.nearest(vectors, F.col("vec_id") % 20 == 0),
        pages.extract(spark.createDataFrame([], "page_id long, url string, html string")),
    ]
    assert all(out.count() == 0 for out in outs)


def test_odd_rows_do_not_stop_the_rest(spark, docs, rows):
    assert language.identify(docs, declared=F.col("lang"), host=F.col("source")).count() == len(rows)
    labels = spark.createDataFrame([(None, 1), (6, None)], "doc_id long, quality int")
    out = quality.score_quality(docs, labels)[0].collect()
    assert len(out) == len(rows) and {r.score for r in out} == {0.5}
    assert contamination.contaminated(docs, spark.createDataFrame([(1, rows[5][1])], "item_id long, text string")).filter("score = 1").count() >= 3


def test_digest_of_query(spark, folder):
    from policylake.llm import queries

    docs = {r.doc_id: r.text for r in queries.table(spark, folder, "documents").collect()}
    for r in queries.op2_line_dedup(spark, folder).filter("n_dropped = 0").collect():
        assert r.kept_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
