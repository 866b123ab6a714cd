"""Near-duplicate documents: an inverted join on the coordinates of MinHash signatures, confirmed on full sets.

Documents with equal shingle sets are one class from the start. A class posts itself under each coordinate-value pair
of its signature. Classes at the wanted similarity share at least ``threshold`` of their pairs, but for a chance of
about 1e-7 (see ``MISS``). Merging the posting lists with skipping: pairs held by one class settle nothing and are dropped; of the
rest a class needs only its ``threshold - 1`` most frequent pairs left out (they cannot alone reach the threshold), so long lists
are skipped and the short ones merged. What meets there counts its collisions over the whole signatures, and what
reaches the threshold is compared on full shingle sets.

Within a list not all pairs are made. First every member meets the list's most central member (whose coordinate pairs are
the most frequent). Then lists whose members are already linked into one component are done; in the others members of
different components meet, if the sizes of their sets allow a link: a member can share no more than those of its shingles that
any other member left over has, which bounds the size of its partners. So a crowd of copies that are each edited too far
is not compared in pairs. Long lists are compared block by block, which sends links only. Links are lost nowhere: what is not compared is already linked, or cannot be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import connected, mixed, texts, trimmed

WORDS = 5
COORDINATES, THRESHOLD = 40, 15
MISS = 1.2e-7  # P(fewer than 15 of 40 coordinates agree) at a similarity of 0.75
BROADCAST_IDS = 1_000_000
CROWD, CROWD_BLOCK = 32, 256  # lists above the first are compared block by block

SIGNED = "doc_id long, n_shingles long, high long, low long, pairs array<long>"
SIGNED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("pairs", pa.list_(pa.int64()))])


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; of the whole sequence if it has fewer words."""
    split = text.lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, len(split))
    size = min(words, len(names))
    out = np.full(len(names) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(31) + names[k : len(names) - size + 1 + k])
    return np.unique(out)


def factors(coordinates: int) -> np.ndarray:
    return mixed(np.arange(1, coordinates + 1, dtype=np.uint64)) | np.uint64(1)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """A row of coordinate-value pairs, each as one 64-bit name, for each non-empty set."""
    out = np.zeros((len(sets), coordinates), np.uint64)
    every, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    for k, factor in enumerate(factors(coordinates)):
        least = np.minimum.reduceat(every * factor, starts)
        out[:, k] = mixed(least + np.uint64(k))
    return out


def signed(docs: DataFrame, coordinates: int, words: int) -> DataFrame:
    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sets = [shingles(t, words) for t in texts(part)]
            digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            full = [n for n, s in enumerate(sets) if len(s)]
            pairs: list[list[int]] = [[] for _ in sets]
            for n, row in zip(full, signatures([sets[n] for n in full], coordinates).view(np.int64).tolist() if full else ()):
                pairs[n] = row
            high, low = (np.array(d, np.uint64).view(np.int64) for d in ([d >> 64 for d in digests], [d & 0xFFFFFFFFFFFFFFFF for d in digests]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(high), pa.array(low), pa.array(pairs, pa.list_(pa.int64()))],
                schema=SIGNED_SCHEMA,
            )

    return docs.mapInArrow(trimmed(sign), SIGNED)


def full_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``(doc_id, shingles)`` of the documents in ``ids``: broadcast while these are known to be few, else shuffled."""
    few = ids.count() <= BROADCAST_IDS
    chosen = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [shingles(t, words).view(np.int64) for t in texts(part)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(rows, pa.list_(pa.int64()))], schema=pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])
            )

    return stage(chosen.mapInArrow(trimmed(sets), "doc_id long, shingles array<long>"), "shingles")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()


def colliding(pairs: DataFrame, posted: DataFrame, threshold: int) -> DataFrame:
    """Those of the distinct pairs ``(a, b)`` whose signatures collide often enough."""
    first, second = (posted.select(F.col("id").alias(n), F.col("pairs").alias(f"pairs_{n}")) for n in "ab")
    both = pairs.join(first, "a").join(second, "b")
    return both.filter(F.size(F.array_intersect("pairs_a", "pairs_b")) >= threshold).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose full sets are similar enough."""
    first, second = (sets.select(F.col("doc_id").alias(n), F.col("shingles").alias(f"set_{n}")) for n in "ab")
    same = F.size(F.array_intersect("set_a", "set_b"))
    # 100 i >= p u with u = |a| + |b| - i
    enough = (100 + percent) * same >= percent * (F.size("set_a") + F.size("set_b"))
    both = pairs.join(second, "b").select("a", "b", "set_b", F.size("set_b").alias("n_b")).join(first, "a")
    possible = (100 * F.least("n_b", F.size("set_a"))) >= percent * F.greatest("n_b", F.size("set_a"))
    return stage(both.filter(possible).filter(enough).select("a", "b").distinct(), "links")


def partner_sizes(sets: DataFrame, percent: int) -> DataFrame:
    """``(id, n, low, high)``: how large a set must be to be linked with this one, given the shingles it shares with any other of the sets.

    With i common shingles, 100 i >= p (n + m - i). As i is at most the number s of shared shingles, m is at most
    s (100 + p) / p - n; and m is at least p n / 100. A set with too few shared shingles has no partner and is left out.
    """
    every = sets.select("doc_id", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    shared = every.groupBy("s").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    counted = every.join(shared, "s", "left_semi").groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("shared"))
    return counted.select(
        F.col("doc_id").alias("id"), "n", F.ceil(F.col("n") * percent / 100).cast("int").alias("low"),
        (F.floor(F.col("shared") * (100 + percent) / percent) - F.col("n")).cast("int").alias("high"),
    ).filter("low <= high")


def crowd_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between the components of crowds: members that long lists bring together.

    A crowd is dealt to blocks, and each two blocks are compared in one task by a product of two incidence matrices over the shingles
    they share. Only links leave the task, so a crowd of similar texts below the threshold sends no pairs.
    """
    heads = members.groupBy("pair").agg(F.min("id").alias("head"))
    edges = members.join(heads, "pair").select("id", "head").distinct()
    crowd = stage(connected(edges, "id", "head"), "crowds")
    sizes = crowd.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / CROWD_BLOCK).cast("int").alias("blocks"))
    of = members.select(F.col("id").alias("node"), "of").distinct()
    rows = crowd.join(sizes, "component").join(of, "node").join(sets, F.col("node") == F.col("doc_id"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("component", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", F.col("node").alias("id"), "of", "shingles")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        _, x, y = (k.as_py() for k in key)
        own = table.column("own").to_numpy()
        ids, parts_of = table.column("id").to_numpy(), table.column("of").to_numpy()
        held = [np.array(s, np.int64) for s in table.column("shingles").to_pylist()]
        first, second = np.flatnonzero(own == x), np.flatnonzero(own == y)
        if not len(first) or not len(second):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        common = np.intersect1d(np.concatenate([held[n] for n in first]), np.concatenate([held[n] for n in second]))
        same = np.zeros((len(first), len(second)), np.float32)
        for at in range(0, len(common), 1 << 14):
            some = common[at : at + (1 << 14)]
            same += _incidence([held[n] for n in first], some) @ _incidence([held[n] for n in second], some).T
        sizes_ = np.array([len(s) for s in held], np.float64)
        enough = (100 + percent) * same.astype(np.float64) >= percent * (sizes_[first][:, None] + sizes_[second][None, :])
        a, b = np.nonzero(enough & (parts_of[first][:, None] != parts_of[second][None, :]))
        a, b = ids[first[a]], ids[second[b]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return dealt.groupBy("component", "x", "y").applyInArrow(compare, "a long, b long")


def _incidence(sets: list[np.ndarray], among: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(among)), np.float32)
    for row, one in zip(out, sets):
        at = np.searchsorted(among, one)
        at[at == len(among)] = 0
        row[at[among[at] == one]] = 1
    return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, words: int = WORDS,
    coordinates: int = COORDINATES, threshold: int = THRESHOLD,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)``: documents by group of near copies, a row for each row of ``docs``.

    Two documents are linked when ``percent`` of the union of their shingle sets is shared; ``component_id`` is the smallest id
    reached over links. Words are lower-cased (A-Z) and split at ASCII white space; a text under ``words`` words is one
    shingle; a null or empty text has none and is linked with nothing. ``n_links`` counts confirmed links of a document's class
    to other classes (copies are not counted, and links inside a component are not all looked for). Rows with one id are one
    document, so their texts count as linked. Rows with a null id stay alone, with a null component. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signs = stage(signed(rows, coordinates, words), "signatures")
    named = signs.filter("doc_id is not null")
    classes = stage(named.filter("n_shingles > 0").groupBy("high", "low").agg(F.min("doc_id").alias("id"), F.first("pairs").alias("pairs")), "classes")

    postings = classes.select("id", F.explode("pairs").alias("pair"))
    often = postings.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = postings.join(often, "pair").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "pair"))).alias("held"))
    held = stage(held.filter(F.size("held") >= threshold), "postings")
    posted = held.select("id", F.transform("held", lambda h: h["pair"]).alias("pairs"), F.aggregate("held", F.lit(0).cast("long"), lambda s, h: s + h["n"]).alias("centre"),
                         F.expr(f"slice(held, 1, size(held) - {threshold - 1}).pair").alias("short"))
    short = posted.select("id", "centre", F.explode("short").alias("pair"))

    # Every member of a list with its most central one.
    heads = short.groupBy("pair").agg(F.max_by("id", F.struct("centre", -F.col("id"))).alias("head"))
    star = short.join(heads, "pair").filter("id <> head").select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()
    met = stage(star, "met")
    met = stage(colliding(met, posted, threshold), "candidates")
    links = confirmed(met, full_sets(rows, ends_of(met), words), percent)
    groups = stage(connected(links, "a", "b"), "components")

    # Lists that still join several components: members of different ones.
    own = short.join(groups, short["id"] == groups["node"], "left").select("id", "pair", F.coalesce("component", "id").alias("of"))
    mixed_lists = own.groupBy("pair").agg(F.min("of").alias("least"), F.max("of").alias("most")).filter("least < most").select("pair")
    own = stage(own.join(mixed_lists, "pair"), "mixed-lists")
    sets = full_sets(rows, own.select(F.col("id").alias("doc_id")).distinct(), words)
    sized = stage(own.join(partner_sizes(sets, percent), "id"), "sizes")
    crowded = sized.groupBy("pair").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") > CROWD).select("pair")
    crowds = crowd_links(sized.join(crowded, "pair"), sets, percent)
    sized = sized.join(crowded, "pair", "left_anti")
    step = lambda n: F.floor(F.log(n) / F.log(F.lit(1.1)))
    larger = sized.select(F.col("id").alias("a"), F.col("of").alias("of_a"), "pair", F.col("n").alias("n_a"), "low", F.col("high").alias("high_a"),
                          F.explode(F.sequence(step(F.col("low")), step(F.least("n", "high")))).alias("step"))
    smaller = sized.filter("high >= n").select(F.col("id").alias("b"), F.col("of").alias("of_b"), "pair", F.col("n").alias("n_b"), F.col("high").alias("high_b"), step(F.col("n")).alias("step"))
    cross = larger.join(smaller, ["pair", "step"]).filter("of_a <> of_b and n_b between low and high_a and n_a between n_b and high_b")
    cross = stage(cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "met")
    cross = colliding(cross, posted, threshold).join(met, ["a", "b"], "left_anti")
    links = stage(links.unionByName(confirmed(cross, sets, percent)).unionByName(crowds).distinct(), "links")
    groups = stage(connected(links, "a", "b"), "components")

    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    placed = classes.select("high", "low", "id").join(groups, F.col("id") == F.col("node"), "left").join(degree, "id", "left")
    placed = placed.select("high", "low", F.coalesce("component", "id").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    # Rows with one id but several texts: the smallest component among them.
    out = signs.drop("pairs").join(placed, ["high", "low"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return out.select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )
