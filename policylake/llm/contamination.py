"""Benchmark passages in training documents: word n-grams as seeds, then Smith-Waterman alignment.

All word n-grams of a test item are its seeds, however frequent they are, so neither a passage that stands in a third of the corpus nor an edited
copy beside verbatim ones loses its own. A document that holds a seed is aligned with the item in the stretch around it, unless
the words they share rule the threshold out; the score is the best local alignment over that of the whole item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import mixed, texts, trimmed

GRAM = 3
FILTER_BITS = 1 << 24
MATCH, MISS, GAP = 2, -1, -1
MARKS = b".,!?;:\"'()[]{}"
BROADCAST_DOCS = 1_000_000


def words_of(text: bytes) -> np.ndarray:
    """Hashes of a text's words, A-Z in lower case, marks at their ends dropped."""
    words = [w for w in (w.strip(MARKS) for w in text.lower().split()) if w]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def grams_of(words: np.ndarray, size: int) -> np.ndarray:
    if len(words) < size:
        return np.zeros(0, np.uint64)
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(31) + words[k : len(words) - size + 1 + k])
    return out


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences, and where in the passage it ends.

    A row a word of the item; gaps along a row are a running maximum.
    """
    steps = np.arange(len(passage) + 1) * -GAP
    row, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for word in item:
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(passage == word, MATCH, MISS))
        row = np.maximum.accumulate(new + steps) - steps
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def most(item: np.ndarray, passage: np.ndarray) -> int:
    """No local alignment of the two scores more: of either one's words, a stretch counts its words held by the other as matches, the rest as misses."""
    bounds = []
    for own, other in ((passage, item), (item, passage)):
        sums = np.concatenate(([0], np.cumsum(np.where(np.isin(own, other), MATCH, max(MISS, GAP)))))
        bounds.append(int((sums - np.minimum.accumulate(sums)).max()))
    return min(bounds)


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    gram: int = GRAM, threshold: float = 0.5,
) -> DataFrame:
    """``(doc_id, item_id, score, end_word)`` of the pairs of document and item whose score is at least ``threshold``.

    The score is the best local alignment's over the item's length times the match score; 1 is a whole copy. ``end_word`` is the number of the
    word of the document after the alignment. A pair takes part where document and item share at least one run of ``gram`` words. Words are compared with A-Z in lower case and without marks at their ends. Items of under ``gram`` words, null and empty
    texts, and rows with a null id take no part. Rows with one id are one document, the best score of a pair counts. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id is not null")
    tests = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter("item_id is not null")

    def item_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words = [words_of(t) for t in texts(part)]
            yield pa.RecordBatch.from_arrays([
                part.column("item_id"), pa.array([w.view(np.int64) for w in words], pa.list_(pa.int64())),
                pa.array([grams_of(w, gram).view(np.int64) for w in words], pa.list_(pa.int64())),
            ], names=["item_id", "words", "grams"])

    tests = tests.mapInArrow(trimmed(item_words), "item_id long, words array<long>, grams array<long>").filter(F.size("grams") > 0)
    tests = stage(tests.dropDuplicates(["item_id", "words"]), "test-items")
    seeds = tests.select("item_id", F.posexplode("grams").alias("item_place", "seed"))

    # A bit table of fixed size lets a document keep to itself what no item holds; the join on seeds is exact.
    place = F.pmod("seed", F.lit(FILTER_BITS))
    bits = seeds.select((place / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(seed, {FILTER_BITS}) % 64 as int))").alias("bit"))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for r in bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        table[r["word"]] = r["bits"]

    def hits(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            docs_, places, found = [], [], []
            for doc, text in zip(part.column("doc_id").to_pylist(), texts(part)):
                grams = grams_of(words_of(text), gram)
                at = (grams.view(np.int64) % FILTER_BITS).astype(np.int64)
                hit = np.flatnonzero((table[at >> 6].view(np.uint64) >> (at & 63).astype(np.uint64)) & np.uint64(1))
                if len(hit):
                    docs_.append(np.full(len(hit), doc, np.int64))
                    places.append(hit)
                    found.append(grams[hit].view(np.int64))
            if docs_:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)) for a in (docs_, places, found)], names=["doc_id", "place", "seed"])

    held = rows.mapInArrow(trimmed(hits), "doc_id long, place long, seed long").join(seeds.select("seed").distinct(), "seed", "left_semi")
    held = stage(held, "seed-hits")

    # Where an item would begin, by document and item.
    begins = held.join(seeds, "seed").select("doc_id", "item_id", F.col("item_place").alias("p"), "place")
    begins = begins.select("doc_id", "item_id", (F.col("place") - F.col("p")).alias("begin")).distinct()
    wanted = begins.groupBy("doc_id", "item_id").agg(F.sort_array(F.collect_list("begin")).alias("begins"))
    wanted = wanted.join(tests.select("item_id", "words"), "item_id")
    wanted = stage(wanted.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "words", "begins")).alias("wanted")), "alignments")
    few = wanted.count() <= BROADCAST_DOCS
    ids = wanted.select("doc_id")
    chosen = rows.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").join(wanted, "doc_id")

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: list[tuple] = []
            for doc, text, pairs in zip(part.column("doc_id").to_pylist(), texts(part), part.column("wanted").to_pylist()):
                words = words_of(text)
                for pair in pairs:
                    item = np.array(pair["words"], np.int64).view(np.uint64)
                    least = threshold * MATCH * len(item)
                    # An alignment that scores enough has at most so many words of the document beside the matches.
                    slack = max(8 + len(item) // 2, int(max(MATCH * len(item) - least, 0) / -max(MISS, GAP)) + 1)
                    best, end, last = 0, 0, None
                    stretches: list[list[int]] = []
                    for begin in pair["begins"]:  # sorted: overlapping stretches become one
                        a, b = max(0, begin - slack), min(len(words), begin + len(item) + slack)
                        if last is not None and a <= stretches[-1][1]:
                            stretches[-1][1] = max(b, stretches[-1][1])
                        else:
                            stretches.append([a, b])
                        last = b
                    for a, b in stretches:
                        if most(item, words[a:b]) < max(least, best + 1):
                            continue
                        got, at = align(item, words[a:b])
                        if got > best:
                            best, end = got, a + at
                    ratio = best / (MATCH * len(item))
                    if ratio >= threshold:
                        out.append((doc, pair["item_id"], ratio, end))
            columns = list(zip(*out)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "score", "end_word"])

    scored = chosen.select("doc_id", "text", "wanted").mapInArrow(trimmed(score), "doc_id long, item_id long, score double, end_word long")
    return scored.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.max_by("end_word", "score").alias("end_word"))
