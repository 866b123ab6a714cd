"""Repeated runs of words, by recompression.

Words are symbols. A round names maximal runs of one symbol, then pairs whose left symbol falls on the left and whose
right symbol falls on the right side of a split of all symbols. Names are 64-bit mixtures of what they stand for, and
sides are bits of names, so equal stretches get equal names in every block: the naming is global without a table of
names. Whether a symbol arises depends on its neighbours only, so inside equal windows equal symbols arise except near the
ends; each symbol carries the stretch of words that settles it. Spark then counts the symbols of the last round over the
corpus. A window that holds a symbol settled inside it that occurs once is not repeated. The windows left
are named from their words and counted the same way, which verifies them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .blocks import BLOCK_BYTES, Finder, covered, inner_starts, isin_sorted, pack, repeats
from .common import mixed
from .suffixes import prefix_sums, window_names

RUN, PAIR = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def word_names(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def symbols(words: np.ndarray, ends: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the symbols after ``rounds`` rounds, and first and one past the last word that settle each.

    A symbol at the end of a document is settled only beyond it: its stretch reaches one word outside.
    """
    place = np.arange(len(words), dtype=np.int64)
    doc = np.searchsorted(ends, place, side="right")
    begins = np.concatenate(([0], ends[:-1]))
    name, low, high = words, place, place + 1
    outside_low, outside_high = begins - 1, ends + 1
    for turn in range(rounds):
        # Runs: a symbol stays itself when alone, so that its name depends on what it spells.
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        length = np.diff(first, append=len(name))
        last = first + length - 1
        run_name = np.where(length > 1, mixed(name[first] * RUN + length.astype(np.uint64)), name[first])
        run_doc = doc[first]
        name, low, high, doc = run_name, _before(low, first, doc, run_doc, outside_low), _after(high, last, doc, run_doc, outside_high), run_doc
        # Pairs: left symbols are those whose bit is set.
        bit = (mixed(name + np.uint64(turn + 1)) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(name), bool)
        joins[:-1] = bit[:-1] & ~bit[1:] & (doc[1:] == doc[:-1])
        tail = np.zeros(len(name), bool)
        tail[1:] = joins[:-1]
        first = np.flatnonzero(~tail)
        last = first + joins[first]
        pair = joins[first]
        pair_name = np.where(pair, mixed(mixed(name[first] * PAIR) + name[last]), name[first])
        pair_doc, left = doc[first], bit[first]
        # A lone left symbol is settled by its right neighbour, a lone right symbol by its left one.
        reach_low = np.where(pair | left, low[first], _before(low, first, doc, pair_doc, outside_low))
        reach_high = np.where(pair | ~left, high[last], _after(high, last, doc, pair_doc, outside_high))
        name, low, high, doc = pair_name, reach_low, reach_high, pair_doc
    return name, low, high


def _before(low: np.ndarray, first: np.ndarray, doc: np.ndarray, own: np.ndarray, outside: np.ndarray) -> np.ndarray:
    at = np.maximum(first - 1, 0)
    return np.minimum(low[first], np.where((first > 0) & (doc[at] == own), low[at], outside[own]))


def _after(high: np.ndarray, last: np.ndarray, doc: np.ndarray, own: np.ndarray, outside: np.ndarray) -> np.ndarray:
    at = np.minimum(last + 1, len(high) - 1)
    return np.maximum(high[last], np.where((last + 1 < len(high)) & (doc[at] == own), high[at], outside[own]))


class WordFinder(Finder):
    density = 0.06
    out = "doc_id long, n_words long, n_removed long, kept string"
    out_schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def __init__(self, width: int, rounds: int) -> None:
        self.width, self.rounds = width, rounds

    def read(self, body: bytes, ends: np.ndarray):
        begins = [0, *ends[:-1].tolist()]
        docs = [body[a:b].split() for a, b in zip(begins, ends.tolist())]
        words = [w for doc in docs for w in doc]
        word_ends = np.cumsum([len(doc) for doc in docs]).astype(np.int64)
        names = word_names(words)
        return docs, word_ends, names, prefix_sums(names)

    def sample(self, state) -> tuple[np.ndarray, ...]:
        _, ends, names, _ = state
        key, low, high = symbols(names, ends, self.rounds)
        inside = high - low <= self.width
        return key, low, high, inside

    def left(self, state, sample: tuple[np.ndarray, ...], repeated: np.ndarray) -> np.ndarray:
        _, ends, names, _ = state
        key, low, high, inside = sample
        alone = inside & ~isin_sorted(key, repeated)
        # Windows that hold a stretch [low, high) start from high - width to low. Stretches that leave the document hold none.
        from_, to = np.maximum(high[alone] - self.width, 0), low[alone]
        out = np.zeros(len(names) + 1, np.int32)
        good = (to >= from_) & (low[alone] >= 0)
        np.add.at(out, from_[good], 1)
        np.add.at(out, to[good] + 1, -1)
        return np.flatnonzero((np.cumsum(out[:-1]) == 0) & inner_starts(ends, self.width, len(names)))

    def names(self, state, starts: np.ndarray) -> np.ndarray:
        return window_names(state[3], starts, self.width)

    def starts(self, state) -> np.ndarray:
        return np.flatnonzero(inner_starts(state[1], self.width, len(state[2])))

    def finish(self, ids: list, ends: np.ndarray, body: bytes, state, starts: np.ndarray) -> list[dict]:
        docs, word_ends, names, _ = state
        stays = ~covered(starts, self.width, len(names))
        rows, begin = [], 0
        for doc, words, end in zip(ids, docs, word_ends.tolist()):
            own = stays[begin:end]
            kept = words if own.all() else [w for w, s in zip(words, own.tolist()) if s]
            rows.append({"doc_id": doc, "n_words": len(words), "n_removed": len(words) - len(kept), "kept": b" ".join(kept).decode()})
            begin = end
        return rows


def remove_repeated_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35, rounds: int = 4, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: each text's words less those in a repeated window of ``width`` words.

    Words are what ASCII white space separates, unchanged; kept words are joined by one space. Every row counts as a
    document: repeated rows are copies of each other. A null text has no words; texts shorter than ``width`` stay
    whole; a null id stays null; other columns are not read.
    """
    return repeats(pack(docs, id_col, text_col, block_bytes), WordFinder(width, rounds))
