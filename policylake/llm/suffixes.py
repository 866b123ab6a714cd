"""Repeated byte strings, by blockwise sorting of suffixes with a difference-cover sample.

A difference cover of period v has, for any two places, a shift below v that takes both to sampled places. So two
suffixes that share ``width`` bytes meet at a pair of sampled suffixes that share ``width - v + 1`` bytes. The sample is
ranked first (equal prefixes, equal rank). A suffix none of whose v next places has a shared rank differs from
every other within ``width`` bytes: the sample's ranks settle it, however long its ties are. Only the suffixes left open
by the ranks are sorted.

Suffixes go to buckets by the least hash of ``gram`` bytes in their first ``width``, which neighbours mostly share: one piece
of text carries some hundred open suffixes. Pieces that occur more than once in whole are settled by their names, and only one
block then sends their text, so a group of copies costs a bucket one text. A bucket, bounded in size, is sorted in one
task at a time, by 64-bit names of the first ``width`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .blocks import (
    ASK, BLOCK_BYTES, bucket_count, covered, cut_points, decoded, encoded, inner_starts, isin_sorted, known, pack, parts,
    questions, repeated_keys,
)
from .common import batches, mixed

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_POWERS: dict[str, np.ndarray] = {}


def byte_table() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for key, base in (("up", _BASE), ("down", inverse)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _POWERS[key] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running sums of values times powers, one longer than ``values``."""
    up, _ = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums


def window_names(sums: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    _, down = powers(len(sums))
    return mixed((sums[starts + width] - sums[starts]) * down[starts])


def difference_cover(order: int) -> np.ndarray:
    """The smallest places that generate all differences modulo ``order**2 + order + 1``, for a prime order (Singer's construction).

    Powers of a primitive element of the field with order**3 members: exponents whose power lies in a plane.
    """
    q, v = order, order * order + order + 1
    for c0 in range(1, q):
        for c1 in range(q):
            for c2 in range(q):
                # x**3 = c2 x**2 + c1 x + c0: walk the powers of x up to scalars
                a, plane, seen = (1, 0, 0), [], set()
                for k in range(v):
                    lead = next(t for t in a if t)
                    point = tuple(t * pow(lead, -1, q) % q for t in a)
                    if point in seen:
                        break
                    seen.add(point)
                    if a[2] == 0:
                        plane.append(k)
                    top = a[2]
                    a = (top * c0 % q, (a[0] + top * c1) % q, (a[1] + top * c2) % q)
                    if not any(a):
                        break
                if len(seen) == v and len(plane) == q + 1 and len({(x - y) % v for x in plane for y in plane}) == v:
                    return np.array(plane, np.int64)
    raise ValueError(f"no cover found for {order}")


def least_hashes(sums: np.ndarray, width: int, gram: int) -> np.ndarray:
    """For each start of ``width`` bytes, the least hash of ``gram`` bytes within it (running minima of blocks of the window's length)."""
    n, w = len(sums) - gram, width - gram + 1
    hashes = window_names(sums, np.arange(n), gram)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = hashes
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


class Cover:
    """Sampled places of a block and what their ranks leave open."""

    def __init__(self, width: int, order: int, gram: int) -> None:
        self.width, self.period, self.gram = width, order * order + order + 1, gram
        if self.period > width or gram > width:
            raise ValueError("neither the period of the difference cover nor the gram may pass the width")
        self.depth = width - self.period + 1
        self.places = np.sort(difference_cover(order))
        self.density = (order + 1) / self.period

    def sums(self, body: bytes) -> np.ndarray:
        return prefix_sums(byte_table()[np.frombuffer(body, np.uint8)])

    def sample(self, ends: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Names of the sampled suffixes' prefixes, and their places."""
        at, begin = [], 0
        for end in ends.tolist():
            if end - begin >= self.width:
                last = end - self.depth
                places = (begin + np.arange(0, last - begin + 1, self.period)[:, None] + self.places).ravel()
                at.append(places[places <= last])
            begin = end
        places = np.concatenate(at) if at else np.zeros(0, np.int64)
        return window_names(sums, places, self.depth), places

    def open_starts(self, ends: np.ndarray, sums: np.ndarray, repeated: np.ndarray) -> np.ndarray:
        """Starts with a shared rank within the next period, inside their document."""
        names, places = self.sample(ends, sums)
        shared = places[isin_sorted(names, repeated)]
        near = np.zeros(len(sums), np.int32)
        np.add.at(near, np.maximum(shared - self.period + 1, 0), 1)
        near[shared + 1] -= 1
        return np.flatnonzero((np.cumsum(near[:-1]) > 0) & inner_starts(ends, self.width, len(sums) - 1))

    def pieces(self, starts: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of neighbouring starts with one least hash: first start, one past the last, name of the text, least hash."""
        if not len(starts):
            return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        least = least_hashes(sums, self.width, self.gram)[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(starts) != 1) | (least[1:] != least[:-1])
        first = np.flatnonzero(new)
        begin, end = starts[first], starts[np.append(first[1:], len(starts)) - 1] + 1
        _, down = powers(len(sums))
        name = mixed(mixed((sums[end + self.width - 1] - sums[begin]) * down[begin]) + (end - begin).astype(np.uint64))
        return begin, end, name, least[first]


PIECES = "block long, begin binary, end binary, name binary, least binary, repeated binary, sends binary"
PIECES_SCHEMA = pa.schema([("block", pa.int64()), *[(n, pa.binary()) for n in ("begin", "end", "name", "least", "repeated", "sends")]])
TEXTS = "bucket int, block long, count binary, name binary, repeated binary, body binary"
TEXTS_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *[(n, pa.binary()) for n in ("count", "name", "repeated", "body")]])
FOUND = "block long, name binary, count binary, bits binary"
FOUND_SCHEMA = pa.schema([("block", pa.int64()), ("name", pa.binary()), ("count", pa.binary()), ("bits", pa.binary())])
OWNED = "block long, keys binary, owned binary"
OWNED_SCHEMA = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("owned", pa.binary())])
OUT = "doc_id long, n_bytes long, kept binary, spans array<struct<begin: long, end: long>>"
OUT_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()),
    ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
])


def array_of(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(data, kind)


def owners(table: pa.Table) -> pa.Table:
    """One bucket of names: which names of each block occur more than once, and which of these the block is to send."""
    blocks = np.array(table.column("block").to_pylist(), np.int64)
    asked = [decoded(x) for x in table.column("keys").to_pylist()]
    keys, who = np.concatenate(asked), np.repeat(blocks, [len(x) for x in asked])
    order = np.lexsort((who, keys))
    keys, who = keys[order], who[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    many = np.diff(first, append=len(keys)) > 1
    again, owner = keys[first[many]], who[first[many]]
    rows = []
    for block, own in zip(blocks.tolist(), asked):
        own = np.unique(own[isin_sorted(own, again)])
        if len(own):
            mine = own[owner[np.searchsorted(again, own)] == block]
            rows.append({"block": block, "keys": encoded(own), "owned": encoded(mine)})
    return pa.Table.from_pylist(rows, OWNED_SCHEMA)


def sorted_bucket(width: int):
    """One bucket of pieces: sorts the suffixes that begin in them and tells each block which occur more than once."""

    def found(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        counts = [array_of(r["count"], np.int64) for r in rows]
        count = np.concatenate(counts)
        body = b"".join(r["body"] for r in rows)
        sums = prefix_sums(byte_table()[np.frombuffer(body, np.uint8)])
        lengths = count + width - 1
        at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        edges = np.concatenate(([0], np.cumsum(count)))
        starts = np.repeat(at - edges[:-1], count) + np.arange(edges[-1])
        names = window_names(sums, starts, width)
        weight = np.repeat(np.concatenate([array_of(r["repeated"], np.uint8) for r in rows]), count)
        every = np.sort(np.concatenate((names, names[weight > 0])))
        hit = isin_sorted(names, np.unique(every[1:][every[1:] == every[:-1]]))
        out, piece = [], 0
        for r, own in zip(rows, counts):
            told, sizes, bits = [], [], []
            for name, n, settled in zip(array_of(r["name"], np.uint64), own.tolist(), r["repeated"]):
                mine = hit[edges[piece] : edges[piece + 1]]
                piece += 1
                if not settled and mine.any():
                    told.append(name)
                    sizes.append(n)
                    bits.append(np.packbits(mine).tobytes())
            if told:
                out.append({
                    "block": r["block"], "name": np.array(told, np.uint64).tobytes(), "count": np.array(sizes, np.int64).tobytes(), "bits": b"".join(bits),
                })
        return pa.Table.from_pylist(out, FOUND_SCHEMA)

    return found


def remove_repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 400, order: int = 11, gram: int = 16,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(doc_id, n_bytes, kept, spans)``: each text less the bytes that lie in a repeated string of ``width`` bytes.

    Every row counts as a document: rows that are repeated, also under one id, are copies of each other. A null text is
    empty; texts shorter than ``width`` stay whole; a null id stays null; other columns are not read. ``order`` (a prime, 11:
    12 of 133 places) sets the difference cover. ``kept`` are bytes, as a cut may fall inside a character.
    """
    cover, asks = Cover(width, order, gram), "bucket int, block long, keys binary"
    blocks = pack(docs, id_col, text_col, block_bytes)
    grouped = blocks.groupBy("block")
    sampled = bucket_count(int((blocks.agg(F.sum("size")).first()[0] or 0) * cover.density))

    def ask_sample(batch: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for part in batch:
                for block, _, ends, body in parts(part):
                    yield from questions(block, cover.sample(ends, cover.sums(body))[0], sampled)

        yield from batches(rows(), ASK)

    def open_pieces(block_table: pa.Table, ranks: pa.Table) -> pa.Table:
        rows = []
        for block, _, ends, body in parts(block_table) if ranks.num_rows else ():
            sums = cover.sums(body)
            begin, end, name, least = cover.pieces(cover.open_starts(ends, sums, known(ranks)), sums)
            rows.append({"block": block, "begin": begin.tobytes(), "end": end.tobytes(), "name": name.tobytes(), "least": least.tobytes()})
        return pa.Table.from_pylist(rows, PIECES_SCHEMA)

    # Each block's open pieces, without their text.
    ranks = repeated_keys(blocks.mapInArrow(ask_sample, asks))
    pieces = stage(grouped.cogroup(ranks.groupBy("block")).applyInArrow(open_pieces, PIECES), "pieces")
    sizes = pieces.agg(F.sum(F.octet_length("name")) / 8).first()[0] or 0
    named = bucket_count(int(sizes))

    def ask_names(batch: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for part in batch:
                for row in part.select(["block", "name"]).to_pylist():
                    yield from questions(row["block"], array_of(row["name"], np.uint64), named)

        yield from batches(rows(), ASK)

    def mark(piece_table: pa.Table, owned: pa.Table) -> pa.Table:
        again, own, rows = known(owned), known(owned.select(["block", "owned"]).rename_columns(["block", "keys"])), piece_table.to_pylist()
        for row in rows:
            name = array_of(row["name"], np.uint64)
            repeated, first = isin_sorted(name, again), np.zeros(len(name), bool)
            first[np.unique(name, return_index=True)[1]] = True
            sends = first & (~repeated | isin_sorted(name, own))
            row |= {"repeated": repeated.astype(np.uint8).tobytes(), "sends": sends.astype(np.uint8).tobytes()}
        return pa.Table.from_pylist(rows, PIECES_SCHEMA)

    owned = pieces.mapInArrow(ask_names, asks).groupBy("bucket").applyInArrow(owners, OWNED)
    marked = stage(pieces.groupBy("block").cogroup(owned.groupBy("block")).applyInArrow(mark, PIECES), "pieces")

    # About (width + 1) / 2 suffixes a piece of text, so the bytes sent follow from the number of pieces.
    buckets = bucket_count(int(sizes) * width)

    def send(block_table: pa.Table, piece_table: pa.Table) -> pa.Table:
        rows, own = [], piece_table.to_pylist()
        for block, _, _, body in parts(block_table) if own else ():
            begin, end, name, least, repeated, sends = (
                array_of(own[0][n], kind)
                for n, kind in (("begin", np.int64), ("end", np.int64), ("name", np.uint64), ("least", np.uint64), ("repeated", np.uint8), ("sends", bool))
            )
            bucket = np.searchsorted(cut_points(buckets), mixed(least), side="right")
            chosen = np.flatnonzero(sends)
            chosen = chosen[np.argsort(bucket[chosen], kind="stable")]
            cuts = np.flatnonzero(np.diff(bucket[chosen])) + 1
            for group in np.split(chosen, cuts) if len(chosen) else ():
                rows.append({
                    "bucket": int(bucket[group[0]]), "block": block, "count": (end - begin)[group].tobytes(), "name": name[group].tobytes(),
                    "repeated": repeated[group].tobytes(),
                    "body": b"".join(body[begin[g] : end[g] + width - 1] for g in group.tolist()),
                })
        return pa.Table.from_pylist(rows, TEXTS_SCHEMA)

    def finish(block_table: pa.Table, answers: pa.Table) -> pa.Table:
        rows, told = [], answers.to_pylist()
        own = next((r for r in told if r["begin"] is not None), None)
        bits: dict[int, np.ndarray] = {}
        for r in (r for r in told if r["begin"] is None):
            at = 0
            for name, n in zip(array_of(r["name"], np.uint64).tolist(), array_of(r["count"], np.int64).tolist()):
                size = -(-n // 8)
                bits[name] = np.unpackbits(np.frombuffer(r["bits"], np.uint8, size, at), count=n)
                at += size
        for _, ids, ends, body in parts(block_table):
            starts = []
            if own:
                pieces_ = (array_of(own[n], kind).tolist() for n, kind in (("begin", np.int64), ("end", np.int64), ("name", np.uint64), ("repeated", np.uint8)))
                for begin, end, name, repeated in zip(*pieces_):
                    if repeated:
                        starts.append(np.arange(begin, end))
                    elif name in bits:
                        starts.append(begin + np.flatnonzero(bits[name]))
            gone = covered(np.concatenate(starts) if starts else np.zeros(0, np.int64), width, len(body))
            data, begin = np.frombuffer(body, np.uint8), 0
            for doc, end in zip(ids, ends.tolist()):
                away = gone[begin:end]
                turns = np.flatnonzero(np.diff(away, prepend=False, append=False)).tolist()
                spans = [{"begin": a, "end": b} for a, b in zip(turns[::2], turns[1::2])]
                rows.append({"doc_id": doc, "n_bytes": end - begin, "kept": data[begin:end][~away].tobytes() if spans else body[begin:end], "spans": spans})
                begin = end
        return pa.Table.from_pylist(rows, OUT_SCHEMA)

    found = grouped.cogroup(marked.groupBy("block")).applyInArrow(send, TEXTS).groupBy("bucket").applyInArrow(sorted_bucket(width), FOUND)
    told = marked.select("block", "begin", "end", "name", "repeated").unionByName(found, allowMissingColumns=True)
    return grouped.cogroup(told.groupBy("block")).applyInArrow(finish, OUT)
