"""Lines repeated across documents, found through sharded minimal perfect hashes.

The distinct hashes of lines that occur in several documents are dealt to shards. A shard becomes a minimal perfect
hash (levels of bit arrays; a hash's index is the rank of the first bit it finds set) over three compact arrays: fingerprint,
number of lines, first document. Lines never meet lines: a document's hashes are looked up in the arrays of their
shards. A shard's arrays go to as many tasks as the lines that ask it fill, and the lines are dealt to these by document and
place, so a line that stands in a third of all documents is looked up in many tasks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import SPACES, mixed, texts, trimmed

KEYS_A_SHARD = 1 << 20
COPIES = 16  # of a shard at least
LINES_A_TASK = 1 << 20
GAMMA = 2.0


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z in lower case (bytes.lower leaves other letters alone)."""
    return line.strip(SPACES).lower()


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= 4 * least or (len(key) >= least and len(key.decode()) >= least)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: bit arrays by level, and ranks of their words."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.before = np.cumsum([0] + [int(level.sum()) for level in levels])
        self.ranks = [np.cumsum(level) - level for level in levels]

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = max(8, int(len(left) * GAMMA))
            at = cls._place(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)) % np.uint64(size)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; another key than those hashed gets any index or -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for n, level in enumerate(self.levels):
            if not len(left):
                break
            at = self._place(keys[left], n, len(level))
            hit = level[at]
            out[left[hit]] = self.before[n] + self.ranks[n][at[hit]]
            left = left[~hit]
        return out

    def packed(self) -> tuple[list[int], bytes]:
        return [len(level) for level in self.levels], b"".join(np.packbits(level).tobytes() for level in self.levels)

    @classmethod
    def unpacked(cls, sizes: list[int], data: bytes) -> PerfectHash:
        levels, at = [], 0
        for size in sizes:
            n = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, n, at), count=size).astype(bool))
            at += n
        return cls(levels)


LINES = "doc long, place int, shard int, hash long, print long"
LINES_SCHEMA = pa.schema([("doc", pa.int64()), ("place", pa.int32()), ("shard", pa.int32()), ("hash", pa.int64()), ("print", pa.int64())])
SHARD = "shard int, sizes array<long>, bits binary, prints binary, counts binary, firsts binary"
SHARD_SCHEMA = pa.schema([("shard", pa.int32()), ("sizes", pa.list_(pa.int64())), *[(n, pa.binary()) for n in ("bits", "prints", "counts", "firsts")]])
DROPS_SCHEMA = pa.schema([("doc", pa.int64()), ("place", pa.int32())])


def build_shard(key: tuple, table: pa.Table) -> pa.Table:
    hashes, prints, counts, firsts = (table.column(n).to_numpy() for n in ("hash", "print", "n", "first"))
    # Both halves of the 128-bit hash make the key, so equal first halves alone do no harm.
    hashes = mixed(hashes.view(np.uint64) ^ prints.view(np.uint64))
    index = PerfectHash.of(hashes)
    at = index.index(hashes)
    placed = [np.empty(len(hashes), kind) for kind in (np.int64, np.int64, np.int64)]
    for array, values in zip(placed, (prints, counts, firsts)):
        array[at] = values
    sizes, bits = index.packed()
    row = {"shard": key[0].as_py(), "sizes": sizes, "bits": bits, "prints": placed[0].tobytes(), "counts": placed[1].tobytes(), "firsts": placed[2].tobytes()}
    return pa.Table.from_pylist([row], SHARD_SCHEMA)


def probe(lines: pa.Table, shard: pa.Table) -> pa.Table:
    """The lines, of those that ask, whose arrays name another document first."""
    if not shard.num_rows or not lines.num_rows:
        return DROPS_SCHEMA.empty_table()
    row = shard.slice(0, 1).to_pylist()[0]
    index = PerfectHash.unpacked(row["sizes"], row["bits"])
    prints, counts, firsts = (np.frombuffer(row[n], np.int64) for n in ("prints", "counts", "firsts"))
    asked, doc = lines.column("print").to_numpy(), lines.column("doc").to_numpy()
    at = index.index(mixed(lines.column("hash").to_numpy().view(np.uint64) ^ asked.view(np.uint64)))
    drop = (at >= 0) & (prints[at] == asked) & (counts[at] > 1) & (firsts[at] != doc)
    return lines.select(["doc", "place"]).filter(pa.array(drop)).cast(DROPS_SCHEMA)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10, carry: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept, carried)``: texts without the lines that a document of smaller id holds too.

    Lines end at ``\\n``; a null or empty text is one empty line. Lines are the same when equal without white space at the ends
    and with A-Z in lower case; those under ``least`` characters always stay. Rows with one id are one document, so a
    repeated row drops nothing of its like. Rows with a null id are returned whole and make no line repeated. Columns named in
    ``carry`` come back as the struct ``carried``, others are not read. Lines are compared by 128 bits of hash.
    """
    carried = F.struct(*carry) if carry else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"), carried.alias("carried"))

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: list[list[int]] = [[], [], [], []]
            for doc, text in zip(part.column("doc").to_pylist(), texts(part)):
                if doc is None:
                    continue
                for place, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if long_enough(key, least):
                        h = xxhash.xxh3_128_intdigest(key)
                        for column, value in zip(out, (doc, place, h >> 64, h & 0xFFFFFFFFFFFFFFFF)):
                            column.append(value)
            hashes, prints = (np.array(c, np.uint64).view(np.int64) for c in out[2:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.nulls(len(hashes), pa.int32()), pa.array(hashes), pa.array(prints)],
                schema=LINES_SCHEMA,
            )

    lines = stage(rows.select("doc", "text").mapInArrow(trimmed(hashed), LINES).drop("shard"), "lines")
    again = lines.groupBy("hash", "print").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n")
    ).filter("first < last").drop("last")
    again = stage(again, "repeated-lines")
    shards = max(1, math.ceil(again.count() / KEYS_A_SHARD))
    shard = F.pmod(F.col("hash"), F.lit(shards)).cast("int").alias("shard")
    index = again.select(shard, "hash", "print", "n", "first").groupBy("shard").applyInArrow(build_shard, SHARD)
    # One row a shard, which is one for every million repeated lines.
    copies = lines.groupBy(shard).agg(F.greatest(F.lit(COPIES), F.ceil(F.count(F.lit(1)) / LINES_A_TASK)).cast("int").alias("copies"))
    copies = stage(copies, "shard-copies")
    index = stage(index, "line-shards").join(copies, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    index = index.drop("copies")
    asking = lines.select("doc", "place", shard, "hash", "print").join(copies, "shard")
    asking = asking.withColumn("copy", F.pmod(F.xxhash64("doc", "place"), F.col("copies")).cast("int")).drop("copies")
    drops = asking.groupBy("shard", "copy").cogroup(index.groupBy("shard", "copy")).applyInArrow(probe, "doc long, place int")
    drops = drops.groupBy("doc").agg(F.collect_list("place").alias("places"))

    def shortened(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, dropped, out = [], [], []
            for text, places in zip(texts(part), part.column("places").to_pylist()):
                split, gone = text.split(b"\n"), set(places or ())
                sizes.append(len(split))
                dropped.append(len(gone))
                out.append(b"\n".join(line for n, line in enumerate(split) if n not in gone).decode() if gone else text.decode())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64()), pa.array(out, pa.string()), part.column("carried")],
                names=["doc_id", "n_lines", "n_dropped", "kept", "carried"],
            )

    joined = rows.join(drops, "doc", "left").select("doc", "text", "places", "carried")
    kind = joined.schema["carried"].dataType.simpleString()
    return joined.mapInArrow(trimmed(shortened), f"doc_id long, n_lines long, n_dropped long, kept string, carried {kind}")
