"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence meet in one posterior: the likelihood of the text's letter trigrams under each language, the language
that the markup or the row declares, the suffix of the address, and the languages of the host, smoothed towards its
domain and the whole corpus. Trigram counts come from a bounded sample of the distinct texts of each declared language; all other
tables are grouped sums of the text posteriors over every row. A further class, ``und``, takes what no language explains better than
chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import texts, trimmed

GRAMS = 1 << 16
FIT_ROWS = 20_000
LEAST_TEXTS = 10
UNKNOWN = "und"
TEMPERATURE = 0.25  # overlapping trigrams are not independent
HOST_STRENGTH = 20.0
CHUNK = 1 << 20
SHARES = 1 << 40

_letters = bytearray(range(256))
for _b in range(128):
    _letters[_b] = ord(chr(_b).lower()) if chr(_b).isalpha() else 32
LETTERS = bytes(_letters)


def chunks(batch: pa.RecordBatch, most: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about a MB in all, with the place of the first; only these are held as Python values."""
    column = batch.column("text")
    sizes = np.nan_to_num(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.float64))
    begin, size = 0, 0.0
    for n, own in enumerate(sizes.tolist()):
        if size and size + own > most:
            yield begin, texts(batch.slice(begin, n - begin))
            begin, size = n, 0.0
        size += own
    if begin < len(sizes):
        yield begin, texts(batch.slice(begin))


def grams(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of the texts, two blanks before and after each; their starts; which trigrams are of blanks only."""
    data = b"  " + b"  ".join(rows).translate(LETTERS) + b"  "
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    starts = np.cumsum([0] + [len(r) + 2 for r in rows[:-1]])
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.uint16), starts, code == 0x202020


def primary(column: Column) -> Column:
    """A language tag's first part in lower case; empty is null."""
    tag = F.lower(F.regexp_extract(F.trim(F.coalesce(column.cast("string"), F.lit(""))), "^[A-Za-z]+", 0))
    return F.when(tag != "", tag)


def gram_counts(docs: DataFrame, fit_rows: int) -> dict[str, np.ndarray]:
    """Trigram counts of every declared language of at least LEAST_TEXTS distinct texts, from about ``fit_rows`` texts in all, and as many
    of each language as of any other that has them; they are chosen by a hash, and a text counts once however often it is copied."""
    said = docs.filter("declared is not null").withColumn("h", F.xxhash64("text"))
    sizes = said.select("declared", "h").distinct().groupBy("declared").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_TEXTS).collect()
    quota, spare, left = LEAST_TEXTS, fit_rows, len(sizes)
    for n in sorted(r["n"] for r in sizes):  # what small languages leave goes to larger ones
        quota = max(LEAST_TEXTS, spare // left)
        if n > quota:
            break
        spare, left = spare - n, left - 1
    cuts = docs.sparkSession.createDataFrame([(r["declared"], min(SHARES, int(quota / r["n"] * SHARES) + 1)) for r in sizes], "declared string, below long")
    fit = said.join(F.broadcast(cuts), "declared").filter(F.pmod("h", F.lit(SHARES)) < F.col("below")).select("declared", "h", "text").dropDuplicates(["declared", "h"])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in parts:
            declared = part.column("declared").to_pylist()
            for begin, rows in chunks(part):
                for language in set(declared[begin : begin + len(rows)]):
                    own = [r for r, d in zip(rows, declared[begin:]) if d == language]
                    code, _, blank = grams(own)
                    sums[language] = sums.get(language, 0) + np.bincount(code[~blank], minlength=GRAMS)
        for language, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["language", "gram", "n"])

    # At most languages x 2**16 rows.
    counted = stage(fit.mapInArrow(trimmed(count), "language string, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n")), "grams")
    known = sorted(r["language"] for r in counted.select("language").distinct().collect())
    out = {language: np.zeros(GRAMS) for language in known}
    for r in counted.collect():
        out[r["language"]][r["gram"]] = r["n"]
    return out


def gram_weights(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Log-odds of each trigram under each language against chance (all trigrams alike)."""
    rows = [np.log((c + 0.5) / (c.sum() + 0.5 * GRAMS) * GRAMS) for c in counts.values()]
    return np.array(rows, np.float32).reshape(len(counts), GRAMS)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared: Column | None = None, host: Column | None = None,
    domain: Column | None = None, suffix: Column | None = None, fit_rows: int = FIT_ROWS, least_probability: float = 0.5, unknown_prior: float = 0.001,
) -> DataFrame:
    """``(id, language, probability, text_language, declared, accepted)`` for each row.

    ``declared`` is a language tag (``fr-CA`` counts as ``fr``), ``host``, ``domain`` and ``suffix`` parts of an address; all may be absent or null.
    A row is accepted unless its best class is ``und`` (no letters, or letters that no language explains better than chance) or no
    class reaches ``least_probability``. A null or empty text is ``und``. Repeated rows get equal answers. Languages are those
    that at least LEAST_TEXTS distinct texts declare; if there are none, everything is ``und``. Other columns are not read.
    """
    null = F.lit(None).cast("string")
    part = lambda c: F.lower(c.cast("string")) if c is not None else null
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), (primary(declared) if declared is not None else null).alias("declared"),
        F.coalesce(part(host), F.lit("")).alias("host"), F.coalesce(part(domain), F.lit("")).alias("domain"), F.coalesce(part(suffix), F.lit("")).alias("suffix"),
    )
    counts = gram_counts(rows, fit_rows)
    languages, weights = list(counts), gram_weights(counts)
    n = len(languages)
    id_type = dict(rows.dtypes)["id"]
    ps = [f"p{k}" for k in range(n)]

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            evidence, letters = np.zeros((batch.num_rows, n)), np.zeros(batch.num_rows, np.int64)
            for begin, own in chunks(batch):
                code, starts, blank = grams(own)
                to = slice(begin, begin + len(own))
                letters[to] = np.add.reduceat(~blank, starts, dtype=np.int64)
                for k in range(n):
                    odds = weights[k][code]
                    odds[blank] = 0
                    evidence[to, k] = np.add.reduceat(odds, starts, dtype=np.float64)
            columns = [batch.column(c) for c in ("id", "declared", "host", "domain", "suffix")]
            posterior = softmax(TEMPERATURE * np.column_stack((evidence, np.zeros(len(letters))))) if n else np.ones((len(letters), 1))
            posterior[letters == 0, :n] = 0
            arrays = [pa.array(posterior[:, k]) for k in range(n)] + [pa.array(list(evidence), pa.list_(pa.float64())), pa.array(letters)]
            yield pa.RecordBatch.from_arrays(columns + arrays, names=["id", "declared", "host", "domain", "suffix", *ps, "evidence", "letters"])

    scored = rows.mapInArrow(trimmed(score), f"id {id_type}, declared string, host string, domain string, suffix string, " + "".join(f"{p} double, " for p in ps) + "evidence array<double>, letters long")
    scored = stage(scored, "language-scores")
    sums = [F.sum(p).alias(p) for p in ps] or [F.lit(0.0).alias("none")]
    fields = ps or ["none"]

    def packed(table: DataFrame, name: str) -> DataFrame:
        return table.withColumn(name, F.array(*fields)).drop(*fields)

    # Hosts below domains below the corpus; suffixes and declared languages as evidence of their own.
    hosts = stage(scored.groupBy("host", "domain", "suffix").agg(*sums), "hosts")
    domains = packed(hosts.groupBy("domain").agg(*sums), "by_domain")
    suffixes = packed(hosts.groupBy("suffix").agg(*sums), "by_suffix")
    context = stage(packed(hosts.groupBy("host", "domain", "suffix").agg(*sums), "by_host").join(domains, "domain").join(suffixes, "suffix"), "contexts")
    corpus = np.array(list(hosts.agg(*sums).first())[:n], float)
    corpus = np.nan_to_num(np.array([0.0 if v is None else v for v in corpus], float))
    claims = np.full((n + 1, n), 0.5)  # row: declared language or another one
    said = scored.filter("declared is not null").groupBy(F.when(F.col("declared").isin(languages), F.col("declared")).otherwise(UNKNOWN).alias("d")).agg(*sums)
    for r in said.collect():  # at most one row a known language and one more
        claims[languages.index(r["d"]) if r["d"] in counts else n] += [r[p] or 0.0 for p in ps]
    claims /= claims.sum(axis=0, keepdims=True) if n else 1
    base = (corpus + 1) / (corpus.sum() + n) if n else corpus

    def fuse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            size = batch.num_rows
            get = lambda c: batch.column(c).flatten().to_numpy().reshape(size, -1)[:, :n]
            letters = batch.column("letters").to_numpy()
            text = np.array([batch.column(p).to_numpy() for p in ps]).T.reshape(size, n)
            evidence = TEMPERATURE * get("evidence")
            # The row's own vote does not count for its host.
            by_host, by_domain, by_suffix = (np.maximum(get(c) - text, 0) for c in ("by_host", "by_domain", "by_suffix"))
            prior = (by_domain + HOST_STRENGTH * base) / (by_domain.sum(axis=1, keepdims=True) + HOST_STRENGTH)
            prior = (by_host + HOST_STRENGTH * prior) / (by_host.sum(axis=1, keepdims=True) + HOST_STRENGTH)
            mean = by_suffix.sum(axis=1, keepdims=True) / max(corpus.sum(), 1)
            tail = np.log((by_suffix + HOST_STRENGTH * mean + 1e-9) / (corpus + HOST_STRENGTH) / (mean + 1e-9)) if n else evidence
            declared = batch.column("declared").to_pylist()
            row_of = {language: k for k, language in enumerate(languages)}
            claim = np.zeros((size, n))
            for k, d in enumerate(declared):
                if d is not None:
                    claim[k] = np.log(claims[row_of.get(d, n)] / claims[row_of.get(d, n)].mean())
            log = np.column_stack((evidence + np.log(prior) + tail + claim, np.full(size, np.log(unknown_prior))))
            posterior = softmax(log)
            posterior[letters == 0] = np.eye(n + 1)[n]
            best = posterior.argmax(axis=1)
            names = np.array([*languages, UNKNOWN], object)
            probability = posterior[np.arange(size), best]
            by_text = np.where((letters == 0) | (evidence.max(axis=1, initial=-np.inf) <= 0), n, evidence.argmax(axis=1) if n else n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names[best], pa.string()), pa.array(probability), pa.array(names[by_text], pa.string()), batch.column("declared"), pa.array((best != n) & (probability >= least_probability))],
                names=["id", "language", "probability", "text_language", "declared", "accepted"],
            )

    joined = scored.join(context, ["host", "domain", "suffix"])
    out = joined.mapInArrow(trimmed(fuse), f"id {id_type}, language string, probability double, text_language string, declared string, accepted boolean")
    return out.withColumnRenamed("id", id_col)
