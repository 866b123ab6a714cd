import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    # names that the operators use inside
    *[T.StructField(n, T.StringType()) for n in ("block", "keys", "id", "doc", "pair", "shard", "n_chars", "weight", "host", "html")],
])


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and long texts, copies, near copies, repeated rows, shared passages and lines."""
    rng = random.Random(5)
    base, line, passage = words(rng, 120), "  The Common Line of Many Texts\t", words(rng, 60)
    out = [(1, None), (2, ""), (3, "   \n\n \t"), (4, "one"), (5, "Two words"), (6, base), (7, base), (7, base), (None, base), (None, None)]
    near = base.split()
    near[50] = "changed"
    out += [(8, " ".join(near)), (9, base.upper()), (10, line + "\n" + words(rng, 30)), (11, words(rng, 5) + "\nthe common line of many texts\n" + words(rng, 4))]
    out += [(20 + k, words(rng, 40) + " " + passage + "\n" + line + "\n" + words(rng, 20 + k)) for k in range(12)]
    out += [(40, "a " * 3000), (41, words(rng, 20000)), (42, "x" * 5000), (43, "ééé ßß ñ " * 40), (44, "short\nshort\nlong enough line\nlong enough line")]
    far = base.split()
    for k in range(40):  # copies of one text, each edited in other places
        own = list(far)
        for at in rng.sample(range(120), 3 + k % 8):
            own[at] = f"w{k}x{at}"
        out.append((100 + k, " ".join(own)))
    return [(i, t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 4}" if i != 5 else None, *["noise"] * 10) for i, t in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
