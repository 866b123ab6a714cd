"""Document fingerprints by winnowing, with DataFrame functions only.

Every run of ``GRAM`` tokens of a text is hashed; of every ``WINDOW`` consecutive hashes the least is chosen, the rightmost of equal ones. The
chosen hashes with their positions are the fingerprint. Two texts that share ``GRAM + WINDOW - 1`` consecutive tokens share a
whole window, hence a chosen hash, wherever the passage stands in them; the positions tell where. Tokens are words; a text whose words
are longer than ``LONG`` code points on average has runs of ``RUN`` code points, from its start, as tokens.

A text's tokens are cut into blocks of ``BLOCK`` windows, each with the tokens that its last window reaches over, so a row stays small
whatever the length of the text. A block's tokens are columns: the hash of a run rolls up from the hashes of its halves, and the least of a
window from the least of its halves, so all of it is compiled code without lambdas, sorts or window frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

# Both powers of two.
GRAM, WINDOW = 4, 8
REACH = GRAM + WINDOW - 1
BLOCK = 32
PLACES = 128  # more than the hashes of a block
NONE = 2**62  # more than any hash
BLANKS = "\t\n\v\f\r"
LONG, RUN = 16, 4
ORDER_PARTITIONS, KEYS_A_PART = 64, 1_000_000


def tokens(text: str) -> Column:
    """The words of a text between blanks; runs of code points where words are not what it is made of."""
    plain = F.col(text)
    for blank in BLANKS:
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    words = F.array_remove(F.split(plain, " "), "")
    return F.when(F.size(words) * (LONG + 1) < F.char_length(text), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{RUN}}}"), F.lit(0))).otherwise(words)


def token_blocks(texts: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """One row for each block of a text: its number ``b`` and its ``tokens``, those its last window reaches over included. Without tokens, one empty block."""
    split = texts.withColumn("all", tokens(text))
    last = F.greatest(F.size("all") - 1, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), F.floor(last / BLOCK).cast("int")), lambda b: F.slice("all", b * BLOCK + 1, BLOCK + REACH - 1))
    return split.select(*keep, F.posexplode(cut).alias("b", "tokens"))


def chosen(blocks: DataFrame, keep: list[str]) -> DataFrame:
    """``marks``: the chosen hashes of a block as ``hash * PLACES + PLACES - 1 - place``, so that the rightmost of equal ones is the least."""
    count = BLOCK + REACH - 1
    keep = [*keep, "b"]
    rows = blocks.select(*keep, F.size("tokens").alias("size"), *[F.xxhash64(F.get("tokens", F.lit(i))).alias(f"m{i}") for i in range(count)])
    width = 1
    while width < GRAM:
        count -= width
        rows = rows.select(*keep, "size", *[F.xxhash64(f"m{i}", f"m{i + width}").alias(f"m{i}") for i in range(count)])
        width *= 2

    def mark(i: int) -> Column:
        # A text shorter than one run has a single run, of all it has.
        there = F.col("size") >= i + GRAM
        there = there | ((F.col("b") == 0) & (F.col("size") > 0)) if i == 0 else there
        return F.when(there, F.shiftrightunsigned(f"m{i}", 32) * PLACES + (PLACES - 1 - i)).otherwise(F.lit(NONE))

    rows = rows.select(*keep, "size", *[mark(i).alias(f"m{i}") for i in range(count)])
    width = 1
    while width < WINDOW:
        count -= width
        rows = rows.select(*keep, "size", *[F.least(f"m{i}", f"m{i + width}").alias(f"m{i}") for i in range(count)])
        width *= 2
    # A window counts if it is whole; a text shorter than one window has a single one.
    whole = [(F.col("size") >= i + REACH) | ((F.col("b") == 0) if i == 0 else F.lit(False)) for i in range(BLOCK)]
    windows = F.array(*[F.when(w, F.col(f"m{i}")).otherwise(F.lit(NONE)) for i, w in enumerate(whole)])
    return rows.select(*keep, F.array_remove(F.array_distinct(windows), NONE).alias("marks"))


def fingerprints(texts: DataFrame, by: list[str], text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``(*by, *carry, places, hashes)`` for rows named by ``by``: the places (from 0, ascending, below 2**31) of the chosen token runs, and their 32-bit hashes.

    Null and empty texts, and those of blanks alone, have none. ``carry`` are columns that go along, in a text's first block only.
    """
    carry = carry or []
    cut = token_blocks(texts, [*by, *carry], text).select(*by, *[F.when(F.col("b") == 0, F.col(c)).alias(c) for c in carry], "b", "tokens")
    marks = chosen(cut, [*by, *carry])
    place = lambda m: F.col("b").cast("long") * BLOCK + (PLACES - 1 - m.bitwiseAND(F.lit(PLACES - 1)))
    # A run chosen by the last windows of a block may be chosen by the next block too: place before hash makes them one number.
    packed = F.transform("marks", lambda m: F.shiftleft(place(m), 32).bitwiseOR(F.shiftright(m, 7)))
    marks = marks.select(*by, *carry, F.when(F.size("marks") > 0, packed).alias("marks"))
    out = marks.groupBy(*by).agg(
        *[F.max(c).alias(c) for c in carry], F.sort_array(F.array_distinct(F.flatten(F.collect_list("marks")))).alias("all_marks"),
    )
    return out.select(
        *by, *carry, F.transform("all_marks", lambda m: F.shiftright(m, 32)).alias("places"),
        F.transform("all_marks", lambda m: m.bitwiseAND(F.lit(2**32 - 1))).alias("hashes"),
    )


def printed(places: Column, hashes: Column) -> Column:
    """A fingerprint as text: ``place:hash`` of each chosen run, hash in eight hexadecimal digits."""
    return F.array_join(F.zip_with(places, hashes, lambda p, h: F.concat(p.cast("string"), F.lit(":"), F.lpad(F.lower(F.hex(h)), 8, "0"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Hashes in both of two fingerprints, as a share of those in either; two empty ones are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def following(keys: DataFrame) -> DataFrame:
    """``(id, name, chars, again, next_id, next_name, copies)``: for every ``(id, name)`` counted ``n`` times what follows it, ids descending (null last), then names.

    Each of several copies is followed by the next one (``again``, ``n - 1`` copies), the last by the next key, and the last key of all by the first. Keys are
    dealt to partitions by range, so no task sees more than its share, however ids are spread; the partitions' first keys close the gaps.
    """
    order = [F.col("id").desc_nulls_last(), F.col("name").asc()]
    parts = max(ORDER_PARTITIONS, keys.count() // KEYS_A_PART)
    dealt = stage(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "text-order")
    inside = Window.partitionBy("part").orderBy(*order)
    lead = [F.lead(F.struct("id", "name")).over(inside).alias("after"), F.row_number().over(inside).alias("nth")]
    rows = dealt.select("part", "id", "name", "n", "chars", *lead)
    # One row for each part; what follows the last key of all is the first.
    firsts = stage(rows.filter("nth = 1").select("part", F.struct("id", "name").alias("own")), "text-parts")
    start = firsts.agg(F.min_by("own", "part").alias("start"))
    chain = firsts.select("part", F.lead("own").over(Window.orderBy("part")).alias("later")).crossJoin(start)
    rows = rows.join(F.broadcast(chain), "part")
    after = F.coalesce("after", "later", "start")
    to_next = F.struct(F.lit(False).alias("again"), after["id"].alias("id"), after["name"].alias("name"), F.lit(1).cast("long").alias("copies"))
    to_copy = F.struct(F.lit(True).alias("again"), F.col("id"), F.col("name"), (F.col("n") - 1).alias("copies"))
    links = rows.select("id", "name", "chars", F.explode(F.when(F.col("n") > 1, F.array(to_next, to_copy)).otherwise(F.array(to_next))).alias("to"))
    return links.select("id", "name", "chars", "to.again", F.col("to.id").alias("next_id"), F.col("to.name").alias("next_name"), F.col("to.copies").alias("copies"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited one, and how alike they are.

    The edited text has the last ``floor(n_chars / 2)`` code points replaced by the first as many (or all) of the next document, ids
    descending, null ids last; after the last comes the first. Rows ``(doc_id, n_chars, edited_sha256, places, hashes, edited_places,
    edited_hashes, near_edited, near_next)``, one for each row of ``docs``. Null texts are empty. Rows with one id follow each other by a
    hash of their texts; repeated rows are followed by each other. A single row is followed by itself. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("name", F.xxhash64("text"))
    keys = rows.groupBy("id", "name").agg(F.count(F.lit(1)).alias("n"), F.first(F.char_length("text")).alias("chars"))
    links = stage(following(keys), "text-links")

    # Each distinct (id, text) once; null ids need a key that joins.
    key = lambda i, n: [F.coalesce(F.col(i), F.lit(0)).alias("i"), F.col(i).isNull().alias("none"), F.col(n).alias("name")]
    by = ["i", "none", "name"]
    texts = rows.select(*key("id", "name"), "text").groupBy(*by).agg(F.first("text").alias("text"))
    marked = fingerprints(texts.withColumn("whole", F.col("text")), by, "whole", ["text"])
    # To the document before goes no more of a text than what replaces that one's end, and the hashes as they are compared.
    own = [F.coalesce(F.col("id"), F.lit(0)).alias("to_i"), F.col("id").isNull().alias("to_none"), F.col("name").alias("to_name")]
    after = marked.join(links.select(*key("next_id", "next_name"), *own, F.floor(F.col("chars") / 2).cast("int").alias("half"), "again", "copies"), by)
    after = after.select(
        *[F.col(f"to_{c}").alias(c) for c in by], "again", "copies", "half", F.left("text", F.col("half")).alias("end"),
        F.transform("hashes", lambda h: (h - 2**31).cast("int")).alias("next_hashes"),
    )
    edit = F.concat(F.left("text", F.char_length("text") - F.col("half")), F.col("end"))
    pairs = marked.join(after, by).select(
        *by, "again", "copies", F.char_length("text").cast("long").alias("n_chars"), edit.alias("edited"), F.sha2(edit, 256).alias("edited_sha256"),
        F.col("places").alias("own_places"), F.col("hashes").alias("own_hashes"),
        F.transform("next_hashes", lambda h: h.cast("long") + 2**31).alias("next_hashes"),
    )
    facts = ["copies", "n_chars", "edited_sha256", "own_places", "own_hashes", "next_hashes"]
    wide = fingerprints(pairs, [*by, "again"], "edited", facts).withColumnsRenamed(
        {"places": "edited_places", "hashes": "edited_hashes", "own_places": "places", "own_hashes": "hashes"}
    )
    near = {"near_edited": likeness(F.col("hashes"), F.col("edited_hashes")), "near_next": likeness(F.col("hashes"), F.col("next_hashes"))}
    out = wide.withColumns(near).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(
        F.when(~F.col("none"), F.col("i")).alias("doc_id"), "n_chars", "edited_sha256", "places", "hashes", "edited_places", "edited_hashes", *near,
    )
