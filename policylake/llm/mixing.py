"""Mixing sources to target weights by temperature, with DataFrame functions only.

A source's weight is its share of the tokens to the power of an exponent, normalised. The exponent is bisected between 1
(shares as they are) and 0 (all sources alike) until the weights' entropy reaches a target, or as long as no source is repeated more often than
a limit allows. Weights then become token budgets. A source's documents are dealt to blocks by a hash; each epoch
permutes the blocks and the documents in them by another hash. Whole blocks are taken until the budget is spent; the block in
which it ends is taken up to the document that crosses it. Running sums thus go over a source's block totals and over
the documents of one block, never over a source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

WORD = r"[^\x20\x09-\x0D]+"
DOCS_A_BLOCK = 4096
HALVINGS, AT_ONCE = 40, 4


def key_number(*parts: Column) -> Column:
    """A number below 2**32 from the text of the parts, the same in every SQL engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def bisected(sources: DataFrame, holds: Callable[[Column, Column], Column]) -> float:
    """The largest exponent in (0, 1], of 2**-40 steps, at which ``holds(share, weight)`` aggregates to true; 0 if none does.

    ``holds`` must be true below the answer and false above it. A pass halves the bracket four times: it weighs the
    sources under all fifteen exponents between its ends in one aggregate.
    """
    def true_at(exponents: list[float]) -> list[bool]:
        tried = sources.withColumn("a", F.explode(F.array(*[F.lit(x) for x in exponents]))).withColumn("p", F.pow("share", F.col("a")))
        total = tried.groupBy("a").agg(F.sum("p").alias("total"))
        rows = tried.join(F.broadcast(total), "a").groupBy("a").agg(holds(F.col("share"), F.col("p") / F.col("total")).alias("ok"))
        found = {r["a"]: bool(r["ok"]) for r in rows.collect()}  # at most fifteen rows
        return [found.get(x, False) for x in exponents]

    if true_at([1.0])[0]:
        return 1.0
    low, step = 0.0, 1.0
    for _ in range(HALVINGS // AT_ONCE):
        step /= 2**AT_ONCE
        tried = [low + step * k for k in range(1, 2**AT_ONCE)]
        low += step * sum(true_at(tried))
    return low


def mixture(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    target_entropy: float | None = 0.95, most_repeats: float | None = 4.0, budget: int | None = None, seed: int = 7,
) -> DataFrame:
    """Rows ``(doc_id, source, n_tokens, epoch, block, block_rank, rank_in_block, weight)``: the documents of a mixture, in order.

    ``target_entropy`` is a fraction of the entropy of equal weights. The exponent is the largest that reaches it; if a source would then
    be repeated more than ``most_repeats`` times, the smallest that keeps the limit (which is at most 1) is taken instead. ``budget`` tokens
    are spread by weight; by default as many as there are. A document is taken while the tokens before it in its source are
    below the source's budget, so each source gets its budget and at most the rest of one document.

    Tokens are words. A document without words is never taken. A null source is a source of its own. Rows are documents: repeated rows
    are taken as often as they stand, ties between them broken by nothing that can be told apart.
    Rows with a null id take no part. An empty table gives no rows. Other columns are not read.
    """
    rows = stage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"),
    ).filter("n_tokens > 0 and doc_id is not null"), "tokens")
    sources = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))
    sources = stage(sources, "sources")
    totals = sources.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    total, count = totals[0] or 0, totals[1]
    spent = total if budget is None else budget
    sources = sources.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    exponent = 1.0
    if target_entropy is not None and count > 1:
        exponent = bisected(sources, lambda _, w: -F.sum(w * F.log(w)) >= F.lit(target_entropy) * F.log(F.lit(float(count))))
    if most_repeats is not None and count > 1:
        # Repeats grow as the exponent falls: bisect 1 - exponent.
        def kept(share: Column, weight: Column) -> Column:
            return F.max(weight * F.lit(float(spent)) / (share * F.lit(float(total)))) > F.lit(float(most_repeats))

        too_low = bisected(sources, kept)
        exponent = max(exponent, too_low)
    power = F.pow("share", F.lit(exponent))
    norm = sources.agg(F.sum(power)).first()[0] or 1.0
    weighed = sources.withColumn("weight", power / F.lit(norm)).withColumn("goal", F.floor(F.col("weight") * F.lit(float(spent))).cast("long"))
    plan = weighed.select(
        F.col("source").alias("of"), "tokens", "weight", "goal", F.ceil(F.col("n_docs") / DOCS_A_BLOCK).cast("long").alias("blocks"),
        F.floor(F.col("goal") / F.col("tokens")).cast("long").alias("full"),
    )
    same = F.col("source").eqNullSafe(F.col("of"))
    block = F.pmod(key_number(F.lit(seed), F.col("doc_id")), F.col("blocks"))
    dealt = rows.join(plan, same).withColumn("block", block).drop("of", "blocks")

    # Epochs 0 .. full - 1 take all of a source, epoch ``full`` what is left of its budget.
    ordered_block = key_number(F.lit(seed), F.col("epoch"), F.coalesce("source", F.lit("")), F.col("block"))
    sums = dealt.groupBy("source", "block", "full", "goal", "tokens").agg(F.sum("n_tokens").alias("inside"))
    sums = sums.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), "full")))
    by_block = Window.partitionBy("source", "epoch").orderBy(ordered_block, "block")
    sums = sums.select(
        F.col("source").alias("of"), F.col("block").alias("b"), "epoch", F.row_number().over(by_block).alias("block_rank"),
        (F.sum("inside").over(by_block) - F.col("inside") + F.col("epoch") * F.col("tokens")).alias("before"), F.col("goal").alias("aim"),
    ).filter("before < aim").drop("aim")
    joined = dealt.join(sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("b"))).drop("of", "b")
    within = Window.partitionBy("source", "epoch", "block").orderBy(key_number(F.lit(seed), F.col("epoch"), F.col("doc_id")), "doc_id")
    taken = joined.withColumn("rank_in_block", F.row_number().over(within)).withColumn(
        "passed", F.col("before") + F.sum("n_tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    )
    return taken.filter("passed < goal").select(
        "doc_id", "source", "n_tokens", "epoch", "block", F.col("block_rank").cast("long").alias("block_rank"),
        F.col("rank_in_block").cast("long").alias("rank_in_block"), "weight",
    )
