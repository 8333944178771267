"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions.

Each source gets a target number of words by its weight, at most ``repeats`` times its size;
what a full source cannot take is shared again among the others.  The mix consists of blocks
of equally many words.  They are apportioned by highest quotients (target / 1, / 3, / 5, ...)
first to the sources, then, within a source, to its shards, which gives every shard a whole
quota.  A shard lays its documents out in seeded order and takes a run of blocks that starts
at a seeded block and goes round, so whole documents are taken but for the run's two ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramloom.llm.common import SPACES, Scratch, n_words, opened, read_table, sealed

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
#: Words of a block.  Quotas are whole blocks, so a source misses its target by half a block.
BLOCK_WORDS = 8
#: Documents of a shard, about.
SHARD_ROWS = 2_000
SEED = 7


def sainte_lague(cells: DataFrame, group: Sequence[str], order: Sequence[str], votes: str,
                 seats: str) -> DataFrame:
    """Adds ``quota``: the group's ``seats`` shared by highest quotients votes / (2 k - 1).

    All quotients need not be listed.  With n cells and V votes, dividing by V / (seats - n / 2)
    and rounding hands out no seat too many, dividing by V / (seats + n / 2) no seat too few.
    Only the quotients between the two, at most about 2 n in a group, are ranked; ties go by
    ``order``.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    n, total = F.count(F.lit(1)).over(whole), F.sum(F.col(votes).cast("double")).over(whole)

    def rounded(divided: Column) -> Column:
        return F.floor(F.when(total > 0, F.col(votes) * F.greatest(divided, F.lit(0.0)) / total)
                       .otherwise(0.0) + 0.5)

    bounds = cells.withColumns({
        "_least": rounded(F.col(seats) - n / 2), "_most": rounded(F.col(seats) + n / 2)})
    bounds = bounds.withColumn("_open", F.col(seats) - F.sum("_least").over(whole))
    keys = [*group, *order]
    ranked = bounds.where("_most > _least").withColumn(
        "_k", F.explode(F.sequence(F.col("_least") + 1, F.col("_most"))))
    by_quotient = whole.orderBy((F.col(votes) / (2 * F.col("_k") - 1)).desc(), *order)
    won = ranked.withColumn("_rank", F.row_number().over(by_quotient)).where("_rank <= _open")
    more = won.groupBy(*[F.col(k).alias(f"_won_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_more"))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_won_{key}"))
    return bounds.join(more, same, "left").select(
        *cells.columns,
        (F.col("_least") + F.coalesce("_more", F.lit(0))).cast("long").alias("quota"))


def targets(by_source: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """Adds ``target`` to one row (source, source_size) per source.

    A level of words per weight rises until the sources it would overfill, held at their
    limit, and the others take ``share`` of all words together.  The loop reads one row of
    sums a round, and a round fills at least one more source.
    """
    # One row per source: their number is small beside the documents'.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = by_source.withColumn("_weight", weight).withColumn(
        "_limit", repeats * F.col("source_size").cast("double"))
    sums = weighed.agg(F.sum("source_size"), F.sum("_weight")).first()
    wanted = share * (sums[0] or 0)
    level, full = (wanted / sums[1] if sums[1] else 0.0), -1
    while True:
        over = F.col("_weight") * F.lit(level) > F.col("_limit")
        row = weighed.agg(
            F.count_if(over), F.sum(F.when(over, F.col("_limit"))),
            F.sum(F.when(~over, F.col("_weight")))).first()
        if row[0] == full or not row[2]:
            break
        full, level = row[0], (wanted - (row[1] or 0.0)) / row[2]
    return weighed.withColumn(
        "target", F.least(F.col("_weight") * F.lit(level), F.col("_limit"))).drop("_weight", "_limit")


def mix(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
        block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """Adds source_size, target and taken to ``sized`` (doc_id, source, size and more columns).

    A null source is a source of its own, last in order.  A document without words is never
    taken.  Rows of one id are separate documents.  An empty table gives an empty result.
    """
    scratch = Scratch(sized.sparkSession, "mix")
    base = scratch.save(sized, "sized")
    per_source = scratch.save(base.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")), "sources")
    aimed = targets(per_source, weights, share, repeats)
    whole = Window.partitionBy(F.lit(0))
    aimed = aimed.withColumn("_seats", F.round(F.sum("target").over(whole) / block_words).cast("long"))
    by_source = scratch.save(
        sainte_lague(aimed, [], ["source"], "target", "_seats").select(
            F.col("source").alias("_source"), "source_size", "target", F.col("quota").alias("_blocks"),
            F.ceil(F.col("_rows") / SHARD_ROWS).cast("int").alias("_shards")), "blocks")

    order = F.xxhash64(F.lit(seed), "doc_id", "size")
    dealt = base.join(by_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumns({
        "_order": order, "_shard": F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), F.col("_shards"))})
    cells = dealt.groupBy("source", "_shard").agg(
        F.sum("size").alias("_words"), F.first("_blocks").alias("_blocks"))
    quotas = sainte_lague(cells, ["source"], ["_shard"], "_words", "_blocks").select(
        F.col("source").alias("_source"), F.col("_shard").alias("_cell"), "_words",
        F.least(F.col("quota") * block_words, repeats * F.col("_words")).alias("_take"))
    shard = Window.partitionBy("source", "_shard").orderBy("_order", "doc_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    laid = dealt.withColumn("_end", F.sum("size").over(shard)).join(
        quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_cell")))
    words = F.greatest(F.col("_words"), F.lit(1))
    times = F.floor(F.col("_take") / words)
    rest = F.col("_take") - times * words
    first = F.pmod(F.xxhash64(F.lit(seed + 2), "source", "_shard"),
                   F.ceil(words / block_words)) * block_words
    begin = F.col("_end") - F.col("size")

    def inside(low: Column, high: Column) -> Column:
        return F.greatest(F.least(F.col("_end"), high) - F.greatest(begin, low), F.lit(0))

    run = inside(first, F.least(first + rest, words)) + inside(F.lit(0), first + rest - words)
    taken = (times * F.col("size") + run).cast("long")
    return laid.withColumn("taken", taken).select(*base.columns, "source_size", "target", "taken")


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(F.col("text")).alias("size"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mix(sizes(read_table(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document as often as it is taken whole,
    and once more with its first words where a run of blocks ends inside it.

    Equal rows are mixed as one document and share what it takes.  Documents without words
    take no part in a mix and stay as they are.  n_chars, where there is such a column, is
    that of the new text.
    """
    marked = sealed(docs).select(
        "row", F.col("row.doc_id").cast("long").alias("_id"), F.xxhash64("row.text").alias("_text"),
        F.col("row.source").alias("_source"), n_words(F.col("row.text")).alias("_size"))
    rows = marked.groupBy("_id", "_text", "_source", "_size").agg(F.count(F.lit(1)).alias("_n"))
    taken = mix(rows.select(
        F.col("_id").alias("doc_id"), F.col("_source").alias("source"),
        (F.col("_size") * F.col("_n")).alias("size"), "_text", "_n"))
    each = taken.select(
        F.col("doc_id").alias("_tid"), F.col("_text").alias("_ttext"), F.col("source").alias("_tsource"),
        F.floor(F.col("taken") / F.col("_n")).alias("_taken"))
    joined = marked.join(
        each, F.col("_id").eqNullSafe(F.col("_tid")) & (F.col("_text") == F.col("_ttext"))
        & F.col("_source").eqNullSafe(F.col("_tsource")))
    text, words = F.col("row.text"), F.greatest(F.col("_size"), F.lit(1))
    times, rest = F.floor(F.col("_taken") / words), F.col("_taken") % words
    start = F.array_join(F.slice(F.array_remove(F.split(text, SPACES), ""), F.lit(1), rest.cast("int")), " ")
    texts = F.when(F.col("_size") == 0, F.array(text)).otherwise(F.concat(
        F.array_repeat(text, times.cast("int")),
        F.when(rest > 0, F.array(start)).otherwise(F.array().cast("array<string>"))))
    changed = {"text": F.col("_out")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_out").eqNullSafe(text), F.col("row.n_chars")).otherwise(
            F.length("_out").cast("long"))
    return opened(joined.withColumn("_out", F.explode(texts)), docs.columns, **changed)
