"""Chat formatting: collapse cumulative snapshots, then render.

A logger that saves a conversation after every turn leaves prefixes of one conversation under
many ids.  Every conversation gets a rolling hash at each turn, which stands for all turns up
to it.  A conversation whose last hash is another one's hash at the same turn is a prefix of
it and goes in an anti-join; the maximal ones are rendered.

The rolling hash is a pair of running sums over turn hashes that contain the turn's place, so
it can be computed for stretches of a conversation apart and then added up: a conversation
that holds much of the table is no single task until its own text is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramloom.llm.common import Scratch, read_table

#: Turn numbers of one stretch.
STRETCH = 1_000
#: Sums are kept below this, so they never overflow.
_MODULUS = (1 << 61) - 1


def _running(value: Column, within: list[str], order: list[Column], inclusive: bool = True) -> Column:
    rows = Window.partitionBy(*within).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    return F.coalesce(F.sum(value).over(rows), F.lit(0))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, place (1, 2, ...), h1, h2 and n_turns for every turn.

    Turns are ordered by turn (null last), role and text; ties of all three are equal turns.
    A null role and a null text differ from empty ones.
    """
    ordered = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role"), F.xxhash64("text").alias("_t1"),
        F.xxhash64(F.lit(1), F.isnull("role"), "role", F.isnull("text"), "text").alias("_t2"),
        F.floor(F.coalesce(F.col("turn").cast("long"), F.lit(1 << 53)) / STRETCH).alias("_stretch"))
    stretch = ["conv_id", "_stretch"]
    sizes = ordered.groupBy(*stretch).agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(
        F.col("conv_id").alias("_conv"), F.col("_stretch").alias("_of"),
        _running(F.col("_n"), ["conv_id"], [F.col("_stretch")], False).alias("_before"),
        F.sum("_n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("_t1"), F.col("_t2")]
    inside = ordered.withColumn("_row", F.row_number().over(Window.partitionBy(*stretch).orderBy(*order)))
    placed = inside.join(starts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_stretch") == F.col("_of"))) \
        .withColumn("place", (F.col("_before") + F.col("_row")).cast("long"))
    hashed = placed
    for k in (1, 2):
        hashed = hashed.withColumn(
            f"_e{k}", F.pmod(F.xxhash64(F.lit(k), "place", "_t1", "_t2"), F.lit(_MODULUS)).cast("decimal(20,0)"))
    sums = hashed.groupBy(*stretch).agg(F.sum("_e1").alias("_s1"), F.sum("_e2").alias("_s2"))
    earlier = sums.select(
        F.col("conv_id").alias("_conv2"), F.col("_stretch").alias("_of2"),
        *[_running(F.col(f"_s{k}"), ["conv_id"], [F.col("_stretch")], False).alias(f"_p{k}") for k in (1, 2)])
    joined = hashed.join(
        earlier, F.col("conv_id").eqNullSafe(F.col("_conv2")) & (F.col("_stretch") == F.col("_of2")))
    rolling = [
        ((_running(F.col(f"_e{k}"), stretch, [F.col("place")]) + F.col(f"_p{k}")) % F.lit(_MODULUS))
        .cast("long").alias(f"h{k}") for k in (1, 2)]
    return joined.select("conv_id", "place", "n_turns", *rolling)


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id and n_turns of the conversations that are no prefix of another one.

    Of equal conversations the least conv_id stays; a null conv_id is one conversation, last.
    """
    scratch = Scratch(turns.sparkSession, "chat")
    rolled = scratch.save(prefixes(turns), "prefixes")
    key = ["place", "h1", "h2"]
    last = F.col("place") == F.col("n_turns")
    known = rolled.groupBy(*key).agg(
        F.max("n_turns").alias("longest"), F.min(F.when(last, F.col("conv_id"))).alias("first_id"))
    complete = rolled.where(last)
    covered = known.select(*[F.col(c).alias(f"_{c}") for c in key], "longest", "first_id")
    same = (F.col("place") == F.col("_place")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    beaten = (F.col("longest") > F.col("n_turns")) | ~F.coalesce(
        F.col("first_id").eqNullSafe(F.col("conv_id")), F.lit(False))
    return complete.join(covered, same & beaten, "left_anti").select("conv_id", "n_turns")


def render(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and text of each maximal conversation of ``turns``.

    A turn is written as ``<|role|>``, a line break, its text and a line break.  A null role is
    written as ``unknown``, a null text as nothing.  An empty table gives an empty result.
    """
    kept = maximal(turns)
    # One output row holds a conversation, so its turns must meet in one task here.
    written = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"),
                       F.coalesce("text", F.lit("")), F.lit("\n"))
    turn = F.struct(
        F.isnull("turn").alias("a"), F.col("turn").alias("b"), F.col("role").alias("c"),
        F.xxhash64("text").alias("d"), written.alias("e"))
    own = kept.select(F.col("conv_id").alias("_kept"), "n_turns")
    chosen = turns.withColumn("_conv", F.col("conv_id").cast("long")).join(
        own, F.col("_conv").eqNullSafe(F.col("_kept")))
    return chosen.groupBy("_conv").agg(
        F.first("n_turns").alias("n_turns"), F.array_sort(F.collect_list(turn)).alias("turns")).select(
        F.col("_conv").alias("conv_id"), "n_turns",
        F.array_join(F.transform("turns", lambda t: t["e"]), "").alias("text"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return render(read_table(spark, sf_dir, "conversations"))


#: Whole prefixes are compared as text; conversations of more turns come first.
ORACLE = """
with t as (
    select conv_id, row_number() over w as place,
           '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) as turn_text
    from conversations window w as (partition by conv_id order by turn nulls last, role, text)),
p as (
    select conv_id, place, count(*) over (partition by conv_id) as n_turns,
           string_agg(turn_text, '') over (partition by conv_id order by place) as prefix from t),
whole as (select * from p where place = n_turns)
select w.conv_id, cast(w.n_turns as bigint) as n_turns, w.prefix as text
from whole w where not exists (
    select 1 from p where p.place = w.place and p.prefix = w.prefix
    and (p.n_turns > w.n_turns or (p.n_turns = w.n_turns and p.conv_id < w.conv_id)))
"""
