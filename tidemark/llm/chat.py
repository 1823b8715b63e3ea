"""Logged conversations: collapse cumulative snapshots, then render what is left. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import written
from tidemark.session import run_dir

SPAN = 1024  # turns of a conversation that are sorted together


def _escaped(text: Column) -> Column:
    """Undone by replacing '<\\|' with '<|' and then '<\\\\' with '<\\'."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("<\\"), F.lit("<\\\\"))
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def render_turn(role: Column, text: Column) -> Column:
    """One turn as text; its marks can't occur inside role or text."""
    return F.concat(F.lit("<|"), _escaped(role), F.lit("|>\n"), _escaped(text), F.lit("<|end|>\n"))


def _numbered(turns: DataFrame) -> DataFrame:
    """Turns in order without repeated rows: conv_id, span, place in the span, role, text."""
    own = Window.partitionBy("conv_id", "span").orderBy("turn", "role", "text")
    repeated = F.col("same") & F.col("same").isNotNull()
    return (
        turns.withColumn("span", F.floor(F.coalesce("turn", F.lit(0)) / SPAN))
        .withColumn("row", F.struct("turn", "role", "text"))
        .withColumn("same", F.lag("row").over(own).eqNullSafe(F.col("row")))
        .where(~repeated).drop("same", "row")
        .withColumn("place", F.row_number().over(own))
    )


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, n (turns), k, and the hashes of the first k turns, for every k."""
    before = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    key = ["conv_id", "span"]

    def join(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select(*(F.col(c).alias(f"_{c}") if c in key else F.col(c) for c in right.columns))
        return left.join(right, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]).drop(*(f"_{c}" for c in key))

    sizes = turns.groupBy(*key).agg(F.count("*").alias("size"))
    sizes = sizes.select(*key, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"), F.sum("size").over(whole).alias("n"))
    k = F.col("base") + F.col("place")
    turn = [k, F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    hashed = join(turns, sizes).select(
        *key, "n", "place", k.alias("k"), F.xxhash64(F.lit(1), *turn).alias("h1"), F.xxhash64(F.lit(2), *turn).alias("h2")
    )
    # Turn hashes know their rank, so their exclusive or stands for the turns in their order.
    own = Window.partitionBy(*key).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    spans = hashed.groupBy(*key).agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    spans = spans.select(*key, *(F.coalesce(F.bit_xor(b).over(before), F.lit(0)).alias(b) for b in ("b1", "b2")))
    running = hashed.withColumns({h: F.bit_xor(h).over(own) for h in ("h1", "h2")})
    return join(running, spans).select(
        "conv_id", "n", "k", F.col("h1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("h2").bitwiseXOR(F.col("b2")).alias("p2")
    )


def collapse_snapshots(conversations: DataFrame, *, turns_per_row: int = 256) -> DataFrame:
    """(conv_id, part, n_turns, n_copies, rendered): the conversations that begin no longer one, as text.

    `conversations` has a row per turn: conv_id, turn, role, text; others are left out. Turns are taken
    in order of (turn, role, text), nulls first, and a row repeated in all four counts once. Numbers of
    turns only order them. A conversation whose turns are the first turns of a longer one goes; of
    equal ones the smallest conv_id stays, with their number in n_copies. Rows without a conv_id are
    one conversation with a null id, kept under its null id unless an equal one has an id. A null role
    or text differs from an empty one and is rendered like it. The text of a conversation is its
    `rendered` in order of `part`; each part has up to `turns_per_row` turns, so a conversation of any
    length is never gathered in one place. An empty table gives an empty result.
    """
    folder = run_dir(conversations.sparkSession, "chat")
    turns = _numbered(conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    ))
    prefixes = written(_prefixes(turns), f"{folder}/prefixes")
    ends = prefixes.where("k = n").groupBy("n", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    begun = prefixes.where("k < n").select(F.col("k").alias("n"), "p1", "p2").distinct()
    kept = written(
        ends.join(begun, ["n", "p1", "p2"], "left_anti").select(F.col("conv_id").alias("id"), F.col("n").alias("n_turns"), "n_copies"),
        f"{folder}/kept",
    )
    before = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    base = turns.groupBy("conv_id", "span").agg(F.count("*").alias("size")).select(
        F.col("conv_id").alias("id"), F.col("span").alias("s"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")
    )
    spans = base.join(kept.withColumnRenamed("id", "kept_id"), F.col("id").eqNullSafe(F.col("kept_id"))).drop("kept_id")
    return (
        turns.join(spans, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("span") == F.col("s")))
        .withColumn("k", F.col("base") + F.col("place"))
        .withColumn("part", F.floor((F.col("k") - 1) / turns_per_row))
        .groupBy("conv_id", "part", "n_turns", "n_copies")
        .agg(F.sort_array(F.collect_list(F.struct("k", "role", "text"))).alias("turns"))
        .select("conv_id", "part", "n_turns", "n_copies",
                F.array_join(F.transform("turns", lambda t: render_turn(t["role"], t["text"])), "").alias("rendered"))
    )
