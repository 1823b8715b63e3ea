"""Benchmark decontamination by template windows. Column expressions only.

Numbers, units and names of a text become typed placeholders; what is left is its template. Windows of
template words of every document meet those of the benchmark in one hash join. The values behind the
placeholders must then map consistently: an item's value has one counterpart in a document, so a
question asked with other numbers is found, and chance matches of a mere form are not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.graph import written
from tidemark.session import run_dir

#: Units that a number may be followed by; with the number they are slots.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents usd eur gbp percent degrees kmh mph"
).split()

COUNTS = 4  # an item of fewer numbers and nothing else is a year or a price, not a question
STARTS = 100_000  # lists of inner hashes up to this length are looked up within a document's array

NUMBER, UNIT, NAME, _SEP = "\ue001", "\ue002", "\ue003", "\ue004"  # from the private use area
_NAME = r"(?<=[\p{Ll}\p{N},;] )\p{Lu}\p{Ll}+"  # a capital within a sentence
_TOKEN = rf"\d+(?:[.,:/]\d+)*|{NAME}?[\p{{L}}\p{{M}}\p{{Nl}}\p{{No}}][\p{{L}}\p{{M}}\p{{N}}]*"


def _marked(text: Column, names: bool) -> Column:
    text = F.translate(F.coalesce(text, F.lit("")), NUMBER + UNIT + NAME + _SEP, "")
    return F.lower(F.regexp_replace(text, _NAME, f"{NAME}$0") if names else text)


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def _number(token: Column) -> Column:
    return F.ascii(token).between(48, 57)  # begins with a digit


def _template(tokens: Column) -> Column:
    def slot(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.element_at(tokens, i)).otherwise("")  # element_at counts from 1
        return (
            F.when(_number(x), NUMBER).when(x.startswith(NAME), NAME)
            .when(x.isin(UNITS) & _number(before), UNIT).otherwise(x)
        )

    return F.transform(tokens, slot)


def _readings(tokens: Column, marked: Column) -> Column:
    """A document with marked names, and if it has any, its windows of names once more with names as words.

    Whether a word counts as a name depends on what stands before it, which a copy may change.
    """
    words = F.transform(tokens, lambda x: F.translate(x, NAME, ""))
    names = F.transform(tokens, lambda x: F.when(x.startswith(NAME), "#").otherwise(""))
    slotted = lambda signs: F.regexp_like(marked, F.lit(f"[{signs}]"))
    first = F.struct(tokens.alias("tokens"), slotted(rf"{NAME}\d").alias("slotted"), F.lit(None).cast("array<string>").alias("only"))
    second = F.struct(words.alias("tokens"), slotted(r"\d").alias("slotted"), names.alias("only"))
    return F.when(marked.contains(NAME), F.array(first, second)).otherwise(F.array(first))


def _inner(hashes: Column, i: Column) -> Column:
    """A hash of the places 2 to 4 of the window from i on: what they are doesn't depend on the words around it."""
    return F.xxhash64(*(F.element_at(hashes, i + k) for k in (1, 2, 3)))


def _windows(df: DataFrame, lengths: list[int], inner: dict[int, list[int]] | None = None) -> DataFrame:
    """`df` with columns tokens, slotted and only: a row (pos, length, hash, slots, inner) for every window of its template.

    Where only isn't null, windows without a mark in it are left out, and so are, before they become rows,
    those of a length in `inner` whose places 2 to 4 aren't in its list.

    slots is null for windows of words, else the values at all places of the window, empty for words.
    A window of mostly slots is hashed with its values, number for number, and has null slots: only
    an exact copy meets it.
    """
    df = df.withColumn("template", F.when(F.col("slotted"), _template(F.col("tokens"))).otherwise(F.col("tokens")))
    df = df.withColumns({
        "hashes": F.transform("template", lambda x: F.xxhash64(x)),
        "values": F.when(F.col("slotted"), F.zip_with("template", "tokens", lambda t, x: F.when(t == x, "").otherwise(x))),
    }).withColumn("marks", F.transform("values", lambda v: F.when(v == "", "").otherwise("#")))

    def of(length: int) -> Column:
        def place(i: Column) -> Column:
            n_slots = F.when(F.col("slotted"), F.length(F.array_join(F.slice("marks", i, length), ""))).otherwise(0)
            return F.struct(i.alias("pos"), n_slots.alias("n"))

        def window(p: Column) -> Column:
            i, heavy = p["pos"], p["n"] * 2 > length
            return F.struct(
                i.alias("pos"), F.lit(length).alias("length"),
                F.when(heavy, F.xxhash64(F.slice("tokens", i, length), F.lit(_SEP)))
                .otherwise(F.xxhash64(F.slice("hashes", i, length))).alias("hash"),
                F.when((p["n"] > 0) & ~heavy, F.array_join(F.slice("values", i, length), _SEP)).alias("slots"),
                (_inner(F.col("hashes"), i) if inner is None and length > 3 else F.lit(None).cast("long")).alias("inner"),
            )

        some = F.size("hashes") >= length
        places = F.sequence(F.lit(1), F.when(some, F.size("hashes") - length + 1).otherwise(1))
        marked = F.filter(places, lambda i: F.array_join(F.slice("only", i, length), "") != "")
        places = F.when(F.col("only").isNull(), places).otherwise(marked)
        if inner is not None and length in inner:
            places = F.filter(places, lambda i: _inner(F.col("hashes"), i).isin(inner[length]))
        return F.when(some, F.transform(F.transform(places, place), window))

    all_ = [of(length) for length in lengths]
    one = all_[0] if len(all_) == 1 else F.concat(*(F.coalesce(a, F.array().cast(
        "array<struct<pos:int,length:int,hash:bigint,slots:string,inner:bigint>>")) for a in all_))
    keep = [c for c in df.columns if c not in ("tokens", "slotted", "only", "template", "hashes", "values", "marks")]
    return df.select(*keep, F.explode(one).alias("w")).select(*keep, "w.*")


def _benchmark_windows(items: DataFrame, width: int) -> DataFrame | None:
    """(item_id, pos, length, hash, slots, inner, n_windows): an item of fewer words than `width` is one window.

    Items are read with names as slots and once more with names as words, for copies in one case. Items
    of numbers alone are left out, see `_counts`.
    """
    variants = []
    for names in (True, False):
        marked = items.withColumn("marked", _marked(F.col("text"), names))
        variants.append(marked.select("item_id", _tokens(F.col("marked")).alias("tokens"), F.lit(True).alias("slotted"), F.lit(None).cast("array<string>").alias("only")))
    both = reduce(DataFrame.unionByName, variants).where(F.exists("tokens", lambda x: ~_number(x)))
    both = both.withColumn("n", F.size("tokens"))
    lengths = [r[0] for r in both.select(F.least("n", F.lit(width)).alias("n")).distinct().orderBy("n").collect()]  # at most `width`
    if not lengths:
        return None
    found = _windows(both, lengths).where(F.col("length") == F.least("n", F.lit(width)))
    return found.withColumn("n_windows", F.col("n") - F.col("length") + 1).drop("n").distinct()


def _counts(tokens: Column) -> Column:
    """The runs of numbers of a text that have at least COUNTS of them, each as one string."""
    marked = F.array_join(F.transform(tokens, lambda x: F.when(_number(x), x).otherwise(_SEP)), " ")
    runs = F.transform(F.split(marked, _SEP), lambda r: F.trim(r))
    return F.array_distinct(F.filter(runs, lambda r: F.size(F.split(r, " ")) >= COUNTS))


def find_leaks(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = 8, least: int = 6, broadcast_rows: int = 500_000,
) -> DataFrame:
    """(doc_id, item_id, windows, n_windows, reworded) for every document and benchmark item it holds.

    Words are letters with what follows of letters and digits, in lower case, or numbers; marks between
    them don't count. Numbers, units after a number, and words with a capital within a sentence are slots;
    the latter are tried as words too. An item is held when at least `least` of its different windows of
    `width` words (all, if it has fewer; an item shorter than `width` is one window) occur in the document.
    Those with equal values always count; of those with other values, the ones whose slot values stand for
    one value only at that place of the document; reworded says that there are such. Windows of more slots
    than words must occur value for value. An item of COUNTS or more numbers and nothing else is one window,
    held where the same numbers stand in a row with no other number before or behind them; one of fewer is held by
    none. Null or empty texts hold nothing and are held by none; rows of equal ids are judged as one document, a null id as any
    other. Repeated items are judged each by id. Empty tables give an empty result; other columns don't
    matter.

    No window of a document is moved to meet the benchmark while that has at most `broadcast_rows`
    windows, which are counted first; beyond, Spark joins them as it finds best.
    """
    folder = run_dir(docs.sparkSession, "leaks")
    rows = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    empty = docs.sparkSession.createDataFrame([], T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("item_id", items.schema[item_id].dataType),
        T.StructField("windows", T.LongType()), T.StructField("n_windows", T.IntegerType()), T.StructField("reworded", T.BooleanType()),
    ]))
    texts = docs.select(F.col(id_col).alias("doc_id"), _marked(F.col(text_col).cast("string"), True).alias("marked"))
    texts = texts.select("doc_id", "marked", _tokens(F.col("marked")).alias("tokens"))
    counts = rows.select("item_id", _tokens(_marked(F.col("text"), False)).alias("tokens")).where(~F.exists("tokens", lambda x: ~_number(x)))
    counts = written(counts.select("item_id", F.explode(_counts(F.col("tokens"))).alias("run")).distinct(), f"{folder}/counts")
    found = empty
    if not counts.isEmpty():
        some = texts.where(F.regexp_like("marked", F.lit(r"\d"))).select("doc_id", F.explode(_counts(F.col("tokens"))).alias("run"))
        found = some.join(counts, "run").select(
            "doc_id", "item_id", F.lit(1).cast("long").alias("windows"), F.lit(1).alias("n_windows"), F.lit(False).alias("reworded")).distinct()
    bench = _benchmark_windows(rows, width)
    if bench is None:
        return found
    bench = written(bench, f"{folder}/benchmark")
    size = bench.count()
    if not size:
        return found
    starts = bench.where("inner IS NOT NULL").groupBy("length").agg(F.count_distinct("inner").alias("n"))  # a row for each length
    few = [r["length"] for r in starts.collect() if r["n"] <= STARTS]
    lists = bench.where(F.col("length").isin(few)).groupBy("length").agg(F.collect_set("inner").alias("starts")).collect()
    lengths = sorted(r[0] for r in bench.select("length").distinct().collect())
    texts = texts.select("doc_id", F.explode(_readings(F.col("tokens"), F.col("marked"))).alias("r")).select("doc_id", "r.*")
    bench = bench.select("item_id", F.col("pos").alias("item_pos"), "length", "hash", F.col("slots").alias("item_slots"), "n_windows")
    windows = _windows(texts, lengths, {r["length"]: r["starts"] for r in lists}).drop("inner")
    met = windows.join(F.broadcast(bench) if size <= broadcast_rows else bench, ["hash", "length"])
    pairs = F.array_distinct(F.filter(
        F.zip_with(F.split("item_slots", _SEP), F.split("slots", _SEP), lambda i, d: F.struct(i.alias("i"), d.alias("d"))),
        lambda p: p["i"] != "",
    ))
    met = written(met.select(
        "doc_id", "item_id", "n_windows", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"),
        F.when(F.col("slots") != F.col("item_slots"), pairs).alias("pairs"),  # null if all values are equal
    ), f"{folder}/met")
    placed = met.groupBy("doc_id", "item_id", "n_windows", "shift").agg(F.collect_set(F.struct("item_pos", "pairs")).alias("found"))
    moved = F.transform(F.filter("found", lambda w: w["pairs"].isNotNull()), lambda w: w["pairs"])
    placed = placed.withColumn("moved", F.array_sort(F.array_distinct(F.flatten(moved))))
    next_ = F.slice("moved", 2, F.greatest(F.size("moved"), F.lit(1)))
    twice = F.filter(F.zip_with("moved", next_, lambda a, b: F.when(a["i"] == b["i"], a["i"])), lambda i: i.isNotNull())
    placed = placed.withColumn("twice", F.array_distinct(twice))  # values with two counterparts
    fits = lambda w: w["pairs"].isNull() | ~F.arrays_overlap(F.transform(w["pairs"], lambda p: p["i"]), "twice")
    counted = placed.select("doc_id", "item_id", "n_windows", F.filter("found", fits).alias("found"))
    counted = counted.select("doc_id", "item_id", "n_windows", F.explode("found").alias("w"))
    return (
        counted.groupBy("doc_id", "item_id", "n_windows")  # a window counts once, however often the document repeats it
        .agg(F.count_distinct("w.item_pos").alias("windows"), F.bool_or(F.col("w.pairs").isNotNull()).alias("reworded"))
        .where(F.col("windows") >= F.least(F.col("n_windows"), F.lit(least)))
        .select("doc_id", "item_id", "windows", "n_windows", "reworded").unionByName(found)
    )
