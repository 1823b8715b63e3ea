"""Spelling variants: words one edit apart, found by the neighbourhoods of words in a reduced alphabet."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import small_batches, tidy
from tidemark.llm.graph import written
from tidemark.session import remove, run_dir

SYMBOLS = 8  # symbols that the letters are hashed to
#: Runs of A-Z, a-z and U+00C0 to U+00FF, as UTF-8 bytes.
_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
_PIECE = 1 << 20  # bytes of a text that are split at a time
_HELD = 100_000  # different words a task holds before it passes their counts on


def runs(raw: bytes) -> Iterator[list[bytes]]:
    """The runs of letters of a text, A-Z in lower case, piece by piece; none is cut."""
    at = 0
    while at < len(raw):
        end = at + _PIECE
        while end < len(raw) and raw[end] & 0xC0 == 0x80:  # not within a code point
            end += 1
        if end < len(raw) and (tail := _RUN.match(raw, end)):  # nor within a run
            end = tail.end()
        yield _RUN.findall(raw[at:end].lower())
        at = end


def respell(doc: str, run: bytes, one_in: int) -> str:
    """The run, without one of its code points in one of `one_in` pairs of document and run."""
    word = run.decode()
    h = zlib.crc32(f"{doc}:{word}".encode()) if one_in else 1
    if one_in and h % one_in == 0:
        cut = h % len(word)
        word = word[:cut] + word[cut + 1 :]
    return word


def _counted(least_length: int, one_in: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for found in runs(text.as_py()):
                    for word, n in Counter(found).items():
                        word = respell(doc, word, one_in)
                        if len(word) >= least_length:
                            held[word] += n
                    if len(held) >= _HELD:
                        yield flush()
        yield flush()

    return run


def vocabulary(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least: int = 5, one_in: int = 199,
) -> DataFrame:
    """(word, n): the words of at least `least_length` code points that occur at least `least` times in all texts.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case, respelled for a pair
    of document and run whose crc32 `one_in` divides (never, if it is 0). A null id is written as an empty one.
    Each task passes on counts, not words, so a word in every text costs a row for each task.
    """
    rows = small_batches(docs).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    counted = rows.mapInArrow(tidy(_counted(least_length, one_in)), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def reduced(word: Column, symbols: int = SYMBOLS) -> Column:
    """The word with each letter hashed to one of a few symbols; of its length in code points."""
    letters = F.split(word, "")
    return F.concat_ws("", F.transform(letters, lambda c: F.conv(F.pmod(F.xxhash64(c), F.lit(symbols)).cast("string"), 10, 36)))


def neighbourhood(word: Column, symbols: int = SYMBOLS) -> Column:
    """All different words over the symbols within one edit of a word, itself included."""
    alphabet = F.array(*(F.lit("0123456789abcdefghijklmnopqrstuvwxyz"[k]) for k in range(symbols)))
    size = F.char_length(word)
    at = F.sequence(F.lit(0), size)  # begins of 0 to all letters
    begin = lambda k: F.substring(word, F.lit(1), k)
    rest = lambda k: F.substring(word, k + 1, size)
    inside = F.slice(at, F.lit(1), size)
    deleted = F.transform(inside, lambda k: F.concat(begin(k), rest(k + 1)))
    replaced = F.flatten(F.transform(inside, lambda k: F.transform(alphabet, lambda s: F.concat(begin(k), s, rest(k + 1)))))
    inserted = F.flatten(F.transform(at, lambda k: F.transform(alphabet, lambda s: F.concat(begin(k), s, rest(k)))))
    return F.array_distinct(F.concat(deleted, replaced, inserted))


def near_words(words: DataFrame, folder: str, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of different words one edit apart.

    One edit of a word is one edit of its reduced form, or none. So the neighbourhood of each different reduced
    word is generated once and joined with the reduced words; where two meet, the words behind
    them are compared as they are, within the join, so only true pairs leave it. A word makes about 2 · length · `symbols`
    rows; a pair that isn't near meets by chance in one of about symbols^length cases.
    """
    words = written(words.withColumn("short", reduced(F.col("word"), symbols)), f"{folder}/reduced")
    shorts = words.select("short").distinct()
    around = shorts.select("short", F.explode(neighbourhood(F.col("short"), symbols)).alias("other"))
    met = written(around.join(shorts.withColumnRenamed("short", "other"), "other", "left_semi"), f"{folder}/met")
    left = words.join(met, "short").select("word", "n", "other")
    right = words.select(F.col("short").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    one_edit = (left["other"] == right["other"]) & (F.levenshtein(left["word"], right["near"], 1) == 1)
    return left.join(right, one_edit).select("word", "n", "near", "near_n")


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root): the end of the forms of every word that has one. A form is `ratio` times as common as its
    word, so chains are short and never close; each round doubles the steps taken."""
    state = written(forms.select("word", F.col("form").alias("root")), f"{folder}/roots-0")
    step = 0
    while True:
        step += 1
        following = state.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = written(state.join(following, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), f"{folder}/roots-{step}")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        state = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least: int = 5,
    ratio: int = 5, one_in: int = 199, symbols: int = SYMBOLS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the `vocabulary`.

    Two words are near if one edit (a code point inserted, deleted or replaced) makes one the other. The form of a word is its most
    frequent near word (ties: the smallest by code points), if that is at least `ratio` (above 1) times as
    frequent; else null. root follows forms from the word to the last one. n_near counts near words. Null and empty texts
    have no words; repeated rows count each time; other columns are left out; without words the result is empty.

    Nothing is kept by the document after the counts. A hot word is one row; a word has at most a few hundred near words
    for each of its letters, as that many other words exist.
    """
    spark, folder = docs.sparkSession, run_dir(docs.sparkSession, "variants")
    words = written(vocabulary(docs, id_col=id_col, text_col=text_col, least_length=least_length, least=least, one_in=one_in), f"{folder}/words")
    best = F.min(F.struct((-F.col("near_n")).alias("down"), F.col("near").alias("near")))
    near = near_words(words, folder, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    common = -F.col("best.down") >= ratio * F.col("n")
    judged = written(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("best.near")).alias("form"), F.when(common, -F.col("best.down")).alias("form_n"),
    ), f"{folder}/judged")
    roots = _roots(judged.where("form IS NOT NULL"), folder)
    remove(spark, f"{folder}/met")
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
