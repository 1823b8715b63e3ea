"""Copies that find_leaks must hold, and clean texts that it must not."""

from __future__ import annotations

from tidemark.llm.decontam import find_leaks


def held(spark, docs, items):
    found = find_leaks(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
        spark.createDataFrame(list(enumerate(items)), "item_id long, text string"),
    ).collect()
    return {(r.doc_id, r.item_id): r for r in found}


def test_exact_copies_of_items_full_of_numbers(spark):
    items = [
        "What is 3 + 4 * 12 - 7?",
        "Add 1 2 3 4 5 6 7 8 9 and 10 then name the sum",
        "Sales 2001 45 2002 51 2003 60 2004 72 2005 80 2006 91 2007 99 total",
    ]
    copies = [f"they asked: {i} and went on." for i in items]
    other = ["they asked: What is 3 + 4 * 12 - 8? and went on.", copies[2].replace("45", "46").replace("2004", "2014").replace("99", "98")]
    assert set(held(spark, copies + other, items)) == {(0, 0), (1, 1), (2, 2)}


def test_an_item_copied_within_a_sentence(spark):
    items = ["What is the capital of France", "Which gas do plants take in from the air"]
    docs = ["as they asked, What is the capital of France and left", "question 7 Which gas do plants take in from the air",
            "as they asked, What is the capital of nowhere", "as they asked, Why is the capital of France"]
    assert set(held(spark, docs, items)) == {(0, 0), (1, 1)}


def test_one_value_with_two_counterparts_leaves_the_other_windows(spark):
    plain = " ".join(f"w{i}x plain" for i in range(20))
    items = [f"He picked 3 apples and then he waited 3 hours by the old gate {plain}"]
    docs = [items[0].replace("3 apples", "5 apples"), items[0].replace("3 apples", "5 apples").replace("3 hours", "7 hours"),
            "He picked 5 apples and then he waited 7 hours by the old gate"]
    found = held(spark, docs, items)
    assert set(found) == {(0, 0), (1, 0)} and found[0, 0].windows < found[0, 0].n_windows


def test_a_repeated_window_counts_once(spark):
    phrase = "which of the following is the correct answer"
    items = [f"{phrase} when water boils at high places and cools down again on the way"]
    docs = [". ".join(f"{phrase} to question w{i}x" for i in range(9)), f"so {items[0]} now", f"{items[0]}. {items[0]}"]
    found = held(spark, docs, items)
    assert set(found) == {(1, 0), (2, 0)} and found[2, 0].windows == found[2, 0].n_windows


def test_an_item_of_numbers_alone_is_found_in_its_copy_and_no_other_table(spark):
    items = ["3 4 5 6 7 8 9 10 11", "12, 7; 19 - 4", "1999", "2.5 2.5 2.5 2.5"]
    docs = ["so: 3 4 5 6 7 8 9 10 11. That was it", "the row 12 7 19 4 was", "1 2 3 4 5 6 7 8 9 10 11 12", "3 4 5 6 7 8 9 10 12",
            "in 1999 it was 12 7 19", "12 7 19 4 5", "2.5 2.5 2.5 2.5", "2.5 2.5 2.5 2.5 2.5"]
    assert set(held(spark, docs, items)) == {(0, 0), (1, 1), (6, 3)}
    assert held(spark, docs, ["3 4 5 6 7 8 9 10 11"]).keys() == {(0, 0)}


def test_windows_are_found_with_and_without_looking_up_their_inside_first(spark, monkeypatch):
    from tidemark.llm import decontam

    items = ["He walked 3 km to the old mill with Anna and back", "Short one here", "a b c", "7 m is the width of 9 m or 5 m"]
    docs = [f"Then km {i} ." for i in items] + ["He walked 4 km to the old mill with Maria and back", "a b d", "3 m is the width of 9 m or 5 m"]
    first = held(spark, docs, items)
    monkeypatch.setattr(decontam, "STARTS", 0)
    assert held(spark, docs, items) == first and {(0, 0), (1, 1), (2, 2), (3, 3), (4, 0)} <= set(first)
