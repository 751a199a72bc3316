"""Benchmark items of fewer words than a shingle, against brute force."""

from ranklight.llm import decontaminate
from tests.llm.test_exact import leaks_by_force


def test_items_of_one_to_four_words_are_found_inside_longer_texts(spark):
    long = " ".join(f"word{k}" for k in range(40))
    docs = {1: long + " one two three four " + long, 2: "one two", 3: "Two, three four!", 4: "two one", 5: long}
    docs |= {6: "three four", 7: long + " four one two one two"}
    items = {1: "one two three four", 2: "two three four", 3: "one TWO", 4: "four", 5: "word3 word4", 6: long}
    want = leaks_by_force(
        {i: t.encode() for i, t in docs.items()}, {i: t.encode() for i, t in items.items()}
    )
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for own in (items, {k: items[k] for k in (1, 2, 3, 4, 5)}):
        benchmark = spark.createDataFrame(list(own.items()), "item_id long, text string")
        got = decontaminate.find_leaks(frame, benchmark).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [w for w in want if w[1] in own]
        assert [(r["first_word"], r["n_windows"]) for r in got if (r["doc_id"], r["item_id"]) == (7, 3)] == [(41, 2)]
