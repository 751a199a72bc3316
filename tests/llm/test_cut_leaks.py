"""Benchmark items in documents shorter than the item, against brute force."""

from ranklight.llm import decontaminate
from tests.llm.test_exact import leaks_by_force


def test_items_cut_by_the_end_of_the_document_are_found(spark):
    items = {n: [f"w{n}x{k}" for k in range(n)] for n in (12, 40, 104)}
    docs = {
        1000 * n + cut: " ".join(own[:cut]) for n, own in items.items() for cut in range(n * 6 // 10, n + 1)
    }
    docs |= {k + 500: "other " + text for k, text in docs.items()}
    want = leaks_by_force(
        {i: t.encode() for i, t in docs.items()}, {n: " ".join(own).encode() for n, own in items.items()}
    )
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    rows = [(n, " ".join(own)) for n, own in items.items()]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    got = decontaminate.find_leaks(frame, benchmark)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == want
    # 36 shingles, of which the document has the first 31.
    assert (40_035, 40) in want
    left = decontaminate.drop_leaking(frame, benchmark)
    assert {r["doc_id"] for r in left.collect()} == set(docs) - {i for i, _ in want}
