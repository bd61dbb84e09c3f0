import pytest
from helpers import documents, random_texts

import brute
from rainroute.llm import decontaminate

ITEMS = [
    (1, "What is the Capital-City of one far away land, and why?"),
    (2, "short item"),
    (3, None),
    (4, " ?! "),
    (5, "what is the capital city of one far away land and more words after it"),
    (6, "café au lait is the drink of the day for all of us"),
    (6, "short item"),
    (None, "lone item without id but with words enough to make several windows of ten words"),
]
ROWS = [
    (1, "xx WHAT is the capital city of one far away land -- and so on"),
    (2, "a Short... ITEM; shorts item"),
    (3, "short itemised"),
    (4, None),
    (5, ""),
    (5, ""),
    (6, "CAFÉ au lait is the drink of the day for all of us"),
    (7, "café au lait is the drink of the day for all of us " * 2000),
    (None, "item without id but with words enough to make several windows of ten words short item"),
]


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 120])
def test_against_brute_force(spark, block):
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, z string")
    rows = ROWS + list(enumerate(random_texts(2, 20), 100))
    df = documents(spark, rows, "hits int, items string, n_words string, k1 int", (1, "i", "w", 2))
    found = decontaminate.find_contamination(df, items, block=block).collect()
    got = sorted(
        (
            -1 if r.doc.doc_id is None else r.doc.doc_id,
            r.n_words,
            len({w for h in r.hits for w in range(h.start, h.stop)}),
            sorted(r["items"]),
        )
        for r in found
    )
    want = brute.contamination([t for _, t in rows], ITEMS, 10)
    assert got == sorted((-1 if i is None else i, *w) for (i, _), w in zip(rows, want, strict=True))


def test_spans_are_places_of_the_original_text(spark):
    items = spark.createDataFrame([(1, "Short item")], "item_id long, text string")
    text = "é, SHORT\n--item! and short item."
    row = decontaminate.find_contamination(documents(spark, [(1, text)]), items).first()
    assert [text.encode()[s.start : s.stop] for s in row.spans] == [b"SHORT\n--item", b"short item"]


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_words for r in decontaminate.find_contamination(documents(spark, [(1, "a b")]), items).collect()] == [2]
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.find_contamination(documents(spark, []), some).collect() == []


def test_clean_documents_stay_as_they_are(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = documents(spark, ROWS, "lang string", ("en",))
    kept = decontaminate.drop_contaminated(df, items)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 5]
