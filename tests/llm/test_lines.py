"""Lines that differ in numbers."""

from nickmap.llm import line_dedup
from tests.llm.test_operators import documents


def test_numbers_are_compared(spark):
    data = [(1, "Revenue in 2019 was 12 million.", "s"), (2, "Revenue in 2023 was 950 million.", "s"), (3, "Revenue in 2019 was 13 million.", "s")]
    docs = documents(spark, data)
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == {1: data[0][1], 2: data[1][1], 3: ""}
    assert {r.class_doc_id for r in line_dedup.line_classes(docs, numbers=True).collect()} == {1}


def test_short_lines_repeat(spark):
    """The stage drops exact copies of short lines, and neither near ones nor blank lines."""
    import corpus_pipeline

    data = [(1, "Contents\n\n \t\nContent\n2019", "s"), (2, " contents\n\n \t\nContext\n2020", "s"), (3, "2019\nnew", "s")]
    out = corpus_pipeline.line_dedup(spark, documents(spark, data), "")
    assert {r.doc_id: r.text for r in out.collect()} == {1: data[0][1], 2: "\n \t\nContext\n2020", 3: "new"}
