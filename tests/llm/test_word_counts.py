"""n_words of operator 10: counted by the words that its windows are made of, not by a pattern in the plan."""

import contextlib
import io
import re

from ridelake.llm.decontamination import contamination_report

TEXTS = ["", None, "one", " Two  words\n", "don't_stop", "a-b/c:9Z", "übergroß naïve 東京 word", "\x00\x7fx\x7b y\x60", "...", "x" * 5000 + " y"]


def test_counts_match_the_contract(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    items = spark.createDataFrame([("i", "one")], "item_id string, text string")
    report = contamination_report(docs, items)
    want = {i: len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")) for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.n_words for r in report.collect()} == want
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        report.explain("extended")
    assert "regexp" not in shown.getvalue()
