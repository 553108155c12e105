"""Repeated runs of lines against a plain search over whole documents."""

import pytest

from ridelake.llm import lines

PASSAGE = ["the first of the shared lines", "the second, quite another one", "a third line of it", "and the fourth"]


def runs(n, before, after, gap):
    """Documents that share only a run of ``n`` lines, each with lines of its own around it."""
    body = ("\n" * gap).join(PASSAGE[:n]) if gap > 1 else "\n".join(PASSAGE[:n])
    return [(i, "".join(f"own {i} before {k}\n" for k in range(before)) + body
             + "".join(f"\nown {i} after {k}" for k in range(after))) for i in range(12)]


@pytest.mark.parametrize("n", [2, 3, 4])
@pytest.mark.parametrize("before, after, gap", [(1, 1, 1), (3, 2, 1), (0, 2, 1), (2, 0, 1), (1, 1, 2), (1, 1, 6)])
def test_shared_runs_go_whole(spark, n, before, after, gap):
    rows = runs(n, before, after, gap)
    got = {r.doc_id: r.text for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1]
    for i, text in rows[1:]:
        assert got[i].split("\n") == [line for line in text.split("\n") if line.startswith("own")]


def pairs_of(text):
    """Neighbouring filled lines with what stands between them, and the numbers of the lines."""
    parts = (text or "").removesuffix("\n").split("\n")
    filled = [i for i, p in enumerate(parts) if p.strip()]
    return parts, [("\n".join(parts[a:b + 1]), a, b) for a, b in zip(filled, filled[1:])]


def test_runs_are_found_as_by_a_plain_search(spark):
    """What goes is repeated by a plain search, and nearly all of that goes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r for r in lines.line_report(docs).collect()}
    seen, repeated, went, wrong, untouched, whole = set(), 0, 0, 0, 0, 0
    for r in rows:
        parts, pairs = pairs_of(r.text)
        gone = set()
        for raw, a, b in pairs:
            gone |= set(range(a, b + 1)) if raw in seen else set()
            seen.add(raw)
        repeated += sum(bool(parts[i].strip()) for i in gone)
        left = got[r.doc_id].text
        plain = "\n".join(p for i, p in enumerate(parts) if i not in gone)
        kept = [p for p in (left or "").split("\n") if p.strip()]
        want = [p for p in plain.split("\n") if p.strip()]
        went += sum(bool(p.strip()) for p in parts) - len(kept)
        if gone:
            untouched += left == r.text
            whole += kept == want
        else:
            wrong += left != r.text
        assert len(kept) >= len(want)  # never more than the plain search
    print(f"lines of repeated runs: {repeated}, removed {went}; documents with some: {whole} whole, {untouched} untouched")
    assert wrong == 0 and repeated > 100 and went >= 0.97 * repeated and untouched <= 0.02 * (whole + untouched)


def test_removed_lines_stand_earlier(spark):
    """The first occurrence of every line stays."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.text or "").split("\n") for r in lines.line_report(docs).collect()}
    seen = set()
    for r in sorted(docs.select("doc_id", "text").collect(), key=lambda r: r.doc_id):
        for line in (r.text or "").split("\n"):
            assert line in seen or not line.strip() or line in got[r.doc_id]
            seen.add(line)


def test_single_lines_stay(spark):
    rows = [(0, "only this one\n"), (1, "other\nonly this one\n"), (2, "only this one"), (3, "x\n\n"), (4, "y\n\n\n"), (5, None),
            (6, "Title A\n\n"), (7, "Title A\n\n"), (8, "\n\nTitle A\n \n"), (9, "Title A\n\nown"), (10, "one\ntwo"), (11, "two\nnone"), (12, "two\none")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.line_report(df).collect()} == dict(rows)
