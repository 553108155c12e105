"""Collocations against a plain count of all phrases, at budgets that split and extend prefixes."""

import re
from collections import Counter

import pytest

from ridelake.llm import phrases

SF = "/root/testdata/sf0.001"


def plain(rows, least=10, depth=3, percent=50, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        own = f.setdefault(lang if lang is not None else "und", Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^ \t]+", piece)
            n[lang if lang is not None else "und"] += len(w)
            own.update(tuple(w[i:i + k]) for k in range(1, depth + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        cand = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i:i + k]] = max(longer[p[i:i + k]], a)
        rows = []
        for p, a in cand.items():
            if 100 * longer[p] >= percent * a:
                continue
            score, _, l, r = min((1000000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


@pytest.mark.parametrize("rows, budget, flush, least", [(None, phrases.BUDGET, phrases.FLUSH, 10), (None, 6000, 100_000, 10), (12, 60, 5_000, 3)])
def test_counts_are_those_of_a_plain_search(spark, rows, budget, flush, least):
    """At the defaults; in several groups; with prefixes extended to full depth."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = sorted((r for r in docs.collect() if rows is None or len(r.text or "") < 3000), key=lambda r: r.doc_id)[:rows]
    want = plain([(r.text, r.lang) for r in found], least)
    docs = spark.createDataFrame([(r.text, r.lang) for r in found], "text string, lang string")
    assert want and mined(docs, budget=budget, flush=flush, min_count=least) == want


@pytest.mark.parametrize("max_words, least, percent, top", [(2, 3, 50, 5), (4, 2, 100, 2000)])
def test_other_lengths_and_bounds(spark, max_words, least, percent, top):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(15).cache()
    want = plain([(r.text, r.lang) for r in docs.collect()], least, max_words, percent, top)
    assert mined(docs, max_words=max_words, min_count=least, inside_percent=percent, top=top, budget=2000) == want
    docs.unpersist()


ODD = [(None, "en"), ("", "en"), ("  \t ", None), ("a b a b a b a b a b a b a b a b a b a b a b", None),
       ("a b", "und"), ("A\x00x B\x01 c\x0bA\x00x B\x01 c. " * 12, "x\x00y"), ("é ß 漢字 é ß 漢字, " * 15, "é"),
       ("w " * 60000, "hot"), ("w v. " * 11, "hot"), ("w v. " * 11, "hot"), ("...;;!?\r\n", "en"), ("one\ttwo\n" * 10, "en")]


@pytest.mark.parametrize("budget", [phrases.BUDGET, 5000])
def test_odd_rows(spark, budget):
    df = spark.createDataFrame(ODD, "text string, lang string").selectExpr("*", "1 AS n", "2 AS phrase", "3 AS `group`", "4 AS words")
    assert mined(df, budget=budget, flush=500) == plain(ODD)
    assert mined(df.filter("text is null")) == []


def test_empty_table(spark):
    assert mined(spark.createDataFrame([], "text string, lang string")) == []


def test_groups_stay_within_the_budget(spark):
    """A building task gets at most twice the budget, but for single paths of full depth."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(15)
    budget = 400
    original = phrases._subtrees

    def watched(depth, least, heavy, held):
        build = original(depth, least, heavy, held)

        def run(batches):
            import numpy as np
            found = list(batches)
            total = {}
            for b in found:
                for words, paths in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    for *path, n in np.frombuffer(paths, "<i4").reshape(depth + 1, -1).T.tolist():
                        key = tuple(words.split(b" ")[p] for p in path)
                        total[key] = total.get(key, 0) + n
            if total:
                assert sum(n for n in total.values() if n <= budget) <= 2 * budget
            yield from build(iter(found))
        return run

    phrases._subtrees = watched
    try:
        assert mined(docs, budget=budget, flush=20_000, min_count=2)
    finally:
        phrases._subtrees = original
