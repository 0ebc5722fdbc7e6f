import random
import re

import duckdb
import pytest

from aerolake.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(5)}
    n, chars, symbols = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text))
    dup = len(lines) - len(set(lines))
    failed = n < 10 or 100 * len(covered) > 20 * n
    upper, lower = len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text))
    lettered = sum(bool(re.search(r"[A-Za-z\x80-\U0010ffff]", w)) for w in words)
    cut = sum(x.endswith("...") for x in text.split("\n"))
    bad = (10 * symbols > n or chars < 3 * n or chars > 12 * n or 10 * dup > 3 * len(lines) or 10 * lettered < 8 * n
           or upper > lower or 10 * cut > 3 * len(lines))
    return n, chars, symbols, dup, len(covered), failed, not failed and not bad


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


@pytest.mark.parametrize("which", ["small_docs", "awkward", "no_docs"])
def test_against_brute_force(which, request):
    docs = request.getfixturevalue(which)
    got = [(r["doc_id"], *(r[c] for c in COLS)) for r in quality.judge(docs).collect()]
    want = [(r["doc_id"], *brute(r["text"])) for r in docs.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_random_texts_and_sql(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["a", "b", "C", "é\n", "d...\n", "#", "\t", "long-word", "12"]) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    got = sorted((r["doc_id"], *(r[c] for c in COLS)) for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(i, *brute(t)) for i, t in rows]
    import pandas as pd

    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    assert sorted(duckdb.sql(quality.SQL).fetchall()) == got


def test_order_prefers_rejection_per_cost():
    def slow(t, rows):
        sum(range(400_000))
        return t.n_words[rows] > 0

    rules = (quality.Rule("slow", slow), quality.Rule("never", lambda t, rows: t.n_words[rows] < 0), quality.Rule("cheap", lambda t, rows: t.n_words[rows] > 12))
    texts = [b" ".join(b"w%d" % (i * 100 + k) for k in range(11 + i % 4)) for i in range(50)]
    ordered = quality.order_rules(texts, rules)
    assert [r.name for r, _, _ in ordered][0] == "cheap"
    assert {r.name for r, _, _ in ordered} == {"slow", "never", "cheap"}


def test_verdict_does_not_depend_on_order(small_docs):
    a = sorted((r["doc_id"], r["kept"]) for r in quality.judge(small_docs, quality.RULES[::-1], sample_rows=1).collect())
    assert a == sorted((r["doc_id"], r["kept"]) for r in quality.judge(small_docs).collect())
