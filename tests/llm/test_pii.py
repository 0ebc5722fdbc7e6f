import hashlib
import random
import re

import pytest

from aerolake.llm import pii


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    """The base spans, by kind."""
    text, out = text or "", []
    number = lambda m: re.sub("[^0-9]", "", m)
    for kind, pattern, good in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(number(m)) <= 19 and luhn(number(m))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(number(m)) <= 15)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if good(m[0])]
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(docs):
    got = sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in pii.detect(docs).collect()), key=str)
    want = []
    for r in docs.collect():
        spans = brute(r["text"])
        want.append((r["doc_id"], *(sum(k == x for x, _, _ in spans) for k in pii.KINDS), hashlib.sha256(listed(spans).encode()).hexdigest()))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("which", ["small_docs", "awkward", "no_docs"])
def test_base_spans(which, request):
    check(request.getfixturevalue(which))


def test_random_texts(spark):
    rng = random.Random(8)
    bits = ["a@b.c", "x.y_z%1@d-e.f.g", "@", ".", "1.2.3.4", "255.0.300.1", "4242424242424242", "4242 4242 4242 4242", "-", " ", "é🎉", "+1 (417) 555-1301",
            "+49 30 1234567", "(212) 555-0100", "212-555-0100", "9", "+", "tel: ", "card ", "mail ", "\n", "_", "bob [at] host [dot] com", "007.1.1.1", "99999999999999999999", "0"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(3000)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_long_runs_and_many_matches(spark):
    rows = [(1, "9" * 10_000), (2, "a" * 10_000 + "@"), (3, "1." * 5_000), (4, "1.2.3.4 " * 3000 + "a@b.cd"), (5, "1-" * 50_000), (6, "+1" + "(" * 100_000), (7, "a@b" + ".c" * 5_000)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_method_adds_spans_and_keeps_the_base(spark):
    texts = [f"Please call (212) 555-01{i:02d} today, phone +1 (417) 555-13{i:02d}. mail me{i}@mail.example.com ok" for i in range(60)]
    texts += [f"version 1.2.3.{i} and 10.20.30.{i} on host 192.168.7.{i}" for i in range(60)] + ["plain words, 3 of 4", "12345 and 3.14 in 2024-01-02"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.detect(docs).collect():
        spans = r["spans"].split(",") if r["spans"] else []
        base = {f"{k}:{a}:{b}" for k, a, b in brute(texts[r["doc_id"]])}
        assert base <= set(spans)
        if r["doc_id"] < 60:
            at = texts[r["doc_id"]].index("(212)")
            assert f"phone:{at}:{at + 14}" in spans
        if r["doc_id"] >= 120:
            assert not spans
    assert spans is not None


def test_a_card_behind_a_phone_number_is_added(spark):
    texts = ["call +1 (417) 555-1301 4242424242424242 now", "or 4242424242424242 here", "not 4242424242424241 this"] + [f"pay 4242424242424242 in part {i}" for i in range(20)]
    got = {r["doc_id"]: r["spans"] for r in pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert brute(texts[0]) == [] and "card:23:39" in got[0].split(",")
    assert got[1] == "card:3:19" and got[2] == ""


def test_reliabilities_are_learned():
    # For e-mail, the pattern and the gazetteer agree on two clear groups; context is noise.
    counts = [(0, (1, 1, c, 1), 1, 100) for c in (0, 1, 2)] + [(0, (2, 2, c, 2), 1, 100) for c in (0, 1, 2)]
    model = pii.fit(counts)
    learned = model.reliabilities["email"]
    assert learned["pattern"]["for_if_yes"] > 0.9 and learned["gazetteer"]["against_if_no"] > 0.9
    assert 0.25 < learned["context"]["for_if_yes"] < 0.42
    assert 0.4 < model.priors["email"] < 0.6
    assert model.weights[0, "pattern", 1] > 0 > model.weights[0, "pattern", 2]


def test_redaction(spark, awkward):
    rows = [(1, "Mail a.b@c.de or +1 (417) 555-1301, é 4242424242424242."), (2, None), (3, "nothing"), (4, ""), (5, "from 1.2.3.4")]
    got = dict(pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == {1: "Mail [EMAIL] or [PHONE], é [CARD].", 2: None, 3: "nothing", 4: "", 5: "from [IP]"}
    out = pii.redact(awkward)
    assert out.columns == awkward.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, awkward.collect()))


def test_main_path_is_native(small_docs):
    import io
    from contextlib import redirect_stdout

    for df in (pii.detect(small_docs), pii.redact(small_docs)):
        text = io.StringIO()
        with redirect_stdout(text):
            df.explain()
        assert "Python" not in text.getvalue() and "Pandas" not in text.getvalue() and "Arrow" not in text.getvalue()
