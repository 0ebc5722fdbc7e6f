import random
import time
import tracemalloc

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aerolake.llm import counting

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def own():
    return counting.Counter(PATH)


@pytest.mark.parametrize("which", ["small_docs", "awkward", "no_docs"])
def test_against_the_library(which, request, library):
    docs = request.getfixturevalue(which)
    got = [tuple(r) for r in counting.count_tokens(docs).collect()]
    rows = docs.collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), n, n > 1024) for r, n in zip(rows, library([r["text"] or "" for r in rows]))]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(seed, own, library):
    rng = random.Random(seed)
    bits = [*"aeiousrt 1239.,!'\"\n\t-_", "the", " of", "ing", "'s", "'ll", "'re", "'ve", " '", "''", "<|endoftext|>", "<|endof", "  ", "\n\n", " ", "　", "\x85", "\x1c",
            "é", "ß", "É", "½", "²", "Ⅷ", "日本", "语言", "🎉", "👩‍👩‍👧", "́", "ǅ", "٣", "क्षि", "​", "᠎", "ſ", "\x00"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 120))) for _ in range(1500)]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 300))) for _ in range(200)]
    want = library(texts)
    for chunk in (3, 16, 256):
        got = own.count([t.encode() for t in texts], chunk).tolist()
        assert got == want, next((t, a, b) for t, a, b in zip(texts, got, want) if a != b)


def test_long_words_run_through_many_chunks(own, library):
    texts = ["x" * 20_000, "ab" * 9000 + " end", " " * 5000 + "a", "\n" * 3000, "0123456789" * 800, "é" * 4000, ""]
    assert own.count([t.encode() for t in texts]).tolist() == library(texts)


def test_open_chunks_are_composed(own, library):
    """Rows of chunks without a pre-token start, whose maps are composed: repeated and
    changing contents, with periods that no chunk length divides, and heads after them."""
    rng = random.Random(9)
    texts = ["a" * 5000 + "b" * 3000 + " a", "abc" * 4000, "abcdefg" * 2000 + "!", "ing" * 999 + "x" * 999 + "é" * 999, "日本語" * 700,
             "".join(rng.choice("etaoinshr") for _ in range(9000)), "-=" * 3000 + "9" * 4001, "end"]
    want = library(texts)
    for chunk in (7, 64, 256):
        assert own.count([t.encode() for t in texts], chunk).tolist() == want


def test_windows_of_long_texts(own, library):
    rng = random.Random(4)
    bits = ["don't", "we'll", "'re", " ", "  ", "\n\n", "the", " of", "é", "日本", "🎉", "12", "!?", "'", "<|endoftext|>", "x" * 40]
    texts = ["".join(rng.choice(bits) for _ in range(700)) for _ in range(12)] + ["q" * 3000, " " * 2500 + "a"]
    want = library(texts)
    for window in (33, 100, 1001):
        assert own.count([t.encode() for t in texts], 16, window).tolist() == want


def test_carried_state_survives_a_new_table(own, library, monkeypatch):
    monkeypatch.setattr(counting, "MAX_STATES", 20)
    texts = ["abcdefghijklmnopqrstuvwxyz" * 100, "some words, and others " * 50]
    assert own.count([t.encode() for t in texts], 16, 200).tolist() == library(texts)


def test_a_megabyte_of_one_letter(own, library):
    """Open chunks share their map and are composed by doubling: no round for each."""
    own.count([b"x" * 2000])
    begun = time.perf_counter()
    got = own.count([b"x" * (1 << 20)]).tolist()
    assert time.perf_counter() - begun < 5
    # The library's own time grows with the square of a pre-token: a letter's tokens repeat.
    few = library(["x" * n for n in (4096, 8192)])
    assert got == [few[0] + (few[1] - few[0]) * ((1 << 20) - 4096) // 4096]


def test_memory_of_a_long_text_is_bounded(own):
    text = ("The river ran past the old mill, didn't it? " * 23_832).encode()
    once = own.count([text]).tolist()[0]
    tracemalloc.start()
    assert abs(own.count([text * 8]).tolist()[0] - 8 * once) <= 8
    assert tracemalloc.get_traced_memory()[1] < 120 << 20
    tracemalloc.stop()


def test_bytes_that_are_not_utf8(own):
    data = (b"caf\xe9 \xff\xfe ok " * 300)
    assert own.count([data], 16, 200).tolist() == own.count([data.decode("utf-8", "replace").encode()], 16).tolist()


def test_the_table_may_be_compiled_anew(own, library, monkeypatch):
    monkeypatch.setattr(counting, "MAX_STATES", 50)
    texts = [f"some word{i} and {i * i} more, isn't it?" for i in range(300)]
    for i in range(0, 300, 50):
        assert own.count([t.encode() for t in texts[i:i + 50]]).tolist() == library(texts[i:i + 50])


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        counting.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
