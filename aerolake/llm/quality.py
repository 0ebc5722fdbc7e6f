"""Quality rules as a short-circuit cascade.

Four base figures are counted for every text. The rules that decide whether a document
stays are conditions on a document, joined by "and", so their order changes the work and
never the verdict. Each rule's cost (CPU time a document) and selectivity are estimated on
a bounded sample; the cascade takes next the rule that rejects most of the documents still
standing per second of its cost, and each rule sees only the survivors of those before.

Words are the runs between ASCII white space. Defined cases: a null or empty text has no
words and fails the base; rows with equal ids are judged row by row; an empty table gives
an empty result. Texts are judged whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Rows of the sample that orders the rules (it decides nothing else).
SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

_SPACE = np.zeros(256, np.uint8)
_SPACE[[0x20, *range(0x09, 0x0E)]] = 1
_CHAR = np.ones(256, np.uint8)  # a code point that isn't white space starts here
_CHAR[[0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)]] = 0
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[list(b"#*$%&|<>")] = 1
_UPPER = np.zeros(256, np.uint8)
_UPPER[0x41:0x5B] = 1
_LOWER = np.zeros(256, np.uint8)
_LOWER[0x61:0x7B] = 1
_LETTER = np.zeros(256, bool)  # an ASCII letter, or part of any character beyond ASCII
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Texts:
    """Texts of a slice and what the base counts of them."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.lens = np.array([len(t) for t in texts], np.int64)
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        words = [t.split() for t in texts]
        self.n_words = np.array([len(w) for w in words], np.int64)
        self.word_chars = self.tally(_CHAR)
        self.n_symbols = self.tally(_SYMBOL)
        lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in texts]
        self.n_lines = np.array([len(x) for x in lines], np.int64)
        self.n_dup_lines = self.n_lines - np.array([len(set(x)) for x in lines], np.int64)
        self.n_repeat_words = repeated_words(words, self.n_words)

    def tally(self, table: np.ndarray) -> np.ndarray:
        """Sum of table[byte] over each text."""
        at = np.concatenate([[0], np.cumsum(table[self.raw], dtype=np.int64)])
        ends = np.cumsum(self.lens)
        return at[ends] - at[ends - self.lens]

    def base_failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words)


def repeated_words(words: list[list[bytes]], counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in that text.

    A window can only repeat if each pair of its neighbouring words does, so whole
    windows are compared only there."""
    codes: dict[bytes, int] = {}
    flat = np.array([codes.setdefault(w, len(codes)) for own in words for w in own], np.int64)
    if len(flat) < window:
        return np.zeros(len(words), np.int64)
    doc = np.repeat(np.arange(len(words)), counts)

    def repeats(key, where):
        _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
        twice = n[inverse] > 1
        return where[twice], inverse[twice]

    # Ranks of runs of growing length, each kept only where the run occurs twice in its text.
    same_doc = doc[1:] == doc[:-1]
    at = np.flatnonzero(same_doc)
    pair = flat[at] * len(codes) + flat[at + 1]
    _, pair = np.unique(pair, return_inverse=True)
    at, rank = repeats(pair * len(words) + doc[at], at)
    for length in range(3, window + 1):
        last = at + length - 1
        fits = last < len(flat)
        at, rank, last = at[fits], rank[fits], last[fits]
        fits = doc[last] == doc[at]
        at, rank, last = at[fits], rank[fits], last[fits]
        at, rank = repeats(rank * len(codes) + flat[last], at)  # a rank holds its text
    edge = np.zeros(len(flat) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    ends = np.cumsum(counts)
    return covered[ends] - covered[ends - counts]


@dataclass(frozen=True)
class Rule:
    """``rejects(texts, rows)``: which of these rows of a slice the rule rejects."""

    name: str
    rejects: Callable[[Texts, np.ndarray], np.ndarray]


def _many_symbols(t: Texts, rows):
    return 10 * t.n_symbols[rows] > t.n_words[rows]


def _word_length(t: Texts, rows):
    return (t.word_chars[rows] < 3 * t.n_words[rows]) | (t.word_chars[rows] > 12 * t.n_words[rows])


def _repeated_lines(t: Texts, rows):
    return 10 * t.n_dup_lines[rows] > 3 * t.n_lines[rows]


def _few_letters(t: Texts, rows):
    """Under 80 % of the words hold a letter."""
    out = np.zeros(len(rows), bool)
    for k, r in enumerate(rows):
        raw = np.frombuffer(t.texts[r], np.uint8)
        space = _SPACE[raw].astype(bool)
        starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        hold = np.add.reduceat(_LETTER[raw], starts) > 0 if len(starts) else np.zeros(0, bool)
        out[k] = 10 * int(hold.sum()) < 8 * len(starts)
    return out


def _shouting(t: Texts, rows):
    """Over half of the ASCII letters are capitals."""
    upper = np.array([int(_UPPER[np.frombuffer(t.texts[r], np.uint8)].sum()) for r in rows], np.int64)
    lower = np.array([int(_LOWER[np.frombuffer(t.texts[r], np.uint8)].sum()) for r in rows], np.int64)
    return upper > lower


def _cut_lines(t: Texts, rows):
    """Over 30 % of the lines with a word end in three dots."""
    return np.array([10 * sum(x.endswith(b"...") for x in t.texts[r].split(b"\n")) > 3 * t.n_lines[r] for r in rows], bool)


RULES = (
    Rule("many_symbols", _many_symbols),
    Rule("word_length", _word_length),
    Rule("repeated_lines", _repeated_lines),
    Rule("few_letters", _few_letters),
    Rule("shouting", _shouting),
    Rule("cut_lines", _cut_lines),
)


def order_rules(texts: list[bytes], rules=RULES) -> list[tuple[Rule, float, float]]:
    """(rule, seconds a document, share rejected of those it would meet), in the order to run."""
    t = Texts(texts)
    standing = np.flatnonzero(~t.base_failed())
    cost, rejected = {}, {}
    for rule in rules:
        begin = time.process_time()
        rejected[rule] = set(standing[rule.rejects(t, standing)].tolist()) if len(standing) else set()
        cost[rule] = max(time.process_time() - begin, 1e-9) / max(1, len(standing))
    left, out, rest = set(standing.tolist()), [], list(rules)
    while rest:
        best = max(rest, key=lambda r: ((len(rejected[r] & left) + 0.01) / cost[r], -rules.index(r)))
        out.append((best, cost[best], len(rejected[best] & left) / max(1, len(left))))
        left -= rejected[best]
        rest.remove(best)
    return out


def judge(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept and rejected_by (null if kept; ``base``, or the first rule that rejected)."""
    docs = common.id_text(docs)
    # Any rows do for the order of the rules; limit() reads as many files as it needs.
    sample = [(r["text"] or "").encode() for r in docs.select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).limit(sample_rows).collect()]
    ordered = [rule for rule, _, _ in order_rules(sample, rules)]

    def run(batches):
        for batch in batches:
            for part, texts in common.slices(batch):
                t = Texts(texts)
                failed = t.base_failed()
                by = np.where(failed, "base", None).astype(object)
                rows = np.flatnonzero(~failed)
                for rule in ordered:
                    if not len(rows):
                        break
                    out = rule.rejects(t, rows)
                    by[rows[out]] = rule.name
                    rows = rows[~out]
                kept = np.zeros(len(texts), bool)
                kept[rows] = True
                yield pa.RecordBatch.from_arrays(
                    [common.column(part, "doc_id")] + [pa.array(x) for x in (t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, kept)] + [pa.array(by, pa.string())],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"])

    return docs.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string")


#: The same figures and verdict in DuckDB SQL (the verdict doesn't depend on the order of the rules).
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT row_no, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
keyed AS (SELECT row_no, i, array_to_string(words[i:i + 4], ' ') AS k FROM win),
twice AS (SELECT row_no, i FROM (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, k) AS c FROM keyed) WHERE c > 1),
rep AS (SELECT row_no, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(0, 5)) AS j) GROUP BY row_no),
m AS (SELECT w.row_no, doc_id, len(words)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS lettered,
        length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper,
        length(t) - length(regexp_replace(t, '[a-z]', '', 'g')) AS lower,
        len(list_filter(string_split(t, chr(10)), lambda x: x LIKE '%...')) AS cut
      FROM w LEFT JOIN rep USING (row_no))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words
    OR word_chars < 3 * n_words OR word_chars > 12 * n_words OR 10 * n_dup_lines > 3 * n_lines
    OR 10 * lettered < 8 * n_words OR upper > lower OR 10 * cut > 3 * n_lines) AS kept
FROM m
"""
