"""Token counts by a compiled finite-state transducer, without making the tokens.

A byte-level BPE vocabulary is compiled, as far as texts need it, into a deterministic
transducer over bytes whose transitions carry emitted-token counts: the change that one
more byte makes to the number of tokens of the pre-token so far (it may be negative, as a
longer token can replace several). A state holds what the future can depend on: for each
suffix of the pre-token that a token may still continue, the suffix, the last token before
it, and how many tokens fewer stand there. A token may follow another if the library's
merges leave the two apart; exactly one of the tokens that end at a place may follow the
last token before it, so the next state is determined.

Where pre-tokens begin follows from a bounded neighbourhood of characters; there the state
returns to the start. Texts are cut into chunks that all run at once. A chunk's state map is
constant after its first pre-token start. A chunk without such a start is open: its map is
made for the states it can meet (equal chunks share one map), and the maps of neighbouring
open chunks are composed by a parallel prefix scan, in as many steps as the logarithm of
their number. What lies before a chunk's first start is then run from the state found.

Defined cases: a null or empty text has no bytes and no tokens; special tokens inside a
text count one each, as the library takes them; repeated rows are counted row by row; an
empty table gives an empty result. Texts are counted whole; long ones pass through in
windows, each from the state in which the one before ended, so that the memory for the
work on a text does not grow with its length. Other columns of the table are not read.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LIMIT = 1024
CHUNK = 256
#: Characters of a long text worked on at a time, and those around a window that decide
#: where pre-tokens start in it (the rules look at most three characters either way).
WINDOW = 1 << 19
CONTEXT = 8
#: States kept in a task's table; beyond this it is compiled anew (results don't change).
MAX_STATES = 120_000

_L, _N, _O, _SPACE, _WHITE, _UNSEEN = range(6)
_START, _OPEN = 0, 1  # a pre-token's beginning; not known yet


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, model = spec["pre_tokenizer"], spec["model"]
        if spec.get("normalizer") or split.get("type") != "ByteLevel" or not split.get("use_regex", True) or split.get("add_prefix_space") or model.get("type") != "BPE":
            raise ValueError("only plain byte-level BPE files can be compiled")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens with stripping can't be compiled")
        to_byte = {c: b for b, c in common._BYTE_CHARS.items()}
        self.bytes_of = {i: bytes(to_byte[c] for c in t) for t, i in model["vocab"].items() if all(c in to_byte for c in t)}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ids = model["vocab"][a], model["vocab"][b]
            self.merges[ids] = rank, model["vocab"][a + b]
        specials = sorted((t["content"].encode() for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, specials))) if specials else None
        # Trie of all tokens: (node, byte) -> node, and the token that ends at a node.
        self.child: dict[int, int] = {}
        self.token_at, self.continues, nodes = {}, set(), 1
        for i, b in self.bytes_of.items():
            if self.encode(b) != [i]:
                continue  # merges never make it
            node = 0
            for x in b:
                nxt = self.child.get(node << 8 | x)
                if nxt is None:
                    nxt = self.child[node << 8 | x] = nodes
                    nodes += 1
                    self.continues.add(node)
                node = nxt
            self.token_at[node] = i
        self.apart: dict[tuple[int, int], bool] = {}

    def encode(self, data: bytes) -> list[int]:
        """BPE of one pre-token by the merges' order."""
        ids = [self.id_of[data[i:i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min(((self.merges.get(p, (1 << 60, 0))[0], i) for i, p in enumerate(zip(ids, ids[1:]))), default=None)
            if best[0] == 1 << 60:
                break
            i = best[1]
            ids[i:i + 2] = [self.merges[ids[i], ids[i + 1]][1]]
        return ids

    def may_follow(self, a: int, b: int) -> bool:
        if (a, b) not in self.apart:
            if len(self.apart) > 500_000:
                self.apart.clear()
            self.apart[a, b] = self.encode(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return self.apart[a, b]


class Transducer:
    """The table: next state and emitted tokens for each state and byte, filled when met."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._clear()

    def _clear(self):
        self.width = 129  # column 0 is padding: it changes nothing
        self.column = np.zeros(256, np.int64)
        self.columns = [None]
        self.number: dict[tuple, int] = {}
        self.states: list = [((), -1), None]
        self.table = np.full((1024, self.width), -1, np.int32)
        self.table[:, 0] = (np.arange(1024) << 8) + 128
        self.table[_OPEN] = (_OPEN << 8) + 128

    def columns_of(self, raw: np.ndarray) -> np.ndarray:
        """Column of each byte."""
        out = self.column[raw]
        fresh = np.unique(raw[out == 0])
        if len(fresh):
            if len(self.columns) + len(fresh) > self.width:
                more = np.full((len(self.table), 128), -1, np.int32)
                more[_OPEN] = (_OPEN << 8) + 128
                self.table, self.width = np.concatenate([self.table, more], 1), self.width + 128
            for b in fresh.tolist():
                self.column[b] = len(self.columns)
                self.columns.append(b)
            out = self.column[raw]
        return out

    def _fill(self, state: int, column: int):
        v, byte = self.v, self.columns[column]
        suffixes, last = self.states[state]
        # Suffixes that go on with this byte: (node, token before, tokens there less tokens here).
        grown = [(c, before, ahead) for node, before, ahead in (*suffixes, (0, last, 0)) if (c := v.child.get(node << 8 | byte)) is not None]
        for node, before, ahead in grown:
            token = v.token_at.get(node)
            if token is not None and (before < 0 or v.may_follow(before, token)):
                break
        else:
            raise AssertionError("no token ends here")
        emitted = ahead + 1
        to = self.adopt((tuple((n, b, a - emitted) for n, b, a in grown if n in v.continues), token))
        self.table[state, column] = (to << 8) + emitted + 128

    def adopt(self, key: tuple) -> int:
        """Number of a state, given what it holds."""
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            if to >= len(self.table):
                more = np.full((len(self.table), self.width), -1, np.int32)
                more[:, 0] = (np.arange(len(self.table), 2 * len(self.table)) << 8) + 128
                self.table = np.concatenate([self.table, more])
        return to

    def step(self, state: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, emitted tokens)."""
        value = self.table[state, column]
        while (missing := value < 0).any():
            for key in np.unique(state[missing] * self.width + column[missing]).tolist():
                self._fill(*divmod(key, self.width))
            value = self.table[state, column]
        return (value >> 8).astype(np.int64), (value & 255) - 128

    def count(self, raw: np.ndarray, starts: np.ndarray, lens: np.ndarray, chunk: int = CHUNK, carried: int = _START) -> tuple[np.ndarray, int]:
        """(tokens of each text, state after the last): raw bytes of all in a row, where
        pre-tokens start, bytes of each. The first text goes on from the state ``carried``
        unless a pre-token starts with it."""
        if not len(raw):
            return np.zeros(len(lens), np.int64), carried
        pieces = -(-lens // chunk)
        first = np.cumsum(pieces) - pieces
        text = np.repeat(np.arange(len(lens)), lens)
        within = np.arange(len(raw)) - np.repeat(np.cumsum(lens) - lens, lens)
        lane, place = first[text] + within // chunk, within % chunk
        total = int(pieces.sum())
        columns, reset = np.zeros((chunk, total), np.int32), np.zeros((chunk, total), bool)
        columns[place, lane], reset[place, lane] = self.columns_of(raw), starts
        emitted = np.zeros(total, np.int64)
        # All chunks at once, each from its first pre-token start on.
        state = np.full(total, _OPEN)
        for k in range(chunk):
            state, n = self.step(np.where(reset[k], _START, state), columns[k])
            emitted += n
        head = np.where(reset.any(0), reset.argmax(0), np.bincount(lane, minlength=total))
        lanes = np.flatnonzero(state == _OPEN)
        if len(lanes):
            self._scan(lanes, columns, state, emitted, carried)
        # Every chunk's end is known now: heads run from the ends of their predecessors.
        now = np.flatnonzero((head > 0) & reset.any(0))
        now = now[np.argsort(-head[now], kind="stable")]
        own = np.where(now > 0, state[now - 1], carried)
        for k in range(int(head[now].max(initial=0))):
            live = int(np.searchsorted(-head[now], -k, "left"))
            own[:live], n = self.step(own[:live], columns[k, now[:live]])
            emitted[now[:live]] += n
        counts = np.bincount(np.repeat(np.arange(len(lens)), pieces), weights=emitted, minlength=len(lens)).astype(np.int64)
        return counts, int(state[-1])

    def _maps(self, contents: np.ndarray, after: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """State maps of different open chunks: (keys in order, end, emitted tokens), where
        a key is chunk << 32 | entry state. ``after`` lists (chunk, a chunk that follows it);
        the entries grow from those given until every end that a follower can meet is one
        of its entries."""
        known, ends, counts = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        begins = np.searchsorted(after[:, 0], np.arange(len(contents) + 1))
        fresh = np.unique(keys)
        while len(fresh):
            own, state, n = contents[fresh >> 32], fresh & 0xFFFFFFFF, np.zeros(len(fresh), np.int64)
            for k in range(own.shape[1]):
                state, more = self.step(state, own[:, k])
                n += more
            order = np.argsort(all_keys := np.concatenate([known, fresh]))
            known, ends, counts = all_keys[order], np.concatenate([ends, state])[order], np.concatenate([counts, n])[order]
            c = fresh >> 32
            many = begins[c + 1] - begins[c]
            at = np.repeat(begins[c] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            fresh = np.setdiff1d(after[at, 1] << 32 | np.repeat(state, many), known)
        return known, ends, counts

    def _scan(self, lanes: np.ndarray, columns: np.ndarray, state: np.ndarray, emitted: np.ndarray, carried: int):
        """Run the open chunks ``lanes`` (ascending): composes the maps of each row of open
        neighbours by doubling; fills in the row's end state and tokens (at its last chunk)."""
        contents, kind = np.unique(np.ascontiguousarray(columns[:, lanes].T), axis=0, return_inverse=True)
        kind = kind.reshape(-1).astype(np.int64)
        head = np.concatenate([[True], np.diff(lanes) != 1])
        tail = np.concatenate([head[1:], [True]])
        inner = np.flatnonzero(~tail)
        after = np.unique(np.stack([kind[inner], kind[inner + 1]], 1), axis=0)
        entry = np.where(lanes[head] > 0, state[lanes[head] - 1], carried)
        # The true entries of the first chunks; for those inside a row, where a pre-token that
        # began with the chunk before would be: later bytes mostly decide, so few more are met.
        known, ends, counts = self._maps(contents, after, np.concatenate([kind[head] << 32 | entry, np.unique(after[:, 0]) << 32 | _START]))
        # A node for each chunk and entry of its map; it leads to the next chunk's entry.
        begins = np.searchsorted(known >> 32, np.arange(len(contents) + 1))
        size = (begins[1:] - begins[:-1])[kind]
        base = np.cumsum(size) - size
        chunk = np.repeat(np.arange(len(lanes)), size)
        key = begins[kind][chunk] + np.arange(len(chunk)) - base[chunk]
        last = tail[chunk]
        follower = np.where(last, chunk, np.minimum(chunk + 1, len(lanes) - 1))
        to = np.searchsorted(known, kind[follower] << 32 | ends[key])
        leads = np.where(last, np.arange(len(chunk)), base[follower] + to - begins[kind[follower]])
        tokens = np.where(last, 0, counts[key])
        rows = np.flatnonzero(head)
        longest = int(np.diff(np.concatenate([rows, [len(lanes)]])).max())
        for _ in range((longest - 1).bit_length()):
            tokens, leads = tokens + tokens[leads], leads[leads]
        node = base[rows] + np.searchsorted(known, kind[rows] << 32 | entry) - begins[kind[rows]]
        final = leads[node]
        at = lanes[tail]
        state[at] = ends[key[final]]
        emitted[at] += tokens[node] + counts[key[final]]


class Splitter:
    """Where pre-tokens start. Each character's class is asked of the library's own splitter
    when it is first met, so both always agree."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.kind = np.full(0x110000, _UNSEEN, np.uint8)
        self.kind[0x20] = _SPACE

    def _classes(self, points: np.ndarray) -> np.ndarray:
        out = self.kind[points]
        if (out == _UNSEEN).any():
            for p in np.unique(points[out == _UNSEEN]).tolist():
                c = chr(p)
                together = [len(self.split(x + c + x)) == 1 for x in ("a", "1", "!")]
                self.kind[p] = together.index(True) if any(together) else _WHITE
            out = self.kind[points]
        return out

    def starts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all texts in a row, whether a pre-token starts at each, bytes of each text)."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        chars = np.array([len(t) for t in texts], np.int64)
        raw = np.frombuffer(joined.encode("utf-8"), np.uint8)
        ends = np.cumsum(chars)
        upto = np.concatenate([[0], np.cumsum(width)])
        lens = upto[ends] - upto[ends - chars]
        if not len(points):
            return raw, np.zeros(0, bool), lens
        n = len(points)
        first = np.zeros(n + 1, bool)
        first[(ends - chars)[chars > 0]] = True
        first[n] = True
        kind = self._classes(points)
        white = kind >= _SPACE
        group = np.minimum(kind, _SPACE)
        before, white_before = np.concatenate([[_UNSEEN], kind[:-1]]), np.concatenate([[False], white[:-1]])
        start = np.concatenate([[True], group[1:] != group[:-1]])
        start &= white | (before != _SPACE)  # a space goes with what follows it
        # The last white space before something else stands alone, or goes with what follows.
        start |= white & white_before & np.concatenate([~white[1:], [False]]) & ~first[1:]
        start |= first[:-1]
        # Contractions: an apostrophe that starts a pre-token, with the letters after it.
        apostrophe = np.flatnonzero((points == 0x27) & (first[:-1] | ((before != _O) & (before != _SPACE))))
        if len(apostrophe):
            padded, at_first = np.concatenate([points, [0, 0]]), np.concatenate([first, [True, True]])
            one, two = padded[apostrophe + 1], padded[apostrophe + 2]
            inside_one, inside_two = ~at_first[apostrophe + 1], ~at_first[apostrophe + 1] & ~at_first[apostrophe + 2]
            short = inside_one & np.isin(one, [ord(c) for c in "stmd"])
            long = inside_two & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
            long &= ~short
            for hit, size in ((short, 2), (long, 3)):
                at = apostrophe[hit]
                for k in range(1, size):
                    start[at + k] = False
                start[(at + size)[at + size < n]] = True
        out = np.zeros(len(raw), bool)
        out[upto[:-1][start]] = True
        return raw, out, lens


class Counter:
    """Splitter and transducer of one vocabulary file."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.splitter, self.transducer = Splitter(path), Transducer(self.vocabulary)

    def count(self, texts: list[bytes], chunk: int = CHUNK, window: int = WINDOW) -> np.ndarray:
        special = self.vocabulary.special
        parts, owner, out = [], [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            at = 0
            for hit in [*(special.finditer(t) if special else ()), None]:
                part = t[at:hit.start() if hit else len(t)]
                if hit:
                    out[i] += 1
                    at = hit.end()
                if len(part) > window:
                    out[i] += self._count_long(part, chunk, window)
                else:
                    parts.append(part.decode("utf-8", "replace"))
                    owner.append(i)
        self._make_room()
        found, _ = self.transducer.count(*self.splitter.starts(parts), chunk)
        np.add.at(out, owner, found)
        return out

    def _make_room(self):
        if len(self.transducer.states) > MAX_STATES:
            self.transducer._clear()

    def _count_long(self, data: bytes, chunk: int, window: int) -> int:
        """Tokens of one long text, window after window."""
        self._make_room()
        around = 4 * CONTEXT  # a character has at most four bytes
        count, state, at = 0, _START, 0
        while at < len(data):
            end = _character(data, min(at + window, len(data)))
            left, right = _character(data, max(at - around, 0)), _character(data, min(end + around, len(data)))
            raw, starts, _ = self.splitter.starts([data[left:right].decode("utf-8", "replace")])
            if len(raw) != right - left:  # not UTF-8: what can't be read is replaced, as in short texts
                return self._count_long(data.decode("utf-8", "replace").encode(), chunk, window)
            own = slice(at - left, end - left)
            if len(self.transducer.states) > MAX_STATES:
                # The table is compiled anew; the carried state goes with it.
                kept = self.transducer.states[state] if state else None
                self.transducer._clear()
                state = self.transducer.adopt(kept) if kept else _START
            n, state = self.transducer.count(raw[own], starts[own], np.array([end - at]), chunk, state)
            count, at = count + int(n[0]), end
        return count


def _character(data: bytes, at: int) -> int:
    """The first character border from ``at`` on."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    path = path or common.vocabulary("byte_bpe_50k.json")

    def run(batches):
        own = common.kept(("counter", path), lambda: Counter(path))
        for batch in batches:
            for part, texts in common.slices(batch, limit=1 << 20):
                n = own.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [common.column(part, "doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    out = common.id_text(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
