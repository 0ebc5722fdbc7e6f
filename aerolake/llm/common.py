"""Helpers shared by the text operators: tables, staged results, text slices, cached encoders."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.session import shared_path

#: Bytes of text that a task works on at a time.
SLICE_BYTES = 2 << 20


def find_library(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver did. That place is the
    workers' own in local mode and on shared installs; other clusters get the library by
    ``--py-files``, as any PySpark package, and skip a path that they don't have."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, here])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    find_library(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """Only doc_id and text, typed, so that other columns of any name can't clash."""
    find_library(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: later stages re-read
    files, so a lost executor never re-runs (or re-orders) what came before."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Cut a batch so that each part holds about ``limit`` bytes of text (a row at
    least). Yields (part, its texts as bytes; a null text is empty)."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        begun = int(size[at - 1]) if at else 0
        end = min(batch.num_rows, int(np.searchsorted(size, begun + limit)) + 1)
        yield batch.slice(at, end - at), [x or b"" for x in texts.slice(at, end - at).to_pylist()]
        at = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def crc_mod(doc_id, n: int):
    """crc32 of the id's decimal text, modulo n (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def crc_of_ids(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def spread_by_size(df: DataFrame, rows: int, per_task: int) -> int:
    """Number of partitions so that none gets more than about ``per_task`` rows."""
    return max(1, -(-rows // per_task))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _distinct(data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(number of each string among the distinct ones, the distinct ones), of strings in a row."""
    offsets = np.zeros(len(lens) + 1, np.int32)
    np.cumsum(lens, out=offsets[1:])
    found = pa.BinaryArray.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary.to_pylist()


def word_codes(texts: list[bytes], apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(number of each word, words of each text, the distinct words by number): the runs
    between bytes that lie apart (a table; ASCII white space), of all texts in a row."""
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    space = apart[raw]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    limits = np.cumsum([0] + [len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, limits)) if len(texts) else np.zeros(0, np.int64)
    codes, words = _distinct(raw[~space], ends - starts)
    return codes, counts, words


# Any character that some definition of white space holds, followed by a space: there
# the space does not open a pre-token by itself, so the text isn't cut.
_WIDE = r"\s\x1c-\x1f\x85᠎​"
_ODD_SPACE = re.compile(
    rb"(?:[\s\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80) ")
#: Last bytes of what _ODD_SPACE may hold before a space: only texts with one are searched.
_ODD_LAST = np.zeros(256, bool)
_ODD_LAST[[*range(0x09, 0x0E), *range(0x1C, 0x21), *range(0x80, 0x8C), 0x8E, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_CUT = re.compile(rf"(?<=[^{_WIDE}]) ")


#: Latin letters (but İ, whose lower case ends in a mark), then ASCII signs: two pre-tokens
#: ("'" may open a contraction, "<" a special token).
_WORD_SIGNS = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:;=-@\\[-`{-~]+)")


#: A word that both vocabularies take as one pre-token, and that normalization only lower-cases.
_WORD = re.compile("[A-Za-zß-öø-ÿ]+")
#: Each byte's character in the byte-level vocabularies (bytes without a visible character move up from 256).
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: chr(b) for b in _VISIBLE} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_VISIBLE}))}


class _Codes(dict):
    """Fragment -> number; new fragments wait in ``pending`` to be encoded."""

    def __init__(self):
        super().__init__()
        self.pending = []

    def __missing__(self, key):
        code = self[key] = len(self)
        self.pending.append(key)
        return code


class Encoder:
    """Ids of whole texts by the ``tokenizers`` library, each distinct fragment encoded once.

    Both vocabularies split a text into pre-tokens before they merge anything. A space
    after a character that is no white space always opens a pre-token
    (``spaces=True``, byte-level vocabularies keep the space in it), and white space
    only separates pre-tokens where the vocabulary drops it (``spaces=False``). So the
    ids of a text are those of its fragments in a row. Beyond ``max_entries`` the memory
    forgets all but the most used half: it saves time and never changes a result.
    """

    def __init__(self, path: str, spaces: bool, max_entries: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.spaces, self.max_entries = spaces, max_entries
        self._clear()

    def _clear(self):
        self.codes = _Codes()
        self.lens, self.offs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _forget(self):
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) > self.max_entries // 2:  # the most used half
            kept = np.sort(kept[np.argpartition(-self.uses[kept], self.max_entries // 2)[:self.max_entries // 2]])
        names = list(self.codes)
        codes = _Codes()
        codes.update((names[c], i) for i, c in enumerate(kept.tolist()))
        lens = self.lens[kept]
        ends = np.cumsum(lens)
        self.pool = self.pool[np.repeat(self.offs[kept] - (ends - lens), lens) + np.arange(int(lens.sum()))]
        self.codes, self.lens, self.offs, self.uses = codes, lens, ends - lens, np.zeros(len(kept), np.int64)

    def _fragments(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of each fragment, fragments of each text)."""
        number = lambda keys: np.array(list(map(self.codes.__getitem__, keys)), np.int64)
        if not self.spaces:  # the vocabulary lower-cases all but its special tokens
            codes, counts, words = word_codes([t if b"<|" in t else t.lower() for t in texts])
            return number(words)[codes], counts
        odd = {}
        for i, t in enumerate(texts):
            raw = np.frombuffer(t, np.uint8)
            if _ODD_LAST[raw[:-1][raw[1:] == 0x20]].any() and _ODD_SPACE.search(t):
                first, *rest = [p.encode() for p in _CUT.split(t.decode("utf-8", "replace"))]
                odd[i] = number([(first,), *rest])
        plain = [b"" if i in odd else t for i, t in enumerate(texts)]
        raw = np.frombuffer(b" ".join(plain) + b" ", np.uint8)
        space = raw == 0x20
        at = np.flatnonzero(space)
        codes, words = _distinct(raw[~space], np.diff(at, prepend=-1) - 1)
        codes = number(words)[codes]
        ends = np.searchsorted(at, np.cumsum([len(t) + 1 for t in plain]) - 1) + 1  # fragments up to each text's last
        counts = np.diff(ends, prepend=0)
        codes[ends - counts] = number((t.split(b" ", 1)[0],) for t in plain)  # no space before a text's first
        if odd:
            parts = np.split(codes, ends[:-1])
            parts = [odd.get(i, p) for i, p in enumerate(parts)]
            codes, counts = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return codes, counts

    def _encode_pending(self):
        """Add the ids of the new fragments; a word with signs after it is put together
        from the ids of both, so that only distinct words meet the tokenizer."""
        if not self.codes.pending:
            return
        pending, both, texts, order, words, word_order = self.codes.pending, [], [], [], [], []
        code = len(self.codes) - len(pending)
        for key in pending:  # grows by words that were only met with signs
            if type(key) is not bytes:
                texts.append(key[0].decode("utf-8", "replace"))
                order.append(code)
            elif key.isalpha():  # ASCII letters
                words.append(key if self.spaces else key.lower())
                word_order.append(code)
            else:
                text = key.decode("utf-8", "replace")
                if _WORD.fullmatch(text):
                    words.append(key if self.spaces else text.lower().encode())
                    word_order.append(code)
                elif m := _WORD_SIGNS.fullmatch(text):
                    signs = m[2].encode()
                    both.append((code, self.codes[m[1].encode()], self.codes[(signs,) if self.spaces else signs]))
                else:
                    texts.append(" " * self.spaces + text)
                    order.append(code)
            code += 1
        self._add(order + word_order, chain(self._ids(texts), self._word_ids(words)))
        if both:
            to, word, signs = np.array(both, np.int64).T
            self.lens[to] = self.lens[word] + self.lens[signs]
            ends = np.cumsum(self.lens[to])
            at = ends - self.lens[to]
            flat = np.zeros(int(ends[-1]), np.uint32)
            for part, start in ((word, at), (signs, at + self.lens[word])):
                n = self.lens[part]
                step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                flat[np.repeat(start, n) + step] = self.pool[np.repeat(self.offs[part], n) + step]
            self.offs[to] = len(self.pool) + at
            self.pool = np.concatenate([self.pool, flat])
        self.codes.pending = []

    def _ids(self, texts: list):
        for i in range(0, len(texts), 4096):
            for e in self.tokenizer.encode_batch_fast(texts[i:i + 4096], add_special_tokens=False):
                yield e.ids

    def _word_ids(self, words: list):
        """A word needs no normalizing or splitting: it goes to the library's BPE model."""
        merge, space = self.model.tokenize, _BYTE_CHARS[0x20] * self.spaces
        for w in words:
            chars = w.decode() if w.isascii() else w.decode("latin-1").translate(_BYTE_CHARS)
            yield [t.id for t in merge(space + chars)]

    def _add(self, order: list, found):
        lens, flat = [], []
        for ids in found:
            lens.append(len(ids))
            flat.extend(ids)
        more = np.zeros(len(self.codes) - len(self.lens), np.int64)
        self.lens, self.offs = np.concatenate([self.lens, more]), np.concatenate([self.offs, more])
        lens = np.array(lens, np.int64)
        self.lens[order], self.offs[order] = lens, len(self.pool) + np.cumsum(lens) - lens
        self.pool = np.concatenate([self.pool, np.array(flat, np.uint32)])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row as uint32, number of ids of each text)."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.codes) > self.max_entries:
            self._forget()
        codes, counts = self._fragments(texts)
        self._encode_pending()
        self.uses = np.concatenate([self.uses, np.zeros(len(self.lens) - len(self.uses), np.int64)])
        self.uses += np.bincount(codes, minlength=len(self.uses))
        lens = self.lens[codes]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(self.offs[codes] - (ends - lens), lens) + np.arange(total)]
        edge = np.concatenate([[0], ends])
        at = np.concatenate([[0], np.cumsum(counts)])
        return ids, edge[at[1:]] - edge[at[:-1]]


_KEPT: dict = {}


def kept(key: tuple, make):
    """What a Python worker keeps over its tasks: one thing at a time. A worker that goes
    on to another operator gives the memory of the one before back."""
    if key not in _KEPT:
        _KEPT.clear()
        gc.unfreeze()
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)
        gc.set_threshold(200_000, 50, 100)  # such memories hold many small objects, seldom garbage
        _KEPT[key] = make()
    return _KEPT[key]


def encoder(path: str, spaces: bool) -> Encoder:
    return kept(("encoder", path, spaces), lambda: Encoder(path, spaces))


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file (the default of the operators' path parameter)."""
    import public_tokenizers

    return public_tokenizers.path(name)
