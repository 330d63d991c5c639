"""Harmonic packing of token sequences.

The capacity C is divided into reciprocal classes: class j holds pieces of length in (C//(j+1), C//j],
and a bin of class j takes exactly j pieces.  A document is cut so that every piece nearly fills its class's share:
full sequences first; then, while the rest would waste more than ``1/SLACK`` of its share, a piece
of exactly the next smaller share is cut off.  Every worker fills the bins of every class by itself, without a
shuffle or any exchange; at its end the pieces in unfinished bins are laid end to end, cut at the
capacity, so a worker leaves one short sequence in all.

A worker is one input partition; it holds at most one open bin per class (under 100 classes).  Sequence ids
carry the partition number, and a repeated task reads the same rows in the same order, so it
packs the same sequences under the same ids.

Defined cases: a null or empty text is the end id alone; a very long text becomes many full sequences; repeated rows are
packed each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
END_ID = 1
#: A piece may leave at most this fraction (1/SLACK) of its class's share unused.
SLACK = 64
#: Distinct words whose ids a worker remembers before it starts afresh; it keeps as many parts of words.
WORD_CACHE = 600_000
#: Text whose distinct words are looked up together.
SLICE_BYTES = 4 << 20
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def cut(length: int, capacity: int = CAPACITY) -> list[int]:
    """Piece lengths of a document."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        j = capacity // rest
        share = capacity // j
        if (share - rest) * SLACK <= share:
            pieces.append(rest)
            break
        pieces.append(capacity // (j + 1))
        rest -= pieces[-1]
    return pieces


class WordIds:
    """Token ids of texts.

    The tokenizer lower-cases and treats the words between blanks separately, so each distinct word is
    encoded once and texts are put together from the words' ids.  A word made of Latin-1 letters and
    closing punctuation falls into exactly these two parts, and each distinct part goes to the tokenizer's BPE model
    directly; every other word goes through the whole tokenizer.  Splitting and counting distinct words are Arrow
    kernels, so Python sees the distinct words of a batch only.
    """

    CLOSING = ".,!|#$%&*?;:"

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._model = self._tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._bytes = {i: as_bytes.pre_tokenize_str(chr(i))[0][0] for i in range(256)}
        self._parts = _Table()
        self._forget()

    def _forget(self) -> None:
        self._known = _Table()
        if len(self._parts.at) > WORD_CACHE:
            self._parts = _Table()

    def _whole(self, word: str) -> list[int]:
        return self._tokenizer.encode(word, add_special_tokens=False).ids

    def _part(self, part: str) -> list[int]:
        return [t.id for t in self._model.tokenize(part.translate(self._bytes))]

    def _learn(self, words: list[str]) -> None:
        """Distinct new words of texts within Latin-1, in lower case."""
        letters = [w.rstrip(self.CLOSING) for w in words]
        simple = [not x or x.isalpha() for x in letters]
        odd = [w for w, s in zip(words, simple) if not s]
        if odd:
            self._known.add(odd, [self._whole(w) for w in odd])
            letters = [x for x, s in zip(letters, simple) if s]
            words = [w for w, s in zip(words, simple) if s]
        closing = [w[len(x):] for w, x in zip(words, letters)]
        at = self._parts.at
        new = [p for p in {**dict.fromkeys(letters), **dict.fromkeys(closing)} if p not in at]
        self._parts.add(new, [self._part(p) for p in new])
        both = np.empty(2 * len(words), np.int64)
        both[::2] = np.fromiter(map(at.__getitem__, letters), np.int64, len(words))
        both[1::2] = np.fromiter(map(at.__getitem__, closing), np.int64, len(words))
        ids, sizes = self._parts.ids(both)
        self._known.extend(words, ids, sizes[::2] + sizes[1::2])

    def _places(self, words: list[str], plain: bool) -> np.ndarray:
        """Where the ids of distinct words are, learned first if need be."""
        get = self._known.at.get
        places = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(places < 0)
        new = [words[i] for i in missing.tolist()]
        if new and plain:
            self._learn(new)
        elif new:
            self._known.add(new, [self._whole(w) for w in new])
        places[missing] = np.fromiter(map(get, new), np.int64, len(new))
        return places

    def _words(self, texts: pa.Array) -> list[np.ndarray]:
        """The places of every word, text by text."""
        lengths = pc.binary_length(texts).to_numpy()
        ends = np.cumsum(lengths)
        begins = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset] if len(texts) else 0
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begins:begins + (ends[-1] if len(ends) else 0)]
        # code points up to U+00FF begin with a byte of at most 0xC3; within Latin-1, lower case is the only
        # thing the tokenizer changes first
        plain = np.ones(len(texts), bool)
        full = np.flatnonzero(lengths)
        if len(full):
            plain[full] = np.maximum.reduceat(raw, (ends - lengths)[full]) <= 0xC3
        found: list[np.ndarray] = [None] * len(texts)
        if plain.any():
            split = pc.split_pattern(pc.replace_substring(pc.utf8_lower(texts.filter(pa.array(plain))), "\n", " "), " ")
            coded = split.flatten().dictionary_encode()
            at = self._places(coded.dictionary.to_pylist(), True)[coded.indices.to_numpy()]
            for i, part in zip(np.flatnonzero(plain).tolist(), np.split(at, np.cumsum(pc.list_value_length(split).to_numpy())[:-1])):
                found[i] = part
        for i in np.flatnonzero(~plain).tolist():
            words = texts[i].as_py().replace("\n", " ").split(" ")
            distinct = {w: k for k, w in enumerate(dict.fromkeys(words))}
            found[i] = self._places(list(distinct), False)[np.fromiter(map(distinct.__getitem__, words), np.int64, len(words))]
        return found

    def encode(self, texts: pa.Array | list[str | None]) -> Iterator[np.ndarray]:
        """One array of ids per text, the end id included."""
        if len(self._known.at) > WORD_CACHE:
            self._forget()
        for words in self._words(pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")):
            ids, _ = self._known.ids(words)
            yield np.append(ids, np.uint32(END_ID))


class _Table:
    """Id sequences of strings, end to end in one array that grows by doubling."""

    def __init__(self):
        self.at: dict[str, int] = {}
        self._flat = np.empty(1 << 16, np.uint32)
        self._start = np.zeros(1 << 14, np.int64)

    def add(self, names: list[str], ids: list[list[int]]) -> None:
        self.extend(names, np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def extend(self, names: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.at)
        used = self._start[n]
        while used + len(flat) > len(self._flat):
            self._flat = np.concatenate([self._flat, np.empty_like(self._flat)])
        while n + len(names) >= len(self._start):
            self._start = np.concatenate([self._start, np.empty_like(self._start)])
        self._flat[used:used + len(flat)] = flat
        self._start[n + 1:n + 1 + len(names)] = used + np.cumsum(sizes)
        self.at.update(zip(names, range(n, n + len(names))))

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings at these places, end to end, and how many each has."""
        first = self._start[places]
        sizes = self._start[places + 1] - first
        ends = np.cumsum(sizes)
        return self._flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + sizes, sizes)], sizes


_words: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    """One word table per Python worker, kept from task to task."""
    if path not in _words:
        _words[path] = WordIds(path)
    return _words[path]


class _Worker:
    """The open bins of one worker and the rows of the sequences it has finished."""

    def __init__(self, worker: int, capacity: int):
        self.capacity = capacity
        self.next_id = worker << 40
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        j = self.capacity // len(ids)
        held = self.open.setdefault(j, [])
        held.append((doc_id, start, ids, doc_tokens))
        if len(held) == j:
            self._close(self.open.pop(j))

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), doc_tokens,
                              self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def finish(self) -> None:
        left, room = [], self.capacity
        for j in sorted(self.open):
            for doc_id, start, ids, doc_tokens in self.open[j]:
                while len(ids):
                    left.append((doc_id, start, ids[:room], doc_tokens))
                    taken = len(left[-1][2])
                    start, ids, room = start + taken, ids[taken:], room - taken
                    if not room:
                        self._close(left)
                        left, room = [], self.capacity
        if left:
            self._close(left)
        self.open = {}

    def drain(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7
        columns = list(zip(*self.rows)) if self.rows else [[]] * 7
        self.rows = []
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``SLICE_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES, prepend=0)).tolist()
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
        if high > low:
            yield batch.slice(low, high - low)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece (see ``SCHEMA``): where it lies in its document and in its sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(tokenizer_path)
        worker = _Worker(TaskContext.get().partitionId(), capacity)
        for batch in batches:
            for part in _slices(batch):
                for doc_id, ids in zip(part.column(0).to_pylist(), words.encode(part.column(1))):
                    start = 0
                    for length in cut(len(ids), capacity):
                        worker.add(doc_id, start, ids[start:start + length], len(ids))
                        start += length
            yield worker.drain()
        worker.finish()
        yield worker.drain()

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
