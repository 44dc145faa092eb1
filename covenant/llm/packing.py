"""Harmonic packing of tokenised documents into sequences of fixed length.

A piece of length L belongs to class ``capacity // L`` = k, and a bin of class k takes exactly k pieces, whatever they are:
no search, no state but one open bin per class, so every task packs its own documents by itself. Documents are cut into
full sequences and a rest; a rest that would waste much of its class's bins is cut down to the next class's full length
first. The open bins of a task are joined end to end when it ends.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.llm.common import kept_in_stage, release_memory, small_batches, text_slices

CAPACITY = 2048
#: A bin may waste one part in so many before a rest is cut.
TOLERANCE = 32
#: Appended to every document.
END_ID = 1
#: Words whose ids a worker keeps in either generation, and words encoded by one call.
REMEMBERED = 300_000
TOGETHER = 1_000

#: The splitting pattern of the public byte-level vocabulary, for texts of the characters below.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PIECES = re.compile(
    rf" ?[{_LETTERS}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+"
)
#: Outside these the classes of Python's patterns and of the tokenizer's could differ, so such texts are encoded whole.
_OTHER = re.compile("[^\t\n\r -~¡-¨«¬®-±´¶-¸»¿-ɏ]")


def tokenizer(path: str) -> Any:
    """The tokenizer for a vocabulary file, as it is loaded."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encoder(path: str) -> Encoder:
    """The worker's encoder: what it has learnt in one task serves the stage's next one, and goes with the stage."""
    return kept_in_stage(f"encoder of {path}", lambda: Encoder(path))


class _Remembered(dict):
    """Ids of words in two generations: a word that is met again moves from the old one to the young one, and when the young
    one is full it becomes the old one. Words in neither are gathered in ``new``, with an empty place for their ids."""

    def __init__(self) -> None:
        self.old: dict[str, bytes] = {}
        self.new: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytes | bytearray:
        ids = self.old.get(word)
        if ids is None:
            return self.new.setdefault(word, bytearray())
        self[word] = ids
        return ids

    def age(self) -> None:
        if len(self) > REMEMBERED:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Ids of texts as the tokenizer gives them, with those of words remembered up to a bound.

    Texts are cut by the vocabulary's own pattern, and the words of some texts that are new are encoded by one call, as parts of
    one sequence. Texts with added tokens or characters beyond the common ones are encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Remembered()

    def _whole(self, text: str) -> bool:
        return _OTHER.search(text) is not None or any(a in text for a in self.added)

    def _learn(self) -> None:
        new = list(self.words.new)
        for at in range(0, len(new), TOGETHER):
            part = new[at : at + TOGETHER]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = array("I", found.ids).tobytes()
            edges = (4 * np.searchsorted(np.array(found.word_ids), np.arange(len(part) + 1))).tolist()
            for word, a, b in zip(part, edges[:-1], edges[1:], strict=True):
                self.words[word] = own = ids[a:b]
                self.words.new[word] += own
        self.words.new = {}

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of some texts."""
        look = self.words.__getitem__
        found = [None if self._whole(text) else list(map(look, _PIECES.findall(text))) for text in texts]
        self._learn()
        self.words.age()
        return [
            np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
            if words is None
            else np.frombuffer(b"".join(words), "<u4")
            for text, words in zip(texts, found, strict=True)
        ]

    def ids(self, text: str) -> np.ndarray:
        return self.batch([text])[0]


def cut_lengths(n: int, capacity: int = CAPACITY, tolerance: int = TOLERANCE) -> list[int]:
    """Lengths of the pieces of a document of n ids, in order."""
    lengths = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if (capacity - k * rest) * tolerance <= capacity:
            lengths.append(rest)
            break
        lengths.append(capacity // (k + 1))
        rest -= lengths[-1]
    return lengths


class Packer:
    """Bins of one task. ``rows`` gathers (doc, start, ids, total, sequence, offset)."""

    def __init__(self, first: int, capacity: int):
        self.next, self.capacity = first, capacity
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, ids, total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        start = 0
        for length in cut_lengths(len(ids), self.capacity):
            k = self.capacity // length
            bin_ = self.open.setdefault(k, [])
            bin_.append((doc, start, ids[start : start + length], len(ids)))
            start += length
            if len(bin_) == k:
                self.close(self.open.pop(k))

    def finish(self) -> None:
        """The pieces of open bins, end to end, cut where a sequence is full."""
        bin_, filled = [], 0
        for k in sorted(self.open):
            for doc, start, ids, total in self.open[k]:
                while len(ids):
                    part = ids[: self.capacity - filled]
                    bin_.append((doc, start, part, total))
                    start, ids, filled = start + len(part), ids[len(part) :], filled + len(part)
                    if filled == self.capacity:
                        self.close(bin_)
                        bin_, filled = [], 0
        if bin_:
            self.close(bin_)
        self.open = {}


def _pack(path: str, capacity: int, with_ids: bool):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        docs, starts, ids, totals, sequences, offsets = zip(*rows, strict=True)
        columns = {
            "doc_id": pa.array(docs, pa.int64()),
            "start": pa.array(starts, pa.int64()),
            "length": pa.array([len(x) for x in ids], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
            "doc_tokens": pa.array(totals, pa.int64()),
            "sequence_id": pa.array(sequences, pa.int64()),
            "offset": pa.array(offsets, pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
        return pa.RecordBatch.from_pydict(columns)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        # Each task numbers its sequences in a range of its own.
        packer = Packer(TaskContext.get().partitionId() << 36, capacity)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for first, last, _, _ in text_slices(texts):
                part = [text or "" for text in texts.slice(first, last - first).to_pylist()]
                for doc, ids in zip(docs[first:last], known.batch(part), strict=True):
                    packer.add(doc, np.concatenate([ids, end]))
                if len(packer.rows) >= 5000:
                    yield batch_of(packer.rows)
                    packer.rows = []
        packer.finish()
        if packer.rows:
            yield batch_of(packer.rows)
        del packer
        release_memory()

    return pack


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Pieces of tokenised documents placed in sequences of at most ``capacity`` ids.

    Takes (doc_id, text), other columns are ignored; ``vocabulary`` is the path of a tokenizer file that every worker can
    read. Texts are encoded as the tokenizer does as loaded: the string of an added token is that token. A null text is empty, and
    every document ends with the id 1, so each row has at least one piece; an empty table gives no rows. Returns doc_id,
    start (ids of the document before the piece), length, ids_crc32, doc_tokens, sequence_id, offset (in the sequence)
    and, if asked for, ids. Repeated rows are packed each on their own. There is no shuffle: a task that is run again
    packs the same documents the same way.
    """
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    schema += ", ids array<int>" if with_ids else ""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_pack(vocabulary, capacity, with_ids), schema)
