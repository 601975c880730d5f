"""Packing documents into token sequences by minimum bin slack.

A document's ids (and an end id) are cut at full windows; what is left over
waits in a pool. Each window takes the longest waiting piece and, by bitset
subset-sum dynamic programming over the lengths that wait, the multiset of
others that fills it closest to capacity; a slack that remains is filled by
cutting one more piece. Each task packs its own rows, so there is no shuffle,
and the pool is bounded: memory does not grow with the input. The rest of a
task's last window is cut into powers of two, which need no padding.

Ids are looked up by word (white space is dropped by the vocabulary, so the
ids of a text are those of its words in turn). The look-up table is bounded
and only saves time.

Defined cases: a null or empty text is its end id alone; repeated rows are
packed each; a null doc_id keeps its row; an empty table gives no piece; a
text of any length is cut at windows. A recomputed task gives the same
pieces and sequence numbers, as both follow from its rows and its number.

``mixture_packed`` packs in the order of a mixture: each stretch of a document
goes to the slot of the block that it lies in, windows are filled only from
one group of neighbouring slots, and sequences are numbered by group. So every
prefix of the sequences is a prefix of the mixture, but for one group.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from meterflow.llm import mixing
from meterflow.llm.common import held, release, slices

WINDOW, END_ID = 2048, 1

#: Pieces that wait before windows are filled, and that stay waiting.
POOL, LEAST_POOL = 1024, 512

#: Neighbouring slots of a mixture that share windows, and the sequence numbers that each such group has.
GROUP_SLOTS, GROUP_BITS = 10, 24

#: Words whose ids are kept in a generation, and the longest such word.
KEPT_WORDS, KEPT_CHARS = 500_000, 64


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it is visible, else the next from 256 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in seen)
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds(dict):
    """Word -> its ids as little-endian bytes, found on first use.

    Two generations: when the newer one is full, it becomes the older one.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer, self.older, self.letters = Tokenizer.from_file(path), {}, _byte_letters()

    def __missing__(self, word: str) -> bytes:
        if not word:
            return b""
        if len(word) > KEPT_CHARS:
            return self.encode(word)
        ids = self.older.get(word)
        if ids is None:
            ids = self.found(word)
        if len(self) >= KEPT_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def found(self, word: str) -> bytes:
        """Letters never merge with marks and are one word for the merges; all else goes through the whole tokenizer."""
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1]]
        low = word.lower()
        if low.isalpha() and word.isalpha() and "\u03a3" not in word and unicodedata.is_normalized("NFC", word):
            if not low.isascii():
                low = low.encode().decode("latin-1").translate(self.letters)
            return self.pack([x.id for x in self.tokenizer.model.tokenize(low)])
        return self.encode(word)

    def encode(self, word: str) -> bytes:
        return self.pack(self.tokenizer.encode(word, add_special_tokens=False).ids)

    @staticmethod
    def pack(ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)


def ids_of(text: str | None, table: WordIds) -> bytes:
    """All ids of a text, as bytes. Spaces and line ends always separate words."""
    return b"".join(map(table.__getitem__, (text or "").replace("\n", " ").split(" ")))


def fill(lengths: dict[int, int], capacity: int) -> list[int]:
    """The multiset of ``lengths`` (length -> count) whose sum is the largest up to ``capacity``.

    ``reach`` has bit s set if the lengths seen so far can sum to s; the sets
    after each length are kept, and counts are traced back through them.
    """
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted((x for x in lengths if x <= capacity), reverse=True):
        before, one = reach, reach
        for _ in range(min(lengths[length], capacity // length)):
            one = (one << length) & mask
            if not one:
                break
            reach |= one
        steps.append((length, before))
        if reach >> capacity & 1:
            break
    total, found = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        while not before >> total & 1:
            total -= length
            found.append(length)
    return found


class Packer:
    """Places one task's pieces; ``rows`` collects (doc, start, length, crc, doc tokens, sequence, offset)."""

    def __init__(self, first_sequence: int, window: int):
        self.next, self.window, self.rows = first_sequence, window, []
        self.waiting: dict[int, list[tuple]] = {}
        self.counts: dict[int, int] = {}
        self.n = 0

    def add(self, doc, raw: bytes, first: int = 0, tokens: int | None = None) -> None:
        """All ids of a document, or those from ``first`` on of one that has ``tokens``."""
        tokens, size = len(raw) // 4 if tokens is None else tokens, self.window * 4
        whole = len(raw) - len(raw) % size
        for at in range(0, whole, size):
            self.place([(doc, first + at // 4, raw[at:at + size], tokens)])
        if whole < len(raw):
            self.wait((doc, first + whole // 4, raw[whole:], tokens))
        if self.n >= POOL:
            while self.n > LEAST_POOL:
                self.window_from_pool()

    def wait(self, piece: tuple) -> None:
        length = len(piece[2]) // 4
        self.waiting.setdefault(length, []).append(piece)
        self.counts[length] = self.counts.get(length, 0) + 1
        self.n += 1

    def take(self, length: int) -> tuple:
        piece = self.waiting[length].pop()
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length], self.waiting[length]
        self.n -= 1
        return piece

    def place(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, raw, tokens in pieces:
            self.rows.append((doc, start, len(raw) // 4, zlib.crc32(raw), tokens, self.next, offset))
            offset += len(raw) // 4
        self.next += 1

    def window_from_pool(self) -> None:
        longest = max(self.counts)
        pieces = [self.take(longest)]
        left = self.window - longest
        for length in fill(self.counts, left) if left else []:
            pieces.append(self.take(length))
            left -= length
        if left and self.n:  # every waiting piece is longer than the slack
            pieces.append(self.cut(self.take(max(self.counts)), left))
            left = 0
        if left:
            self.powers(pieces)
        else:
            self.place(pieces)

    def cut(self, piece: tuple, length: int) -> tuple:
        """The first ``length`` ids of a piece; the others wait again."""
        doc, start, raw, tokens = piece
        if len(raw) > length * 4:
            self.wait((doc, start + length, raw[length * 4:], tokens))
        return doc, start, raw[:length * 4], tokens

    def powers(self, pieces: list[tuple]) -> None:
        """Pieces of less than a window, as sequences whose lengths are powers of two."""
        left = sum(len(p[2]) // 4 for p in pieces)
        while left:
            size = room = 1 << (left.bit_length() - 1)
            taken = []
            while room:
                doc, start, raw, tokens = pieces.pop(0)
                n = min(room, len(raw) // 4)
                taken.append((doc, start, raw[:n * 4], tokens))
                if n * 4 < len(raw):
                    pieces.insert(0, (doc, start + n, raw[n * 4:], tokens))
                room -= n
            self.place(taken)
            left -= size

    def finish(self) -> None:
        while self.n:
            self.window_from_pool()


def _fields(docs: DataFrame) -> list[T.StructField]:
    return [T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [
        T.StructField(x, T.LongType()) for x in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]


def _emptied(packer: Packer, kind: pa.DataType, fields: list[T.StructField]) -> pa.RecordBatch:
    rows, packer.rows = packer.rows, []
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:]]], [f.name for f in fields])


def packed(docs: DataFrame, text: str = "text", path: str | None = None, window: int = WINDOW,
           end_id: int = END_ID) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (longs)."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    end = struct.pack("<I", end_id)
    fields = _fields(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, packer, kind = held(path, lambda: WordIds(path)), Packer(TaskContext.get().partitionId() << 40, window), None

        for b in slices(batches):
            kind = b.schema.field(0).type
            for doc, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                packer.add(doc, ids_of(body, table) + end)
            if len(packer.rows) >= 20_000:
                yield _emptied(packer, kind, fields)
        packer.finish()
        if packer.rows:
            yield _emptied(packer, kind, fields)

    return docs.select("doc_id", F.col(text)).mapInArrow(run, T.StructType(fields))


def _stretches(start: int, size: int, slots: list[int], tokens: int, block: int) -> Iterator[tuple[int, int, int, int]]:
    """(slot, place in the source, first id, end id) of a document's stretches: ids are dealt evenly over its characters."""
    edges = [start, *range((start // block + 1) * block, start + size, block), start + size]
    for slot, a, b in zip(slots, edges, edges[1:]):
        first, end = (a - start) * tokens // size, (b - start) * tokens // size
        if first < end:
            yield slot, a, first, end


def mixture_packed(docs: DataFrame, text: str = "text", path: str | None = None, window: int = WINDOW, end_id: int = END_ID,
                   block: int = mixing.BLOCK, **shares) -> DataFrame:
    """The rows of ``packed``, with sequences in the order of the mixture of ``docs``."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    end, fields = struct.pack("<I", end_id), _fields(docs)
    kept = docs.select("doc_id", F.col(text).alias("text"), "source")
    names = ["doc_id", "slot", "place", "first", "tokens", "ids"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held(path, lambda: WordIds(path))
        for b in slices(batches):
            out = []
            for doc, body, start, size, slots in zip(*[c.to_pylist() for c in b.columns]):
                raw = ids_of(body, table) + end
                tokens = len(raw) // 4
                out += [(doc, slot, place, a, tokens, raw[a * 4:z * 4])
                        for slot, place, a, z in _stretches(start, size, slots, tokens, block)]
            columns = list(zip(*out)) or [[]] * len(names)
            kinds = [b.schema.field(0).type, *[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        packer, group, kind = Packer(0, window), None, None
        for b in slices(batches):
            kind = b.schema.field(0).type
            for doc, slot, _, first, tokens, raw in zip(*[c.to_pylist() for c in b.columns]):
                if slot // GROUP_SLOTS != group:
                    packer.finish()
                    group = slot // GROUP_SLOTS
                    packer.next = group << GROUP_BITS
                packer.add(doc, raw, first, tokens)
            if len(packer.rows) >= 20_000:
                yield _emptied(packer, kind, fields)
        packer.finish()
        if packer.rows:
            yield _emptied(packer, kind, fields)

    longs = [T.StructField(x, T.LongType()) for x in names[1:-1]]
    rows = mixing.spread(kept, ["doc_id", "text"], block=block, **shares).mapInArrow(
        cut, T.StructType([fields[0], *longs, T.StructField("ids", T.BinaryType())]))
    # A group holds at most GROUP_SLOTS blocks: never more than a task can take. Sequence numbers hold the order,
    # so groups may be dealt by hash; dealing them by range would make all ids twice, once to find the ranges.
    rows = rows.withColumn("_group", F.floor(F.col("slot") / GROUP_SLOTS)).repartition("_group")
    rows = rows.sortWithinPartitions("slot", "place").drop("_group")
    return rows.mapInArrow(run, T.StructType(fields))
