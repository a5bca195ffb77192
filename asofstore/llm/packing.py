"""Vector bin packing of training examples (operator 8).

Every example becomes token ids and an end id; sequences take pieces of
examples under three limits at once: tokens, segments and loss-bearing tokens.
A task packs the rows of its own input split as a stream, so nothing is
exchanged and memory is bounded by a pool of waiting examples (``POOL`` of
them; a text longer than that is held alone). For the open sequence the
**dot-product heuristic** picks, among the waiting examples that fit, the one
whose demand vector has the largest inner product with the free capacities
(each in units of its limit). When none fits whole, the example with the
largest product is cut at the capacity that binds. The rest of a split, less
than one sequence, is laid out in sequences of descending powers of two, which
need no padding.

A sequence is named by split and number, so a task that runs again makes the
same sequences.

Defined results: null text is empty and is the end id alone; an empty table
gives no rows; repeated rows are packed each for itself; a null doc_id is
carried; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

POOL = 64
# The split rule of the tokenizer file, for text in which its
# normaliser does no more than lower-case (printable ASCII and Latin letters).
_L = "a-zªµºÀ-ÖØ-öø-ž"
_N = "0-9²³¹¼-¾"
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-įı-ž]*")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\\s{_L}{_N}]+")


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class WordTokens(C.Remembered):
    """Ids (little-endian uint32 bytes) of each lower-cased word.

    This kind of tokenizer drops white space and encodes pre-tokens
    independently of each other, so a text's ids are its words' ids in order;
    texts with characters outside the plain range go to the tokenizer whole.
    """

    LIMIT = 800_000
    LETTERS = _byte_letters()

    def __init__(self, path: str, end_id: int):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.end = np.uint32(end_id).tobytes()

    def make(self, word: str) -> bytes:
        ids = []
        for piece in _PIECES.findall(word):
            if not piece.isascii():
                piece = "".join(map(self.LETTERS.__getitem__, piece.encode()))
            ids += [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for t in texts:
            if t and "<|" not in t and _PLAIN.fullmatch(t):
                ids = b"".join(map(self.__getitem__, t.lower().split()))
            else:
                ids = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids if t else [], "<u4").tobytes()
            out.append(ids + self.end)
        return out


class Packer:
    """Sequences of one split, made as its examples arrive."""

    def __init__(self, split: int, tokens: int, segments: int, loss: int):
        self.limit = np.array([tokens, segments, loss], float)
        self.next_id = split << 32
        self.waiting: list[tuple] = []              # (doc_id, ids, loss_from)
        self.start = np.zeros(POOL, np.int64)       # of what is left of each waiting example
        self.demand = np.zeros((3, POOL))           # its tokens, segments, loss-bearing tokens
        self.left = 0
        self.pieces: list[tuple] = []
        self._open(tokens)

    def _open(self, tokens: int) -> None:
        self.free = np.array([tokens, self.limit[1], self.limit[2]], float)
        self.at, self.segment, self.sequence = 0, 0, None

    def add(self, doc_id, ids: bytes, loss_from: int) -> None:
        i, n = len(self.waiting), len(ids) // 4
        self.waiting.append((doc_id, ids, loss_from))
        self.start[i] = 0
        self.demand[:, i] = n, 1, max(0, n - loss_from)
        self.left += n
        while len(self.waiting) == POOL or self.left >= 4 * POOL * self.limit[0]:
            self._place()

    def finish(self) -> None:
        while self.left and self.left >= self.free[0]:
            self._place()
        if self.at and self.left:       # end the open sequence at a power of two, if one is in reach
            top = 1 << ((self.at + self.left).bit_length() - 1)
            self.free[0] = top - self.at if top > self.at else self.left
        while self.waiting:
            if not self.at:
                self._open(min(int(self.limit[0]), 1 << (self.left.bit_length() - 1)))
            self._place()

    def _place(self) -> None:
        """One piece into the open sequence."""
        n = len(self.waiting)
        demand = self.demand[:, :n]
        fits = (demand <= self.free[:, None]).all(axis=0)
        product = (self.free / self.limit ** 2) @ demand
        i = int(np.where(fits, product, -1).argmax()) if fits.any() else int(product.argmax())
        doc_id, ids, loss_from = self.waiting[i]
        start, length = int(self.start[i]), int(demand[0, i])
        if not fits[i]:                 # cut: plain tokens first, then as many loss-bearing ones as are allowed
            length = int(min(length, self.free[0], max(0, loss_from - start) + self.free[2]))
        if not length:                  # the loss limit is used up
            self._open(int(self.limit[0]))
            return
        if self.sequence is None:
            self.sequence = self.next_id
            self.next_id += 1
        part = ids[4 * start:4 * (start + length)]
        loss = max(0, start + length - max(start, loss_from))
        self.pieces.append((doc_id, start, length, zlib.crc32(part), len(ids) // 4, self.sequence, self.at,
                            self.segment, loss, part))
        self.free -= (length, 1, loss)
        self.at += length
        self.segment += 1
        self.left -= length
        if length == demand[0, i]:
            last = self.waiting.pop()
            if i < n - 1:
                self.waiting[i] = last
                self.start[i], self.demand[:, i] = self.start[n - 1], self.demand[:, n - 1]
        else:
            self.start[i] += length
            self.demand[0, i] -= length
            self.demand[2, i] -= loss
        if not self.free[0] or not self.free[1]:
            self._open(int(self.limit[0]))


PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, segment bigint, loss_tokens bigint")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, tokens: int = 4096, segments: int = 1024,
         loss_tokens: int | None = None, id_col: str = "doc_id", text_col: str = "text",
         prompt_col: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece; with ``with_ids`` also its ``ids``.

    ``prompt_col``: text that precedes ``text_col`` and bears no loss (for
    instruction data); without it every token bears loss.
    """
    C.small_batches(docs.sparkSession)
    loss_limit = tokens if loss_tokens is None else loss_tokens
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"),
                      (F.col(prompt_col) if prompt_col else F.lit(None).cast("string")).alias("_prompt"))
    kinds = [pa.int64()] * 9

    def out(pieces: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*pieces))
        arrays = [pa.array(c, t) for c, t in zip(cols[:9], kinds)]
        names = [x.split()[0] for x in PIECES.split(", ")]
        if with_ids:
            ids = np.frombuffer(b"".join(cols[9]), "<u4").astype(np.int32)
            arrays.append(C.list_array(ids, np.array(cols[2]), pa.int32()))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer_path, end_id).use()
        packer = Packer(TaskContext.get().partitionId(), tokens, segments, loss_limit)
        for b in C.slices(batches, 500):
            texts, prompts = b.column("_text").to_pylist(), b.column("_prompt").to_pylist()
            before = [len(x) // 4 - 1 for x in coder.encode(prompts)] if prompt_col else [0] * len(texts)
            whole = coder.encode([(p or "") + "\n" + (t or "") if p else t for p, t in zip(prompts, texts)])
            for i, ids, n in zip(b.column("_id").to_pylist(), whole, before):
                packer.add(i, ids, n)
            if len(packer.pieces) > 1000:
                yield out(packer.pieces)
                packer.pieces = []
        packer.finish()
        if packer.pieces:
            yield out(packer.pieces)
    return src.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


_CODERS: dict[tuple[str, int], WordTokens] = {}


def _coder(path: str, end_id: int) -> WordTokens:
    """One tokenizer per Python worker; its remembered words outlive a task."""
    if (path, end_id) not in _CODERS:
        _CODERS[path, end_id] = WordTokens(path, end_id)
    return _CODERS[path, end_id]
