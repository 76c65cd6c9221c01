"""Sum-of-squares online packing of documents into windows of tokens.

Each document becomes token ids and one end id. Whole windows are cut off its front; the rest is placed into
the fill level that makes the sum, over levels, of squared counts of partially filled windows least
(a new window counts as level 0). Only the counts per level, an array of the window's size, decide, so a
placement takes the same time whatever was packed before.

Every task packs the rows of its partition as they come. At its end, and whenever more than
``max_open`` windows are open, the open windows are closed: the pieces of the emptiest are cut to fill the
fullest. What remains in the end is cut into sequences whose lengths are powers of two, which need no
padding. So no task sees the documents of another, nothing is shuffled, and a task keeps
``max_open`` windows at most.

Ids are those of the ``tokenizers`` library. As this library spends most of its time on words it has seen
before, texts are cut at spaces and newlines where a tokenizer with the byte-level pattern always cuts
too, and each worker process keeps the ids of recent cuts in a table of bounded size.

Defined results: null and empty texts are the end id alone; equal and repeated rows are packed each; an
empty table gives no rows; other columns are ignored. Sequence numbers are unique, not dense.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 1024
END_ID = 0
#: Open windows that a task keeps before it closes them.
MAX_OPEN = 4096
#: Entries of a worker's table of known cuts (about 200 bytes each), and the longest cut kept there.
MAX_KNOWN, MAX_CUT = 800_000, 48
#: Characters encoded together.
TOGETHER = 2_000_000
#: Unknown cuts that one call of the tokenizer takes as one text.
JOINED = 256

PIECES = (
    "doc_id {doc}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint,"
    " offset bigint"
)

_ADJACENT_BLANKS = re.compile(r"\s\s|\0")
_CUTS = re.compile(r"(?<=\S)(?= )")
#: A cut that can stand behind another one of its kind and still is cut off there.
_JOINABLE = re.compile(r" \S+")


def cuts_of(text: str) -> list[str]:
    """The text cut where the tokenizer cuts too: before a space after a non-space, and around newlines.

    Around newlines only where no blanks are side by side, as the tokenizer may take those together.
    """
    if _ADJACENT_BLANKS.search(text):
        return _CUTS.split(text)
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; the same as the tokenizer gives."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self._widths[number] = len(token)

    def _learn(self, cuts: set[str]) -> dict[str, bytes]:
        """Ids of ``cuts``; those that are short become known."""
        joinable = [c for c in cuts if _JOINABLE.fullmatch(c)]
        got: dict[str, bytes] = {}
        groups = [joinable[i : i + JOINED] for i in range(0, len(joinable), JOINED)]
        joined = self._tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)
        for group, found in zip(groups, joined):
            ids = np.array(found.ids, "<u4")
            # a token has as many characters as it stands for bytes, which tells where a cut's tokens end
            ends = np.cumsum(self._widths[ids])
            wanted = np.cumsum([len(c.encode()) for c in group])
            last = np.searchsorted(ends, wanted)
            if len(ends) and last[-1] == len(ends) - 1 and (ends[last] == wanted).all():
                data, stops = ids.tobytes(), (4 * (last + 1)).tolist()
                got.update((c, data[i:j]) for c, i, j in zip(group, [0, *stops], stops))
        alone = [c for c in cuts if c not in got]
        found = self._tokenizer.encode_batch_fast(alone, add_special_tokens=False) if alone else []
        got.update((c, struct.pack(f"<{len(ids := x.ids)}I", *ids)) for c, x in zip(alone, found))
        self._known.update((c, ids) for c, ids in got.items() if len(c) <= MAX_CUT)
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self._known) > MAX_KNOWN:
            # what was met first is met most often
            self._known = dict(islice(self._known.items(), MAX_KNOWN // 2))
        known, missing, found = self._known.get, set(), []
        for text in texts:
            cuts = cuts_of(text)
            ids = list(map(known, cuts))
            lacks = None in ids
            if lacks:
                missing.update([c for c, x in zip(cuts, ids) if x is None])
            found.append((cuts if lacks else None, ids))
        more = self._learn(missing)
        return [
            b"".join(ids if cuts is None else [more[c] if x is None else x for c, x in zip(cuts, ids)])
            for cuts, ids in found
        ]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker process's encoder of a file; it outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Packer:
    """Windows with counts per fill level; ``done`` collects (piece, sequence, offset)."""

    def __init__(self, size: int, first_sequence: int, max_open: int = MAX_OPEN) -> None:
        self.size, self.next, self.max_open = size, first_sequence, max_open
        self.counts = np.zeros(size + 1, np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(size)]  # by fill level
        self.n_open = 0
        self.done: list[tuple] = []

    def add(self, doc: object, ids: bytes) -> None:
        """Cut off whole windows and place the rest. A piece is (doc, total, start, length, ids)."""
        total = len(ids) // 4
        whole = total - total % self.size
        for start in range(0, whole, self.size):
            self._emit([(doc, total, start, self.size, ids[4 * start : 4 * (start + self.size)])])
        if total > whole:
            self._place((doc, total, whole, total - whole, ids[4 * whole :]))

    def _place(self, piece: tuple) -> None:
        length = piece[3]
        # change of the sum of squares if the piece goes to level h; a full window counts nothing
        to = 2 * self.counts[length:] + 1
        to[-1] = 0
        change = to - 2 * self.counts[: len(to)] + 1
        change[self.counts[: len(to)] == 0] = np.iinfo(np.int64).max
        change[0] = to[0]
        level = int(change.argmin())
        window = []
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        window.append(piece)
        fill = level + length
        if fill == self.size:
            self._emit(window)
        else:
            self.open[fill].append(window)
            self.counts[fill] += 1
            self.n_open += 1
            if self.n_open > self.max_open:
                self.close(False)

    def _emit(self, window: list[tuple]) -> None:
        offset = 0
        for piece in window:
            self.done.append((piece, self.next, offset))
            offset += piece[3]
        self.next += 1

    def close(self, last: bool) -> None:
        """Fill the fullest open windows with cut pieces of the emptiest; at last, end the remaining one."""
        windows = [(fill, w) for fill in range(self.size - 1, 0, -1) for w in self.open[fill]]
        self.open = [[] for _ in range(self.size)]
        self.counts[:] = 0
        self.n_open = 0
        front, back = 0, len(windows) - 1
        loose: list[tuple] = []  # pieces of a window taken apart
        while front <= back:
            fill, window = windows[front]
            front += 1
            while fill < self.size:
                if not loose:
                    if front > back:
                        break
                    loose = windows[back][1]
                    back -= 1
                doc, total, start, length, ids = loose.pop()
                take = min(length, self.size - fill)
                window.append((doc, total, start, take, ids[: 4 * take]))
                fill += take
                if take < length:
                    loose.append((doc, total, start + take, length - take, ids[4 * take :]))
            if fill == self.size:
                self._emit(window)
            else:
                loose = window
        if loose and last:
            self._end(loose)
        elif loose:
            fill = sum(p[3] for p in loose)
            self.open[fill].append(loose)
            self.counts[fill] += 1
            self.n_open += 1

    def _end(self, pieces: list[tuple]) -> None:
        """Sequences of the remaining pieces, each as long as a power of two."""
        left = sum(p[3] for p in pieces)
        pieces = pieces[::-1]
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            window = []
            while room:
                doc, total, start, length, ids = pieces.pop()
                take = min(length, room)
                window.append((doc, total, start, take, ids[: 4 * take]))
                room -= take
                if take < length:
                    pieces.append((doc, total, start + take, length - take, ids[4 * take :]))
            self._emit(window)


def packed(docs: DataFrame, tokenizer: str, size: int = WINDOW, max_open: int = MAX_OPEN) -> DataFrame:
    """One row per piece: the columns of ``PIECES``.

    ``tokenizer`` is the path of a byte-level BPE file for ``tokenizers`` that all executors can
    read; ``size`` a power of two.
    """
    if size & (size - 1):
        raise ValueError("the window's size must be a power of two")
    kind = docs.schema["doc_id"].dataType
    names = [part.split()[0] for part in PIECES.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(size, TaskContext.get().partitionId() << 33, max_open)
        encode = encoder(tokenizer).encode
        end = np.array([END_ID], "<u4").tobytes()
        doc_type = None

        def rows() -> pa.RecordBatch:
            done, packer.done = packer.done, []
            columns = [
                pa.array([p[0] for p, _, _ in done], doc_type),
                *(
                    pa.array(values, pa.int64())
                    for values in (
                        [p[2] for p, _, _ in done],
                        [p[3] for p, _, _ in done],
                        [zlib.crc32(p[4]) for p, _, _ in done],
                        [p[1] for p, _, _ in done],
                        [s for _, s, _ in done],
                        [o for _, _, o in done],
                    )
                ),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for docs_, texts in _portions(batch):
                for doc, ids in zip(docs_, encode(texts)):
                    packer.add(doc, ids + end)
                yield rows()
        if doc_type is not None:
            packer.close(True)
            yield rows()

    return docs.select("doc_id", "text").mapInArrow(pack, PIECES.format(doc=kind.simpleString()))


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a batch, so many together that their texts have about ``TOGETHER`` characters."""
    docs, texts, chars = [], [], 0
    for doc, text in zip(batch["doc_id"], batch["text"]):
        text = text.as_py() or ""
        docs.append(doc.as_py())
        texts.append(text)
        chars += len(text)
        if chars > TOGETHER:
            yield docs, texts
            docs, texts, chars = [], [], 0
    if texts:
        yield docs, texts
