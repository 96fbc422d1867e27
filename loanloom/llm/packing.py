"""Packing documents into token windows: bounded-space online best fit.

Every partition streams its documents past a fixed number of open windows. A piece goes to the open window with
the least room that still takes it. When none does, the fullest window is emitted; if that would leave more than
``max_gap`` of it empty, the head of the piece is cut off to fill it first. At the end of the partition the open
windows are left over; those of ``merge_width`` neighbouring partitions are merged by best fit decreasing, the
emptiest windows being broken up to fill the others. Memory per task is ``open_windows`` windows, and
``merge_width * open_windows`` windows in a merge, whatever the input's size or skew.

Defined cases: a null or empty text is the single end id; a null id column value is carried; repeated rows are
separate documents; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import bisect
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written
from .text import Memo

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())])
_PER_PARTITION = 1 << 31
_MERGED = 1 << 62


class ChunkTokenizer:
    """Ids of whole texts, remembered by chunk between spaces or line ends.

    These two characters separate words for tokenizers that drop white space, so the ids of a text are those of its
    chunks in order. A chunk of Latin letters and then marks is coded from its lower-cased letters and its marks, if
    the tokenizer splits and folds such words so, which is tried on probes; any other chunk goes through the whole
    tokenizer. ``limit`` bounds the memo only: of two generations, the older one is dropped.
    """

    WORD = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u0148\u014a-\u017e]+)([.,;:!?|#*$%&]*)")
    PROBES = ("Abc,", "\u00c9t\u00e9.", "xyz!!", "Q?:;", "\u0160koda|", "thIng", "abc###", "de%%%", "fg&&&.", "h$$$", "ij***!!")

    def __init__(self, path: str, limit: int = 250_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.letters = Memo(lambda c: "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))))
        whole = self._whole(list(self.PROBES))
        try:
            self.direct = [self._word(self.WORD.fullmatch(p)) for p in self.PROBES] == whole
            self.direct &= not any(self.WORD.match(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        except Exception:  # a tokenizer without one of the parts
            self.direct = False

    def _whole(self, chunks: list[str]) -> list[bytes]:
        return [np.array(c.ids, "<u4").tobytes() for c in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _piece(self, piece: str) -> bytes:
        coded = self.pieces.get(piece)
        if coded is None:
            ids = [t.id for t in self.tokenizer.model.tokenize(piece.translate(self.letters))]
            coded = self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return coded

    def _word(self, match: re.Match) -> bytes:
        letters, marks = match.groups()
        return self._piece(letters.lower()) + (self._piece(marks) if marks else b"")

    def _learn(self, chunks: set[str]) -> None:
        other = []
        for chunk in chunks:
            coded = self.older.get(chunk)
            if coded is None:
                match = self.WORD.fullmatch(chunk) if self.direct else None
                if match is None:
                    other.append(chunk)
                    continue
                coded = self._word(match)
            self.known[chunk] = coded
        self.known.update(zip(other, self._whole(other)))

    def encode(self, texts: list[str | None], end: bytes) -> list[bytes]:
        split = [(text or "").replace("\n", " ").split(" ") for text in texts]
        if len(self.known) > self.limit:
            self.older, self.known = self.known, {}
        if len(self.pieces) > self.limit:
            self.pieces = {}
        self._learn(set(chain.from_iterable(split)).difference(self.known))
        get = self.known.__getitem__
        return [b"".join(map(get, parts)) + end for parts in split]


class Windows:
    """The open windows of one task; ``emit`` gets every window that closes."""

    def __init__(self, window: int, count: int | None, max_gap: float, emit):
        self.window, self.count, self.least, self.emit = window, count, int(window * max_gap), emit
        self.rooms: list[tuple[int, int]] = []
        self.held: dict[int, list[tuple]] = {}
        self.made = 0

    def put(self, doc, start: int, ids: bytes, total: int) -> None:
        """``ids``: four bytes each."""
        while ids:
            size = len(ids) // 4
            if size >= self.window:
                head, ids = ids[: 4 * self.window], ids[4 * self.window :]
                self.emit([(doc, start, head, total)])
                start += self.window
                continue
            k = bisect.bisect_left(self.rooms, (size, -1))
            if k < len(self.rooms):
                room, name = self.rooms.pop(k)
                self._add(name, room, (doc, start, ids, total))
                return
            if self.count is None or len(self.rooms) < self.count:
                self.made += 1
                self.held[self.made] = []
                self._add(self.made, self.window, (doc, start, ids, total))
                return
            room, name = self.rooms.pop(0)
            if room > self.least:
                self._add(name, room, (doc, start, ids[: 4 * room], total))
                ids, start = ids[4 * room :], start + room
            else:
                self.emit(self.held.pop(name))

    def _add(self, name: int, room: int, piece: tuple) -> None:
        self.held[name].append(piece)
        room -= len(piece[2]) // 4
        if room:
            bisect.insort(self.rooms, (room, name))
        else:
            self.emit(self.held.pop(name))

    def left(self) -> list[list[tuple]]:
        return [self.held[name] for _, name in self.rooms]


def _placed(pieces: list[tuple], sequence: int, is_open: bool) -> list[tuple]:
    rows, offset = [], 0
    for doc, start, ids, total in pieces:
        rows.append((doc, start, len(ids) // 4, ids, total, sequence, offset, is_open))
        offset += len(ids) // 4
    return rows


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _ARROW)], schema=_ARROW)


def merged(pieces: list[tuple], window: int, max_gap: float) -> list[list[tuple]]:
    """Best fit decreasing; then the emptiest windows fill up the others, so at most one keeps a large gap."""
    out: list[list[tuple]] = []
    bins = Windows(window, None, max_gap, out.append)
    for piece in sorted(pieces, key=lambda p: (-len(p[2]), p[0] is None, p[0] or 0, p[1])):
        bins.put(*piece)
    rest = sorted(bins.left(), key=lambda w: -sum(len(p[2]) for p in w))
    first, last = 0, len(rest) - 1
    room = lambda w: window - sum(len(p[2]) for p in w) // 4
    while first < last:
        free = room(rest[first])
        if free <= bins.least:
            first += 1
            continue
        doc, start, ids, total = rest[last].pop()
        rest[first].append((doc, start, ids[: 4 * free], total))
        if len(ids) > 4 * free:
            rest[last].append((doc, start + free, ids[4 * free :], total))
        if not rest[last]:
            last -= 1
    return out + [w for w in rest if w]


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = 4096, end_id: int = 2, open_windows: int = 64, max_gap: float = 0.01, merge_width: int = 4) -> DataFrame:
    """Pieces of documents placed in sequences of at most ``window`` ids.

    ``ids`` holds unsigned little-endian 32-bit ids; ``start`` counts the document's ids before the piece,
    ``offset`` those before it in its sequence, gapless from 0. Each id lies in exactly one piece.
    """
    end = np.array([end_id], "<u4").tobytes()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ChunkTokenizer(tokenizer_path)
        base, made, rows = TaskContext.get().partitionId() * _PER_PARTITION, 0, []

        def emit(pieces: list[tuple], is_open: bool = False) -> None:
            nonlocal made
            rows.extend(_placed(pieces, base + made, is_open))
            made += 1

        bins = Windows(window, open_windows, max_gap, emit)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(0, len(ids), 512):
                for doc, coded in zip(ids[k : k + 512], coder.encode(texts[k : k + 512], end)):
                    bins.put(doc, 0, coded, len(coded) // 4)
                if rows:
                    yield _arrow(rows)
                    rows = []
        for pieces in bins.left():
            emit(pieces, True)
        if rows:
            yield _arrow(rows)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        base = _MERGED + int(pdf["merge"].iloc[0]) * _PER_PARTITION
        docs_ = [None if pd.isna(d) else int(d) for d in pdf["doc_id"]]
        pieces = list(zip(docs_, pdf["start"], pdf["ids"], pdf["doc_tokens"]))
        rows = [r[:7] for k, w in enumerate(merged(pieces, window, max_gap)) for r in _placed(w, base + k, False)]
        out = pd.DataFrame(rows, columns=[f.strip().split(" ")[0] for f in PIECES.split(",")])
        return out.astype({"doc_id": "Int64"})

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    placed = written(source.mapInArrow(place, PIECES + ", open boolean"))
    closed = placed.filter(~F.col("open")).drop("open")
    left = placed.filter("open").withColumn("merge", F.expr(f"sequence_id div {_PER_PARTITION * merge_width}")).drop("open")
    return closed.unionByName(left.groupBy("merge").applyInPandas(merge, PIECES))
