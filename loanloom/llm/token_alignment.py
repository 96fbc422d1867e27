"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often over the corpus.

A document is coded by both tokenizers; byte offsets at which a token of each side ends cut it into groups, and two
tokens with overlapping byte ranges are linked. A pair's count is the number of documents that hold it linked.

Tasks code documents and collect (pair, document) records. A *run* is some two million links: sorted side-major, that
is by A id, then B id, then document, and radix-partitioned by the A id into ``BUCKETS`` slices of zstd frames. Runs
are written once to the shared folder. A bucket's slices are counted by heap merges of some ``fan_in`` runs at a
time, level by level, so neither a frequent pair nor the number of runs makes a task large: a run brings each of its
pairs once, however many of its documents hold it. The last merge sees all pairs of an A id next to each other and
finds its highest count. Then each bucket's counts, at most the vocabularies' product over ``BUCKETS`` pairs, meet
groups of slices again; what every document gains from them goes back to the document's run and is summed there.

Defined cases: null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens:
zeros and an empty groups text. Very long texts are coded in stretches. Null and repeated ids and repeated rows are
documents of their own; other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written

#: Radix of the A id, and pairs of a frame.
BUCKETS, FRAME = 128, 8192
#: Bits of a document's number in its run.
DOC_BITS = 20
#: Characters coded together.
STRETCH = 1 << 21
#: Numbers of runs set aside for each task.
_RUNS_PER_TASK = 1 << 24
#: A blank or line end between signs: no token of either side reaches over it.
_SEAM = re.compile(r"(?<=\S)(?=[ \n]\S)")
_ENCODED = "run long, idx int, id long, n_a long, n_b long, n_groups long, n_links long, groups string, bucket int, pairs array<binary>, docs binary"
_ARROW = pa.schema([("run", pa.int64()), ("idx", pa.int32()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("bucket", pa.int32()), ("pairs", pa.list_(pa.binary())), ("docs", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def squeezed(*arrays: np.ndarray) -> bytes:
    """Non-negative integer arrays of one length, by byte planes, as a zstd frame."""
    widths = [max(1, -(-int(a.max(initial=0)).bit_length() // 8)) for a in arrays]
    planes = [a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for a, w in zip(arrays, widths)]
    return zstandard.compress(b"".join(planes) + bytes(widths), 3)


def spread(frame: bytes, count: int) -> list[np.ndarray]:
    """The ``count`` arrays of ``squeezed``, as 64-bit integers."""
    raw = zstandard.decompress(frame)
    widths, body = raw[-count:], np.frombuffer(raw, np.uint8, len(raw) - count)
    size, at, out = len(body) // sum(widths), 0, []
    for w in widths:
        wide = np.zeros((size, 8), np.uint8)
        wide[:, :w] = body[at : at + w * size].reshape(w, size).T
        out.append(wide.view("<i8").reshape(-1))
        at += w * size
    return out


def framed(pairs: np.ndarray, *values: np.ndarray) -> list[bytes]:
    """Ascending pairs and their values as frames; differences from each frame's first pair on."""
    cut = range(0, len(pairs), FRAME)
    return [squeezed(np.diff(pairs[k : k + FRAME], prepend=0), *(v[k : k + FRAME] for v in values)) for k in cut]


def opened(frames: list[bytes], count: int = 1) -> Iterator[list[np.ndarray]]:
    for frame in frames:
        pairs, *values = spread(frame, 1 + count)
        yield [np.cumsum(pairs), *values]


def heap_merged(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sums of the counts of equal pairs over sorted runs, ascending; one open frame a run.

    The heap holds every run by its least pair. All pairs up to the least end of an open frame are at hand, so these are
    taken off together."""
    feeds = [opened(r) for r in runs]
    heads: dict[int, list[np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def push(k: int, head: list[np.ndarray] | None) -> None:
        head = next(feeds[k], None) if head is None or not len(head[0]) else head
        if head is None:
            heads.pop(k, None)
        else:
            heads[k] = head
            heapq.heappush(heap, (int(head[0][0]), k))

    for k in range(len(runs)):
        push(k, None)
    while heap:
        bound, taken = min(int(h[0][-1]) for h in heads.values()), []
        while heap and heap[0][0] <= bound:
            _, k = heapq.heappop(heap)
            pairs, counts = heads[k]
            end = int(np.searchsorted(pairs, bound, "right"))
            taken.append((pairs[:end], counts[:end]))
            push(k, [pairs[end:], counts[end:]])
        pairs, counts = (np.concatenate(x) for x in zip(*taken))
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], counts[order]
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        yield pairs[first], np.add.reduceat(counts, first)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Side:
    """A tokenizer: ``code(chunk)`` gives ids, ``raw[id]`` a token's bytes."""

    raw: list[bytes]

    def code(self, chunk: str) -> list[int]:
        raise NotImplementedError


class ByteLevel(Side):
    """A byte-level BPE file. Ids in the order of merges can be coded by ranks, which is four times as fast."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        added = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        vocabulary, letters = self.whole.get_vocab(with_added_tokens=True), byte_letters()
        self.raw = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.raw[i] = token.encode() if token in added else bytes(letters[c] for c in token)
        with open(path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        self.ranks = None
        if made == sorted(made):
            ranks = {self.raw[i]: i for t, i in vocabulary.items() if t not in added}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def code(self, chunk: str) -> list[int]:
        if self.ranks is not None and len(chunk) < 1 << 16:
            return self.ranks.encode_ordinary(chunk)
        return self.whole.encode(chunk, add_special_tokens=False).ids


class Pieces(Side):
    """A piece model that puts a blank before a text. Chunks can be coded one by one if no piece holds a blank or line
    end after another sign; ``seams`` says whether that is so."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.raw = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.seams = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.blank = m.piece_to_id("▁")

    def code(self, chunk: str) -> list[int]:
        if chunk.startswith(" "):
            return self.model.encode(chunk[1:], num_threads=1)
        ids = self.model.encode(chunk, num_threads=1)  # only after a seam: a line end
        return ids[1:] if ids[:1] == [self.blank] else [0]


class Aligner:
    """Coded and aligned chunks between seams, remembered in arrays; ``limit`` bounds the memory, not the results."""

    def __init__(self, a: ByteLevel, b: Pieces, limit: int = 250_000, stretch: int = STRETCH):
        self.a, self.b, self.limit, self.stretch = a, b, limit, stretch
        self.a_len, self.b_len = (np.fromiter(map(len, s.raw), np.int64, len(s.raw)) for s in (a, b))
        # ids, as text, before another of their side, before the other side, and before another group
        self.texts = [f"{i}{end}" for s, ends in ((a, ",|"), (b, ",;")) for end in ends for i in range(len(s.raw))]
        self.forget()

    @property
    def most(self) -> int:
        """Places of the A ids of one bucket."""
        return -(-len(self.a.raw) // BUCKETS)

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, 4), np.int64)
        self.places, self.links, self.bad, self.odd = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), set()

    def split(self, text: str) -> list[str]:
        """Chunks of a text with a blank before it, each with its first blank or line end, were all blanks single."""
        return (" " + text).replace("\n", " \n").split(" ")[1:]

    def learn(self, chunks: list[str]) -> None:
        """Codes chunks that begin with a blank or line end."""
        a, b = [self.a.code(c) for c in chunks], [self.b.code(c) for c in chunks]
        good = np.array([b"".join(map(self.a.raw.__getitem__, x)) == b"".join(map(self.b.raw.__getitem__, y)) == c.encode() for c, x, y in zip(chunks, a, b)], bool)
        a, b = ([x if ok else [] for x, ok in zip(s, good)] for s in (a, b))
        n_a, n_b = (np.fromiter(map(len, s), np.int64, len(s)) for s in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(s), np.int64) for s in (a, b))
        len_a, len_b = self.a_len[ids_a], self.b_len[ids_b]
        end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
        cut_a, cut_b = np.isin(end_a, end_b), np.isin(end_b, end_a)
        first, last = np.searchsorted(end_b, end_a - len_a, "right"), np.searchsorted(end_b - len_b, end_a, "left")
        reach = last - first
        b_at = np.repeat(first - np.cumsum(reach) + reach, reach) + np.arange(int(reach.sum()))
        home = ids_a % BUCKETS * self.most + ids_a // BUCKETS
        links = np.repeat(home, reach) * len(self.b.raw) + ids_b[b_at]
        # tokens in the order of the groups, A before B
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        sizes = len(self.a.raw), len(self.b.raw)
        names = np.concatenate((ids_a + cut_a * sizes[0], 2 * sizes[0] + ids_b + cut_b * sizes[1]))
        names = names[np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")]
        parts, ends = list(map(self.texts.__getitem__, names.tolist())), np.cumsum(n_a + n_b).tolist()
        of_a = np.repeat(np.arange(len(chunks)), n_a)
        n_groups, n_links = np.bincount(of_a, cut_a, len(chunks)).astype(np.int64), np.bincount(of_a, reach, len(chunks)).astype(np.int64)
        self.groups += ["".join(parts[s:e])[:-1] for s, e in zip([0, *ends], ends)]
        self.counts = np.concatenate((self.counts, np.stack((n_a, n_b, n_groups, n_links), 1)))
        self.places = np.concatenate((self.places, self.places[-1] + np.cumsum(n_links)))
        self.links, self.bad = np.concatenate((self.links, links)), np.concatenate((self.bad, ~good))

    def ready(self, lists: list[list[str]], plain: bool) -> None:
        """Learns what is new; ``plain`` chunks come without their blank."""
        new = list(set(chain.from_iterable(lists)).difference(self.known))
        if plain:  # chunks with a blank or line end at their ends are no chunks between seams
            self.odd.update(c for c in new if not c or c != c.strip() and (c[0] != "\n" or c[1:] != c[1:].strip() or len(c) == 1))
            new = [c for c in new if c not in self.odd]
        at = len(self.groups)
        self.learn([" " + c if plain and c[0] != "\n" else c for c in new])
        self.known.update(zip(new, range(at, at + len(new))))

    def stretches(self, text: str) -> Iterator[str]:
        """The text with a blank before it, cut at seams into stretches of some ``stretch`` characters."""
        text, start = " " + text, 0
        while len(text) - start > 2 * self.stretch:
            seam = _SEAM.search(text, start + self.stretch)
            if seam is None:
                break
            yield text[start : seam.start()]
            start = seam.start()
        yield text[start:]

    def align(self, texts: list[str]) -> Iterator[list[np.ndarray]]:
        """For every text the numbers of its chunks, in arrays one after the other; the arrays' numbers hold till the next
        one is asked for."""
        if len(self.known) + len(self.odd) > self.limit:
            self.forget()
        short = [self.split(t) if len(t) <= self.stretch and self.b.seams else [] for t in texts]
        self.ready(short, True)
        for text, chunks in zip(texts, short):
            if chunks and self.odd.isdisjoint(chunks):
                yield iter((np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks)),))
            else:
                yield self._slowly(text)

    def _slowly(self, text: str) -> Iterator[np.ndarray]:
        """Seams found one by one; these chunks are coded for this text alone and forgotten after it."""
        for stretch in self.stretches(text) if self.b.seams else [" " + text]:
            chunks = _SEAM.split(stretch) if self.b.seams else [stretch]
            held = self.known, self.groups, self.counts, self.places, self.links, self.bad
            self.known, self.groups = {}, []
            self.counts, self.places, self.links, self.bad = np.zeros((0, 4), np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
            self.ready([chunks], False)
            yield np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
            self.known, self.groups, self.counts, self.places, self.links, self.bad = held


class Runs:
    """The records of a task, as runs; ``rows`` holds what is ready to go."""

    def __init__(self, aligner: Aligner, base: int, digest: bool, links: int):
        self.aligner, self.run, self.digest, self.links = aligner, base, digest, links
        self.rows: list[tuple] = []
        self._begin()

    def _begin(self) -> None:
        self.docs, self.size = 0, 0
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, name, arrays: Iterator[np.ndarray]) -> None:
        al, total, own, texts, size, bad = self.aligner, np.zeros(4, np.int64), [], [], 0, False
        digest = hashlib.sha256()
        for k, at in enumerate(arrays):
            if bad := bad or bool(al.bad[at].any()):
                continue
            counts = al.counts[at]
            total += counts.sum(0)
            groups = ";".join(map(al.groups.__getitem__, at.tolist()))
            digest.update((";" + groups if k else groups).encode())
            if not self.digest:
                texts.append(groups)
            n = counts[:, 3]
            take = np.repeat(al.places[at] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            own.append((al.links[take], np.ones(len(take), np.int64)))
            size += len(take)
            if size > self.links and len(own) > 1:
                own = [_summed(own)]
                size = len(own[0][0])
        if bad:
            total[:], own, texts, size = 0, [], [], 0
        groups = ("" if not total[0] else digest.hexdigest()) if self.digest else ";".join(texts)
        self.held += [(pairs << DOC_BITS | self.docs, times) for pairs, times in own]
        self.size += size
        self.rows.append((self.run, self.docs, name, *total.tolist(), groups, None, None, None))
        self.docs += 1
        if self.size > self.links or self.docs == 1 << DOC_BITS:
            self.close()

    def close(self) -> None:
        """Writes the run's slices."""
        if self.held:
            keys, times = _summed(self.held)
            pairs, docs = keys >> DOC_BITS, keys & (1 << DOC_BITS) - 1
            width = self.aligner.most * len(self.aligner.b.raw)
            ends = np.searchsorted(pairs, np.arange(BUCKETS + 1) * width)
            for bucket, (s, e) in enumerate(zip(ends, ends[1:])):
                if s < e:
                    own = pairs[s:e] - bucket * width
                    first = np.flatnonzero(np.diff(own, prepend=-1))
                    gaps = np.diff(docs[s:e], prepend=0)
                    gaps[first] = docs[s:e][first]
                    self.rows.append((self.run, None, None, None, None, None, None, None, bucket, framed(own[first], np.diff(first, append=e - s)), squeezed(gaps, times[s:e])))
        self.run += 1
        self._begin()


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys of parts brought together."""
    keys = np.concatenate([k for k, _ in parts])
    if all((t == 1).all() for _, t in parts):
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first], np.diff(first, append=len(keys))
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], np.concatenate([t for _, t in parts])[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times, first)


def _portions(batch: pa.RecordBatch, most: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of neighbouring rows, some ``most`` characters at a time."""
    names, texts, size = [], [], 0
    for k in range(batch.num_rows):
        names.append(batch.column(0)[k].as_py())
        texts.append(batch.column(1)[k].as_py() or "")
        size += len(texts[-1])
        if size > most or k == batch.num_rows - 1:
            yield names, texts
            names, texts, size = [], [], 0


def encode(docs: DataFrame, a_path: str, b_path: str, *, id_col: str, text_col: str, digest: bool, run_links: int, stretch: int) -> DataFrame:
    """Rows of documents (``bucket`` null) and of slices of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ByteLevel(a_path), Pieces(b_path), stretch=stretch)
        runs = Runs(aligner, TaskContext.get().partitionId() * _RUNS_PER_TASK, digest, run_links)
        for batch in batches:
            for names, texts in _portions(batch, stretch):
                for name, text, arrays in zip(names, texts, aligner.align(texts)):
                    runs.add(name, arrays if text else iter(()))
                if runs.rows:
                    yield _batch(runs.rows, _ARROW)
                    runs.rows = []
        runs.close()
        if runs.rows:
            yield _batch(runs.rows, _ARROW)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _ENCODED)


def _grouped(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Neighbouring rows with equal keys, read as they come."""
    rows = (r for b in batches for k in range(0, b.num_rows, 64) for r in b.slice(k, 64).to_pylist())
    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def count(slices: DataFrame, runs: int, b_size: int, fan_in: int) -> DataFrame:
    """(bucket, pairs): all pairs of a bucket with their counts, and whether these are their A id's highest.

    ``slices``: (bucket, run, pairs) with ``run`` from 0 to below ``runs``."""
    schema = pa.schema([("bucket", pa.int32()), ("run", pa.int64()), ("pairs", pa.list_(pa.binary()))])

    def merge(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (bucket, to), rows in _grouped(batches, "bucket", "to"):
                parts = list(heap_merged([r["pairs"] for r in rows]))
                pairs, counts = (np.concatenate(x) for x in zip(*parts))
                values = [counts]
                if last:
                    first = np.flatnonzero(np.diff(pairs // b_size, prepend=-1))
                    highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(pairs)))
                    values.append((counts == highest).astype(np.int64))
                yield _batch([(bucket, to, framed(pairs, *values))], schema)

        return run

    while True:
        last = runs <= fan_in
        dealt = slices.withColumn("to", F.floor(F.col("run") / fan_in)).repartition("bucket", "to").sortWithinPartitions("bucket", "to", "run")
        slices = dealt.select("bucket", "to", "pairs").mapInArrow(merge(last), "bucket int, run long, pairs array<binary>")
        if last:
            return slices.drop("run")
        runs = -(-runs // fan_in)


def contribute(slices: DataFrame, counts: DataFrame, teams: int) -> DataFrame:
    """(run, idx, n_best, count_sum): what every document gets from all its links. ``teams``: into how many parts the runs
    are dealt, each of which meets its own copy of a bucket's counts."""
    given = pa.schema([("run", pa.int64()), ("size", pa.int32()), ("sums", pa.binary())])
    taken = pa.schema([("run", pa.int64()), ("idx", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, "bucket", "team"):
            known = None
            for r in rows:
                if known is None:
                    known = [np.concatenate(x) for x in zip(*opened(r["pairs"], 2))]
                    continue
                pairs, holders = (np.concatenate(x) for x in zip(*opened(r["pairs"])))
                gaps, times = spread(r["docs"], 2)
                ends = np.cumsum(holders)
                docs = np.cumsum(gaps)
                docs -= np.repeat(docs[ends - holders] - gaps[ends - holders], holders)
                at = np.searchsorted(known[0], pairs)
                n, best = np.repeat(known[1][at], holders) * times, np.repeat(known[2][at], holders) * times
                # halves of 26 bits: sums of 64-bit floats stay exact
                low, high = (np.bincount(docs, x).astype(np.int64) for x in (n & (1 << 26) - 1, n >> 26))
                yield _batch([(r["run"], len(low), squeezed(np.bincount(docs, best).astype(np.int64), low + (high << 26)))], given)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (run,), rows in _grouped(batches, "run"):
            best = total = np.zeros(0, np.int64)
            for r in rows:
                one, two = spread(r["sums"], 2)
                if len(one) > len(best):
                    best, total = (np.concatenate((x, np.zeros(len(one) - len(x), np.int64))) for x in (best, total))
                best[: len(one)] += one
                total[: len(two)] += two
            n = len(best)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, run)), pa.array(np.arange(n, dtype=np.int32)), pa.array(best), pa.array(total)], schema=taken)

    copies = counts.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(teams - 1).cast("long"))).alias("team"), F.lit(-1).cast("long").alias("run"), "pairs", F.lit(None).cast("binary").alias("docs"))
    own = slices.select("bucket", F.pmod(F.xxhash64("run"), F.lit(teams)).cast("long").alias("team"), "run", "pairs", "docs")
    met = copies.unionByName(own).repartition("bucket", "team").sortWithinPartitions("bucket", "team", "run")
    sums = met.mapInArrow(give, "run long, size int, sums binary")
    return sums.repartition("run").sortWithinPartitions("run").mapInArrow(take, "run long, idx int, n_best long, count_sum long")


def align(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, run_links: int = 2_000_000, fan_in: int = 256, stretch: int = STRETCH) -> DataFrame:
    """Per document ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups``, for instance
    ``a1,a2|b1;a3|b2,b3``. ``digest``: ``groups`` is the SHA-256 of that text (empty without tokens), made where the text
    is, since it is some four times as long as the documents. ``run_links``, ``fan_in`` and ``stretch`` bound memory: links of a
    run, runs of a merge, characters coded together; results do not depend on them."""
    encoded = written(encode(docs, a_path, b_path, id_col=id_col, text_col=text_col, digest=digest, run_links=run_links, stretch=stretch))
    slices = encoded.filter("bucket IS NOT NULL").select("bucket", "run", "pairs", "docs")
    held = encoded.filter("bucket IS NOT NULL").agg(F.approx_count_distinct("run", 0.02)).first()[0]
    dealt = F.pmod(F.xxhash64("run"), F.lit(max(1, held)))
    counts = written(count(slices.select("bucket", dealt.alias("run"), "pairs"), held, len(Pieces(b_path).raw), fan_in))
    gained = contribute(slices, counts, max(1, -(-held // fan_in)))
    rows = encoded.filter("bucket IS NULL").join(gained, ["run", "idx"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups")

