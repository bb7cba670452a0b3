"""SentencePiece BPE by a table of distinct marked words.

In a vocabulary whose pieces have white-space markers only at their beginning, no merge can cross
from a word into the marker after it. A text is then a row of chunks (a run of markers and the
word after it) that are segmented independently, so each distinct chunk is segmented once and
its ids are put back by position.

The table has two levels. Spark counts the distinct chunks of the whole corpus (combined in the
tasks before the shuffle), and those used most, at most ``TABLE`` of them and none longer than
``LONG`` bytes, are segmented once and sent to every task. What is not among them is segmented
once for each megabyte of text it stands in, which is cheaper than a join that carries every
word of the corpus. The table's size bounds only what is sent: results do not depend on it.

Memory of a task is some hundred bytes for each byte of the longest text, or of ``PIECE``; a
chunk (a text without white space) may be as long as its text.

Defined cases: a null text is encoded as an empty one (no ids, both digests of the empty
string); a written marker U+2581 counts as a blank, as with the library; repeated rows each give
a row; only the named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.words import pieces, span_hashes
from provlake.session import cut

#: Bytes of text encoded at once.
PIECE = 1 << 20
#: Rows of the corpus-wide table, and the longest chunk in it, in bytes.
TABLE, LONG = 200_000, 64
#: Runs of symbols above this length are merged by a heap, each by itself.
RUN = 200
_NONE = np.int64(1 << 30)
_MARK, _BLANK = "▁", 0x20
#: Fixed values of the model file's format: kinds of pieces, and the kind of model.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BPE = 2


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of every field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = number() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            at += size
            yield key >> 3, raw[at - size:at]


class Chunks(NamedTuple):
    """Texts of a batch with a leading blank each, markers as blanks; chunks in order, and the first chunk of every text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text_at: np.ndarray


def chunks_of(data: np.ndarray, offsets: np.ndarray) -> Chunks:
    size = np.diff(offsets)
    full = np.flatnonzero(size > 0)
    data = np.insert(data, offsets[full], _BLANK)
    begin = offsets[full] + np.arange(len(full))
    mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else np.zeros(0, np.int64)
    if len(mark):
        data[mark] = _BLANK
        begin = begin - 2 * np.searchsorted(mark, begin)
        data = np.delete(data, np.concatenate([mark + 1, mark + 2]))
    first = data == _BLANK
    first[1:] &= data[:-1] != _BLANK
    first[begin] = True
    start = np.flatnonzero(first)
    end = np.append(start[1:], len(data))[:len(start)]
    text_at = np.zeros(len(offsets), np.int64)
    text_at[-1] = len(start)
    text_at[full] = np.searchsorted(start, begin)
    for_empty = np.flatnonzero(size == 0)
    nearest = np.searchsorted(full, for_empty)
    text_at[for_empty] = np.append(text_at[full], len(start))[nearest]
    return Chunks(data, start, end, span_hashes(data, start, end) if len(start) else np.zeros(0, np.uint64), text_at)


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of all members of spans, one span after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Model:
    """Pieces and merges of a BPE model file."""

    def __init__(self, raw: bytes):
        self.piece, score, self.kind = [], [], []
        rules, trainer = {}, {}
        for number, value in _fields(raw):
            if number == 1:
                one = dict(_fields(value))
                self.piece.append(one[1].decode())
                score.append(np.frombuffer(one.get(2, bytes(4)), np.float32)[0])
                self.kind.append(one.get(3, _NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                rules = dict(_fields(value))
        plain = [i for i, kind in enumerate(self.kind) if kind == _NORMAL]
        own = {self.piece[i]: i for i in plain}
        byte = {int(self.piece[i][3:5], 16): i for i, kind in enumerate(self.kind) if kind == _BYTE}
        if trainer.get(3, 1) != _BPE or rules.get(2) or not rules.get(3, 1) or rules.get(4, 1) or not rules.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only BPE models with a leading marker and unchanged text are supported")
        if set(self.kind) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or len(byte) != 256 or _MARK not in own:
            raise ValueError("only models of normal pieces with all 256 byte pieces are supported")
        if any(_MARK in text.lstrip(_MARK) or any(c not in own for c in text) for text in own):
            raise ValueError("pieces must not cross markers, and their characters must be pieces")
        self.byte_ids = np.array([byte[b] for b in range(256)], np.int64)
        self.symbol = np.full(0x110000, -1, np.int32)
        for text, i in own.items():
            if len(text) == 1:
                self.symbol[ord(text)] = i
        self.symbol[_BLANK] = own[_MARK]
        rank = np.unique(-np.array(score), return_inverse=True)[1]
        merges = {(own[text[:i]] << 20) | own[text[i:]]: own[text] for text in own for i in range(1, len(text)) if text[:i] in own and text[i:] in own}
        self.pair = np.array(sorted(merges), np.int64)
        self.merged = np.array([merges[int(k)] for k in self.pair], np.int64)
        self.rank = rank[self.merged].astype(np.int64)
        beside = {(own[a] << 20) | own[b] for text in own for a, b in zip(text, text[1:], strict=False)}
        self.beside = np.array(sorted(beside), np.int64)
        said = [b"" if kind == _CONTROL else " ⁇ ".encode() if kind == _UNKNOWN else bytes([int(text[3:5], 16)]) if kind == _BYTE
                else text.replace(_MARK, " ").encode() for text, kind in zip(self.piece, self.kind, strict=True)]
        self.said_size = np.array([len(x) for x in said], np.int64)
        self.said_at = np.cumsum(self.said_size) - self.said_size
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self.digits = [str(i) for i in range(len(self.piece))]

    @staticmethod
    def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def _pairs(self, a: np.ndarray, b: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Place of each pair of neighbours among the merges by rank and pair, or _NONE."""
        at, found = self._at(self.pair, (a << 20) | b)
        return np.where(found & real & (a >= 0) & (b >= 0), at, _NONE)

    def _heap(self, ids: list[int]) -> list[int]:
        """Symbols left after all merges of one long run; -1 stands for a symbol that was merged away."""
        n, gone = len(ids), -2
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and ids[i] >= 0 and ids[j] >= 0:
                key = (ids[i] << 20) | ids[j]
                at = int(np.searchsorted(self.pair, key))
                if at < len(self.pair) and self.pair[at] == key:
                    heapq.heappush(waiting, (int(self.rank[at]), i, ids[i], ids[j], at))

        for i in range(n - 1):
            offer(i, i + 1)
        while waiting:
            _, i, a, b, at = heapq.heappop(waiting)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[at]), gone
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return ids

    def segment(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks written one after the other, and how many each has.

        Neighbours that stand side by side in no piece are certain cuts. Between cuts every run
        merges its best pair, the leftmost of equal ones, until it has none; runs that are done
        leave the round.
        """
        if not len(size):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        byte_at = np.cumsum(width) - width
        chunk_at = np.searchsorted(byte_at, np.cumsum(size) - size)
        ids = self.symbol[points].astype(np.int64)
        edge = np.zeros(len(ids), bool)
        edge[chunk_at] = True
        edge[1:] |= ~self._at(self.beside, (ids[:-1] << 20) | ids[1:])[1]
        final = ids.copy()
        bounds = np.append(np.flatnonzero(edge), len(ids))
        long = np.flatnonzero(np.diff(bounds) > RUN)
        rest = np.ones(len(ids), bool)
        for i in long:
            lo, hi = bounds[i], bounds[i + 1]
            final[lo:hi] = self._heap(ids[lo:hi].tolist())
            rest[lo:hi] = False
        self._rounds(np.flatnonzero(rest), ids[rest], edge[rest], final)
        keep = final > -2
        count = np.where(final == -1, width, 1) * keep
        chunk_ids = np.add.reduceat(count, chunk_at)
        at = np.repeat(np.flatnonzero(keep), count[keep])
        within = np.arange(len(at)) - np.repeat(np.cumsum(count[keep]) - count[keep], count[keep])
        unknown = final[at] == -1
        return np.where(unknown, self.byte_ids[data[np.minimum(byte_at[at] + within * unknown, len(data) - 1)]], final[at]), chunk_ids

    def _rounds(self, at: np.ndarray, ids: np.ndarray, edge: np.ndarray, final: np.ndarray) -> None:
        """Merges all runs side by side; ``final`` gets the symbols left, -2 where one was merged away."""
        pair = np.full(len(at), _NONE)
        if len(at):
            pair[:-1] = self._pairs(ids[:-1], ids[1:], ~edge[1:])
        while len(at):
            first = np.flatnonzero(edge)
            rank = np.where(pair < _NONE, self.rank[np.minimum(pair, len(self.rank) - 1)], _NONE)
            best = np.minimum.reduceat((rank << 32) | np.arange(len(at)), first)
            go = best < (_NONE << 32)
            merge = best[go] & 0xFFFFFFFF
            if len(merge) < len(first):
                stay = np.repeat(go, np.diff(np.append(first, len(at))))
                moved = np.cumsum(stay) - 1
                at, ids, edge, pair, merge = at[stay], ids[stay], edge[stay], pair[stay], moved[merge]
                if not len(at):
                    break
            ids[merge] = self.merged[pair[merge]]
            final[at[merge]] = ids[merge]
            final[at[merge + 1]] = -2
            keep = np.ones(len(at), bool)
            keep[merge + 1] = False
            moved = np.cumsum(keep) - 1
            at, ids, edge, pair, merge = at[keep], ids[keep], edge[keep], pair[keep], moved[merge]
            for left in (merge, merge[~edge[merge]] - 1):
                right = np.minimum(left + 1, len(at) - 1)
                pair[left] = self._pairs(ids[left], ids[right], ~edge[right] & (right > left))

    def encode_all(self, found: Chunks, table: Table | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts one after the other, and where each text's ids begin and end."""
        size = found.end - found.start
        _, one, same = np.unique(found.hash, return_index=True, return_inverse=True)
        other = np.flatnonzero(~_equal(found.data, found.start, size, found.data, found.start[one][same], size[one][same]))
        if len(other):  # equal hashes of different chunks: each of those stands for itself
            same[other] = len(one) + np.arange(len(other))
            one = np.concatenate([one, other])
        begin, count = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
        known = np.zeros(len(one), bool)
        flat = np.zeros(0, np.int64)
        if table is not None and len(table.hash):
            row, hit = self._at(table.hash, found.hash[one])
            known[hit] = _equal(found.data, found.start[one[hit]], size[one[hit]], table.data, table.start[row[hit]], table.size[row[hit]])
            begin[known], count[known], flat = table.ids_at[row[known]], table.n_ids[row[known]], table.ids
        new = one[~known]
        ids, n = self.segment(found.data[_spans(found.start[new], size[new])], size[new])
        begin[~known], count[~known] = len(flat) + np.cumsum(n) - n, n
        flat = np.concatenate([flat, ids])
        ids = flat[_spans(begin[same], count[same])]
        return ids, np.concatenate([[0], np.cumsum(count[same])])[found.text_at]

    def decode_all(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the pieces one after the other, markers as blanks."""
        return self.said[_spans(self.said_at[ids], self.said_size[ids])]

    def encode(self, text: str) -> list[int]:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.encode_all(chunks_of(raw, np.array([0, len(raw)])))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: runs of byte pieces are read as UTF-8, each wrong byte as U+FFFD."""
        out, run, first = [], bytearray(), True
        for i in [*ids, None]:
            if i is not None and self.kind[i] == _BYTE:
                run.append(int(self.piece[i][3:5], 16))
                continue
            if run:
                out.append(_valid(bytes(run)))
                run, first = bytearray(), False
            if i is None or self.kind[i] == _CONTROL:
                continue
            text = self.said[self.said_at[i]:self.said_at[i] + self.said_size[i]].tobytes().decode()
            out.append(text[1:] if first and self.piece[i].startswith(_MARK) else text)
            first = False
        return "".join(out)


def _valid(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as wrong:
            out += [raw[at:at + wrong.start].decode(), "�"]
            at += wrong.start + 1
    return "".join(out)


def _equal(a: np.ndarray, a_at: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Whether spans hold the same bytes."""
    out = a_size == b_size
    some = np.flatnonzero(out)
    if len(some):
        size = a_size[some]
        differs = a[_spans(a_at[some], size)] != b[_spans(b_at[some], size)]
        if differs.any():
            out[some] = np.add.reduceat(differs, np.cumsum(size) - size) == 0
    return out


class Table(NamedTuple):
    """Segmented chunks, sorted by hash."""

    hash: np.ndarray
    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    ids: np.ndarray
    ids_at: np.ndarray
    n_ids: np.ndarray


_loaded: dict[str, Model] = {}


def model(raw: bytes) -> Model:
    """One per process and file."""
    key = sha256(raw).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Model(raw)
    return _loaded[key]


def _binary(data: np.ndarray, size: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in pieces(batch, size=PIECE):
            found = chunks_of(data, offsets)
            _, one, n = np.unique(found.hash, return_index=True, return_counts=True)
            size = (found.end - found.start)[one]
            one, n, size = one[size <= LONG], n[size <= LONG], size[size <= LONG]
            yield pa.RecordBatch.from_arrays([_binary(found.data[_spans(found.start[one], size)], size), pa.array(n.astype(np.int64))], names=["chunk", "n"])


def chunk_counts(documents: DataFrame) -> DataFrame:
    """``chunk`` (bytes, the marker as a blank) and ``n``, how often it stands in the texts; chunks of up to LONG bytes."""
    return documents.select("text").mapInArrow(_counted, "chunk binary, n bigint").groupBy("chunk").agg(F.sum("n").alias("n"))


def _segmented(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    m = model(shared.value)
    for batch in batches:
        chunk = batch.column(0).cast(pa.large_binary())
        raw = b"".join(chunk.to_pylist())
        size = np.array([len(x) for x in chunk.to_pylist()], np.int64)
        ids, n = m.segment(np.frombuffer(raw, np.uint8), size)
        offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))], names=["chunk", "ids"])


def frequent_chunks(counts: DataFrame, shared, rows: int = TABLE) -> DataFrame:
    """``chunk`` and ``ids`` of the chunks used most, at most ``rows``.

    Counts are graded by powers of 2**(1/8); whole grades are taken from the top, so that only
    the sizes of the grades (a few hundred) are seen by the driver.
    """
    graded = counts.withColumn("grade", F.floor(F.log2("n") * 8))
    least, left = None, rows
    for r in sorted(graded.groupBy("grade").count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        least = r["grade"]
    kept = graded.where(F.col("grade") >= least if least is not None else F.lit(False)).select("chunk")
    return kept.mapInArrow(partial(_segmented, shared), "chunk binary, ids array<int>")


def _table(frequent: DataFrame) -> Table:
    rows = frequent.toArrow().combine_chunks()
    chunk, ids = rows.column("chunk").to_pylist(), rows.column("ids")
    size = np.array([len(x) for x in chunk], np.int64)
    start = np.cumsum(size) - size
    data = np.frombuffer(b"".join(chunk), np.uint8)
    value = span_hashes(data, start, start + size) if len(chunk) else np.zeros(0, np.uint64)
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    n = np.array(ids.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    order = np.argsort(value)
    flat = np.asarray(ids.flatten().to_numpy(zero_copy_only=False), np.int64)
    return Table(value[order], data, start[order], size[order], flat, (np.cumsum(n) - n)[order], n[order])


def _coded(shared, table, at_text: int, with_ids: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    m = model(shared.value)
    for batch in batches:
        n_tokens, id_hash, text_hash, all_ids = [], [], [], []
        for _, _, data, offsets in pieces(batch.select([at_text]).rename_columns(["text"]), size=PIECE):
            flat, at = m.encode_all(chunks_of(data, offsets), table.value)
            raw = m.decode_all(flat)
            raw_at = np.concatenate([[0], np.cumsum(m.said_size[flat])])[at].tolist()
            raw, said, at = raw.tobytes(), flat.tolist(), at.tolist()
            for i in range(len(at) - 1):
                got = said[at[i]:at[i + 1]]
                n_tokens.append(len(got))
                id_hash.append(sha256(",".join(map(m.digits.__getitem__, got)).encode()).hexdigest())
                text_hash.append(sha256(raw[raw_at[i] + 1:raw_at[i + 1]]).hexdigest())  # without the leading blank
                if with_ids:
                    all_ids.append(got)
        more = [pa.array(n_tokens, pa.int64()), pa.array(id_hash, pa.string()), pa.array(text_hash, pa.string())]
        more += [pa.array(all_ids, pa.list_(pa.int32()))] if with_ids else []
        kept = [i for i in range(batch.num_columns) if i != at_text]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *more],
                                         names=[*[batch.schema.names[i] for i in kept], "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])


def _file(documents: DataFrame, path: str):
    with open(path, "rb") as file:
        return documents.sparkSession.sparkContext.broadcast(file.read())


def encode_documents(documents: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), ids: bool = False, table: int = TABLE) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of every text, and the ids themselves if wanted.

    ``table`` bounds the rows of the table sent to the tasks.
    """
    shared = _file(documents, path)
    counts = cut(chunk_counts(documents), "chunks")
    frequent = documents.sparkSession.sparkContext.broadcast(_table(cut(frequent_chunks(counts, shared, table), "chunk-ids")))
    own = documents.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != "text")
    schema += ", n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return own.mapInArrow(partial(_coded, shared, frequent, len(keep), ids), schema)


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with the text of their ids in place of them; a null list gives an empty text."""
    shared = _file(encoded, path)

    @F.pandas_udf("string")
    def text_of(column):
        m = model(shared.value)
        return column.map(lambda x: m.decode([] if x is None else list(x)))

    return encoded.withColumn("text", text_of(F.col(ids))).drop(ids)
