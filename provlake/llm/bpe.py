"""Byte-level BPE with forced borders.

A merge can only join two bytes that stand next to each other inside some token of the
vocabulary. Byte pairs that stand in no token are certain cuts: what lies between two cuts is
encoded by itself and the ids are concatenated. The cuts are applied inside the pieces the
vocabulary's own splitting pattern gives (the pattern looks ahead, so it is applied to whole
texts), after special tokens have been cut out. A task encodes the different pieces of a few
megabytes of text together, all fragments one merge at a time.

Defined cases: a null text is encoded as an empty one (no ids, both digests of the empty
string); special tokens written in a text become their ids, as with the library; repeated rows
each give a row; only the named columns are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache, partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.words import pieces, span_hashes

#: Bytes of text encoded at once.
PIECE = 1 << 20
_NONE, _SLOT = np.int64(1 << 30), np.int64(0x1E3779B97F4A7C15)


@cache
def _kinds() -> np.ndarray:
    """Of every code point: 1 letter, 2 number, 3 white space, 0 anything else."""
    kind = np.zeros(0x110000, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for value, name in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
        for run in regex.findall(name, every):
            kind[ord(run[0]):ord(run[-1]) + 1] = value
    kind[0xD800:0xE000] = 0
    return kind


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    def __init__(self, raw: str):
        spec = json.loads(raw)
        letter = _byte_letters()
        vocab = spec["model"]["vocab"]
        self.token = {i: bytes(letter[c] for c in text) for text, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: text.encode() for text, i in self.special.items()}
        self.byte = [0] * 256
        self.inside = np.zeros((256, 256), bool)
        for text, i in vocab.items():
            raw_token = self.token[i]
            if len(raw_token) == 1:
                self.byte[raw_token[0]] = i
            pairs = np.frombuffer(raw_token, np.uint8)
            self.inside[pairs[:-1], pairs[1:]] = True
        pairs = [(vocab[a] << 20) | vocab[b] for a, b in spec["model"]["merges"]]
        self.merge_id = np.array([vocab[a + b] for a, b in spec["model"]["merges"]], np.int64)
        key, rank = np.array(pairs, np.int64), np.arange(len(pairs))
        slot = (key * _SLOT) >> 42 & ((1 << 20) - 1)
        self.slot_key, self.slot_rank = np.full(1 << 20, -1), np.zeros(1 << 20, np.int64)
        self.slot_key[slot], self.slot_rank[slot] = key, rank
        rest = np.flatnonzero(self.slot_key[slot] != key)
        order = rest[np.argsort(key[rest])] if len(rest) else np.zeros(1, np.int64)
        self.rest_key, self.rest_rank = key[order], rank[order]
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.byte_ids = np.array(self.byte, np.int64)
        self.said = [str(i) for i in range(max(self.token) + 1)]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions where the pieces of the splitting pattern begin, and how many each text has.

        The pattern reads: a contraction; or letters, digits or other signs, with one blank before
        them if there is one; or white space, all but its last character if a sign follows.
        """
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        byte_at = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000), out=byte_at[1:])
        kind = _kinds()[points]
        begin = np.zeros(len(points) + 1, bool)
        begin[np.searchsorted(byte_at, offsets)] = True  # first characters of texts, and the end
        joined = ~begin[1:-1]  # character i + 1 is in the same text as i
        start = begin.copy()
        start[1:-1] |= kind[1:] != kind[:-1]
        last_space = np.flatnonzero((kind[:-1] == 3) & (kind[1:] != 3) & joined)
        start[last_space] = True
        start[last_space[points[last_space] == 32] + 1] = False
        quote = np.flatnonzero((points == 39) & start[:-1])
        for tail in ("s", "t", "m", "d", "re", "ve", "ll"):
            size, at = len(tail), quote[quote + len(tail) < len(points)]
            for j, letter in enumerate(tail, 1):
                at = at[(points[at + j] == ord(letter)) & ~begin[at + j]]
            start[at + 1] = False
            start[at + size + 1] = True
        at = byte_at[np.flatnonzero(start[:-1])]
        return at, np.diff(np.searchsorted(at, offsets))

    def _merged(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pieces at once, and how many each piece has.

        Between forced borders every fragment merges its lowest-ranked pair, the leftmost of equal
        ones, until no fragment has a pair left; fragments that are done leave the round.
        """
        ids = self.byte_ids[raw]
        edge = np.zeros(len(raw), bool)
        edge[np.cumsum(size)[:-1]] = True
        edge[0] = True
        edge[1:] |= ~self.inside[raw[:-1], raw[1:]]
        at = np.arange(len(raw))
        final = ids.copy()
        pair = np.full(len(raw), _NONE)
        pair[:-1] = self._rank(ids[:-1], ids[1:], ~edge[1:])
        while len(at):
            first = np.flatnonzero(edge)
            best = np.minimum.reduceat((pair << 32) | np.arange(len(at)), first)
            go = best < (_NONE << 32)
            merge = best[go] & 0xFFFFFFFF
            if len(merge) < len(first):  # done fragments leave
                stay = np.repeat(go, np.diff(np.append(first, len(at))))
                moved = np.cumsum(stay) - 1
                at, ids, edge, pair, merge = at[stay], ids[stay], edge[stay], pair[stay], moved[merge]
                if not len(at):
                    break
            ids[merge] = self.merge_id[pair[merge]]
            final[at[merge]] = ids[merge]
            final[at[merge + 1]] = -1
            keep = np.ones(len(at), bool)
            keep[merge + 1] = False
            moved = np.cumsum(keep) - 1
            at, ids, edge, pair, merge = at[keep], ids[keep], edge[keep], pair[keep], moved[merge]
            for left in (merge, merge[~edge[merge]] - 1):
                right = np.minimum(left + 1, len(at) - 1)
                pair[left] = self._rank(ids[left], ids[right], ~edge[right] & (right > left))
        left = final >= 0
        count = np.add.reduceat(left, np.cumsum(size) - size).astype(np.int64)
        return final[left], count

    def _rank(self, a: np.ndarray, b: np.ndarray, real: np.ndarray) -> np.ndarray:
        key = (a << 20) | b
        slot = (key * _SLOT) >> 42 & (len(self.slot_key) - 1)
        out = np.where(self.slot_key[slot] == key, self.slot_rank[slot], _NONE)
        more = np.flatnonzero((self.slot_key[slot] != key) & (self.slot_key[slot] >= 0))
        if len(more):
            i = np.minimum(np.searchsorted(self.rest_key, key[more]), len(self.rest_key) - 1)
            out[more] = np.where(self.rest_key[i] == key[more], self.rest_rank[i], _NONE)
        return np.where(real, out, _NONE)

    def encode_all(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts one after the other, and where each text's ids begin and end."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        start, per_text = self._pieces(data, offsets)
        end = np.append(start[1:], len(data))
        _, one, same = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        size = (end - start)[one]
        take = np.repeat(start[one] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        ids, count = self._merged(data[take], size)
        n = count[same]
        begin = np.cumsum(n) - n
        flat = ids[np.repeat((np.cumsum(count) - count)[same] - begin, n) + np.arange(n.sum())]
        piece_at = np.concatenate([[0], np.cumsum(per_text)])
        return flat, np.append(begin, n.sum())[piece_at]

    def encode(self, text: str) -> list[int]:
        """One text, special tokens in it included."""
        ids: list[int] = []
        for run in self.marks.split(text) if self.marks else [text]:
            raw = np.frombuffer(run.encode(), np.uint8)
            ids += [self.special[run]] if run in self.special else self.encode_all(raw, np.array([0, len(raw)]))[0].tolist()
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[str, Vocabulary] = {}


def vocabulary(raw: str) -> Vocabulary:
    """One per process and file."""
    key = sha256(raw.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(raw)
    return _loaded[key]


def _coded(shared, at_text: int, ids: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(shared.value)
    for batch in batches:
        n_tokens, id_hash, text_hash, all_ids = [], [], [], []
        for _, _, data, offsets in pieces(batch.select([at_text]).rename_columns(["text"]), size=PIECE):
            raw = data.tobytes()
            marked = {i for i in range(len(offsets) - 1) for x in vocab.special if x.encode() in raw[offsets[i]:offsets[i + 1]]} if any(x.encode() in raw for x in vocab.special) else ()
            flat, at = vocab.encode_all(data, offsets)
            flat = flat.tolist()
            for i in range(len(offsets) - 1):
                got = vocab.encode(raw[offsets[i]:offsets[i + 1]].decode()) if i in marked else flat[at[i]:at[i + 1]]
                n_tokens.append(len(got))
                id_hash.append(sha256(",".join(map(vocab.said.__getitem__, got)).encode()).hexdigest())
                text_hash.append(sha256(vocab.decode(got).encode()).hexdigest())
                if ids:
                    all_ids.append(got)
        more = [pa.array(n_tokens, pa.int64()), pa.array(id_hash, pa.string()), pa.array(text_hash, pa.string())]
        more += [pa.array(all_ids, pa.list_(pa.int32()))] if ids else []
        kept = [batch.column(i) for i in range(batch.num_columns) if i != at_text]
        names = [batch.schema.names[i] for i in range(batch.num_columns) if i != at_text]
        yield pa.RecordBatch.from_arrays([*kept, *more], names=[*names, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids])


def encode_documents(documents: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), ids: bool = False) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of every text, and the ids themselves if wanted.

    The vocabulary file is read once and sent to the tasks; its size does not depend on the data.
    """
    with open(path, encoding="utf-8") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())
    own = documents.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != "text")
    schema += ", n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return own.mapInArrow(partial(_coded, shared, len(keep), ids), schema)


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with the text of their ids in place of them; a null list gives an empty text."""
    with open(path, encoding="utf-8") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("string")
    def text_of(column):
        vocab = vocabulary(shared.value)
        return column.map(lambda x: vocab.decode([] if x is None else list(x)))

    return encoded.withColumn("text", text_of(F.col(ids))).drop(ids)
