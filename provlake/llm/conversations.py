"""A weighted prefix trie over rebuilt conversations, by collapse of whole sequences.

Identical rebuilt conversations become one sequence with a weight and a list of the
conversations that end with it. Sequences that are proper prefixes of others are dropped by an
anti-join, the rest are the leaves; nodes are the distinct prefixes, and every value of a node is
an aggregate over the weighted prefixes below it.

Nothing is gathered for each conversation. Turns are range-partitioned and sorted; a prefix is
named by two 64-bit polynomial sums over 128-bit turn digests, which a task adds up row by row
and which continue in the next partition from a carry (one for each partition, through the
driver). Rebuilding a conversation only shifts and adds such sums, so the name of "first turns of
one, later turns of another" needs no second look at the turns.

Saved bytes of a subtree come without a row for each pair of node and ancestor: every node is
owned by the smallest conversation in it, the nodes a sequence owns are the lower end of its
path, so a subtree holds all that is owned by the sequences through its top, less what the top's
own owner owns above it (a running sum along that path, in blocks).

Defined cases: rows without a conv_id belong to no conversation; null role or text counts as
empty; turns of one number are ordered by the digest of role and text, null numbers come first;
repeated rows are turns like others; the base of a negative id is found with the sign of
``%`` in SQL (toward zero); an empty table gives no rows, not even a root; only the four named
columns are read. Names of prefixes are 128-bit hashes; texts are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from provlake.operators.running import running_sum
from provlake.session import cut

GROUP, HEADS = 5, 9
#: Bytes of joined ids in one row, on the way to an end list's digest.
BLOCK = 1 << 16
#: Depths summed in one window on the way to saved bytes.
STRETCH = 4096
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_FULL = (1 << 64) - 1
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)
_NODE = ["depth", "k1", "k2"]
_TURNS = "conv_id bigint, pos bigint, k1 bigint, k2 bigint, q1 bigint, q2 bigint, n_bytes bigint"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _powers(base: int, first: int, n: int) -> np.ndarray:
    """base**first, base**(first + 1), ... modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = pow(base, first, 1 << 64)
    return np.multiply.accumulate(out)


def _table(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names=names)


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and prefix sums of each turn among the turns of its conversation in this partition."""
    part = TaskContext.get().partitionId()
    conv, count, sums = None, 0, [0, 0]
    for batch in batches:
        if not len(batch):
            continue
        ids = batch.column(0).to_numpy()
        n_bytes = batch.column(2).to_numpy()
        digest = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(-1, 2)
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        size = np.diff(np.append(first, len(ids)))
        goes_on = conv is not None and ids[0] == conv
        place = np.arange(len(ids)) - np.repeat(first, size)
        before = np.zeros(len(first), np.int64)
        before[0] = count if goes_on else 0
        pos = place + np.repeat(before, size) + 1
        columns = []
        for i, base in enumerate(_BASES):
            power = _powers(base, 1, int(size.max()))[place]
            if goes_on:
                power[:size[0]] *= np.uint64(pow(base, count, 1 << 64))
            term = digest[:, i] * power
            total = np.cumsum(term)
            start = np.zeros(len(first), np.uint64)
            start[1:] = total[first[1:] - 1]
            start[0] = np.uint64((-sums[i] if goes_on else 0) & _FULL)
            key = total - np.repeat(start, size)
            columns += [key, key - term]
        yield _table(f"{_TURNS}, part bigint", ids, pos, columns[0], columns[2], columns[1], columns[3], n_bytes, np.full(len(ids), part))
        conv, count, sums = ids[-1], int(pos[-1]), [int(columns[0][-1]), int(columns[2][-1])]


def _carries(placed: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """By partition: the conversation that begins before it, its turns there and their sums."""
    edges = placed.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos", "k1", "k2")).alias("last")).orderBy("part").collect()
    out, conv, count, sums = {}, None, 0, (0, 0)
    for r in edges:
        last, own = r["last"], (r["last"]["k1"] & _FULL, r["last"]["k2"] & _FULL)
        if conv is not None and r["first"] == conv:
            out[r["part"]] = (conv, count, *sums)
        if conv is not None and last["conv_id"] == conv:
            sums = tuple((s + pow(b, count, 1 << 64) * o) & _FULL for s, b, o in zip(sums, _BASES, own, strict=True))
            count += last["pos"]
        else:
            conv, count, sums = last["conv_id"], last["pos"], own
    return out


def _carried(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, pos, k1, k2, q1, q2, n_bytes, part = (c.to_numpy().copy() for c in batch.columns)
        keys = [x.view(np.uint64) for x in (k1, k2, q1, q2)]
        for p in np.unique(part).tolist():
            if p in shared.value:
                conv, count, *sums = shared.value[p]
                rows = (part == p) & (ids == conv)
                pos[rows] += count
                for i, key in enumerate(keys):
                    key[rows] = key[rows] * np.uint64(pow(_BASES[i % 2], count, 1 << 64)) + np.uint64(sums[i % 2])
        yield _table(_TURNS, ids, pos, *keys, n_bytes)


def turn_prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), the names of the turns up to it (k1, k2) and before it (q1, q2), bytes of its text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = cut(conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"), "turn"), "turns")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartitionByRange(parts, *order, F.rand(1)).sortWithinPartitions(*order).select("conv_id", "digest", "n_bytes")
    placed = cut(dealt.mapInArrow(_added_up, f"{_TURNS}, part bigint"), "turn-sums")
    shared = conversations.sparkSession.sparkContext.broadcast(_carries(placed))
    return placed.mapInArrow(partial(_carried, shared), _TURNS)


def _shift(by: np.ndarray, which: int) -> np.ndarray:
    """base**by for by from -HEADS to 0."""
    return np.array([pow(_INVERSES[which], j, 1 << 64) for j in range(HEADS + 1)], np.uint64)[-by]


_KEYS = "a1 bigint, a2 bigint, g1 bigint, g2 bigint"


def _whole(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the name of the whole rebuilt conversation."""
    for batch in batches:
        col = {n: batch.column(i).to_numpy() for i, n in enumerate(batch.schema.names) if n != "head"}
        out = []
        for i in (1, 2):
            a, g, last = (col[f"{x}{i}"].view(np.uint64) for x in ("a", "g", "l"))
            own = (last - g) * _shift(col["taken"] - col["h"], i - 1)
            out.append(pa.array(np.where(col["n"] > col["h"], a + own, a).view(np.int64)))
        yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*names, "w1", "w2"])


def _own_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns of representatives, as prefixes of the rebuilt conversation."""
    for batch in batches:
        col = {n: batch.column(i).to_numpy() for i, n in enumerate(batch.schema.names)}
        shift = col["taken"] - col["h"]
        keys = []
        for name in ("k1", "k2", "q1", "q2"):
            i = name[1]
            keys.append(col[f"a{i}"].view(np.uint64) + (col[name].view(np.uint64) - col[f"g{i}"].view(np.uint64)) * _shift(shift, int(i) - 1))
        depth = col["pos"] + shift
        yield _table(_PREFIX, col["conv_id"], col["weight"], depth, *keys, col["n_bytes"], (depth < col["length"]).astype(np.int64))


_PREFIX = "seq bigint, weight bigint, depth bigint, k1 bigint, k2 bigint, q1 bigint, q2 bigint, n_bytes bigint, inner bigint"


def rebuilt(turns: DataFrame) -> DataFrame:
    """A row for each conversation: how it is put together, its length and the name of the whole (w1, w2).

    ``head`` holds the turns taken from the base (at most eight); a1, a2 name them all, g1, g2
    the own turns that are left out.
    """
    head = F.struct("pos", "k1", "k2", "q1", "q2", "n_bytes")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.max(F.struct("pos", "k1", "k2")).alias("last"),
                                         F.array_sort(F.collect_list(F.when(F.col("pos") < HEADS, head))).alias("heads"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("base_n"), F.col("heads").alias("base_heads"))
    both = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0).cast("bigint"))))
    zero = F.lit(0).cast("bigint")

    def key(heads: str, n: str, name: str):
        return F.coalesce(F.try_element_at(F.col(heads), F.nullif(F.col(n), zero).cast("int"))[name], zero)

    names = ["conv_id", "n", "h", "taken", "length", "a1", "a2", "g1", "g2", "l1", "l2", "head"]
    rows = both.select("conv_id", "n", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), zero)).alias("length"),
                       *[key("base_heads", "taken", f"k{i}").alias(f"a{i}") for i in (1, 2)], *[key("heads", "h", f"k{i}").alias(f"g{i}") for i in (1, 2)],
                       F.col("last.k1").alias("l1"), F.col("last.k2").alias("l2"),
                       F.slice(F.coalesce("base_heads", F.array()), 1, F.col("taken").cast("int")).alias("head"))
    whole = rows.mapInArrow(partial(_whole, names), StructType(list(rows.schema.fields)).add("w1", "long").add("w2", "long"))
    return cut(whole.drop("l1", "l2"), "rebuilt")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of each sequence in this partition as texts of bounded length."""
    part = TaskContext.get().partitionId()
    key, said, size, at = None, [], 0, 0

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(("length", "w1", "w2", "part", "at", "ids"), (*key, part, at, ",".join(said)), strict=True))], _ENDS)

    for batch in batches:
        out = []
        for *now, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if said and (now != key or size > BLOCK):
                out.append(row())
                said, size, at = [], 0, at + 1
            key = now
            said.append(str(conv))
            size += len(said[-1]) + 1
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if said:
        yield row()


_ENDS = pa.schema([("length", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("part", pa.int64()), ("at", pa.int64()), ("ids", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined texts of each sequence, read in order."""
    key, digest = None, None
    for batch in batches:
        out = []
        for length, w1, w2, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (length, w1, w2) == key:
                digest.update(b",")
            else:
                if key:
                    out.append((*key, digest.hexdigest()))
                key, digest = (length, w1, w2), sha256()
            digest.update(ids.encode())
        if out:
            yield _digest_rows(out)
    if key:
        yield _digest_rows([(*key, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=[*_NODE, "ends_sha256"])


def end_lists(members: DataFrame) -> DataFrame:
    """depth, k1, k2 and ends_sha256 of every sequence: the digest of its conversations' ids, ascending, joined by commas.

    Ids are joined to texts of bounded length where they lie; a digest is one stream by nature,
    so only those texts of one sequence meet in a task, which reads them one at a time.
    """
    order = ["length", "w1", "w2", "conv_id"]
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = members.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    joined = cut(ids.mapInArrow(_joined_ids, "length bigint, w1 bigint, w2 bigint, part bigint, at bigint, ids string"), "ends")
    dealt = joined.repartition(parts, "length", "w1", "w2").sortWithinPartitions("length", "w1", "w2", "part", "at")
    return dealt.select("length", "w1", "w2", "ids").mapInArrow(_digests, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def sequences(members: DataFrame) -> DataFrame:
    """Distinct rebuilt conversations: length, w1, w2, ``weight`` and ``seq``, the smallest conversation."""
    return members.groupBy("length", "w1", "w2").agg(F.count("*").alias("weight"), F.min("conv_id").alias("seq"))


def prefixes(turns: DataFrame, members: DataFrame, distinct: DataFrame) -> DataFrame:
    """Every prefix of every distinct sequence, the empty one included, with the sequence's weight.

    A very long sequence is a hot key of the join with its turns; the turns are the side that
    adaptive execution splits.
    """
    reps = members.join(distinct.select(F.col("seq").alias("conv_id"), "weight"), "conv_id")
    from_base = reps.select("conv_id", "weight", "length", F.explode("head").alias("t")).select(
        F.col("conv_id").alias("seq"), "weight", F.col("t.pos").alias("depth"), "t.k1", "t.k2", "t.q1", "t.q2", "t.n_bytes",
        (F.col("t.pos") < F.col("length")).cast("bigint").alias("inner"))
    own = turns.join(reps.drop("head", "w1", "w2"), "conv_id").where("pos > h").mapInArrow(_own_rows, _PREFIX)
    none = F.lit(0).cast("bigint")
    root = distinct.select("seq", "weight", *[none.alias(c) for c in ("depth", "k1", "k2", "q1", "q2", "n_bytes")], (F.col("length") > 0).cast("bigint").alias("inner"))
    return cut(root.unionByName(from_base).unionByName(own), "prefixes")


def leaves(distinct: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sequences that are no proper prefix of another."""
    inner = nodes.where("inner = 1").select(F.col("depth").alias("length"), F.col("k1").alias("w1"), F.col("k2").alias("w2"))
    return distinct.join(inner, ["length", "w1", "w2"], "left_anti")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = turn_prefixes(conversations)
    members = rebuilt(turns)
    distinct = cut(sequences(members), "sequences")
    rows = prefixes(turns, members, distinct)
    nodes = cut(rows.groupBy(*_NODE).agg(F.sum("weight").alias("n_convs"), F.min("seq").alias("conv_id"), F.max("n_bytes").alias("n_bytes"),
                                         F.max("inner").alias("inner"), F.max("q1").alias("q1"), F.max("q2").alias("q2")), "nodes")
    saved = ((F.col("n_convs") - 1) * F.col("n_bytes")).cast("bigint")
    above = running_sum(nodes, ["conv_id"], ["depth"], saved, F.floor(F.col("depth") / STRETCH), "above").select(*_NODE, "above")
    owned = nodes.groupBy(F.col("conv_id").alias("seq")).agg(F.sum(saved).alias("owned"))
    facts = distinct.select("seq").join(owned, "seq", "left").join(leaves(distinct, nodes).select("seq", F.lit(1).alias("leaf")), "seq", "left").select(
        "seq", F.coalesce("owned", F.lit(0).cast("bigint")).alias("owned"), F.coalesce("leaf", F.lit(0)).cast("bigint").alias("leaf"))
    below = rows.select("seq", *_NODE).join(facts, "seq").groupBy(*_NODE).agg(F.sum("owned").alias("owned"), F.sum("leaf").alias("n_leaves"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(above, _NODE).join(below, _NODE).join(children, _NODE, "left").join(end_lists(members), _NODE, "left").join(parents, ["depth", "q1", "q2"], "left")
    return out.select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
                      F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_leaves", (F.col("owned") - F.col("above")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
