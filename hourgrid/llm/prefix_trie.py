"""Prefix trie of conversations as a node table behind minimal perfect hashes.

Every prefix of a conversation's turns has a 128-bit digest, made from the digest before it and
that of the turn. Distinct digests, with how many conversations start with them, are the nodes;
they are counted natively, combined before the shuffle, so a first turn that a third of all
conversations share is one row a task.

What has to be added up over subtrees is added up in shards. Nodes with more than ``bound``
conversations form the top of the trie; ``bound`` grows with the input, so that at most ``TOP``
nodes can have more. A node right below the top, with all that is below it, has at most
``bound`` conversations: these subtrees are dealt to shards. A shard numbers its digests by a
minimal perfect hash, verifies every slot against the whole digest, scatters counts into flat
arrays, and adds them up along the array of parents' slots from the deepest level on. The top is
one more shard, which takes the sums of the subtrees hanging below it as counts of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import MASK, U64, batches_of, mix, rows_of, travels_by_value
from hourgrid.session import saved

travels_by_value(__name__)

#: No more nodes than this are in the top of a trie, whatever its size.
TOP = 100_000
#: A node of the top has more conversations than this even in a small input.
LEAST_BOUND = 50
#: Nodes that a shard receives, about.
SHARD_NODES = 500_000
#: A rebuilt conversation takes fewer turns than this from its family's first one.
HEADS = 9
NO_TURNS = hashlib.sha256(b"").hexdigest()


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit digests: every digest has a slot of its own, below their number.

    Digests go to places of a table twice as large as their number; those alone at a place
    take the next slots, the rest try again in a table of their own.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.tables: list[np.ndarray] = []
        first = 0
        while len(high):
            if len(self.tables) == 64:  # as good as impossible
                raise ValueError("the digests are not distinct")
            place = self.place(high, low, 2 * len(high), len(self.tables))
            alone = np.bincount(place, minlength=2 * len(high)) == 1
            self.tables.append(np.where(alone, first - 1 + np.cumsum(alone), -1))
            first += int(alone.sum())
            high, low = high[~alone[place]], low[~alone[place]]

    @staticmethod
    def place(high: np.ndarray, low: np.ndarray, size: int, level: int) -> np.ndarray:
        return (mix(high + mix(low + U64((level + 1) * 0x9E3779B97F4A7C15 & MASK))) % U64(size)).astype(np.int64)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of every digest; one that was not numbered gets some slot or -1, so verify it."""
        found = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, table in enumerate(self.tables):
            got = table[self.place(high[left], low[left], len(table), level)]
            found[left] = got
            left = left[got < 0]
        return found


def add_up(nodes: pa.Table) -> pa.Table:
    """Children, leaves and sums of ``saved`` of all nodes of a shard.

    ``outer_children`` and ``outer_leaves`` count what hangs below a node in other shards.
    """
    def column(name: str) -> np.ndarray:
        return nodes.column(name).fill_null(0).to_numpy().astype(np.int64)

    high, low, parent_high, parent_low = (column(c).view(U64) for c in ("high", "low", "parent_high", "parent_low"))
    depth, conv, n = column("depth"), column("conv"), nodes.num_rows
    table = PerfectHash(high, low)
    slot = table.slots(high, low)
    row = np.empty(n, np.int64)  # that has a slot
    row[slot] = np.arange(n)
    # a parent in this shard must have the very digest and depth at its slot
    parent = table.slots(parent_high, parent_low)
    of = row[np.maximum(parent, 0)]
    inside = (parent >= 0) & (high[of] == parent_high) & (low[of] == parent_low) & (depth[of] == depth - 1)
    # flat arrays by slot
    parents, depths, children, leaves, total = (np.empty(n, np.int64) for _ in range(5))
    parents[slot], depths[slot], total[slot] = np.where(inside, parent, -1), depth, column("saved")
    children[slot], leaves[slot] = column("outer_children"), column("outer_leaves")
    children += np.bincount(parents[parents >= 0], minlength=n)
    leaves[children == 0] = 1
    order = np.argsort(-depths, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depths[order])) + 1):
        level = level[parents[level] >= 0]
        np.add.at(total, parents[level], total[level])
        np.add.at(leaves, parents[level], leaves[level])
    return pa.table({
        "high": nodes.column("high"), "low": nodes.column("low"), "conv_id": conv, "depth": depth,
        "parent_high": nodes.column("parent_high"), "parent_low": nodes.column("parent_low"),
        "parent_conv_id": pa.array(conv[of], pa.int64(), mask=~inside), "n_convs": column("n_convs"),
        "n_children": children[slot], "n_leaves": leaves[slot], "saved_tokens": total[slot]})


SUMS = ("high long, low long, conv_id long, depth long, parent_high long, parent_low long, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved_tokens long")
CHAIN = "high long, low long, parent_high long, parent_low long, depth long, conv long, size long, ends boolean"


def _halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def prefixes(turns: DataFrame, cut: DataFrame | None = None) -> DataFrame:
    """One row for every conversation and prefix of it, the empty one included.

    ``turns`` is what ``rebuilt`` returns. ``cut`` holds the digests of the top, at most ``TOP``
    unless a caller's bound lets more in; then the columns ``root_high`` and ``root_low`` follow:
    the conversation's first digest below the top (null within the top).
    """
    context = turns.sparkSession.sparkContext
    top = None if cut is None else context.broadcast({(r.high, r.low) for r in cut.select("high", "low").toLocalIterator()})
    columns = CHAIN + ("" if top is None else ", root_high long, root_low long")
    fields = [(c.split()[0], pa.bool_() if c.endswith("boolean") else pa.int64()) for c in columns.split(", ")]

    def chained(conv: int, own: Iterator[tuple]) -> Iterator[tuple]:
        """The prefixes of one conversation, given its turns' (digest, size)."""
        digest, parent, root, depth, size = bytes(16), (None, None), (None, None), 0, 0
        turn = next(own, None)
        while True:
            here = _halves(digest)
            if top is not None and root[0] is None and here not in top.value:
                root = here
            yield (*here, *parent, depth, conv, size, turn is None, *(root if top is not None else ()))
            if turn is None:
                return
            parent, depth, size = here, depth + 1, turn[1]
            digest = hashlib.blake2b(digest + turn[0], digest_size=16).digest()
            turn = next(own, None)

    def noted(own: Iterator[tuple], heads: list[tuple]) -> Iterator[tuple]:
        for turn in own:
            if len(heads) < HEADS - 1:
                heads.append(turn)
            yield turn

    def all_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for family, members in groupby(rows_of(batches), key=itemgetter(0)):
            heads: list[tuple] = []  # of the family's first conversation, which comes first if there is one
            for (conv, head), rows in groupby(members, key=itemgetter(1, 5)):
                own = (row[3:5] for row in rows)
                if conv == family:
                    yield from chained(conv, noted(own, heads))
                else:
                    yield from chained(conv, chain(heads[:head], islice(own, head, None)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(all_prefixes(batches), fields, 8192)

    order = [F.col(c).asc_nulls_first() for c in ("family", "conv", "turn", "digest")]
    rows = turns.select("family", "conv", "turn", "digest", "size", "head").repartition("family").sortWithinPartitions(*order)
    return rows.mapInArrow(run, columns)


def rebuilt(rows: DataFrame, family: int = 5, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(family, conv, turn, digest, size, head): what ``prefixes`` needs of every turn; no texts.

    A conversation's first ``head`` turns are those of the conversation ``family``, the
    largest multiple of ``family`` not above its own number; ``head`` is the CRC-32 of its
    number as text modulo ``HEADS``. With ``family=1`` every conversation stays as it is.
    """
    plain = rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")  # tells roles from texts
    return plain.select(
        (F.col("conv") - F.pmod("conv", F.lit(family))).alias("family"), "conv", "turn",
        F.unhex(F.md5(whole)).alias("digest"), F.octet_length("text").cast("long").alias("size"),
        (F.crc32(F.col("conv").cast("string")) % HEADS).alias("head"))


def end_digests(paths: DataFrame) -> DataFrame:
    """(high, low, ends_sha256): SHA-256 of the ids that end at a node, ascending, joined by commas.

    Ids stream through a task in order; none are held.
    """
    fields = [("high", pa.int64()), ("low", pa.int64()), ("ends_sha256", pa.string())]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (high, low), rows in groupby(rows_of(batches), key=itemgetter(0, 1)):
            digest, joint = hashlib.sha256(), b""
            for _, _, conv in rows:
                digest.update(joint + str(conv).encode())
                joint = b","
            yield high, low, digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(digests(batches), fields, 8192)

    ends = paths.filter("ends").select("high", "low", "conv")
    return ends.repartition("high", "low").sortWithinPartitions("high", "low", "conv").mapInArrow(
        run, "high long, low long, ends_sha256 string")


def trie(rows: DataFrame, family: int = 5, conv: str = "conv_id", turn: str = "turn", role: str = "role",
         text: str = "text", bound: int | None = None, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row a node.

    A node is a distinct sequence of first turns (role and text) of rebuilt conversations, see
    ``rebuilt``; the root is the empty one. ``conv_id`` is the smallest member. Turns go by
    number, null first; turns of one number by the MD5 of role and text. A null role or text is
    empty. Rows without a conversation's number belong to none and are left out. Repeated rows
    are repeated turns. Conversations rebuilt without turns end at the root. No rows give no
    nodes. Columns other than those named are not read. ``bound`` (by default so large that at
    most ``TOP`` nodes have more members) cuts the top of the trie from its subtrees.
    """
    turns = saved(rebuilt(rows, family, conv, turn, role, text), "trie-turns")
    members = prefixes(turns).groupBy("high", "low").agg(F.count("*").alias("n_convs"))
    if bound is None:
        # a conversation has a turn, and is a member of no more nodes than one, its own turns and its head
        bound = LEAST_BOUND + (1 + HEADS) * turns.count() // TOP
    top = saved(members.filter(F.col("n_convs") > bound), "trie-top")
    paths = saved(prefixes(turns, top), "trie-paths")
    keys = ["root_high", "root_low", "high", "low"]
    nodes = paths.groupBy(*keys).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("depth").alias("depth"),
        F.min("parent_high").alias("parent_high"), F.min("parent_low").alias("parent_low"), F.min("size").alias("size"))
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("size"))
    nodes = saved(nodes, "trie-nodes")
    shards = nodes.count() // shard_nodes + 1
    below = nodes.filter("root_high is not null").withColumn("shard", F.pmod(F.xxhash64("root_high", "root_low"), F.lit(shards)))
    bare = below.withColumn("outer_children", F.lit(0)).withColumn("outer_leaves", F.lit(0))
    lower = saved(bare.groupBy("shard").applyInArrow(add_up, SUMS), "trie-lower")
    hanging = lower.filter("parent_conv_id is null").groupBy(F.col("parent_high").alias("h"), F.col("parent_low").alias("l")).agg(
        F.count("*").alias("outer_children"), F.sum("n_leaves").alias("outer_leaves"), F.sum("saved_tokens").alias("outer_saved"))
    upper = nodes.filter("root_high is null").join(
        hanging, (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")), "left")
    upper = upper.withColumn("saved", F.col("saved") + F.coalesce("outer_saved", F.lit(0))).withColumn("shard", F.lit(0))
    upper = saved(upper.groupBy("shard").applyInArrow(add_up, SUMS), "trie-upper")
    # parents of subtrees lie in the top
    above = upper.select(F.col("high").alias("h"), F.col("low").alias("l"), F.col("conv_id").alias("above"))
    roots = lower.filter("parent_conv_id is null").join(
        above, (F.col("parent_high") == F.col("h")) & (F.col("parent_low") == F.col("l")), "left")
    found = roots.withColumn("parent_conv_id", F.col("above")).select(lower.columns).unionByName(
        lower.filter("parent_conv_id is not null")).unionByName(upper)
    ended = end_digests(paths).select(F.col("high").alias("h"), F.col("low").alias("l"), "ends_sha256")
    found = found.join(ended, (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")), "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(NO_TURNS)).alias("ends_sha256"))
