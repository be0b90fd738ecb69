"""Prefix trie of conversations by ROLLUP over positional turn-id columns.

A turn's id is a 128-bit digest of its role and text, followed by its number of words. A
conversation becomes rows of `WIDTH` positional columns, turns 1 to WIDTH in its first block
and so on. GROUP BY block, prior node, ROLLUP (t0, ..., t7) then aggregates all prefixes that
end in a block together, told apart by grouping_id; a block is keyed by the node that the
block before it ends at, so conversations of any length take one pass, not one for each block.
A node's key combines 128 bits of hash of every (place, turn id) of its prefix by exclusive
or: keys of all prefixes are running aggregates, whatever the length of a conversation.

What subtrees add up goes through a second ROLLUP. The smallest member of a node owns it, and
along a conversation's path the nodes that it owns are the deepest ones. So the nodes below a
node are those owned by its members: all that any other member owns, and of its owner those
from its own depth on. The first is a sum over members, the second a running sum along one
path. Positions, keys and path sums run along pieces of the order of all turns, so that no
conversation, however long, is one task's work.

Defined results: turns are ordered by `turn`, null first; turns of equal number by their id.
Repeated rows are turns of their own. A null role or text is empty. Rows without a
conv_id belong to no conversation. A conversation all of whose turns are taken from it is a
member of the root alone. An empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtally.llm.common import stored
from subtally.operators.grouping import with_pieces

#: Positional columns of a block.
WIDTH = 8
#: Neighbouring conversations that share openings, and the bound of the openings' length.
FAMILY = 20
OPENINGS = 4

_SLOTS = [f"t{i}" for i in range(WIDTH)]
_WORD = r"[^\x20\x09-\x0D]+"


def running(
    frame: DataFrame, key: str, order: Sequence[str],
    sums: Mapping[str, Column] | None = None, xors: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running totals per key along `order` (ascending, no nulls), the row's own included.

    For keys of unbounded size: rows are dealt by pieces of the order, totals run inside each
    piece, and only a piece's first key can go on from earlier pieces. What it brings along is
    added up over one row for each piece.
    """
    kinds = {**{n: (c, F.sum) for n, c in (sums or {}).items()}, **{n: (c, F.bit_xor) for n, c in (xors or {}).items()}}
    cut = with_pieces(frame.withColumns({f"__{n}": c for n, (c, _) in kinds.items()}), [key, *order])
    cut = cut.repartition("__piece")
    inside = Window.partitionBy("__piece", key).orderBy(*order)
    far = inside.rowsBetween(Window.unboundedPreceding, 0)
    piece = Window.partitionBy("__piece").orderBy(key, *order)
    inner = cut.withColumns({
        "__first": F.lag(key).over(piece).isNull(), "__last": F.lead(key).over(piece).isNull(),
        **{n: f(f"__{n}").over(far) for n, (_, f) in kinds.items()},
    })
    ends = inner.filter("__first OR __last").groupBy("__piece").agg(
        F.max(F.when(F.col("__first"), F.col(key))).alias("head"),
        F.max(F.when(F.col("__last"), F.struct(F.col(key).alias("key"), *kinds))).alias("tail"),
    )
    along = Window.orderBy("__piece")
    same = Window.partitionBy("tail.key").orderBy("__piece").rowsBetween(Window.unboundedPreceding, 0)
    # One task holds a row for each piece.
    brought = ends.repartition(1).withColumns({f"__{n}": f(f"tail.{n}").over(same) for n, (_, f) in kinds.items()})
    carried = brought.select("__piece", F.col("head").alias("__head"), *[
        F.when(F.lag("tail.key").over(along) == F.col("head"), F.lag(f"__{n}").over(along)).alias(f"__c_{n}")
        for n in kinds
    ])
    both = inner.join(carried, "__piece")
    add = {F.sum: lambda a, b: a + b, F.bit_xor: lambda a, b: a.bitwiseXOR(b)}

    def total(name: str, how) -> Column:
        earlier = F.when(F.col(key) == F.col("__head"), F.col(f"__c_{name}"))
        return add[how](F.col(name), F.coalesce(earlier, F.lit(0))).alias(name)

    return both.select(*frame.columns, *[total(n, f) for n, (_, f) in kinds.items()])


def numbered_turns(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, pos (from 1) and id of every turn."""
    role_text = F.concat(F.length(F.coalesce(role, F.lit(""))).cast("string"), F.lit(":"),
                         F.coalesce(role, F.lit("")), F.coalesce(text, F.lit("")))
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD))
    turn_id = F.concat(F.substring(F.sha2(role_text, 256), 1, 32), F.lpad(F.hex(words), 16, "0"))
    turns = stored(
        conversations.select(
            F.col(conv_id).cast("long").alias("conv_id"),
            F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"),
            F.col(turn).isNotNull().alias("known"), F.unhex(turn_id).alias("tid"),
        ).filter("conv_id IS NOT NULL")
    )
    placed = running(turns, "conv_id", ["known", "turn", "tid"], sums={"pos": F.lit(1)})
    return placed.select("conv_id", "pos", "tid")


def members_of(turns: DataFrame) -> DataFrame:
    """conv_id and n_turns of every conversation."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))


def share_openings(
    turns: DataFrame, members: DataFrame, family: int = FAMILY, openings: int = OPENINGS
) -> tuple[DataFrame, DataFrame]:
    """Turns and members, with first turns replaced by those of the family's first conversation.

    Conversation c takes the first h turns of conversation c - c % family, with h the
    unsigned CRC-32 of its number modulo `openings`, and drops as many of its own.
    """
    base = F.col("conv_id") - F.col("conv_id") % family
    length = F.crc32(F.col("conv_id").cast("string")) % openings
    heads = turns.filter((base == F.col("conv_id")) & (F.col("pos") < openings)).groupBy(
        F.col("conv_id").alias("base")
    ).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "tid"))), lambda t: t["tid"]).alias("heads"))
    none = F.array().cast("array<binary>")
    told = stored(
        members.withColumns({"h": length, "base": base}).join(stored(heads), "base", "left").select(
            "conv_id", "n_turns", "h", F.slice(F.coalesce("heads", none), 1, F.col("h").cast("int")).alias("taken"),
        )
    )
    # Where the family's first conversation is too short, own turns move up; a small table as a rule.
    gaps = stored(told.filter("size(taken) < h").select("conv_id", (F.size("taken") - F.col("h")).alias("gap")))
    own = turns.filter(F.col("pos") > length).join(gaps, "conv_id", "left").select(
        "conv_id", (F.col("pos") + F.coalesce("gap", F.lit(0))).alias("pos"), "tid"
    )
    taken = told.select("conv_id", F.posexplode("taken").alias("at", "tid")).select(
        "conv_id", (F.col("at") + 1).cast("long").alias("pos"), "tid"
    )
    left = F.size("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))
    return own.unionByName(taken), told.select("conv_id", left.alias("n_turns"))


def _hashes(place: Column, turn_id: Column) -> tuple[Column, Column]:
    """Two hashes of a turn at its place."""
    return F.xxhash64(F.lit(1), place, turn_id), F.xxhash64(turn_id, place, F.lit(2))


def _blocks(turns: DataFrame, members: DataFrame) -> DataFrame:
    """conv_id, block, key of the prior node, turn ids by place; a first block for every member.

    e1, e2 are the block's own part of the keys of prefixes that go beyond it.
    """
    slot = (F.col("pos") - 1) % WIDTH
    one, two = _hashes(F.col("pos").cast("long"), F.col("tid"))
    cells = turns.groupBy("conv_id", F.expr(f"(pos - 1) div {WIDTH}").alias("block")).agg(  # WIDTH turns at most
        *[F.max(F.when(slot == i, F.col("tid"))).alias(name) for i, name in enumerate(_SLOTS)],
        F.bit_xor(one).alias("e1"), F.bit_xor(two).alias("e2"),
    )
    keyed = running(stored(cells), "conv_id", ["block"], xors={"p1": F.col("e1"), "p2": F.col("e2")})
    keyed = keyed.withColumns({f"p{i}": F.col(f"p{i}").bitwiseXOR(F.col(f"e{i}")) for i in (1, 2)})
    nothing = [F.lit(None).cast("binary").alias(name) for name in _SLOTS]
    zero = [F.lit(0).cast("long").alias(name) for name in ("block", "p1", "p2", "e1", "e2")]
    return keyed.unionByName(members.filter("n_turns = 0").select("conv_id", *zero, *nothing))


def _rolled_up(blocks: DataFrame, measures: str) -> DataFrame:
    """One row for each node: its key and its parent's, depth, last turn id, and the measures."""
    slots = ", ".join(_SLOTS)
    groups = blocks.sparkSession.sql(
        f"SELECT block, p1, p2, {slots}, {WIDTH} - bit_count(grouping_id()) AS j, {measures} "
        f"FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP ({slots})",
        blocks=blocks,
    )
    last = F.get(F.array(*_SLOTS), F.col("j") - 1)
    # The part before the first column is the node of the block before, or the root.
    nodes = groups.withColumn("last", last).filter("(j = 0 AND block = 0) OR last IS NOT NULL")

    def key(which: int, length: Column) -> Column:
        folded = F.col(f"p{which + 1}")
        for i, name in enumerate(_SLOTS):
            place = F.col("block") * WIDTH + (i + 1)
            folded = folded.bitwiseXOR(F.when(length > i, _hashes(place, F.col(name))[which]).otherwise(0))
        return folded

    names = [part.split(",")[0].strip() for part in measures.split(" AS ")[1:]]
    return nodes.select(
        key(0, F.col("j")).alias("k1"), key(1, F.col("j")).alias("k2"),
        key(0, F.col("j") - 1).alias("q1"), key(1, F.col("j") - 1).alias("q2"),
        (F.col("block") * WIDTH + F.col("j")).alias("depth"), "last",
        *names,
    )


def _ends(blocks: DataFrame) -> DataFrame:
    """k1, k2 and digest of the members that end at each node where any does.

    A digest is one stream by its nature: the members of a node pass in order through one
    task, which holds no more of them than a batch.
    """
    ends = blocks.groupBy("conv_id").agg(F.bit_xor("e1").alias("k1"), F.bit_xor("e2").alias("k2")).select(
        "k1", "k2", "conv_id"
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, stream = None, None
        for batch in batches:
            done: list[tuple[int, int, str]] = []
            for k1, k2, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (k1, k2) == node:
                    stream.update(b",%d" % conv)
                    continue
                if node:
                    done.append((*node, stream.hexdigest()))
                node, stream = (k1, k2), hashlib.sha256(b"%d" % conv)
            yield _rows(done)
        if node:
            yield _rows([(*node, stream.hexdigest())])

    ordered = ends.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id")
    return ordered.mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def _rows(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
    kinds = [("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]
    columns = list(zip(*done)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], schema=pa.schema(kinds))


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The trie of numbered `turns` (conv_id, pos, tid) of all `members` (conv_id, n_turns).

    A row for each node: conv_id, the smallest member; depth; parent_conv_id; n_convs;
    n_children; n_leaves and saved_tokens of the subtree; ends_sha256 of the members that end
    there; n_words of the last turn.
    """
    blocks = stored(_blocks(turns, members))
    words = F.conv(F.hex(F.substring("last", 17, 8)), 16, 10).cast("long")
    nodes = stored(
        _rolled_up(blocks, "count(*) AS n_convs, min(conv_id) AS conv_id")
        .withColumn("n_words", F.coalesce(words, F.lit(0))).drop("last")
    )
    children = nodes.filter("depth > 0").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(
        F.count("*").alias("n_children")
    )
    parents = nodes.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent"))
    linked = nodes.join(children, ["k1", "k2"], "left").join(parents, ["q1", "q2"], "left").select(
        "k1", "k2", "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_words",
        (-F.col("depth")).alias("up"),
    )
    weight = (F.col("n_convs") - 1) * F.col("n_words")
    summed = stored(running(stored(linked), "conv_id", ["up"], sums={"below": weight}))
    owned = stored(summed.groupBy("conv_id").agg(
        F.sum(weight).alias("owned_saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("owned_leaves")
    ))
    weighed = blocks.join(owned, "conv_id", "left").fillna(0, ["owned_saved", "owned_leaves"])
    others = _rolled_up(
        weighed, "sum(owned_saved) AS all_saved, min_by(owned_saved, conv_id) AS own_saved, sum(owned_leaves) AS n_leaves"
    ).select("k1", "k2", (F.col("all_saved") - F.col("own_saved")).alias("beside"), "n_leaves")
    return summed.join(others, ["k1", "k2"]).join(_ends(blocks), ["k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("below") + F.col("beside")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "n_words",
    )


def conversation_trie(conversations: DataFrame, shared: bool = False, **columns: str) -> DataFrame:
    """The trie of all conversations, with openings shared inside families if `shared`."""
    turns = stored(numbered_turns(conversations, **columns))
    members = members_of(turns)
    return prefix_trie(*share_openings(turns, members) if shared else (turns, members))
