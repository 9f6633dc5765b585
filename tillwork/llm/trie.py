"""Conversation prefix trie, with subtree totals by parallel tree contraction.

Every distinct sequence of first turns is a node.  A node is known by the depth and
the exclusive or of two 64-bit hashes of each turn's place and SHA-256, so the
nodes of a conversation come from running totals that can be carried from chunk to
chunk: no conversation has to fit in a task.

Totals over subtrees are made by contracting the trie.  Each round rakes the leaves
into their parents and compresses unary chains: nodes with one child, chosen so
that no two neighbours are, are spliced out and what they hold is noted on
the link of their child.  The number of rounds grows with the logarithm of the
nodes, however deep the trie is.  The spliced nodes are expanded again from their
children, by doubling the links between them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import discard, spill

#: Conversations share the first turns of the first one of each family of so many.
FAMILY = 5
#: A conversation takes up to this many turns, less one, from the first of its family.
SHARED = 9
#: Turns of a conversation that are totalled in one window.
CHUNK = 4096
#: Characters of a piece of a list of conversation ids.
PIECE = 1 << 18


def _carried(rows: DataFrame, keys: list[str], order: Column, **sums: tuple) -> DataFrame:
    """Add running totals, this row included, of each group ``keys`` over its rows by (chunk, order).

    ``sums`` gives (aggregate, column) for each new column; the total of
    earlier chunks is one row for each chunk, so no group has to fit in a task.
    """
    add = {F.sum: lambda a, b: a + b, F.bit_xor: lambda a, b: a.bitwiseXOR(b)}
    inside = Window.partitionBy(*keys, "chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.groupBy(*keys, "chunk").agg(*[how(c).alias(f"_{name}") for name, (how, c) in sums.items()])
    whole = whole.select(*keys, "chunk", *[F.coalesce(how(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name, (how, _) in sums.items()])
    out = rows.withColumns({name: how(c).over(inside) for name, (how, c) in sums.items()}).join(spill(whole, "chunks"), [*keys, "chunk"])
    return out.withColumns({name: add[how](F.col(name), F.col(f"_{name}")) for name, (how, _) in sums.items()}).drop(*[f"_{n}" for n in sums])


def ordered_turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, place, said, bytes) for each turn: its place from 1, the SHA-256 of role and text, and the bytes of the text.

    Null turns come first; rows of one turn are ordered by role and text.  Runs
    of a range partition are the chunks in which places are counted.
    """
    told = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    said = F.sha2(F.concat(F.octet_length(told[0]).cast("string"), F.lit(":"), *told).cast("binary"), 256)
    rows = df.select(F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), said.alias("said"),
                     F.octet_length(told[1]).cast("long").alias("bytes"), F.concat(told[0], F.lit("\0"), told[1]).alias("tie")).filter("conv IS NOT NULL")
    # ties of a turn are told apart, so ranges may cut a conversation anywhere; the driver samples short keys only
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", F.col("turn").asc_nulls_first()]
    rows = rows.repartitionByRange(parts, *order, F.substring("tie", 1, 64)).withColumn("chunk", F.spark_partition_id())
    rows = spill(rows.sortWithinPartitions(*order, "tie").withColumn("at", F.monotonically_increasing_id()).withColumn("one", F.lit(1).cast("long"))
                 .select("conv", "said", "bytes", "chunk", "at", "one"), "turns")
    return _carried(rows, ["conv"], F.col("at"), place=(F.sum, "one")).select("conv", "place", "said", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv, depth, said, bytes), and all conversations (conv, length).

    Conversation c begins with the first h turns of the first conversation of
    its family, where there is one, and goes on with its own turns after h.
    """
    sizes = spill(turns.groupBy("conv").agg(F.max("place").alias("own")).withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED).withColumn(
        "base", F.col("conv") - F.col("conv") % FAMILY), "conversations")
    there = sizes.select(F.col("conv").alias("base"), F.col("own").alias("of_base"))
    sizes = spill(sizes.join(there, "base", "left").select("conv", "own", "h", "base", F.least("h", F.coalesce("of_base", F.lit(0))).alias("given")), "conversations")
    first = turns.filter(F.col("place") < SHARED).withColumnRenamed("conv", "base")
    given = sizes.filter("given > 0").select("base", "conv", "given").join(first, "base").filter("place <= given").select("conv", F.col("place").alias("depth"), "said", "bytes")
    own = turns.join(sizes.select("conv", "h", "given"), "conv").filter("place > h").select(
        "conv", (F.col("given") + F.col("place") - F.col("h")).alias("depth"), "said", "bytes")
    length = F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return given.unionByName(own), sizes.select("conv", length.alias("length"))


NODE = ["depth", "x", "y"]


def _rows(keys: list[tuple], *columns: tuple[str, list, pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array([k[i] for k in keys], pa.int64()) for i in range(3)] + [pa.array(values, kind) for _, values, kind in columns]
    return pa.RecordBatch.from_arrays(arrays, [*NODE, *(name for name, _, _ in columns)])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined ids of each run of equal nodes, in pieces of some ``PIECE`` characters."""
    def batch_of(runs):
        return _rows([k for k, _ in runs], ("conv", [ids[0] for _, ids in runs], pa.int64()), ("ids", [",".join(map(str, ids)) for _, ids in runs], pa.string()))

    now, ids = None, []
    for batch in batches:
        runs, columns = [], [batch.column(c).to_numpy() for c in range(4)]
        begins = np.flatnonzero(np.r_[batch.num_rows > 0, np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)])
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), batch.num_rows]):
            key = tuple(int(c[a]) for c in columns[:3])
            if ids and (key != now or len(ids) >= PIECE // 20):
                runs.append((now, ids))
                ids = []
            now, ids = key, ids + columns[3][a:b].tolist()
        yield batch_of(runs)
    if ids:
        yield batch_of([(now, ids)])


def _streamed_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, which come in order: a stream, of which one batch is held at a time."""
    now, total = None, None
    for batch in batches:
        found, keys = [], zip(*(batch.column(c).to_pylist() for c in range(3)))
        for key, piece in zip(keys, batch.column(4)):
            if key != now:
                if now is not None:
                    found.append((now, total.hexdigest()))
                now, total = key, hashlib.sha256()
            else:
                total.update(b",")
            total.update(piece.as_py().encode())
        yield _rows([k for k, _ in found], ("ends_sha256", [h for _, h in found], pa.string()))
    if now is not None:
        yield _rows([now], ("ends_sha256", [total.hexdigest()], pa.string()))


def ends_of(members: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256) from the last nodes (depth, x, y, conv) of all conversations.

    Ids are joined to pieces in a range sort, which may cut the list of a node
    anywhere; the pieces of a node are then hashed in their order, a stream.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = NODE
    ordered = members.select(*key, "conv").repartitionByRange(parts, *key, "conv").sortWithinPartitions(*key, "conv")
    pieces = ordered.mapInArrow(_pieces, "depth long, x long, y long, conv long, ids string")
    return pieces.repartition(parts, *key).sortWithinPartitions(*key, "conv").mapInArrow(
        _streamed_hash, "depth long, x long, y long, ends_sha256 string")


def nodes_of(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, weight, ends_sha256) of every node.

    ``weight`` is what the node saves itself: (n_convs - 1) x the bytes of its last text.
    """
    lane = lambda salt: F.xxhash64(F.lit(salt), "depth", "said")
    rows = turns.select("conv", "depth", "bytes", lane("x").alias("a"), lane("y").alias("b")).withColumn("chunk", F.floor(F.col("depth") / CHUNK))
    rows = spill(_carried(rows, ["conv"], F.col("depth"), x=(F.bit_xor, "a"), y=(F.bit_xor, "b")), "prefixes")
    last = conversations.withColumnRenamed("length", "depth").join(rows.select("conv", "depth", "x", "y"), ["conv", "depth"], "left")
    last = spill(last.select("conv", "depth", F.coalesce("x", F.lit(0)).alias("x"), F.coalesce("y", F.lit(0)).alias("y")), "ends")
    key = NODE
    nodes = rows.groupBy(*key).agg(F.min("conv").alias("conv"), F.count("*").alias("n"), F.max("bytes").alias("bytes"), F.max("a").alias("a"), F.max("b").alias("b"))
    root = conversations.agg(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.min("conv").alias("conv"),
                             F.count("*").alias("n"), F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).filter("n > 0")
    nodes = spill(nodes.unionByName(root).withColumns({"up_x": F.col("x").bitwiseXOR(F.col("a")), "up_y": F.col("y").bitwiseXOR(F.col("b"))}), "nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_x").alias("x"), F.col("up_y").alias("y")).agg(F.count("*").alias("kids"))
    whole = spill(nodes.join(children, key, "left").join(ends_of(last), key, "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "nodes")
    above = whole.filter("kids > 0").select((F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("conv").alias("up"))
    out = whole.join(above, ["depth", "up_x", "up_y"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        ((F.col("n") - 1) * F.col("bytes")).alias("weight"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    return spill(out, "trie")


def _rank(conv: Column, depth: Column, round_: int) -> Column:
    """What decides which nodes of a chain go first: those whose depth has the fewest zero bits at its end, then a lot.

    Of a chain of consecutive depths every second node goes in each round.
    """
    return F.struct(F.bit_count(depth.bitwiseAND(-depth) - 1), F.xxhash64(conv, depth, F.lit(round_)))


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) of every node, from (conv_id, depth, parent_conv_id, n_children, weight).

    A node is named by its smallest conversation and its depth.  ``leaves`` and
    ``saved`` of a row that is left hold the subtrees raked into it, ``link_leaves``
    and ``link_saved`` what was spliced out between it and its parent.
    """
    alive = nodes.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("pc"), (F.col("depth") - 1).alias("pd"),
                         F.col("n_children").alias("kids"), (F.col("n_children") == 0).cast("long").alias("leaves"), F.col("weight").alias("saved"),
                         F.lit(0).cast("long").alias("link_leaves"), F.lit(0).cast("long").alias("link_saved"))
    done, spliced, files, round_ = [], [], [], 0
    left = alive.limit(1).count()
    while left:
        round_ += 1
        leaf = F.col("kids") == 0
        done.append(alive.filter(leaf).select("c", "d", "leaves", "saved"))
        # what the children of a node say: sums over the leaves, and the only other child
        other = F.when(~leaf, F.struct("c", "d", "link_leaves", "link_saved"))
        said = alive.filter("pc IS NOT NULL").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(
            F.count_if(leaf).alias("gone"), F.sum(F.when(leaf, F.col("leaves") + F.col("link_leaves")).otherwise(0)).alias("more_leaves"),
            F.sum(F.when(leaf, F.col("saved") + F.col("link_saved")).otherwise(0)).alias("more_saved"), F.max(other).alias("child"))
        rest = alive.filter(~leaf).join(said, ["c", "d"]).withColumns({
            "kids": F.col("kids") - F.col("gone"), "leaves": F.col("leaves") + F.col("more_leaves"), "saved": F.col("saved") + F.col("more_saved")})
        # a chosen node ranks before its parent and its child, so no two neighbours are chosen
        own, up, down = (_rank(F.col(c), F.col(d), round_) for c, d in (("c", "d"), ("pc", "pd"), ("child.c", "child.d")))
        out = (F.col("kids") == 1) & F.col("pc").isNotNull() & (own < up) & (own < down)
        rest = spill(rest.withColumn("out", F.coalesce(out, F.lit(False))).drop("gone", "more_leaves", "more_saved"), "contracted")
        files.append(rest)
        gone = rest.filter("out").select(
            "c", "d", F.col("child.c").alias("to_c"), F.col("child.d").alias("to_d"), F.col("pc").alias("new_pc"), F.col("pd").alias("new_pd"),
            (F.col("leaves") + F.col("child.link_leaves")).alias("leaves"), (F.col("saved") + F.col("child.link_saved")).alias("saved"),
            F.col("link_leaves").alias("new_leaves"), F.col("link_saved").alias("new_saved"))
        spliced.append(gone.select("c", "d", "to_c", "to_d", "leaves", "saved"))
        links = gone.select(F.col("to_c").alias("c"), F.col("to_d").alias("d"), "new_pc", "new_pd", (F.col("leaves") + F.col("new_leaves")).alias("new_leaves"),
                            (F.col("saved") + F.col("new_saved")).alias("new_saved"))
        moved = F.col("new_pc").isNotNull()
        alive = rest.filter("NOT out").drop("out", "child").join(links, ["c", "d"], "left").select(
            "c", "d", F.coalesce("new_pc", "pc").alias("pc"), F.coalesce("new_pd", "pd").alias("pd"), "kids", "leaves", "saved",
            F.when(moved, F.col("new_leaves")).otherwise(F.col("link_leaves")).alias("link_leaves"),
            F.when(moved, F.col("new_saved")).otherwise(F.col("link_saved")).alias("link_saved"))
        alive = spill(alive, "alive")
        files.append(alive)
        left = alive.limit(1).count()
    totals = _expanded(done, spliced, nodes)
    for file in files:
        discard(file)
    return totals


def _expanded(done: list[DataFrame], spliced: list[DataFrame], nodes: DataFrame) -> DataFrame:
    """Totals of raked and of spliced nodes; a spliced one has that of the child it names, and what its row says."""
    if not done:
        return nodes.select("conv_id", "depth", F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    raked, links = done[0], spliced[0]
    for a, b in zip(done[1:], spliced[1:]):
        raked, links = raked.unionByName(a), links.unionByName(b)
    links, steps = spill(links, "spliced"), 1
    while steps < len(spliced):  # a chain of links goes through one node of each round at most
        steps *= 2
        next_ = links.select(F.col("c").alias("to_c"), F.col("d").alias("to_d"), F.col("to_c").alias("next_c"), F.col("to_d").alias("next_d"),
                             F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        joined = links.join(next_, ["to_c", "to_d"], "left").select(
            "c", "d", F.coalesce("next_c", "to_c").alias("to_c"), F.coalesce("next_d", "to_d").alias("to_d"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        before, links = links, spill(joined, "spliced")
        discard(before)
    below = raked.select(F.col("c").alias("to_c"), F.col("d").alias("to_d"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    whole = links.join(below, ["to_c", "to_d"]).select("c", "d", (F.col("leaves") + F.col("more_leaves")).alias("leaves"), (F.col("saved") + F.col("more_saved")).alias("saved"))
    return spill(raked.unionByName(whole).select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), "totals")


def prefix_trie(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each node of the trie of all rebuilt conversations.

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the root),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  A null role or text
    is empty; a null turn comes first, and rows of one turn are ordered by role and
    text; rows without conversation take no part.  Conversations that rebuild to no
    turn end at the root.  The first of a family is by division towards zero.  No
    conversation gives no row.
    """
    turns, conversations = rebuilt(ordered_turns(df, conv_id, turn, role, text))
    nodes = nodes_of(turns, spill(conversations, "lengths"))
    return nodes.join(subtree_totals(nodes), ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
