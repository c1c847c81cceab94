"""A prefix trie of conversations, built and searched as a distributed z-fast trie.

A conversation is a sequence of turns; a prefix of it is named by a 128-bit hash that is chained
turn by turn, so two prefixes are compared by comparing names. The trie is compacted: a node
stands for a whole edge, the prefixes from just below its parent down to its own (its extent),
and carries their names. Nodes are hashed at their handle, the prefix whose length is the 2-fattest
number (that divisible by the highest power of two) of the edge's lengths.

Conversations are inserted in batches. All that are not in the trie yet look for their exit node at
the same time by fat binary search: the prefix of 2-fattest length between what is known to be a
node and what is known to be too long is looked up among the handles, which takes one join
per halving, whatever the height of the trie. The one edge that leaves the node found in the
conversation's direction then tells where exactly it parts. A batch is one conversation for each
place and next turn at which any part from the trie; it gives a leaf, and the edges left in the middle
are cut there. The others go on below that place with the next batch. The choice within a batch is
by hash, so a path is entered anew about as often as the logarithm of the number of conversations.

Totals of subtrees come from the compacted nodes by pointer doubling; then the edges are expanded.
Equal conversations fold into one before all this. Every step is written to the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quaymill.llm.common import fold, scratch
from quaymill.sources.workspace import Scratch

NAME_BYTES = 16
GROUP = 100
FOLDS = 6

NODE = ["key", "depth", "parent", "start", "before", "keys", "sums"]


def _root() -> Column:
    """The name of the empty prefix."""
    return F.lit("").cast("binary")


# --- conversations --------------------------------------------------------------------------


def turn_lists(conversations: DataFrame) -> DataFrame:
    """Per conv_id its ``turns`` in order: name of role and text, and code points of the text.

    Ordered by turn, null first, ties by the name. Null roles and texts are empty. Texts are
    hashed where they are and not shuffled. A conversation must fit in a row, at about 40 bytes a
    turn.
    """
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    both = F.concat(F.sha2(role.cast("binary"), 256), F.sha2(text.cast("binary"), 256))
    name = F.unhex(F.left(F.sha2(both.cast("binary"), 256), F.lit(2 * NAME_BYTES)))
    turn = F.struct("turn", name.alias("name"), F.length(text).cast("long").alias("chars"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["name"], t["chars"])).alias("turns"))


def share_openings(lists: DataFrame, group: int = GROUP, folds: int = FOLDS) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c % group.

    h is the crc32 of c as text modulo ``folds``; a shorter opening is taken whole, an absent one
    is empty. A null conv_id keeps its turns.
    """
    first = lists.select(
        F.col("conv_id").alias("opener"), F.slice("turns", 1, folds - 1).alias("opening")
    ).where("opener IS NOT NULL")
    own = lists.withColumn("opener", F.col("conv_id") - F.col("conv_id") % group)
    own = own.withColumn("h", F.when(F.col("conv_id").isNull(), 0).otherwise(fold(F.col("conv_id"), folds)).cast("int"))
    joined = own.join(first, "opener", "left")
    none = F.slice("turns", 1, 0)
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    opening = F.slice(F.coalesce("opening", none), F.lit(1), F.col("h"))
    return joined.select("conv_id", F.concat(opening, rest).alias("turns"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name every prefix and add up its code points."""
    for batch in batches:
        paths, sums = [], []
        for names, chars in zip(batch.column("names").to_pylist(), batch.column("chars").to_pylist()):
            path, total, name, so_far = [], [], b"", 0
            for own, size in zip(names, chars):
                name = hashlib.blake2b(name + own, digest_size=NAME_BYTES).digest()
                so_far += size
                path.append(name)
                total.append(so_far)
            paths.append(path)
            sums.append(total)
        columns = [batch.column("conv_id"), pa.array(paths, pa.list_(pa.binary())), pa.array(sums, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "path", "sums"])


def _members(lists: DataFrame, space: Scratch) -> DataFrame:
    """place (a distinct number), conv_id, path, sums and the end of each conversation."""
    kind = lists.schema["conv_id"].dataType.simpleString()
    split = lists.select("conv_id", F.col("turns.name").alias("names"), F.col("turns.chars").alias("chars"))
    chained = split.mapInArrow(_chain, f"conv_id {kind}, path array<binary>, sums array<bigint>")
    numbered = chained.select(
        F.monotonically_increasing_id().alias("place"),
        "conv_id",
        "path",
        "sums",
        F.size("path").alias("size"),
        F.coalesce(F.try_element_at("path", F.lit(-1)), _root()).alias("end"),
    )
    return space.keep(numbered, "members")


# --- the compacted trie ---------------------------------------------------------------------


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    shift = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, shift), shift)


def _at(array: str, place: Column) -> Column:
    return F.try_element_at(array, place.cast("int"))


def _name_at(depth: Column) -> Column:
    return F.when(depth > 0, _at("path", depth)).otherwise(_root())


def _sum_at(depth: Column) -> Column:
    return F.when(depth > 0, _at("sums", depth)).otherwise(F.lit(0).cast("long"))


def _exits(pending: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """Append ``exit``, the depth at which each path leaves the trie, and ``edge``, the node cut there.

    ``pending`` has ``low``, the depth of a node on the path; ``longest`` is the largest distance
    from there to the end. ``edge`` is null where the path leaves at a node.
    """
    handle = two_fattest(F.col("start"), F.col("depth")) - F.col("start")
    handles = nodes.select(
        F.element_at("keys", handle.cast("int")).alias("handle"),
        F.col("key").alias("node"),
        F.col("start").alias("node_start"),
        F.col("depth").alias("node_depth"),
    )
    found = pending.withColumn("high", F.col("size"))
    for _ in range(longest.bit_length()):
        is_open = F.col("low") < F.col("high")
        found = found.withColumn("middle", F.when(is_open, two_fattest(F.col("low"), F.col("high"))))
        # A search that is over looks up its own end, so that no key gathers them.
        found = found.withColumn("handle", _at("path", F.coalesce("middle", "size")))
        found = found.join(handles, "handle", "left")
        hit = F.col("middle").isNotNull() & F.col("node").isNotNull()
        whole = hit & (F.col("node_depth") <= F.col("size")) & (_at("path", F.col("node_depth")) == F.col("node"))
        low = F.when(whole, F.col("node_depth")).when(hit, F.col("node_start")).otherwise(F.col("low"))
        high = (
            F.when(whole | ~is_open, F.col("high")).when(hit, F.col("node_start")).otherwise(F.col("middle") - 1)
        )
        found = found.withColumns({"new_low": low, "new_high": high}).select(
            "place", "size", "path", "sums", F.col("new_low").alias("low"), F.col("new_high").alias("high")
        )
    edges = nodes.select(
        F.col("keys")[0].alias("first"), F.col("key").alias("node"), F.col("depth").alias("node_depth"), "keys"
    )
    # Beyond the end of a path nothing is looked up; its own end is no first name of an edge below.
    found = found.withColumn("first", F.coalesce(_at("path", F.col("low") + 1), _at("path", F.col("size"))))
    found = found.join(edges, "first", "left")
    below = F.slice("path", F.col("low") + 1, F.greatest(F.size("keys"), F.lit(0)))
    alike = F.zip_with("keys", below, lambda a, b: F.coalesce(a == b, F.lit(False)))
    common = F.when(
        F.col("node").isNotNull() & (F.col("low") < F.col("size")), F.size(F.filter(alike, lambda same: same))
    ).otherwise(0)
    exit_depth = F.col("low") + common
    edge = F.when((common > 0) & (exit_depth < F.col("node_depth")), F.col("node"))
    return found.select("place", "size", "path", "sums", exit_depth.alias("exit"), edge.alias("edge"))


def _cut(nodes: DataFrame, left: DataFrame) -> DataFrame:
    """The nodes, those that are left in the middle of their edge cut at these depths."""
    cuts = left.where("edge IS NOT NULL").groupBy(F.col("edge").alias("key")).agg(F.collect_set("exit").alias("cuts"))
    # As many cuts as the edge has turns at most.
    depths = F.array_sort(F.concat(F.coalesce("cuts", F.array().cast("array<int>")), F.array("depth")))
    pieces = nodes.join(cuts, "key", "left").withColumn("depths", depths)
    starts = F.concat(F.array("start"), F.slice("depths", 1, F.size("depths") - 1))
    pairs = F.arrays_zip(starts.alias("from"), F.col("depths").alias("to"))
    pieces = pieces.withColumn("pairs", pairs).withColumn("piece", F.explode("pairs"))
    first, last = F.col("piece.from") - F.col("start"), F.col("piece.to") - F.col("start")
    is_top = first == 0
    return pieces.select(
        _at("keys", last).alias("key"),
        F.col("piece.to").alias("depth"),
        F.when(is_top, F.col("parent")).otherwise(_at("keys", F.greatest(first, F.lit(1)))).alias("parent"),
        F.col("piece.from").alias("start"),
        F.when(is_top, F.col("before")).otherwise(_at("sums", F.greatest(first, F.lit(1)))).alias("before"),
        F.slice("keys", first + 1, last - first).alias("keys"),
        F.slice("sums", first + 1, last - first).alias("sums"),
    )


def compacted_trie(members: DataFrame, space: Scratch) -> DataFrame:
    """The nodes below the root: NODE columns, one row per end of a path or place where paths part.

    ``members`` has place, path, sums, size and end.
    """
    # Equal conversations have one end; the first place stands for them.
    first = members.groupBy("end").agg(F.min("place").alias("place")).select("place")
    paths = members.where("size > 0").join(first, "place", "left_semi")
    pending = space.keep(paths.select("place", "size", "path", "sums", F.lit(0).alias("low")), "pending-0")
    nodes, turn = None, 0
    while True:
        longest = pending.agg(F.max(F.col("size") - F.col("low"))).first()[0]
        if longest is None:
            break
        if nodes is None:
            left = pending.select(
                "place", "size", "path", "sums", F.lit(0).alias("exit"), F.lit(None).cast("binary").alias("edge")
            )
        else:
            left = space.keep(_exits(pending, nodes, longest), f"exits-{turn}")
        goes_on = left.where(F.col("exit") < F.col("size"))
        # One conversation for each place and next turn; the name of the next prefix tells both.
        batch = goes_on.groupBy(_at("path", F.col("exit") + 1)).agg(F.min("place").alias("place")).select("place")
        batch = space.keep(batch, f"batch-{turn}")
        rest = F.col("size") - F.col("exit")
        leaves = goes_on.join(batch, "place", "left_semi").select(
            _at("path", F.col("size")).alias("key"),
            F.col("size").alias("depth"),
            _name_at(F.col("exit")).alias("parent"),
            F.col("exit").alias("start"),
            _sum_at(F.col("exit")).alias("before"),
            F.slice("path", F.col("exit") + 1, rest).alias("keys"),
            F.slice("sums", F.col("exit") + 1, rest).alias("sums"),
        )
        grown = leaves if nodes is None else _cut(nodes, left).unionByName(leaves)
        nodes = space.keep(grown.select(*NODE), f"nodes-{turn}")
        later = goes_on.join(batch, "place", "left_anti")
        later = later.select("place", "size", "path", "sums", F.col("exit").alias("low"))
        turn += 1
        pending = space.keep(later, f"pending-{turn}")
    if nodes is None:
        columns = "key binary, depth int, parent binary, start int, before bigint, keys array<binary>, sums array<bigint>"
        return members.sparkSession.createDataFrame([], columns)
    return nodes


# --- totals ---------------------------------------------------------------------------------

_SUMS = ("n_convs", "n_leaves", "member_chars", "edge_chars")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each end; rows come sorted by end and id."""
    end, state = None, None
    for batch in batches:
        ends, digests = [], []
        for own, conv_id in zip(batch.column("end").to_pylist(), batch.column("conv_id").to_pylist()):
            if own != end:
                if end is not None:
                    ends.append(end)
                    digests.append(state.hexdigest())
                end, state = own, hashlib.sha256(str(conv_id).encode())
            else:
                state.update(f",{conv_id}".encode())
        yield pa.RecordBatch.from_arrays([pa.array(ends, pa.binary()), pa.array(digests, pa.string())], ["end", "ends_sha256"])
    if end is not None:
        yield pa.RecordBatch.from_arrays([pa.array([end], pa.binary()), pa.array([state.hexdigest()])], ["end", "ends_sha256"])


def _ends(members: DataFrame, space: Scratch) -> DataFrame:
    """Per end: how many conversations, the smallest id, their code points, and the digest of their ids."""
    ends = members.groupBy("end").agg(
        F.count("*").alias("n"),
        F.min("conv_id").alias("least"),
        F.count("conv_id").alias("named"),
        F.sum(F.coalesce(F.try_element_at("sums", F.lit(-1)), F.lit(0).cast("long"))).alias("chars"),
    )
    ends = space.keep(ends, "ends")
    # A digest is a fold over all ids of an end in order: they stream through one task, which holds
    # one batch. Ends with a single id, most of them, need none of that.
    several = members.where("conv_id IS NOT NULL").select("end", "conv_id")
    # Written: a repartition by the key of a join below it is left out of the plan, and that join may
    # split a hot end over several tasks.
    several = space.keep(several.join(ends.where("named > 1").select("end"), "end", "left_semi"), "several")
    streamed = several.repartition("end").sortWithinPartitions("end", "conv_id")
    digests = streamed.mapInArrow(_digests, "end binary, ends_sha256 string")
    alone = F.sha2(F.coalesce(F.col("least").cast("string"), F.lit("")).cast("binary"), 256)
    return ends.join(digests, "end", "left").select(
        "end", "n", "least", "chars", F.coalesce("ends_sha256", alone).alias("ends_sha256")
    )


def _subtrees(tree: DataFrame, space: Scratch) -> DataFrame:
    """``tree`` (key, up, conv_id, sums) with each value taken over the node and all below it.

    Pointer doubling: after k rounds a node has added up 2**k generations, and ``up`` is its
    ancestor of that distance. Values fold before they are shuffled to a popular ancestor.
    """
    turn = 0
    while not tree.where("up IS NOT NULL").isEmpty():
        lower = tree.where("up IS NOT NULL")
        gained = lower.groupBy(F.col("up").alias("key")).agg(
            F.min("conv_id").alias("more_id"), *[F.sum(name).alias(f"more_{name}") for name in _SUMS]
        )
        higher = tree.select(F.col("key").alias("up"), F.col("up").alias("next"))
        ups = lower.select("key", "up").join(higher, "up").select("key", "next")
        joined = tree.join(gained, "key", "left").join(ups, "key", "left")
        none = F.lit(0).cast("long")
        tree = joined.select(
            "key",
            F.col("next").alias("up"),
            F.least("conv_id", "more_id").alias("conv_id"),
            *[(F.col(name) + F.coalesce(f"more_{name}", none)).alias(name) for name in _SUMS],
        )
        tree = space.keep(tree, f"subtrees-{turn}")
        turn += 1
    return tree


def build_trie(lists: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations' turns, the empty one included.

    ``lists`` is as from ``turn_lists``: conv_id and turns. The columns are conv_id (smallest
    member; null if no member has an id), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens (over the subtree: members but one, times the code points of the
    last text), ends_sha256 (of the ids of conversations that end here, in order, comma-joined;
    a null id counts as a member and is not listed) and name, the hash that identifies the prefix.
    A conversation without turns is a member of the root. Rows with one conv_id are one
    conversation. An empty table has no prefix and gives no rows.
    """
    space = scratch(lists.sparkSession, "trie")
    members = _members(lists, space)
    nodes = compacted_trie(members, space)
    kind = members.schema["conv_id"].dataType
    root = members.agg(F.count("*").alias("n")).where("n > 0").select(
        _root().alias("key"),
        F.lit(0).alias("depth"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).alias("start"),
        F.lit(0).cast("long").alias("before"),
        F.array(_root()).alias("keys"),
        F.array(F.lit(0).cast("long")).alias("sums"),
    )
    nodes = nodes.unionByName(root)
    ends = _ends(members, space).withColumnRenamed("end", "key")
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("children"))
    none = F.lit(0).cast("long")
    # Written with their own values, so that sums and joins over them can split a popular node.
    nodes = nodes.join(ends, "key", "left").join(children, "key", "left").select(
        *NODE,
        F.col("least").cast(kind).alias("least"),
        F.coalesce("n", none).alias("n"),
        F.coalesce("chars", none).alias("chars"),
        F.coalesce("children", none).alias("children"),
        F.coalesce("ends_sha256", F.sha2(_root(), 256)).alias("ends_sha256"),
    )
    nodes = space.keep(nodes, "compacted")
    tree = nodes.select(
        "key",
        F.col("parent").alias("up"),
        F.col("least").alias("conv_id"),
        F.col("n").alias("n_convs"),
        (F.col("children") == 0).cast("long").alias("n_leaves"),
        F.col("chars").alias("member_chars"),
        (F.element_at("sums", -1) - F.col("before")).alias("edge_chars"),
    )
    totals = space.keep(_subtrees(tree, space).drop("up"), "totals")
    above = totals.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    return _expanded(nodes.join(totals, "key").join(above, "parent", "left"))


def _expanded(nodes: DataFrame) -> DataFrame:
    """All prefixes along the edges; those above the last share its members."""
    count = F.size("keys")
    along = nodes.select(
        "*", F.posexplode(F.arrays_zip("keys", F.concat(F.array("before"), F.slice("sums", 1, count - 1)).alias("upto")))
        .alias("step", "turn")
    )
    is_last, is_first = F.col("step") == count - 1, F.col("step") == 0
    upto = F.col("turn.upto")
    # Every member's code points from here on, less those of each prefix below once.
    saved = F.col("member_chars") - F.col("n_convs") * upto - (F.col("edge_chars") - (upto - F.col("before")))
    return along.select(
        "conv_id",
        (F.when(F.col("depth") == 0, 0).otherwise(F.col("start") + F.col("step") + 1)).cast("long").alias("depth"),
        F.when(is_first, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(is_last, F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        "n_leaves",
        saved.alias("saved_tokens"),
        F.when(is_last, F.col("ends_sha256")).otherwise(F.sha2(_root(), 256)).alias("ends_sha256"),
        F.col("turn.keys").alias("name"),
    )
