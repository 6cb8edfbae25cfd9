"""The prefix trie of conversations: each distinct beginning of turns is a node.

Method (burst trie): conversations are suffixes in a container under a trie head, at first all
under the root. A container that holds more than ``limit`` turns bursts: its head moves along the
turns that all its suffixes share, and each next turn id becomes the head of a container of its own.
When none is too large, containers are dealt over tasks, sorted, and swept into nodes; totals then
go up from the containers to the heads that burst, round by round.

A turn is a 128-bit hash of its role and text, beside its words: texts are not moved. Equal
conversations are one suffix with a count, so a conversation that many copy, or a first turn that many
share, is no task's burden. Turns are numbered by ranges of all turns and not per conversation, and a
conversation of more than ``block`` turns is cut into blocks: a block's container lies under the
beginning before it, and levels of blocks are swept from the last to the first. So no task holds more
than a block or a container. The ids of conversations that end in a node are joined in runs of bounded
length and hashed in a stream, as SHA-256 has to read them in order.

Turns are ordered by turn, null ones first; those of one number by their hash. A null role or text is
empty. Rows without a conv_id belong to no conversation and are left out. Repeated rows are turns of their
own. An empty table has no node, not even the root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakeloom.llm.rows import materialise, numbered, tasks
from lakeloom.operators.spread import spread_join

#: Turns of a container beyond which it bursts.
LIMIT = 2_000
#: Turns of a conversation that are held at once.
BLOCK = 1_024
#: Conversation ids joined to one string before they are hashed.
IDS = 4_096
NO_IDS = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0 on), id (of role and text) and words of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length before the role tells where it ends
    both = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(both, 256), 1, 32)).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.asc_nulls_first("turn"), F.asc("id"), F.asc("row")]
    return numbered(rows, order, "place", by=["conv_id"], purpose="turns").select("conv_id", "place", "id", "words")


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, place, id, words) of the rebuilt conversations, and the length of each, also of those without turns.

    The first h turns of c are those of c - c % group; h is the CRC-32 of c in decimals, modulo ``most``.
    """
    conv = F.col("conv_id")
    taken = F.crc32(conv.cast("string").cast("binary")) % most
    firsts = (
        turns.filter(F.col("place") < most - 1)
        .groupBy(conv.alias("from"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "id", "words"))).alias("firsts"))  # at most most - 1 turns
    )
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumn("h", taken)
    convs = spread_join(convs.withColumn("from", conv - conv % group), firsts, ["from"], "left")
    held = F.least("h", F.coalesce(F.size("firsts"), F.lit(0))).cast("long")
    convs = convs.withColumn("held", held).select(
        "conv_id", "held", (F.col("h") - held).alias("gap"), F.slice("firsts", F.lit(1), held.cast("int")).alias("firsts"),
        (held + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"),
    )
    convs = materialise(convs, "conversations")
    heads = convs.filter("held > 0").select("conv_id", F.inline("firsts"))
    gaps = convs.filter("gap > 0").select("conv_id", "gap")
    own = spread_join(turns.filter(F.col("place") >= taken), gaps, ["conv_id"], "left", by=["conv_id", "place"])
    own = own.withColumn("place", F.col("place") - F.coalesce("gap", F.lit(0)))
    columns = ["conv_id", "place", "id", "words"]
    return heads.select(columns).unionByName(own.select(columns)), convs.select("conv_id", "length")


def _blocks(turns: DataFrame, lengths: DataFrame, block: int) -> tuple[DataFrame, int]:
    """Rows of conversations cut into blocks, and how many levels of them there are.

    conv_id, level, head (what came before), ids and words of the block's turns, top (words of the turn before), and under
    (the head of what follows, if the block is full). A block that is full is always followed by one, be it empty.
    """
    number = F.floor(F.col("place") / block)
    ordered = F.sort_array(F.collect_list(F.struct("place", "id", "words")))  # at most a block
    cut = turns.groupBy("conv_id", number.alias("level")).agg(ordered.alias("turns"))
    full = cut.select(
        "conv_id", "level", F.transform("turns", lambda t: t["id"]).alias("ids"), F.transform("turns", lambda t: t["words"]).alias("words")
    )
    ended = lengths.filter(F.col("length") % block == 0).select(
        "conv_id", F.floor(F.col("length") / block).alias("level"), F.array().cast("array<binary>").alias("ids"),
        F.array().cast("array<bigint>").alias("words"),
    )
    rows = full.unionByName(ended)
    levels = 1 + (lengths.agg(F.max("length")).first()[0] or 0) // block
    if levels == 1:
        nothing = F.lit(None).cast("binary")
        return rows.select("conv_id", "level", F.lit(b"").alias("head"), "ids", "words", F.lit(0).cast("long").alias("top"), nothing.alias("under")), 1
    # a beginning's key: its blocks' hashes, each with its number, so that their order counts
    path = W.partitionBy("conv_id").orderBy("level")
    hashes = [F.xxhash64("ids", "level", F.lit(seed)) for seed in (1, 2)]
    rows = rows.withColumns({f"h{i}": h for i, h in enumerate(hashes)})
    rows = rows.withColumns({f"p{i}": F.bit_xor(f"h{i}").over(path.rowsBetween(W.unboundedPreceding, 0)) for i in range(2)})
    rows = rows.withColumn("top", F.coalesce(F.lag(F.try_element_at(F.col("words"), F.lit(-1))).over(path), F.lit(0).cast("long")))

    def key(level: Column, first: Column, second: Column) -> Column:
        return F.unhex(F.md5(F.concat_ws(":", level, first, second)))

    p0, p1 = F.col("p0"), F.col("p1")
    before = key(F.col("level"), p0.bitwiseXOR(F.col("h0")), p1.bitwiseXOR(F.col("h1")))
    under = F.when(F.size("ids") == block, key(F.col("level") + 1, p0, p1))
    head = F.when(F.col("level") == 0, F.lit(b"")).otherwise(before)
    return rows.select("conv_id", "level", head.alias("head"), "ids", "words", "top", under.alias("under")), levels


def _hashed_ends(members: DataFrame) -> DataFrame:
    """key and the SHA-256 of its conv_ids, ascending and comma-joined; members: key, conv_id, each pair once."""
    placed = numbered(members, [F.asc("conv_id")], "place", by=["key"], purpose="members")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")  # at most IDS
    runs = placed.groupBy("key", F.floor(F.col("place") / IDS).alias("run")).agg(joined.alias("ids"))
    runs = materialise(runs, "id-runs")
    long = runs.filter("run > 0").select("key").distinct()

    def digest(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in frames:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pa.RecordBatch.from_pylist([{"key": k, "ends": e} for k, e in done], schema=_ENDS)
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"key": key, "ends": state.hexdigest()}], schema=_ENDS)

    many = spread_join(runs, long, ["key"], "left_semi", by=["key"]).repartition(tasks(members), "key").sortWithinPartitions("key", "run")
    one = spread_join(runs, long, ["key"], "left_anti", by=["key"]).select("key", F.sha2("ids", 256).alias("ends"))
    return one.unionByName(many.select("key", "ids").mapInArrow(digest, "key binary, ends string"))


_ENDS = pa.schema([("key", pa.binary()), ("ends", pa.string())])


def _suffixes(blocks: DataFrame, block: int) -> DataFrame:
    """Equal blocks under one head as one: level, head, ids, words, top, under, n (conversations), least and ends."""
    path = F.concat_ws(",", F.hex("head"), F.array_join(F.transform("ids", F.hex), ","))
    keyed = materialise(blocks.withColumn("key", F.unhex(F.md5(path))), "blocks")
    kept = ["level", "head", "ids", "words", "top", "under"]
    groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), *(F.first(c).alias(c) for c in kept))
    ends = _hashed_ends(keyed.filter(F.size("ids") < block).select("key", "conv_id"))
    rows = spread_join(groups, ends, ["key"], "left").drop("key")
    return rows.withColumn("parent", F.lit(None).cast("binary")).withColumn("skip", F.lit(0))


def _burst(rows: DataFrame, limit: int) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Suffixes in containers of at most ``limit`` turns, or one suffix; the heads that burst and the suffixes that end
    at one, round by round."""
    heads, stops = [], []
    while True:
        ends = F.struct("ids", "words")
        sizes = rows.groupBy("head").agg(
            F.sum(F.size("ids") - F.col("skip")).alias("turns"), F.min(ends).alias("lo"), F.max(ends).alias("hi"), F.count(F.lit(1)).alias("rows"),
            F.first("parent").alias("parent"), F.first("skip").alias("skip"), F.first("top").alias("top"),
        )
        equal = F.zip_with("lo.ids", "hi.ids", lambda a, b: F.coalesce(a == b, F.lit(False)))
        over = sizes.filter((F.col("turns") > limit) & (F.col("rows") > 1)).select(
            "head", "parent", "skip", "top", (F.array_position(equal, False) - 1).cast("int").alias("shared"), F.col("lo.words").alias("path")
        )
        over = materialise(over, "burst-heads")
        if over.isEmpty():
            return rows, heads, stops
        heads.append(over)
        marked = spread_join(rows, over.select("head", "shared"), ["head"], "left", by=["head"])
        here = F.size("ids") > F.col("shared")
        following = F.unhex(F.md5(F.concat(F.col("head"), F.try_element_at("ids", F.col("shared") + 1))))
        moved = (
            marked.filter(F.col("shared").isNull() | here)
            .withColumn("parent", F.when(here, F.col("head")).otherwise(F.col("parent")))
            .withColumn("skip", F.when(here, F.col("shared") + 1).otherwise(F.col("skip")))
            .withColumn("head", F.when(here, following).otherwise(F.col("head")))
        )
        marked_stops = marked.filter(F.col("shared").isNotNull() & ~here)
        stops.append(materialise(marked_stops.select("head", "n", "least", "ends"), "stops"))
        rows = materialise(moved.drop("shared"), "containers")


_NODE = (
    "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
    "head binary, parent binary, under binary"
)
_NODE_ARROW = pa.schema(
    [(f.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]) for f in _NODE.split(", ")]
)


def sweep_container(rows: list[dict]) -> list[dict]:
    """The nodes of a container's suffixes, sorted by their ids.

    The first is the node of the head; it names head and parent. A suffix with ``under`` ends in the head of another
    container, whose totals it brings: in place of that node comes a row that names the node above it.
    """
    first = rows[0]
    skip = first["skip"]
    depth, above, words = [skip], [-1], [first["words"][skip - 1] if skip else first["top"]]
    n, least, ends, beyond = [0], [None], [None], [None]
    path, last = [0], first["ids"][:skip]
    for row in rows:
        ids = row["ids"]
        shared, most = skip, min(len(ids), len(last))
        while shared < most and ids[shared] == last[shared]:
            shared += 1
        del path[shared - skip + 1 :]
        for at in range(shared, len(ids)):
            depth.append(at + 1)
            above.append(path[-1])
            words.append(row["words"][at])
            n.append(0)
            least.append(None)
            ends.append(None)
            beyond.append(None)
            path.append(len(depth) - 1)
        node, last = path[-1], ids
        n[node], least[node], ends[node] = row["n"], row["least"], row["ends"]
        beyond[node] = row if row["under"] is not None else None
    count = len(depth)
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    for node in range(count - 1, -1, -1):  # what is below a node was made after it
        if beyond[node]:
            leaves[node], saved[node] = beyond[node]["under_leaves"], beyond[node]["under_saved"]
        else:
            leaves[node] = leaves[node] or 1
            saved[node] += (n[node] - 1) * words[node]
        up = above[node]
        if up >= 0:
            n[up] += n[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    out = []
    for node in range(count):
        top, row = node == 0, beyond[node]
        out.append(
            {
                "conv_id": least[node], "depth": depth[node], "parent_conv_id": None if top else least[above[node]], "n_convs": n[node],
                "n_children": children[node], "n_leaves": leaves[node], "saved_tokens": saved[node], "ends": ends[node],
                "head": first["head"] if top else None, "parent": first["parent"] if top else None, "under": row["under"] if row else None,
            }
        )
    return out


def _sweep(rows: DataFrame) -> DataFrame:
    """Nodes of all containers: those are dealt over the tasks by head and come one after the other."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in frames:
            out: list[dict] = []
            for row in batch.to_pylist():
                if held and held[0]["head"] != row["head"]:
                    out += sweep_container(held)
                    held = []
                held.append(row)
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_pylist(out, schema=_NODE_ARROW)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=_NODE_ARROW)
        if held:
            yield pa.RecordBatch.from_pylist(sweep_container(held), schema=_NODE_ARROW)

    return rows.repartition(tasks(rows), "head").sortWithinPartitions("head", "ids").mapInArrow(run, _NODE)


_TOTALS = ["conv_id", "n_convs", "n_leaves", "saved_tokens"]


def _head_nodes(heads: DataFrame, stops: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of heads that burst in one round, from the tops of the containers and heads below them."""
    below = tops.filter(F.col("parent").isNotNull()).groupBy("parent").agg(
        F.min("conv_id").alias("least"), F.sum("n_convs").alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
        F.count(F.lit(1)).alias("children"),
    )
    known = spread_join(heads, below.withColumnRenamed("parent", "head"), ["head"], "inner")
    stop = stops.select("head", F.col("n").alias("stopped"), F.col("least").alias("stop_least"), "ends")
    known = spread_join(known, stop, ["head"], "left")
    known = known.withColumn("n", F.col("n") + F.coalesce("stopped", F.lit(0))).withColumn("least", F.least("least", "stop_least"))
    node = known.select("*", F.explode(F.sequence("skip", "shared")).alias("depth"))
    is_top, is_last = F.col("depth") == F.col("skip"), F.col("depth") == F.col("shared")
    # the words of the nodes from this one on to the last of the head
    words = F.slice("path", F.greatest(F.col("depth"), F.lit(1)), F.col("shared") - F.greatest(F.col("depth"), F.lit(1)) + 1)
    own = F.aggregate(words, F.when(F.col("depth") == 0, F.col("top")).otherwise(F.lit(0)).cast("long"), lambda a, w: a + w)
    return node.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.when(~is_top, F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(is_last, F.col("children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + (F.col("n") - 1) * own).alias("saved_tokens"),
        F.when(is_last, F.col("ends")).alias("ends"),
        F.when(is_top, F.col("head")).alias("head"),
        F.when(is_top, F.col("parent")).alias("parent"),
        F.lit(None).cast("binary").alias("under"),
    )


def prefix_trie(conversations: DataFrame, group: int = 20, most: int = 4, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256.

    limit, block: see above; they change no result.
    """
    turns, lengths = rebuilt(turns_of(conversations), group, most)
    blocks, levels = _blocks(turns, lengths, block)
    suffixes = _suffixes(blocks, block)
    if levels > 1:
        suffixes = materialise(suffixes, "suffixes")
    found: list[DataFrame] = []
    under: DataFrame | None = None  # totals of the containers one level deeper
    for level in range(levels - 1, -1, -1):
        rows = suffixes.filter(F.col("level") == level) if levels > 1 else suffixes
        totals = ["under_leaves", "under_saved"]
        if under is None:
            rows = rows.withColumns({c: F.lit(None).cast("long") for c in totals})
        else:
            rows = spread_join(rows, under, ["under"], "left", by=["head", "ids"])
        rows, heads, stops = _burst(materialise(rows, "containers"), limit)
        parts = [materialise(_sweep(rows), "nodes")]
        for burst, stopped in zip(reversed(heads), reversed(stops), strict=True):
            tops = reduce(DataFrame.unionByName, (p.filter("head IS NOT NULL") for p in parts))
            parts.append(materialise(_head_nodes(burst, stopped, tops), "head-nodes"))
        nodes = reduce(DataFrame.unionByName, parts)
        if heads:
            burst = reduce(DataFrame.unionByName, parts[1:]).filter("head IS NOT NULL")
            least = burst.select(F.col("head").alias("parent"), F.col("conv_id").alias("above"))
            nodes = spread_join(nodes, least, ["parent"], "left", by=["conv_id", "depth"])
            nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).drop("above")
        nodes = materialise(nodes.withColumn("depth", F.col("depth") + F.lit(level * block)).withColumn("level", F.lit(level)), "level-nodes")
        found.append(nodes)
        tops = nodes.filter("head IS NOT NULL AND parent IS NULL")
        under = tops.select(F.col("head").alias("under"), F.col("n_leaves").alias("under_leaves"), F.col("saved_tokens").alias("under_saved"))
    nodes = reduce(DataFrame.unionByName, found)
    if levels > 1:  # the node above a deeper container's top is in the level before
        links = nodes.filter("under IS NOT NULL").select(F.col("under").alias("head"), F.col("parent_conv_id").alias("above"))
        nodes = spread_join(nodes.filter("under IS NULL"), links, ["head"], "left", by=["conv_id", "depth"])
        nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return nodes.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(NO_IDS)).alias("ends_sha256"),
    )
