"""The trie of shared conversation prefixes, by ROLLUP over positional turn columns.

Every turn becomes one id (the digest of role and text, with the text's length in
code points). A conversation is a row of ``FIRST_BLOCK`` positional id columns, and
one ROLLUP over (node, t1, .., tK) aggregates all its prefixes together;
``grouping_id`` tells how long the prefix of a group is. Conversations that go on
and share their prefix with another one continue in a further block of
``NEXT_BLOCK`` columns, whose ``node`` is the node that the block before ended in.
A prefix of one conversation alone has a single path below it, which is written
down at once, whatever its length. Sums over subtrees come from a second ROLLUP
over the nodes, from the last block back to the first.

A node is named by its depth and its smallest member: nodes of one depth share no
member. Numbers of turns inside one conversation come from a range partitioning
by (conversation, turn), so that a very long conversation spreads over many tasks.
The digest of a node's ended members is read as a stream of chunks in order; that
stream is all a single task sees of a node, however many end there.

Defined cases: a null role or text is empty; a null turn is first; turns with one
number follow each other by role, then by digest; repeated rows are turns of their
own; the remainder of a negative id has its sign, as in SQL; a null conversation id
is one conversation that sorts after all others, takes no turns of another and is
written ``null``; an empty table has no nodes, as the
root has no member; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderloom.llm.common import NULL_ID, id_order, stored

FIRST_BLOCK = 8
NEXT_BLOCK = 32
#: heads have fewer turns than this
HEADS = 6
FAMILY = 100
#: ids in one chunk of a node's ended members
CHUNK = 4096


def turn_ids(turns: DataFrame) -> DataFrame:
    """conv, turn, role, tid: the id of (role, text) ends in the code points of the text."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return turns.select(id_order(F.col("conv_id").cast("long")).alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        F.concat(digest, F.lit(":"), F.length(text).cast("string")).alias("tid"))


def numbered(turns: DataFrame) -> DataFrame:
    """conv, pos (from 0), tid. Ranges of (conversation, turn) are numbered alone; what a conversation
    has in earlier ranges is added."""
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("tid").asc()]
    ranged = stored(turn_ids(turns).repartitionByRange(F.col("conv").asc(), *order)
                    .withColumn("range", F.spark_partition_id()), "trie-turns")
    here = F.row_number().over(Window.partitionBy("range", "conv").orderBy(*order)) - 1
    parts = ranged.groupBy("conv", "range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("range")) - F.col("n")
    # at most one conversation goes on from the ranges before into each range
    went_on = parts.select("conv", "range", before.alias("before")).where("before > 0")
    return (ranged.withColumn("here", here).join(F.broadcast(went_on), ["conv", "range"], "left")
            .select("conv", (F.col("here") + F.coalesce("before", F.lit(0))).cast("long").alias("pos"), "tid"))


def head_size(conv: Column) -> Column:
    """How many turns a conversation takes from the first one of its family."""
    known = F.crc32(conv.cast("string").cast("binary")) % HEADS
    return F.when(conv != NULL_ID, known).otherwise(F.lit(0)).cast("long")


def first_of_family(conv: Column) -> Column:
    return F.when(conv != NULL_ID, conv - conv % FAMILY)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, tid) and (conv, len) of the rebuilt conversations, turnless ones too."""
    own = stored(numbered(turns), "trie-numbered")
    convs = own.select("conv").distinct()
    # fewer than HEADS turns of one conversation in a hundred
    heads = own.where((F.col("pos") < HEADS - 1) & (F.col("conv") == first_of_family(F.col("conv"))))
    taken = (convs.select(F.col("conv").alias("to"), first_of_family(F.col("conv")).alias("conv"), head_size(F.col("conv")).alias("h"))
             .join(heads, "conv").where("pos < h").select(F.col("to").alias("conv"), "pos", "tid"))
    sizes = heads.groupBy("conv").agg(F.count("*").alias("there")).withColumnRenamed("conv", "first")
    h = head_size(F.col("conv"))
    rest = (own.where(F.col("pos") >= h).withColumn("first", first_of_family(F.col("conv"))).join(sizes, "first", "left")
            .select("conv", (F.col("pos") - h + F.least(h, F.coalesce("there", F.lit(0)))).alias("pos"), "tid"))
    whole = stored(taken.unionByName(rest), "trie-rebuilt")
    lengths = stored(convs.join(whole.groupBy("conv").agg(F.count("*").alias("len")), "conv", "left")
                     .select("conv", F.coalesce("len", F.lit(0)).alias("len")), "trie-lengths")
    return whole, lengths


def _start(block: int) -> int:
    return 0 if block == 0 else FIRST_BLOCK + (block - 1) * NEXT_BLOCK


def _width(block: int) -> int:
    return FIRST_BLOCK if block == 0 else NEXT_BLOCK


def _key(node: Column, ids: Column) -> Column:
    return F.md5(F.concat_ws(",", node.cast("string"), ids))


def _ids(width: int) -> Column:
    return F.array_compact(F.array(*[f"t{i}" for i in range(1, width + 1)]))


def _rollup(rows: DataFrame, width: int, *sums: Column) -> DataFrame:
    """node, d, ids and ``sums`` of every prefix of the block's columns: the groups whose d columns are all there."""
    columns = [f"t{i}" for i in range(1, width + 1)]
    groups = rows.rollup("node", *columns).agg(*sums, F.grouping_id().alias("gid"))
    return (groups.withColumn("d", F.lit(width) - F.bit_count("gid")).withColumn("ids", _ids(width))
            .where((F.col("d") >= 0) & (F.size("ids") == F.col("d"))).drop("gid", *columns))


def _block_rows(live: DataFrame, blocks: DataFrame, block: int) -> DataFrame:
    """live conversations with their turn columns of one block."""
    width = _width(block)
    own = blocks.where(F.col("block") == block).select("conv", "ids")
    return live.join(own, "conv", "left").select(
        "conv", "node", "len", *[F.get("ids", F.lit(i)).alias(f"t{i + 1}") for i in range(width)])


def _last_length(ids: Column) -> Column:
    return F.coalesce(F.substring_index(F.try_element_at(ids, F.lit(-1)), ":", -1).cast("long"), F.lit(0))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    whole, lengths = rebuilt(turns)
    place = F.when(F.col("pos") < FIRST_BLOCK, 0).otherwise(1 + F.floor((F.col("pos") - FIRST_BLOCK) / NEXT_BLOCK))
    # at most NEXT_BLOCK turns in a group
    grouped = whole.groupBy("conv", place.cast("int").alias("block")).agg(F.sort_array(F.collect_list(F.struct("pos", "tid"))).alias("turns"))
    blocks = stored(grouped.select("conv", "block", F.col("turns.tid").alias("ids")), "trie-blocks")

    live = lengths.select("conv", F.lit(0).cast("long").alias("node"), "len")
    levels, ended, alone, block = [], [], [], 0
    while block == 0 or not live.isEmpty():
        start, width = _start(block), _width(block)
        rows = stored(_block_rows(live, blocks, block), "trie-rows")
        groups = _rollup(rows, width, F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("len").alias("longest"))
        nodes = groups.select(
            "node", "d", "ids", "conv", "n_convs", "longest", _key(F.col("node"), F.col("ids")).alias("key"),
            F.when(F.col("d") > 0, _key(F.col("node"), F.slice("ids", F.lit(1), F.greatest(F.col("d") - 1, F.lit(0))))).alias("above"))
        nodes = stored(nodes, "trie-nodes")
        ups = nodes.where("d > 0").select(F.col("key").alias("above"), F.col("conv").alias("up"))
        if block == 0:
            root = nodes.where("d = 0").first()
            top = F.lit(root.conv if root else None).cast("long")
        else:
            top = F.col("node")
        parent = F.when(F.col("d") == 1, top).when(F.col("d") > 1, F.col("up"))
        nodes = stored(nodes.join(ups, "above", "left")
                       .select("node", "d", "ids", "key", "conv", "n_convs", "longest", parent.alias("parent")), "trie-parents")
        levels.append(nodes)
        # the node that each conversation ends in, or leaves the block by
        out = (rows.select("conv", "len", _key(F.col("node"), _ids(width)).alias("key"))
               .join(nodes.select("key", F.col("conv").alias("at"), "n_convs"), "key"))
        out = stored(out.select("conv", "len", "at", "n_convs"), "trie-out")
        ended.append(out.where(F.col("len") <= start + width).select(F.col("len").alias("depth"), "at", "conv"))
        goes_on = out.where(F.col("len") > start + width)
        alone.append(goes_on.where("n_convs = 1").select("conv", "len", F.lit(start + width).alias("from")))
        live = goes_on.where("n_convs > 1").select("conv", F.col("at").alias("node"), "len")
        block += 1

    nodes = _with_subtrees(levels)
    single = _single_paths(whole, _all(alone))
    children = (nodes.where("parent IS NOT NULL").select((F.col("depth") - 1).alias("depth"), F.col("parent").alias("conv"))
                .unionByName(single.where("first").select((F.col("depth") - 1).alias("depth"), "conv"))
                .groupBy("depth", "conv").agg(F.count("*").alias("n_children")))
    nodes = (nodes.join(children, ["depth", "conv"], "left")
             .select("conv", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens"))
    digests = ends_digests(_all(ended))
    nodes = nodes.join(digests, ["conv", "depth"], "left").unionByName(single.drop("first"))
    empty = hashlib.sha256(b"").hexdigest()
    known = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return nodes.select(known("conv").alias("conv_id"), "depth", known("parent").alias("parent_conv_id"), "n_convs", "n_children",
                        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def _all(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for more in frames[1:]:
        whole = whole.unionByName(more)
    return whole


def _with_subtrees(levels: list[DataFrame]) -> DataFrame:
    """The nodes of all blocks with leaves and saved tokens of their subtrees, from the last block to the first."""
    found, below = [], None
    for block in reversed(range(len(levels))):
        start, width, nodes = _start(block), _width(block), levels[block]
        depth = F.lit(start) + F.col("d")
        leaf = F.col("longest") == depth
        # below a block's end: the sums of the next block, or one path alone
        path = (F.col("d") == width) & ~leaf & (F.col("n_convs") == 1)
        saved = F.when(depth > 0, (F.col("n_convs") - 1) * _last_length(F.col("ids"))).otherwise(F.lit(0))
        rows = nodes.select("node", "d", "conv", (leaf | path).cast("long").alias("leaves"), saved.alias("saved"),
                            *[F.get("ids", F.lit(i)).alias(f"t{i + 1}") for i in range(width)])
        if below is not None:
            more = below.select(F.col("node").alias("conv"), F.lit(width).alias("d"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
            rows = (rows.join(more, ["conv", "d"], "left")
                    .withColumns({"leaves": F.col("leaves") + F.coalesce("l", F.lit(0)), "saved": F.col("saved") + F.coalesce("s", F.lit(0))}))
        sums = stored(_rollup(rows, width, F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
                      .withColumn("key", _key(F.col("node"), F.col("ids"))).select("key", "node", "d", "leaves", "saved"), "trie-sums")
        below = sums.where("d = 0") if block else None
        own = nodes if block == 0 else nodes.where("d > 0")
        found.append(own.join(sums.select("key", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), "key")
                     .select("conv", depth.cast("long").alias("depth"), "parent", "n_convs", "n_leaves", "saved_tokens"))
    return stored(_all(found), "trie-subtrees")


def _single_paths(whole: DataFrame, alone: DataFrame) -> DataFrame:
    """The nodes below a block's end that one conversation passes alone: each has it as its only member."""
    last = F.col("depth") == F.col("len")
    own = F.when(F.col("conv") == NULL_ID, F.lit("null")).otherwise(F.col("conv").cast("string"))
    return (whole.join(alone, "conv").where(F.col("pos") >= F.col("from"))
            .select("conv", (F.col("pos") + 1).cast("long").alias("depth"), "len", (F.col("pos") == F.col("from")).alias("first"))
            .select("conv", "depth", F.col("conv").alias("parent"), F.lit(1).cast("long").alias("n_convs"),
                    (~last).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
                    F.when(last, F.sha2(own.cast("binary"), 256)).alias("ends_sha256"), "first"))


def ends_digests(ended: DataFrame) -> DataFrame:
    """conv, depth, ends_sha256 of the nodes (depth, at) that members end in. Ids in order are joined into
    chunks where they lie; the chunks of a node pass one hash in order, one at a time."""
    ordered = ended.repartitionByRange("depth", "at", "conv").sortWithinPartitions("depth", "at", "conv")

    def chunks(batches):
        def made(at, ids):
            text = ",".join("null" if i == NULL_ID else str(i) for i in ids)
            return pa.RecordBatch.from_pylist([{"depth": at[0], "at": at[1], "first": ids[0], "text": text}], schema=chunk_schema)

        at, ids = None, []
        for batch in batches:
            for depth, node, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (at != (depth, node) or len(ids) == CHUNK):
                    yield made(at, ids)
                    ids = []
                at = depth, node
                ids.append(conv)
        if ids:
            yield made(at, ids)

    chunk_schema = pa.schema([("depth", pa.int64()), ("at", pa.int64()), ("first", pa.int64()), ("text", pa.string())])
    pieces = ordered.select(F.col("depth").cast("long"), "at", "conv").mapInArrow(chunks, "depth long, at long, first long, text string")

    def digests(batches):
        at, done = None, None
        for batch in batches:
            found = []
            for depth, node, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if at != (depth, node):
                    if at:
                        found.append((*at, done.hexdigest()))
                    at, done = (depth, node), hashlib.sha256(text.encode())
                else:
                    done.update(b"," + text.encode())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), digest_types)], names=["depth", "conv", "ends_sha256"])
        if at:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*at, done.hexdigest()), digest_types)],
                                             names=["depth", "conv", "ends_sha256"])

    digest_types = [pa.int64(), pa.int64(), pa.string()]
    out = T.StructType([T.StructField("depth", T.LongType()), T.StructField("conv", T.LongType()), T.StructField("ends_sha256", T.StringType())])
    return pieces.repartition("depth", "at").sortWithinPartitions("depth", "at", "first").mapInArrow(digests, out)
