"""Conversation prefix trie: every distinct beginning of a conversation with what shares it, by Spark SQL's ROLLUP.

A turn has an id of two 64-bit hashes of its role and text. Conversations are cut into blocks of :data:`BLOCK` turns;
one row holds the turn ids of a block in positional columns, and the node at which the block before ended. ``GROUP BY
block, prior, ROLLUP (t1 .. t8)`` with ``grouping_id()`` then aggregates all prefixes of all blocks in one pass, with
partial aggregation before the shuffle. A node is known by its depth and the exclusive or of its turn ids, each hashed
with its place; that is associative, so the node before every block comes from prefix sums, and conversations of any
length need no further pass.

What a node says of its subtree is a sum over its members, so no tree is walked: let s be the depth from which on a
conversation is the smallest member of its nodes, found by a first ROLLUP. Then a node is childless if its longest
member ends there; each leaf has one smallest member, so leaves are a sum of flags; a child is new where s is one
deeper; and a conversation saves the bytes of its turns from the node down to s.
"""

from __future__ import annotations

import hashlib
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stage

#: Positional columns of a block.
BLOCK = 8
#: Blocks whose prefix sums are taken in one group; longer conversations are summed by these segments first.
SEGMENT = 1024
#: Conversation ids in one piece of a node's list of ends.
CHUNK = 4096
#: How conversations are rebuilt: families of this many ids, and fewer shared turns than this.
FAMILY, MOST_SHARED = 5, 9


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, at, x, y, n)``: each turn's place from 1, the two halves of its id, and the bytes of its text.

    Turns are sorted by all tasks together and numbered by what comes before, so one conversation may hold any share
    of the rows.
    """
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("x"), F.xxhash64(F.lit("second"), role, text).alias("y"), F.octet_length(text).cast("long").alias("n"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("x"), F.col("y")]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the last key lets equal rows, of which any order is right, lie in several tasks
    spread = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(tasks, *order, "salt").sortWithinPartitions(*order)
    lying = stage(spread.select("conv_id", "x", "y", "n", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("place")), "trie-sorted")
    runs = lying.groupBy("conv_id", "task").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = stage(runs.select("conv_id", "task", "first", before.alias("before")), "trie-runs")
    return lying.join(runs, ["conv_id", "task"]).select("conv_id", (F.col("place") - F.col("first") + F.col("before") + 1).alias("at"), "x", "y", "n")


def shared_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations that begin like the first of their family: as ``turns``, with a row of null ``at`` for each turnless one.

    Conversation c takes the first h turns of conversation c - c % 5 (all if fewer, none if it is absent) and then its own
    turns after its first h, where h is crc32 of its decimal id % 9. A negative c % 5 counts as in Python, 0 to 4.
    """
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    sizes = stage(turns.groupBy("conv_id").agg(F.count("*").alias("size")), "trie-sizes")
    asked = sizes.select(F.col("conv_id").alias("c"), first.alias("conv_id"), shared_turns(F.col("conv_id")).alias("h"))
    known = asked.join(sizes, "conv_id", "left").select("c", "conv_id", "h", F.least("h", F.coalesce("size", F.lit(0))).alias("taken"))
    known = stage(known, "trie-known")
    given = turns.filter(F.col("at") < MOST_SHARED).join(known, "conv_id").filter("at <= h").select(F.col("c").alias("conv_id"), "at", "x", "y", "n")
    own = turns.join(known.select(F.col("c").alias("conv_id"), "h", "taken"), "conv_id").filter("at > h")
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "x", "y", "n")
    left = sizes.join(known.select(F.col("c").alias("conv_id"), "h", "taken"), "conv_id").filter("taken = 0 and size <= h")
    none = F.lit(None).cast("long")
    return given.unionByName(own).unionByName(left.select("conv_id", none.alias("at"), none.alias("x"), none.alias("y"), none.alias("n")))


def _blocks(turns: DataFrame) -> DataFrame:
    """``(conv_id, block, t1 .. t8, prior, length)``: the blocks of each conversation; a turnless one has an empty first block.

    A turn column is ``(x, y, n)``: the turn's id hashed with its place, and its bytes; ``prior`` has the same of all turns
    before the block together.
    """
    place = F.col("at") - 1
    turn = F.struct(F.xxhash64("x", "at").alias("x"), F.xxhash64("y", "at").alias("y"), "n")
    rows = turns.select("conv_id", F.coalesce(F.expr(f"(at - 1) div {BLOCK}"), F.lit(0)).alias("block"), (place % BLOCK).alias("k"), F.when(F.col("at").isNotNull(), turn).alias("t"))
    columns = [F.max(F.when(F.col("k") == k, F.col("t"))).alias(f"t{k + 1}") for k in range(BLOCK)]
    whole = F.struct(F.bit_xor("t.x").alias("x"), F.bit_xor("t.y").alias("y"), F.coalesce(F.sum("t.n"), F.lit(0)).alias("n"))
    made = stage(rows.groupBy("conv_id", "block").agg(*columns, F.count("t").alias("size"), whole.alias("all")), "trie-blocks")

    def over(window: Window, of: str) -> Column:
        x, y, n = (f(F.col(f"{of}.{c}")).over(window) for f, c in ((F.bit_xor, "x"), (F.bit_xor, "y"), (F.sum, "n")))
        return F.struct(F.coalesce(x, F.lit(0)).alias("x"), F.coalesce(y, F.lit(0)).alias("y"), F.coalesce(n, F.lit(0)).alias("n"))

    segment = F.expr(f"block div {SEGMENT}").alias("segment")
    sums = made.groupBy("conv_id", segment).agg(
        F.sum("size").alias("size"), F.struct(F.bit_xor("all.x").alias("x"), F.bit_xor("all.y").alias("y"), F.sum("all.n").alias("n")).alias("all")
    )
    whole_conv, past = Window.partitionBy("conv_id"), lambda by, *keys: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    sums = stage(sums.select("conv_id", "segment", over(past("segment", "conv_id"), "all").alias("far"), F.sum("size").over(whole_conv).alias("length")), "trie-segments")
    near = made.withColumn("segment", segment).withColumn("near", over(past("block", "conv_id", "segment"), "all"))
    joined = near.join(sums, ["conv_id", "segment"])
    prior = F.struct(*[f.alias(c) for c, f in (("x", F.expr("near.x ^ far.x")), ("y", F.expr("near.y ^ far.y")), ("n", F.expr("near.n + far.n")))])
    return joined.select("conv_id", "block", *_T, prior.alias("prior"), "length")


_T = [f"t{k + 1}" for k in range(BLOCK)]


def _rollup(blocks: DataFrame, aggregates: str) -> DataFrame:
    """``(depth, x, y, up_x, up_y, above, k, ...)`` of every node: its key, its parent's, the bytes above its own turn, its
    place in its block (0: the root) and the aggregates of its members."""
    grouped = blocks.sparkSession.sql(
        f"SELECT block, prior, {', '.join(_T)}, grouping_id() AS rolled, {aggregates} FROM {{blocks}} GROUP BY block, prior, ROLLUP ({', '.join(_T)})", blocks=blocks
    )
    rolled = {(1 << (BLOCK - k)) - 1: k for k in range(BLOCK + 1)}  # grouping_id has a bit for each column rolled up
    k = F.element_at(F.create_map(*[F.lit(v) for pair in rolled.items() for v in pair]), F.col("rolled").cast("int"))
    upto = [F.lit(None)] + [F.col(t) for t in _T]
    nodes = grouped.withColumn("k", k)
    there = F.expr("CASE k " + " ".join(f"WHEN {i} THEN t{i} IS NOT NULL" for i in range(1, BLOCK + 1)) + " ELSE block = 0 END")
    xor = lambda c, end: F.expr(" ^ ".join([f"prior.{c}", *[f"coalesce(CASE WHEN k {end} {i} THEN t{i}.{c} END, 0L)" for i in range(1, BLOCK + 1)]]))
    above = F.expr(" + ".join(["prior.n", *[f"coalesce(CASE WHEN k > {i} THEN t{i}.n END, 0L)" for i in range(1, len(upto))]]))
    return nodes.filter(there).select(
        (F.col("block") * BLOCK + F.col("k")).alias("depth"), xor("x", ">=").alias("x"), xor("y", ">=").alias("y"),
        xor("x", ">").alias("up_x"), xor("y", ">").alias("up_y"), above.alias("above"), "k", *[c for c in grouped.columns if c not in ("block", "prior", "rolled", *_T)],
    )


def _ends(blocks: DataFrame) -> DataFrame:
    """``(depth, x, y, ends_sha256)`` for every node at which conversations end.

    The ids of a node are sorted by all tasks together and joined to pieces of at most :data:`CHUNK` ids; one task then runs
    the pieces of a node through SHA-256 in order, which has no other way, without holding more than a piece.
    """
    spark = blocks.sparkSession
    last = [F.expr(" ^ ".join([f"prior.{c}", *[f"coalesce({t}.{c}, 0L)" for t in _T]])).alias(c) for c in ("x", "y")]
    ending = blocks.filter(f"length <= (block + 1) * {BLOCK}").select(F.col("length").alias("depth"), *last, "conv_id")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["depth", "x", "y", "conv_id"]

    def pieces(batches):
        for key, ids in groupby(_rows(batches), key=lambda r: r[:3]):
            while part := [i for *_, i in islice(ids, CHUNK)]:
                yield _batch([(*key, part[0], ",".join(map(str, part)))], "first", "piece")

    def digests(batches):
        for key, parts in groupby(_rows(batches), key=lambda r: r[:3]):
            digest, mark = hashlib.sha256(), ""
            for *_, piece in parts:
                digest.update((mark + piece).encode())
                mark = ","
            yield _batch([(*key, digest.hexdigest())], "ends_sha256")

    lists = ending.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(pieces, "depth long, x long, y long, first long, piece string")
    return lists.repartition("depth", "x", "y").sortWithinPartitions("depth", "x", "y", "first").mapInArrow(digests, "depth long, x long, y long, ends_sha256 string")


def _rows(batches):
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batch(rows: list[tuple], *more: str) -> pa.RecordBatch:
    kinds = [pa.string() if isinstance(v, str) else pa.int64() for v in rows[0]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["depth", "x", "y", *more])


def trie(turns: DataFrame) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``, a row per node.

    ``turns`` is as :func:`turns_of` or :func:`rebuilt` give it. A node is a distinct sequence of first turns (role and text);
    the root has none, and every conversation is its member. ``conv_id`` is the smallest member; ``n_convs`` counts members;
    ``n_leaves`` the childless nodes of the subtree, its top included; ``saved_tokens`` adds up over the subtree each node's
    (members - 1) x bytes of its last text; ``ends_sha256`` is of the ids of the members that end there.
    """
    blocks = stage(_blocks(turns), "trie-rows")
    first = stage(_rollup(blocks, "min(conv_id) AS conv_id, max(length) AS longest"), "trie-first")
    reps = first.groupBy("conv_id").agg(
        F.min("depth").alias("s"), F.min("above").alias("s_above"), F.max(F.when(F.col("longest") == F.col("depth"), 1).otherwise(0)).alias("leaf")
    )
    reps = stage(reps, "trie-smallest")
    # all bytes of a conversation that is smallest nowhere are above s
    size = F.expr(" + ".join(["prior.n", *[f"coalesce({t}.n, 0L)" for t in _T]]))
    totals = blocks.filter(f"length <= (block + 1) * {BLOCK}").select("conv_id", size.alias("bytes"))
    facts = stage(totals.join(reps, "conv_id", "left").select("conv_id", "s", F.coalesce("s_above", "bytes").alias("upto"), F.coalesce("leaf", F.lit(0)).alias("leaf")), "trie-facts")
    held, told = "prior.n", ["min(conv_id) AS conv_id", "count(*) AS n_convs", "sum(leaf) AS n_leaves"]
    for k in range(BLOCK + 1):
        if k > 1:
            held += f" + coalesce(t{k - 1}.n, 0L)"
        told += [f"sum(greatest(upto - ({held}), 0L)) AS saved{k}", f"count_if(s <= block * {BLOCK} + {k + 1} AND length > block * {BLOCK} + {k}) AS children{k}"]
    nodes = _rollup(blocks.join(facts, "conv_id"), ", ".join(told))
    at_k = lambda name: F.expr("CASE k " + " ".join(f"WHEN {k} THEN {name}{k}" for k in range(BLOCK + 1)) + " END")
    nodes = stage(nodes.select(
        "conv_id", "depth", "x", "y", "up_x", "up_y", "n_convs", at_k("children").alias("n_children"), "n_leaves", at_k("saved").alias("saved_tokens")), "trie-nodes")
    # a node whose smallest member is new has its parent's from a join; any other has its own
    new = nodes.join(reps.select("conv_id", F.col("s").alias("depth")), ["conv_id", "depth"]).filter("depth > 0").select("conv_id", "depth", "up_x", "up_y")
    ups = nodes.select(F.col("conv_id").alias("parent"), F.col("depth").alias("up"), F.col("x").alias("up_x"), F.col("y").alias("up_y"))
    parents = stage(new.withColumn("up", F.col("depth") - 1).join(ups, ["up", "up_x", "up_y"]).select("conv_id", "depth", "parent"), "trie-parents")
    ends = stage(_ends(blocks), "trie-ends")
    out = nodes.join(parents, ["conv_id", "depth"], "left").join(ends, ["depth", "x", "y"], "left")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """:func:`trie` of the rebuilt conversations (:func:`rebuilt`) of a table ``(conv_id, turn, role, text)``.

    Turns are ordered by ``turn``, null first, and where that is equal by a hash of role and text; a null role or text is
    empty; repeated rows are turns of their own. Rows of a null ``conv_id`` belong to no conversation and take no part. An
    empty table gives no rows; other columns are ignored.
    """
    turns = stage(turns_of(conversations), "trie-turns")
    return trie(stage(rebuilt(turns), "trie-rebuilt"))
