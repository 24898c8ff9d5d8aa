"""Prefix trie of conversations: which openings are shared, by whom, and how many words a shared prefix saves.

A node is a distinct sequence of first turns; its owner is the smallest conversation that starts with it.  What a
conversation owns is a chain from its first owned depth to its last turn, so chains are the tree: each hangs on a node of
another chain.  The first owned depth is found by halving, in joins against the minima of contested prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.staging import staged, unstage
from lexforge.llm.texts import map_batches

#: Prefix digests of one conversation stand in rows of so many depths.
RUN = 256
_PREFIXES = "conv_id bigint, depth bigint, prefix binary, words bigint"
_ARROW = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("prefix", pa.binary()), ("words", pa.int64())])
_ENDS = pa.schema([("owner", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])


def turns_of(df: DataFrame, conv_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows (conv_id, turn, role, text): null role and text are empty, rows without a conversation are left out."""
    rows = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(order_col).alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(x) for c, x in ((role_col, "role"), (text_col, "text"))])
    return rows.filter(F.col("conv_id").isNotNull())


def borrowed_openings(turns: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """Rows (conv_id, pos, role, text) of conversations rebuilt on another's opening; a row without a position for each conversation.

    Conversation c takes the first h turns of c - c % block, then its own after its first h, where h is the CRC-32 of its
    id modulo ``most``.  Turns are ordered with nulls first, equal ones by role and text.  One shuffle, by block.
    """
    base = F.col("conv_id") - F.col("conv_id") % block
    share = lambda c: F.crc32(c.cast("string")) % most
    rows = turns.withColumn("base", base).repartition("base")
    in_block = Window.partitionBy("base")
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("base", "conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")).cast("long"))
    rows = rows.withColumn("convs", F.collect_set("conv_id").over(in_block)).withColumn("n_base", F.coalesce(F.max(F.when(F.col("conv_id") == F.col("base"), F.col("pos"))).over(in_block), F.lit(0).cast("long")))
    takers = F.when((F.col("conv_id") == F.col("base")) & (F.col("pos") < most), F.filter("convs", lambda c: share(c) >= F.col("pos"))).otherwise(F.array().cast("array<bigint>"))
    own, taken = F.col("pos") > share(F.col("conv_id")), F.least(share(F.col("conv_id")), F.col("n_base"))
    place = lambda conv, pos, role, text: F.struct(conv.alias("conv_id"), pos.cast("long").alias("pos"), role.alias("role"), text.alias("text"))
    role, text = F.col("role"), F.col("text")
    out = F.concat(
        F.transform(takers, lambda c: place(c, F.col("pos"), role, text)),
        F.when(own, F.array(place(F.col("conv_id"), F.col("pos") - share(F.col("conv_id")) + taken, role, text))).otherwise(F.array().cast("array<struct<conv_id:bigint,pos:bigint,role:string,text:string>>")),
        F.when(F.col("pos") == 1, F.array(place(F.col("conv_id"), F.lit(None), F.lit(None).cast("string"), F.lit(None).cast("string")))).otherwise(F.array().cast("array<struct<conv_id:bigint,pos:bigint,role:string,text:string>>")),
    )
    return rows.select(F.inline(out))


def prefix_digests(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, depth, prefix, words) from depth 0 on: a digest of the first turns, and the words of the last of them.

    Turns are digested where they are, so that only digests move; a conversation's rows are then read in order and never
    held together.
    """
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    rows = turns.select("conv_id", F.coalesce("pos", F.lit(0).cast("long")).alias("pos"), F.unhex(F.sha2(said, 256)).alias("turn"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, depth, state = None, 0, b""
        for batch in batches:
            out: list[tuple[int, int, bytes, int]] = []
            for c, pos, turn, words in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                if c != conv:
                    conv, depth, state = c, 0, b""
                    out.append((c, 0, b"", 0))
                if pos:
                    depth += 1
                    state = hashlib.blake2b(state + turn, digest_size=20).digest()
                    out.append((c, depth, state, words))
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True) if out else [[]] * 4, _ARROW, strict=True)], schema=_ARROW)

    return map_batches(rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "turn"), run, _PREFIXES, rows=4096)


def first_owned(prefixes: DataFrame, contested: DataFrame) -> DataFrame:
    """Rows (conv_id, len, first, at_owner): the first depth whose prefix the conversation owns, and who owns the one before.

    ``first`` is len + 1 where it owns nothing.  A conversation that owns a prefix owns every longer one of its own, so the
    depth is found by halving: each round looks up one prefix of every undecided conversation in ``contested``; a prefix
    that isn't there has one member.  Rounds grow with the logarithm of the longest conversation.
    """
    runs = staged(prefixes.filter("depth > 0").groupBy("conv_id", F.floor((F.col("depth") - 1) / RUN).alias("run")).agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "prefix"))), lambda x: x["prefix"]).alias("prefixes")), "prefix-runs")
    sizes = prefixes.groupBy("conv_id").agg(F.max("depth").alias("len"))
    # depths up to low are owned by others, those from high on by the conversation; the smallest one owns the root
    root = contested.filter("depth = 0").head()
    smallest = F.lit(root["owner"] if root else None).cast("long")
    start = F.when(F.col("conv_id") == smallest, 0).otherwise(F.col("len") + 1).cast("long")
    open_ = staged(sizes.select("conv_id", "len", F.lit(0).cast("long").alias("low"), start.alias("high"), smallest.alias("at_owner")), "search")
    done: list[DataFrame] = []
    while True:
        decided = open_.filter("high - low <= 1").select("conv_id", "len", F.col("high").alias("first"), "at_owner")
        done.append(decided)
        left = open_.filter("high - low > 1")
        if left.isEmpty():
            break
        probe = left.withColumn("mid", F.expr("(low + high) div 2"))
        probe = probe.join(runs.withColumnRenamed("conv_id", "c"), (F.col("conv_id") == F.col("c")) & (F.expr(f"(mid - 1) div {RUN}") == F.col("run")))
        probe = probe.select("conv_id", "len", "low", "high", "at_owner", "mid", F.get("prefixes", (F.expr(f"(mid - 1) % {RUN}")).cast("int")).alias("prefix"))
        found = probe.join(contested.select("prefix", "owner"), "prefix", "left")
        foreign = F.col("owner").isNotNull() & (F.col("owner") != F.col("conv_id"))
        low, high = F.when(foreign, F.col("mid")).otherwise(F.col("low")), F.when(foreign, F.col("high")).otherwise(F.col("mid"))
        open_ = staged(found.select("conv_id", "len", low.alias("low"), high.alias("high"), F.when(foreign, F.col("owner")).otherwise(F.col("at_owner")).alias("at_owner")), "search")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    out = staged(out, "first-owned")
    unstage(runs)
    return out


def ancestors(chains: DataFrame) -> DataFrame:
    """Rows (conv_id, anc, at): every chain that a chain hangs on, directly or not, and the depth of that chain where it does.

    Paths double each round.  A chain of first depth d has d ancestors at most, so the rows never exceed the turns.
    """
    known = staged(chains.select("conv_id", F.col("parent").alias("anc"), F.col("at"), F.lit(1).cast("long").alias("hop")), "ancestors")
    while True:
        reach = known.agg(F.max("hop")).head()[0]
        if reach is None:
            return known.drop("hop")
        tips = known.filter(F.col("hop") == reach).select("conv_id", F.col("anc").alias("tip"))
        more = tips.join(known.select(F.col("conv_id").alias("tip"), "anc", "at", "hop"), "tip").select("conv_id", "anc", "at", (F.col("hop") + reach).alias("hop"))
        grown = staged(known.unionByName(more), "ancestors")
        if grown.agg(F.max("hop")).head()[0] == reach:
            return grown.drop("hop")
        unstage(known)
        known = grown


def end_digests(ends: DataFrame) -> DataFrame:
    """Rows (owner, depth, ends_sha256): SHA-256 over the ids of the conversations that end at a node, ascending, fed one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            owner, depth, conv = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            cuts = [0, *(np.flatnonzero((owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1])) + 1).tolist(), len(owner)] if len(owner) else [0]
            out = []
            for a, b in pairwise(cuts):
                listed = ",".join(map(str, conv[a:b].tolist())).encode()
                if (owner[a], depth[a]) == key:
                    digest.update(b"," + listed)
                else:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (owner[a], depth[a]), hashlib.sha256(listed)
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True) if out else [[]] * 3, _ENDS, strict=True)], schema=_ENDS)
        if key is not None:
            yield pa.record_batch([pa.array([x], f.type) for x, f in zip((*key, digest.hexdigest()), _ENDS, strict=True)], schema=_ENDS)

    rows = ends.select("owner", "depth", "conv_id").repartition("owner", "depth").sortWithinPartitions("owner", "depth", "conv_id")
    return map_batches(rows, run, "owner bigint, depth bigint, ends_sha256 string", rows=1 << 16)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` holds (conv_id, pos, role, text) in any order, positions from 1 on; a row with a null position makes a
    conversation known that may have no turn.  Equal positions follow each other by the digest of role and text.  Empty
    role and text are values like any other; a table without rows gives none; repeated conversations (equal turns under
    different ids) are members of the same nodes.
    """
    prefixes = staged(prefix_digests(turns), "prefixes")
    per_prefix = prefixes.groupBy("prefix").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.max("depth").alias("depth"), F.max("words").alias("words"))
    nodes = staged(per_prefix, "nodes")
    contested = nodes.filter((F.col("n_convs") > 1) | (F.col("depth") == 0)).select("prefix", "owner", "depth")
    owned = first_owned(prefixes, contested)

    chains = owned.filter((F.col("first") > 0) & (F.col("first") <= F.col("len"))).select("conv_id", "len", F.col("at_owner").alias("parent"), (F.col("first") - 1).alias("at"))
    attached = staged(chains.groupBy(F.col("parent").alias("owner"), F.col("at").alias("depth")).agg(F.count("*").alias("n_attached")), "attached")
    # what a chain has of its own: its last node, if nothing hangs on it, and the words that its nodes save
    bare = owned.filter(F.col("first") <= F.col("len")).select(F.col("conv_id").alias("owner"), F.col("len").alias("depth"))
    leaf = bare.join(attached, ["owner", "depth"], "left").select("owner", F.col("depth").alias("len"), F.when(F.col("n_attached").isNull(), 1).otherwise(0).cast("long").alias("leaf"))
    saved = nodes.groupBy("owner").agg(F.sum((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    own = staged(leaf.join(saved, "owner"), "own-sums")
    below = ancestors(chains).join(own.select(F.col("owner").alias("conv_id"), "leaf", "saved"), "conv_id")
    below = below.groupBy(F.col("anc").alias("owner"), F.col("at").alias("depth")).agg(F.sum("leaf").alias("leaves_below"), F.sum("saved").alias("saved_below"))

    ends = owned.select(F.when(F.col("first") <= F.col("len"), F.col("conv_id")).otherwise(F.col("at_owner")).alias("owner"), F.col("len").alias("depth"), "conv_id")
    zero = F.lit(0).cast("long")
    rows = nodes.select("owner", "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved_here"))
    rows = rows.join(attached, ["owner", "depth"], "left").join(below, ["owner", "depth"], "left").join(end_digests(ends), ["owner", "depth"], "left")
    rows = rows.join(own.select("owner", "len", "leaf"), "owner").join(chains.select(F.col("conv_id").alias("owner"), "parent", "at"), "owner", "left")
    upward = Window.partitionBy("owner").orderBy(F.desc("depth"))
    from_here = lambda c: F.sum(F.coalesce(c, zero)).over(upward)
    return rows.select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == F.col("at") + 1, F.col("parent")).otherwise(F.col("owner")).cast("long").alias("parent_conv_id"),
        "n_convs",
        (F.coalesce("n_attached", zero) + F.when(F.col("depth") < F.col("len"), 1).otherwise(0)).cast("long").alias("n_children"),
        (F.col("leaf") + from_here(F.col("leaves_below"))).cast("long").alias("n_leaves"),
        (from_here(F.col("saved_here")) + from_here(F.col("saved_below"))).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
