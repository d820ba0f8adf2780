"""The prefix trie of rebuilt conversations, by fingerprints that compose.

A sequence of turns has a fingerprint in a monoid: the pair (h, n) of a polynomial over the turns' hashes and their
number, with (h, n) * (g, m) = (h B**m + g, n + m).  Prefix products of the stored conversations are found in one pass
over ranges of the order, the products of a conversation that spans ranges being combined at the seams.  A rebuilt
conversation is the head of a base conversation and an own suffix; the fingerprint of each of its prefixes is combined
from those two products, and no rebuilt text ever exists.

Equal fingerprints of equal length make a node.  Every row of a node refers to a stored turn, its last one; a node holds
if all last turns have one content hash and all rows come from one parent, and content hashes hold if no two contents
share one, which is checked against the texts.  By induction from the root, nodes that hold are exactly the prefixes.  If
anything does not hold, all is done again with the next seed.

Figures over subtrees need no descent: a node's subtree is met by the conversations that pass through it, so leaves and
saved tokens are counted on one conversation of each node and summed along its path from the end.

Rows: turns are ordered by turn (NULL first), role and text; a NULL role or text is empty; repeated rows are turns each;
rows without a conversation id are left out; ``c % 5`` has the sign of ``c``; an empty table gives no rows; extra columns
are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import in_arrow, shuffle_partitions, written
from harborline.operators.ordered import in_ranges

MASK = (1 << 64) - 1
HEADS, SHARERS = 9, 5  # a head has crc32(id) % HEADS turns of the conversation at the next lower multiple of SHARERS
SEEDS = (0, 1, 2, 3)
CHUNK = 4096  # ids that are joined to one text before texts are digested in order


def step(seed: int) -> int:
    """The base B of the polynomials: odd, so that it can be divided by."""
    return int.from_bytes(hashlib.blake2b(f"step {seed}".encode(), digest_size=8).digest(), "little") | 1


def powers_of(base: int, exponents: np.ndarray) -> np.ndarray:
    """base**n modulo 2**64 for each n."""
    out, square, left = np.ones(len(exponents), np.uint64), np.uint64(base & MASK), exponents.astype(np.uint64)
    with np.errstate(over="ignore"):
        while left.any():
            out = np.where(left & np.uint64(1) == 1, out * square, out)
            square, left = square * square, left >> np.uint64(1)
    return out


def scanned(rows: DataFrame, group: str, order: list[str], value: str, base: int, names: list[str], **ranges) -> DataFrame:
    """The columns ``names`` of the rows with ``place`` (1, 2, ... in the group), ``product`` (h of all values up to the
    row) and ``before`` (up to the row before).  With base 1 products are sums.

    Each range is scanned by itself; one row per range carries what a group that spans ranges had before.
    """
    kept = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, product, place, serial = None, 0, 0, 0
        for batch in batches:
            ranks, groups, values = (batch.column(c).to_pylist() for c in ("range", group, "_value"))
            out = np.empty((4, batch.num_rows), np.uint64)
            for i, at in enumerate(zip(ranks, groups)):
                if at != now:
                    serial = 0 if now is None or now[0] != at[0] else serial
                    now, product, place = at, 0, 0
                out[1, i] = product
                product, place, serial = (product * base + values[i]) & MASK, place + 1, serial + 1
                out[0, i], out[2, i], out[3, i] = product, place, serial
            columns = [*(batch.column(c) for c in ("range", *names)), *(pa.array(o.view(np.int64)) for o in out)]
            yield pa.RecordBatch.from_arrays(columns, names=["range", *names, "product", "before", "place", "serial"])

    local = in_arrow(in_ranges(rows, [group, *order], **ranges).select("range", *names, F.col(value).alias("_value")), scan,
                     f"range int, {kept}, product long, before long, place long, serial long")
    local = written(local, "scanned")
    ends = local.groupBy("range").agg(F.max("serial").alias("serial"))
    ends = local.join(ends, ["range", "serial"]).select("range", F.col(group).alias("last"), "product", "place")
    ends = ends.join(local.where("serial = 1").select("range", F.col(group).alias("opening")), "range")

    def seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, product, place = None, 0, 0
        for batch in batches:
            out = []
            for row in batch.select(["range", "last", "product", "place", "opening"]).to_pylist():
                if row["opening"] != last:
                    product, place = 0, 0
                out.append((row["range"], row["opening"], product, place))
                goes_on = row["last"] == row["opening"] and row["opening"] == last
                earlier = (product, place) if goes_on else (0, 0)
                product = (earlier[0] * pow(base, row["place"], 1 << 64) + row["product"]) & MASK
                last, place = row["last"], earlier[1] + row["place"]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
                 pa.array(np.array(columns[2], np.uint64).view(np.int64)), pa.array(columns[3], pa.int64())],
                names=["_range", "_group", "_product", "_place"])

    carried = in_arrow(ends.repartition(1).sortWithinPartitions("range"), seams,
                       "_range int, _group long, _product long, _place long")
    carried = written(carried, "seams").where("_place > 0")
    joined = local.join(carried, (F.col("range") == F.col("_range")) & (F.col(group) == F.col("_group")), "left")
    joined = joined.select(*names, "product", "before", "place", F.coalesce("_product", F.lit(0)).alias("_product"),
                           F.coalesce("_place", F.lit(0)).alias("_place"))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, b, place, carry, more = (batch.column(c).to_numpy() for c in ("product", "before", "place", "_product", "_place"))
            carry = carry.view(np.uint64)
            with np.errstate(over="ignore"):
                h = carry * powers_of(base, place) + h.view(np.uint64)
                b = carry * powers_of(base, place - 1) + b.view(np.uint64)
            columns = [*(batch.column(c) for c in names), pa.array(h.view(np.int64)), pa.array(b.view(np.int64)), pa.array(place + more)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "product", "before", "place"])

    return in_arrow(joined, combine, f"{kept}, product long, before long, place long")


def turns_of(conversations: DataFrame, seed: int) -> DataFrame | None:
    """conv, turn, hash (of role and text), bytes (of the text) of every turn; None if two contents share a hash."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = turns.withColumn("hash", F.xxhash64(F.lit(seed), "role", "text"))
    contents = turns.groupBy("hash", "role", "text").agg(F.lit(1).alias("one"))
    if not contents.groupBy("hash").count().where("count > 1").isEmpty():
        return None
    return turns


def head_size(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuilt(own: DataFrame, base: int) -> DataFrame:
    """conv, depth, fp, parent_fp, hash, bytes, last: every prefix of every rebuilt conversation, the empty one too.

    ``own``: conv, hash, bytes, place, product, before of every stored turn.
    """
    short = own.where(F.col("place") < HEADS).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("place", "product", "before", "hash", "bytes"))).alias("heads"))  # eight at most
    sizes = own.groupBy("conv").agg(F.max("place").alias("n"))
    convs = sizes.join(short, "conv").withColumns({"h": head_size(F.col("conv")), "base": F.col("conv") - F.col("conv") % SHARERS})
    bases = short.select(F.col("conv").alias("base"), F.col("heads").alias("lent"))
    convs = convs.join(bases, "base", "left")
    lent = F.slice(F.coalesce("lent", F.array().cast(convs.schema["heads"].dataType)), F.lit(1), F.col("h").cast("int"))
    cut = F.when(F.col("h") > 0, F.get("heads", F.least("h", "n").cast("int") - 1)["product"]).otherwise(F.lit(0))
    convs = convs.select("conv", "h", "n", lent.alias("lent"), cut.alias("cut"))
    convs = convs.withColumns({"k": F.size("lent"), "head": F.coalesce(F.get("lent", F.size("lent") - 1)["product"], F.lit(0))})
    convs = written(convs.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt-conversations")
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("fp"), F.lit(0).cast("long").alias("parent_fp"),
                        F.lit(0).cast("long").alias("hash"), F.lit(0).cast("long").alias("bytes"), (F.col("length") == 0).alias("last"))
    first = convs.select("conv", "length", F.explode("lent").alias("t")).select(
        "conv", F.col("t.place").alias("depth"), F.col("t.product").alias("fp"), F.col("t.before").alias("parent_fp"), "t.hash", "t.bytes",
        (F.col("t.place") == F.col("length")).alias("last"))
    plan = convs.where("n > h").select(F.col("conv").alias("_conv"), "h", "k", "cut", "head", "length")
    rest = own.join(plan, (F.col("conv") == F.col("_conv")) & (F.col("place") > F.col("h"))).select(
        "conv", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), "product", "before", (F.col("place") - F.col("h")).alias("m"),
        "cut", "head", "hash", "bytes", "length")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            product, before, m, cut, head = (batch.column(c).to_numpy() for c in ("product", "before", "m", "cut", "head"))
            with np.errstate(over="ignore"):  # head * suffix, the suffix being what is left of a prefix without the cut
                changed = head.view(np.uint64) - cut.view(np.uint64)
                fp = product.view(np.uint64) + changed * powers_of(base, m)
                parent = before.view(np.uint64) + changed * powers_of(base, m - 1)
            last = pa.array(batch.column("depth").to_numpy() == batch.column("length").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("depth"), pa.array(fp.view(np.int64)), pa.array(parent.view(np.int64)),
                 batch.column("hash"), batch.column("bytes"), last],
                names=["conv", "depth", "fp", "parent_fp", "hash", "bytes", "last"])

    rest = in_arrow(rest, combine, "conv long, depth long, fp long, parent_fp long, hash long, bytes long, last boolean")
    return root.unionByName(first).unionByName(rest)


def paths_and_nodes(conversations: DataFrame, bits: int, **ranges) -> tuple[DataFrame, DataFrame]:
    """The rows of ``rebuilt`` and their nodes (depth, fp, parent_fp, conv, n_convs, bytes), once all of them hold.

    ``bits``: how many bits of a turn's hash the first seed uses; later ones use all.
    """
    for seed in SEEDS:
        turns = turns_of(conversations, seed)
        if turns is None:
            continue
        turns = turns.withColumn("value", F.col("hash") if seed or bits == 64 else F.col("hash").bitwiseAND(F.lit((1 << bits) - 1)))
        turns = turns.withColumn("bytes", F.octet_length("text").cast("long"))
        own = written(scanned(turns, "conv", ["turn", "role", "text"], "value", step(seed), ["conv", "hash", "bytes"], **ranges), "turns")
        paths = written(rebuilt(own, step(seed)), "paths")
        nodes = paths.groupBy("depth", "fp").agg(
            F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"), F.min("parent_fp").alias("parent_fp"),
            F.max("parent_fp").alias("_parent"), F.min("hash").alias("_low"), F.max("hash").alias("_high"))
        nodes = written(nodes, "nodes")
        if nodes.where("parent_fp <> _parent OR _low <> _high").isEmpty():
            return paths, nodes.drop("_parent", "_low", "_high")
    raise ValueError("no seed gives fingerprints without a collision")


def ends_digests(paths: DataFrame, **ranges) -> DataFrame:
    """depth, fp, ends_sha256 of every node where a conversation ends.

    Ids are sorted in ranges, so those of one node may come from many tasks; each task joins them to texts of up to CHUNK
    ids.  The digest of a node then reads those texts in order, one at a time.
    """
    ends = in_ranges(paths.where("last").select("depth", "fp", "conv"), ["depth", "fp", "conv"], **ranges)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, serial = None, [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"range": now[0], "serial": serial, "depth": now[1], "fp": now[2], "ids": ",".join(map(str, held))}])

        for batch in batches:
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in ("range", "depth", "fp", "conv"))):
                if held and (at != now or len(held) >= CHUNK):
                    yield close()
                    held, serial = [], serial + 1
                now = at
                held.append(conv)
        if held:
            yield close()

    parts = in_arrow(ends.select("range", "depth", "fp", "conv"), joined, "range long, serial long, depth long, fp long, ids string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            out = []
            for *at, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "fp", "ids"))):
                if at != now:
                    if now is not None:
                        out.append((*now, sha.hexdigest()))
                    now, sha = at, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield as_rows(out)
        if now is not None:
            yield as_rows([(*now, sha.hexdigest())])

    def as_rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                                          names=["depth", "fp", "ends_sha256"])

    parts = parts.repartition(shuffle_partitions(paths.sparkSession), "depth", "fp").sortWithinPartitions("depth", "fp", "range", "serial")
    return in_arrow(parts.select("depth", "fp", "ids"), digest, "depth long, fp long, ends_sha256 string")


def trie(conversations: DataFrame, bits: int = 64, **ranges) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``bits``: of a turn's hash in the first attempt; fewer make collisions, which are found and cured by the next.
    """
    paths, nodes = paths_and_nodes(conversations, bits, **ranges)
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fp").alias("parent_fp"), F.col("conv").alias("parent_conv_id"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_fp").alias("fp")).agg(
        F.count("*").alias("n_children"))
    tree = nodes.where("depth > 0").join(above, ["depth", "parent_fp"], "left").unionByName(
        nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    tree = written(tree.join(children, ["depth", "fp"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie")
    # What a node saves, at its place on the path of one of its conversations; and leaves, by one of theirs.
    saving = tree.where("n_convs > 1 AND bytes > 0").select(
        "conv", "depth", "fp", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    leaves = tree.where("n_children = 0").select(F.col("conv").alias("_conv"))
    value = paths.select("conv", "depth", "fp").join(saving, ["conv", "depth", "fp"], "left").join(
        leaves, F.col("conv") == F.col("_conv"), "left").select(
        "conv", "fp", "depth", (-F.col("depth")).alias("up"), F.coalesce("saved", F.lit(0)).alias("saved"),
        F.col("_conv").isNotNull().cast("long").alias("leaf"))
    saved = scanned(value, "conv", ["up"], "saved", 1, ["fp", "depth", "conv", "leaf"], **ranges)  # sums from the end of each path
    below = saved.groupBy("depth", "fp").agg(F.sum("product").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    ends = ends_digests(paths, **ranges)
    out = tree.join(below, ["depth", "fp"]).join(ends, ["depth", "fp"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
