"""The trie of conversations' common beginnings, built as adaptive radix trees over turn ids.

A turn's id is 16 bytes of a hash of role and text; a conversation is the string of its turns' ids. Conversations are
sorted by that string over all tasks, and each task builds a radix tree (``radix_tree``) of every ``BLOCK_BYTES`` of
ids. Only depths that are whole turns become nodes of the trie: an edge may hold several, a branch inside an id none.

A node all of whose conversations lie in one tree is finished there. As trees are runs of the sorted strings, only the
prefixes of a tree's first and last string may go on in other trees; those are emitted as parts and put together:
counts and smallest members by aggregation; sums over subtrees along the trees' first and last paths (each part
belongs to one path, a running sum from the end of a path gives what it adds to each of its nodes, and a node's sum
is that of all paths through it). Parts number two paths per tree, so all of this is small beside the nodes.

A conversation is one row of ids and word counts (24 bytes a turn; texts stay behind in Spark's sort), which has to fit
into a task as a text has. Any number of conversations may be equal or begin alike: they are spread over tasks
by their own id. Only the digest of such a node's ids is made in one task, in a stream of the trees' pieces.

Defined results: rows without conv_id take no part. NULL role or text is empty. Turns are ordered by turn (NULL first),
ties by role, then text; repeated rows are turns of their own. A conversation may be without turns (it is a member of the
root alone). Without conversations there is no node. Other columns are not read, so names may clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.batches import stored
from vitrine.llm.radix_tree import RadixTree

WIDTH = 16
BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 20_000
_WORDS = r"[^\x20\x09-\x0D]+"
_ROOT = bytes(WIDTH)

_WHOLE, _PART, _ENDS = 0, 1, 2
_FIELDS = {
    "kind": ("int", pa.int32()),
    "block": ("long", pa.int64()),
    "id": ("binary", pa.binary()),
    "parent": ("binary", pa.binary()),
    "conv_id": ("long", pa.int64()),
    "depth": ("long", pa.int64()),
    "parent_conv_id": ("long", pa.int64()),
    "n_convs": ("long", pa.int64()),
    "n_children": ("long", pa.int64()),
    "n_leaves": ("long", pa.int64()),
    "saved_tokens": ("long", pa.int64()),
    "words": ("long", pa.int64()),
    "sides": ("int", pa.int32()),
    "ends": ("string", pa.string()),
}
_SCHEMA = ", ".join(f"{name} {kind}" for name, (kind, _) in _FIELDS.items())
NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation: conv, ids and words of its turns in order."""
    rows = conversations.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).where(F.col("conv").isNotNull())
    place = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    # The length keeps role and text apart.
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    turns = rows.select(
        "conv",
        place.alias("place"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, WIDTH).alias("id"),
        F.regexp_count("text", F.lit(_WORDS)).cast("long").alias("words"),
    )
    own = F.sort_array(F.collect_list(F.struct("place", "id", "words")))
    return turns.groupBy("conv").agg(own.alias("turns")).select("conv", "turns.id", "turns.words").toDF("conv", "ids", "words")


def spliced(convs: DataFrame, base: Column, heads: Column) -> DataFrame:
    """Each conversation with its first ``heads`` turns replaced by those of conversation ``base``.

    All of the base's turns if it has fewer, none if it is absent.
    """
    rows = convs.select("conv", "ids", "words", heads.alias("heads"), F.when(heads > 0, base).otherwise(F.col("conv")).alias("base"))
    bases = convs.select(F.col("conv").alias("base"), F.struct("ids", "words").alias("own"))
    joined = rows.join(bases, "base", "left")

    def parts(name: str) -> Column:
        none = F.array().cast(convs.schema[name].dataType)
        head = F.slice(F.coalesce(F.col(f"own.{name}"), none), F.lit(1), F.col("heads"))
        return F.concat(head, F.slice(F.col(name), F.col("heads") + 1, F.greatest(F.size(name) - F.col("heads"), F.lit(0))))

    return joined.select("conv", parts("ids").alias("ids"), parts("words").alias("words"))


def _tree_rows(rows: list[tuple[bytes, int, list[int]]], block: int) -> pa.RecordBatch:
    """All nodes of one tree over sorted rows (string, conv, words)."""
    tree = RadixTree()
    words: dict[bytes, list[int]] = {}
    for key, conv, own in rows:
        tree.insert(key, conv)
        words.setdefault(key, own)
    first, last = rows[0][0], rows[-1][0]
    order = list(tree.walk())
    # Bottom up: members, smallest member, highest nodes of the trie, leaves and savings below; the last three
    # also without the turns of the node's own edge.
    for node, start, end in reversed(order):
        count, least = len(node.ends), min(node.ends, default=None)
        open_, leaves, saved = 0, 0, 0
        for _, kid in node.kids.items():
            n, low, (o, l, s), _ = kid.note
            count, least = count + n, low if least is None else min(least, low)
            open_, leaves, saved = open_ + o, leaves + l, saved + s
        below = (open_, leaves, saved)
        top, bottom = start // WIDTH + 1, end // WIDTH
        if top <= bottom:
            if node.key in words:
                saved += (count - 1) * sum(words[node.key][max(top, 1) - 1 : bottom])
            open_, leaves = 1, leaves if open_ else 1
        node.note = (count, least, (open_, leaves, saved), below)

    out: dict[str, list] = {name: [] for name in _FIELDS}

    def emit(**values) -> None:
        for name, column in out.items():
            column.append(values.get(name))

    parts: dict[bytes, dict] = {}
    # Top down: the trie node above each tree node as (depth, smallest member, sides, id).
    above = {id(tree.root): (None, None, 3, None)}
    for node, start, end in order:
        count, least, (_, leaves, _), (open_, leaves_below, saved) = node.note
        depth, parent_least, sides, parent = above.pop(id(node))
        own = words.get(node.key, [])
        top, bottom = start // WIDTH + 1, end // WIDTH
        left = sum(own[max(top, 1) - 1 : bottom])  # words of the edge's turns from here down
        for d in range(top, bottom + 1):
            here = node.key[WIDTH * (d - 1) : WIDTH * d] if d else b""
            word = own[d - 1] if d else 0
            inherited = sides
            if d and sides:  # still a prefix of the first (1) or last (2) string
                at = slice(WIDTH * (d - 1), WIDTH * d)
                sides = sides & ((first[at] == here) | (last[at] == here) << 1)
            children = open_ if d == bottom else 1
            ends = sorted(node.ends) if d == bottom else []
            text = ",".join(map(str, ends))
            if sides:
                number = hashlib.blake2b(parent + here, digest_size=WIDTH).digest() if d else _ROOT
                parts[number] = dict(
                    kind=_PART, block=block, id=number, parent=parent, conv_id=least, depth=d, n_convs=count,
                    n_children=0, n_leaves=0, saved_tokens=0, words=word, sides=sides,
                )
                if ends:
                    emit(kind=_ENDS, block=block, id=number, ends=text)
                parent = number
            else:
                total = saved + (count - 1) * left
                n_leaves = leaves_below if children and d == bottom else leaves
                n_leaves = n_leaves or 1
                hung = parent if inherited else None
                emit(
                    kind=_WHOLE, block=block, parent=hung, conv_id=least, depth=d,
                    parent_conv_id=None if hung else parent_least, n_convs=count, n_children=children,
                    n_leaves=n_leaves, saved_tokens=total, ends=hashlib.sha256(text.encode()).hexdigest(),
                )
                if hung:
                    part = parts[hung]
                    part["n_children"] += 1
                    part["n_leaves"] += n_leaves
                    part["saved_tokens"] += total
                parent = None
            depth, parent_least = d, least
            left -= word
        for _, kid in node.kids.items():
            above[id(kid)] = (depth, parent_least, sides, parent)
    for part in parts.values():
        emit(**part)
    return pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, (_, t) in _FIELDS.items()], names=list(_FIELDS))


def _trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    held, size = [], 0
    for batch in batches:
        for conv, ids, words in zip(*(batch.column(n) for n in ("conv", "ids", "words"))):
            key = b"".join(ids.as_py())
            held.append((key, conv.as_py(), words.as_py()))
            size += len(key)
            if size >= BLOCK_BYTES or len(held) >= BLOCK_ROWS:
                yield _tree_rows(held, block)
                held, size, block = [], 0, block + 1
    if held:
        yield _tree_rows(held, block)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the joined texts of each id, from rows sorted by id and block."""
    now, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"id": now, "digest": state.hexdigest()}], pa.schema([("id", pa.binary()), ("digest", pa.string())]))

    for batch in batches:
        for number, text in zip(batch.column("id").to_pylist(), batch.column("ends")):
            if number != now:
                if state is not None:
                    yield done()
                now, state = number, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.as_py().encode())
    if state is not None:
        yield done()


def _subtree_sums(parts: DataFrame, merged: DataFrame) -> DataFrame:
    """n_leaves and saved_tokens of the nodes that several trees share."""
    paths = parts.select("id", "block", "depth", F.explode(F.array(F.lit(1), F.lit(2))).alias("side"), "sides")
    paths = paths.where(F.col("sides").bitwiseAND(F.col("side")) != 0).select("id", "depth", F.struct("block", "side").alias("path"))
    owned = paths.groupBy("id").agg(F.min("path").alias("owner")).join(merged.select("id", "own_leaves", "own_saved"), "id")
    valued = paths.join(owned, "id")
    mine = F.col("path") == F.col("owner")
    up = Window.partitionBy("path").orderBy(F.col("depth").desc())
    running = [
        F.sum(F.when(mine, F.col(f"own_{name}")).otherwise(0)).over(up).alias(name) for name in ("leaves", "saved")
    ]
    return valued.select("id", *running).groupBy("id").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def nodes(spark: SparkSession, convs: DataFrame) -> DataFrame:
    """One row per node of the trie over conversations (conv, ids, words), each conv once."""
    ranged = convs.repartitionByRange("ids", "conv").sortWithinPartitions("ids", "conv")
    table = stored(spark, ranged.select("conv", "ids", "words").mapInArrow(_trees, _SCHEMA), "trees")

    parts = table.where(F.col("kind") == _PART)
    sums = {"n": "n_convs", "hung_children": "n_children", "hung_leaves": "n_leaves", "hung_saved": "saved_tokens"}
    merged = parts.groupBy("id").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        *[F.sum(source).alias(name) for name, source in sums.items()],
    )
    shared = merged.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("shared"))
    merged = merged.join(shared, "id", "left").withColumn("n_children", F.col("hung_children") + F.coalesce("shared", F.lit(0)))
    merged = merged.withColumn("own_leaves", F.col("hung_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
    merged = merged.withColumn("own_saved", F.col("hung_saved") + (F.col("n") - 1) * F.col("words"))
    merged = stored(spark, merged, "shared-nodes")

    pieces = table.where(F.col("kind") == _ENDS).select("id", "block", "ends")
    digests = pieces.repartition("id").sortWithinPartitions("id", "block").select("id", "ends").mapInArrow(_digests, "id binary, digest string")
    least = merged.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    split = (
        merged.join(_subtree_sums(parts, merged), "id")
        .join(digests, "id", "left")
        .join(least, "parent", "left")
        .withColumn("ends_sha256", F.coalesce("digest", F.sha2(F.lit(""), 256)))
        .withColumnRenamed("n", "n_convs")
    )
    whole = table.where(F.col("kind") == _WHOLE).withColumnRenamed("ends", "ends_sha256")
    # A part may have very many children; each meets it under the number of its own tree.
    here = parts.select("block", F.col("id").alias("parent")).join(least, "parent")
    hung = whole.where(F.col("parent").isNotNull()).drop("parent_conv_id").join(here, ["parent", "block"])
    inner = whole.where(F.col("parent").isNull())
    return split.select(*NODES).union(hung.select(*NODES)).union(inner.select(*NODES))
