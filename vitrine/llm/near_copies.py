"""Near-duplicate documents by Order MinHash, candidates verified by banded alignment.

A text is a sequence of words (lower-cased, without ASCII punctuation), its k-mers are runs of five words, labelled
with the number of the same run's earlier occurrences. Each of ``TABLES`` hash functions selects the ``PER_TABLE``
labelled k-mers with the least values; their sequence in the order of the text is a key. Two texts share a key if
they agree in the k-mers selected and in their order, which follows edit similarity rather than the sets alone.

Two texts are linked if an alignment of their words (least edits, within a band) leaves matched runs with ``m``
common k-mers of ``a`` and ``b`` such that m / (a + b - m) is ``SIMILARITY`` or more. A text with fewer than five words
is one k-mer. Classes are the connected components of the links.

Texts with equal words are one node from the start, whatever their number. Nodes that share a key are candidates:

1. Each node is compared with the most popular node it shares a key with (the one with the most candidates), so
   a group of any size gives one pair per node.
2. Where a key joins nodes that are still in different classes, its nodes lie in blocks, and pairs of blocks are compared
   inside tasks: all pairs across classes, but for those that cannot be similar by length or by a bound on the common
   k-mers (bits of one text that the other lacks), or whose classes have been joined meanwhile. Pairs are never
   rows; a pair of blocks passes on links that join two classes only. So no candidate link is lost.

Defined results: a text that is NULL or has no words is a class of its own, even among copies. Repeated rows
are one class. The class of documents is named by its smallest key; a class without keys has NULL. An empty table
gives no rows. Other columns are not read, so names may clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.batches import mixed, plain_words, rolled, stored
from vitrine.llm.components import components

KMER = 5
SIMILARITY = 0.8
TABLES = 20
PER_TABLE = 3
BITS = 1024
BLOCK_ROWS = 1024
BLOCK_BYTES = 16 << 20
PAIRS_AT_ONCE = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_SEED = 11

SIGNED = "key long, mark long, node binary, n long, keys array<long>, bits array<long>, words binary"


def _functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(_SEED)
    flips, factors = random.integers(0, 1 << 63, (2, TABLES), np.uint64)
    return flips[:, None], (factors * np.uint64(2) + np.uint64(1))[:, None]


def kmers(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of five words; of all words, if there are fewer."""
    return rolled(words, min(KMER, len(words)), _BASE) if len(words) else np.empty(0, np.uint64)


def labelled(runs: np.ndarray) -> np.ndarray:
    """K-mers told apart by the number of earlier occurrences."""
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    if new.all():
        return runs
    at = np.arange(len(runs))
    label = np.empty(len(runs), np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.where(label > 0, mixed(runs + label * np.uint64(_BASE)), runs)


def order_keys(runs: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """One key per table: the selected k-mers in the order of the text."""
    wanted = min(PER_TABLE, len(runs))
    chosen = np.empty((TABLES, wanted), np.int64)
    with np.errstate(over="ignore"):
        values = (runs[None, :] ^ flips) * factors
        rows = np.arange(TABLES)
        for k in range(wanted):
            chosen[:, k] = values.argmin(axis=1)
            values[rows, chosen[:, k]] = np.iinfo(np.uint64).max
        chosen.sort(axis=1)
        key = np.arange(TABLES, dtype=np.uint64) * np.uint64(_BASE)
        for k in range(wanted):
            key = mixed(key ^ runs[chosen[:, k]]) + np.uint64(1)
    return key.view(np.int64)


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips, factors = _functions()
    longs = pa.list_(pa.int64())
    for batch in batches:
        texts = batch.column("text")
        out: tuple[list, ...] = ([], [], [], [], [])
        for i in range(batch.num_rows):
            words = plain_words(texts[i].as_py())
            if not words:
                for column, value in zip(out, (None, 0, None, None, None)):
                    column.append(value)
                continue
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            runs = labelled(kmers(hashes))
            bits = np.zeros(BITS, np.uint8)
            bits[(runs % np.uint64(BITS)).astype(np.int64)] = 1
            out[0].append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
            out[1].append(len(runs))
            out[2].append(order_keys(runs, flips, factors))
            out[3].append(np.packbits(bits).view(np.int64))
            out[4].append(hashes.astype("<u4").tobytes())
        kinds = (pa.binary(), pa.int64(), longs, longs, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("mark"), *[pa.array(c, t) for c, t in zip(out, kinds)]],
            names=["key", "mark", "node", "n", "keys", "bits", "words"],
        )


def _matched(a: np.ndarray, b: np.ndarray, most: int) -> list[int] | None:
    """Lengths of the runs of words matched by an alignment with the fewest edits, None beyond ``most`` edits.

    Furthest places on diagonals by number of edits: only diagonals up to ``most`` from the main one are visited.
    """

    def slide(x: int, k: int) -> int:
        size = 32
        while x < len(a) and x + k < len(b):
            n = min(size, len(a) - x, len(b) - x - k)
            differ = a[x : x + n] != b[x + k : x + k + n]
            first = int(differ.argmax())
            if differ[first]:
                return x + first
            x, size = x + n, size * 4
        return x

    target = len(b) - len(a)
    if abs(target) > most:
        return None
    reached = [{0: slide(0, 0)}]
    before = [{0: (0, None)}]  # where the last slide began and the diagonal it came from
    while reached[-1].get(target, -1) < len(a):
        if len(reached) > most:
            return None
        last, now, came = reached[-1], {}, {}
        for k in range(-len(reached), len(reached) + 1):
            options = []
            if k in last:
                options.append((last[k] + 1, k))  # another word
            if k - 1 in last:
                options.append((last[k - 1], k - 1))  # a word more in b
            if k + 1 in last:
                options.append((last[k + 1] + 1, k + 1))  # a word more in a
            options = [(x, d) for x, d in options if x <= len(a) and 0 <= x + k <= len(b)]
            if options:
                x, d = max(options)
                came[k] = (x, d)
                now[k] = slide(x, k)
        reached.append(now)
        before.append(came)
    runs, k = [], target
    for level in range(len(reached) - 1, -1, -1):
        start, source = before[level][k]
        runs.append(reached[level][k] - start)
        k = source
    return runs


def similarity(a: np.ndarray, b: np.ndarray, runs: tuple[np.ndarray, np.ndarray] | None = None) -> float:
    """Share of common k-mers by alignment; 0 if it cannot reach ``SIMILARITY``.

    ``runs`` are the labelled k-mers of both, if they are known.
    """
    own, other = max(1, len(a) - KMER + 1), max(1, len(b) - KMER + 1)
    least = SIMILARITY / (1 + SIMILARITY) * (own + other) - 1e-9  # common k-mers that are needed
    if min(own, other) < least:
        return 0.0
    if min(len(a), len(b)) < KMER:
        return float(np.array_equal(a, b))
    # The common k-mers of an alignment are no more than those of the bags, which are faster to count.
    if runs is None:
        runs = tuple(labelled(kmers(x.astype(np.uint64))) for x in (a, b))
    if len(np.intersect1d(*runs, assume_unique=True)) < least:
        return 0.0
    # An edit spoils at least one k-mer.
    matched = _matched(a, b, int(own + other - 2 * least) + 1)
    if matched is None:
        return 0.0
    common = sum(max(0, n - KMER + 1) for n in matched)
    return common / (own + other - common) if common >= least else 0.0


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("a_words").to_pylist(), batch.column("b_words").to_pylist())
        keep = [similarity(np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")) >= SIMILARITY - 1e-9 for a, b in pairs]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _links(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that alignment confirms."""
    words = nodes.select("node", "words")
    texts = pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("a_words")), "a")
    texts = texts.join(words.select(F.col("node").alias("b"), F.col("words").alias("b_words")), "b")
    return texts.select("a", "b", "a_words", "b_words").mapInArrow(_verified, "a binary, b binary")


def _popular_pairs(spark: SparkSession, members: DataFrame) -> DataFrame:
    """Each node with the most popular node that it shares a key with."""
    popular = members.groupBy("node").agg(F.sum("size").alias("size"))
    rated = members.select("key", "node").join(popular, "node")
    leaders = rated.groupBy("key").agg(F.max(F.struct("size", "node")).alias("leader"))
    found = rated.join(leaders, "key").where(F.struct("size", "node") < F.col("leader"))
    best = found.groupBy("node").agg(F.max("leader").alias("leader"))
    return best.select(F.col("node").alias("a"), F.col("leader.node").alias("b"))


def possible_pairs(
    n: np.ndarray, bits: np.ndarray, classes: np.ndarray, first: np.ndarray, others: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row of ``first`` and one of ``others`` (row numbers) of different classes that may be similar.

    The common k-mers of two texts are no more than those of one, less the bits that the other lacks.
    """
    rows, columns = [], []
    step = max(1, PAIRS_AT_ONCE // max(1, len(others)))
    for start in range(0, len(first), step):
        own = first[start : start + step]
        least = SIMILARITY / (1 + SIMILARITY) * (n[own][:, None] + n[others][None, :]) - 1e-6
        fits = (classes[own][:, None] != classes[others][None, :]) & (own[:, None] != others[None, :])
        fits &= np.minimum(n[own][:, None], n[others][None, :]) >= least
        if not fits.any():
            continue
        lacks = np.zeros(fits.shape, np.int64)
        lacked = np.zeros(fits.shape, np.int64)
        for w in range(bits.shape[1]):
            x, y = bits[own, w][:, None], bits[others, w][None, :]
            lacks += np.bitwise_count(x & ~y)
            lacked += np.bitwise_count(y & ~x)
        fits &= (n[own][:, None] - lacks >= least) & (n[others][None, :] - lacked >= least)
        i, j = np.nonzero(fits)
        rows.append(own[i])
        columns.append(others[j])
    none = np.empty(0, np.int64)
    return (np.concatenate(rows), np.concatenate(columns)) if rows else (none, none)


def links_of_group(group: list[tuple], same: bool) -> list[tuple[bytes, bytes]]:
    """Pairs of classes that a link joins among rows (table, root, in_second, n, keys, bits, words) of one key.

    Rows of the first block meet those of the second, or each other (``same``). Each pair is looked at under the first key
    that it shares, and only as long as its classes are not joined yet.
    """
    table = group[0][0]
    names = [g[1] for g in group]
    numbers = {name: i for i, name in enumerate(dict.fromkeys(names))}
    classes = np.array([numbers[name] for name in names])
    if len(numbers) < 2:
        return []
    second = np.array([g[2] for g in group])
    n = np.array([g[3] for g in group], np.int64)
    keys = np.array([g[4] for g in group], np.int64)
    # Signed numbers would be counted by their absolute value.
    bits = np.array([g[5] for g in group], np.int64).view(np.uint64)
    everyone = np.arange(len(group))
    first, others = (everyone, everyone) if same else (everyone[~second], everyone[second])
    a, b = possible_pairs(n, bits, classes, first, others)
    if same:
        a, b = a[a < b], b[a < b]
    for earlier in range(table):
        new = keys[a, earlier] != keys[b, earlier]
        a, b = a[new], b[new]
    joined = list(range(len(numbers)))

    def root(i: int) -> int:
        while joined[i] != i:
            joined[i] = joined[joined[i]]
            i = joined[i]
        return i

    words, runs = {}, {}
    by_number = list(numbers)
    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = root(classes[i]), root(classes[j])
        if x == y:
            continue
        for k in (i, j):
            if k not in words:
                words[k] = np.frombuffer(group[k][6], "<u4")
                runs[k] = np.sort(labelled(kmers(words[k].astype(np.uint64))))
        if similarity(words[i], words[j], (runs[i], runs[j])) >= SIMILARITY - 1e-9:
            joined[max(x, y)] = min(x, y)
            out.append((by_number[x], by_number[y]))
    return out


def _joined_classes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between classes, from rows sorted by key and pair of blocks."""
    names = ("key", "i", "j", "table", "root", "block", "n", "keys", "bits", "words")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    now, held = None, []

    def found() -> pa.RecordBatch:
        links = links_of_group(held, now[1] == now[2])
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], schema=schema)

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in names]
        for key, i, j, table, root, block, *rest in zip(*columns):
            if now != (key, i, j):
                if held:
                    yield found()
                now, held = (key, i, j), []
            held.append((table, root, block == j, *rest))
    if held:
        yield found()


def _class_links(members: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of nodes that share a key.

    The nodes of a key lie in blocks of a bounded size by a hash, and each pair of blocks is compared where it lies: rows
    grow with nodes times blocks of their key, pairs are never rows.
    """
    classed = members.select("table", "key", "node").join(roots, "node", "left")
    classed = classed.select("table", "key", "node", F.coalesce("root", "node").alias("root"))
    sized = classed.join(nodes.select("node", F.octet_length("words").alias("bytes")), "node")
    mixed_keys = sized.groupBy("key").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("rows"), F.sum("bytes").alias("bytes")
    )
    mixed_keys = mixed_keys.where(F.col("least") != F.col("most"))
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("bytes") / BLOCK_BYTES)).cast("int")
    rows = classed.join(mixed_keys.select("key", blocks.alias("blocks")), "key")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = rows.withColumn("other", other).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "table", "root", "block", "node"
    )
    full = paired.join(nodes.select("node", "n", "keys", "bits", "words"), "node").drop("node")
    group = ["key", "i", "j"]
    return full.repartition(*group).sortWithinPartitions(*group).mapInArrow(_joined_classes, "a binary, b binary")


def _classes(spark: SparkSession, documents: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Signed documents, and nodes with their roots."""
    columns = documents.select(
        F.col(key).cast("long").alias("key"),
        F.xxhash64(F.col(text)).alias("mark"),
        F.col(text).cast("binary").alias("text"),
    )
    signed = stored(spark, columns.mapInArrow(_signed, SIGNED), "signed")
    # Copies of a text give equal columns, so any of them will do; they are aggregated before the shuffle.
    known = signed.where(F.col("node").isNotNull())
    nodes = known.select("node", "keys").dropDuplicates(["node"])
    members = nodes.select("node", F.posexplode("keys").alias("table", "key"))
    shared = members.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    members = stored(spark, members.join(shared, "key"), "members")
    involved = members.select("node").distinct()
    texts = known.select("node", "n", "keys", "bits", "words").join(involved, "node", "left_semi").dropDuplicates(["node"])
    nodes = stored(spark, texts, "nodes")

    links = stored(spark, _links(_popular_pairs(spark, members), nodes), "links")
    roots = components(spark, links)
    # Classes are joined by the links between them; the nodes' own links are not needed again.
    more = stored(spark, _class_links(members, nodes, roots), "class-links")
    upper = components(spark, more).select(F.col("node").alias("root"), F.col("root").alias("top"))
    below = roots.join(upper, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return signed, below.union(upper.select("root", "top"))


def classes(spark: SparkSession, documents: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document: key, class_id (the smallest key of its class) and class_size (documents in it)."""
    signed, roots = _classes(spark, documents, key, text)
    rows = signed.select("key", "node")
    # Few distinct nodes stand for many rows: names and sizes of classes are made of counts per node.
    counts = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("key").alias("least"), F.count("*").alias("n"))
    rooted = counts.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least", "n")
    named = rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"))
    of_node = rooted.join(named, "root").select("node", "class_id", "class_size")
    return rows.join(of_node, "node", "left").select(
        F.col("key").alias(key),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
    )


def one_of_each(spark: SparkSession, documents: DataFrame, key: str, text: str) -> DataFrame:
    """The documents with one of each class: the smallest key (NULL last), of its texts the one with the least hash.

    Texts without words are classes of their own and all stay.
    """
    signed, roots = _classes(spark, documents, key, text)
    known = signed.where(F.col("node").isNotNull()).select("node", _order(F.col("key"), F.col("mark")))
    least = known.groupBy("node").agg(F.min("order").alias("order")).join(roots, "node", "left")
    chosen = least.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("order").alias("order"))
    alone = signed.where(F.col("node").isNull()).select(_order(F.col("key"), F.col("mark"))).distinct()
    wanted = chosen.select("order", F.lit(True).alias("__once")).union(alone.select("order", F.lit(False)))
    wanted = wanted.select(
        F.col("order.missing").alias("__missing"), F.col("order.key").alias("__key"), F.col("order.mark").alias("__mark"), "__once"
    )
    names = ["__missing", "__key", "__mark"]
    rows = documents.select(
        "*", _order(documents[key].cast("long"), F.xxhash64(documents[text])).alias("__order")
    ).select("*", *[F.col(f"__order.{n[2:]}").alias(n) for n in names])
    found = rows.drop("__order").join(wanted, names)
    # Rows that agree in key and text stand together already.
    number = F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(1)))
    found = found.withColumn("__number", number).where((F.col("__number") == 1) | ~F.col("__once"))
    return found.select(*[f"`{c}`" for c in documents.columns])


def _order(key: Column, mark: Column) -> Column:
    return F.struct(
        key.isNull().alias("missing"), F.coalesce(key, F.lit(0).cast("long")).alias("key"), mark.alias("mark")
    ).alias("order")
