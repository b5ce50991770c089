"""Trie of conversation prefixes, from composable fingerprints of turn sequences.

Each conversation is rebuilt from the first ``h`` turns of its base and its own turns after its first ``h``. A sequence of
turns has a fingerprint: its length and, for three primes p, the sum of t(i) * r^i mod p over its turns. Such pairs form
a monoid: (n, F) * (m, G) = (n + m, F + r^n * G). The fingerprint of a rebuilt prefix is therefore the product of the base's head
and a stretch of the conversation's own turns, which is the difference of two of its own prefixes, shifted; no rebuilt text
exists anywhere. A node of the trie is a group of equal (depth, fingerprint).

Groups verify equality: all members of a node must refer to one turn key and one parent, and all stored turns of one
key must have one role and text; by induction over depths the members' sequences are then equal. Should a group fail, all is
made again from other hash seeds.

Nothing is gathered by conversation or node: turns are numbered by ranges, running sums go by stretches of ``STRETCH``
positions, and the sum over a subtree is found without walking it: each node's value stands on the path of its smallest
member, is summed up along that path, and the members' sums are added up by node. Only the digest of a node's
ends is sequential, as SHA-256 is: sorted ids are written out in pieces side by side, and one task streams a node's pieces.

Defined cases. Turns are ordered by turn, null first, ties by role, by the text's first 64 characters, then by hash. A null role
or text is empty. A turn without conv_id belongs to no conversation. Repeated rows are turns of their own. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wideskein.llm.common import cut, in_order, slices, text_or_empty, word_count

#: Primes below 2^31 and a base for each; products of two residues fit a long.
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)
BASES = (1_234_567_891, 987_654_321, 1_122_334_455)
#: Positions whose running sums one window holds.
STRETCH = 4096
#: Conversations of one group of bases, and how many different heads there are.
GROUP, HEADS = 20, 4
#: Ids in one piece of a digest's input.
PIECE = 20_000
_J = range(len(PRIMES))
_NODE = ["depth", *(f"f{j}" for j in _J)]
_PARENT = [f"p{j}" for j in _J]


def head_length(conv: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(HEADS)).cast("int")


def _power(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    """base^exponents mod prime, elementwise."""
    out, square, left = np.ones(len(exponents), dtype=np.uint64), np.uint64(base), exponents.astype(np.uint64)
    p = np.uint64(prime)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * square % p
        square = square * square % p
        left >>= np.uint64(1)
    return out


def _terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """t(pos) * r^pos for each prime, beside conv_id, pos, k0, k1 and words."""
    for batch in slices(batches, 4096):
        pos = batch.column(1).to_numpy()
        a, b = (batch.column(i).to_numpy().view(np.uint64) for i in (2, 3))
        terms = []
        for j in _J:
            p = np.uint64(PRIMES[j])
            turn = (a % p * np.uint64(BASES[(j + 1) % 3]) + b % p) % p
            terms.append(pa.array((turn * _power(BASES[j], pos, PRIMES[j]) % p).astype(np.int64)))
        yield pa.RecordBatch.from_arrays([*batch.columns, *terms], names=[*batch.schema.names, *(f"t{j}" for j in _J)])


def running_sums(df: DataFrame, key: str, at: str, values: list[str], backwards: bool = False) -> DataFrame:
    """``df`` with, for each of the values, before_<value>: the sum over the key's rows before it (after it, if ``backwards``).

    ``at`` is a whole number from 0 that is unique in a key and leaves few gaps. Sums within a stretch of positions are added to the
    sums of the stretches before it, so a key with most of all rows is in many windows.
    """
    dealt = df.withColumn("_stretch", F.floor(F.col(at) / STRETCH))
    order = (lambda c: F.col(c).desc()) if backwards else F.col
    sums = dealt.groupBy(key, "_stretch").agg(*(F.sum(v).alias(f"_sum_{v}") for v in values))
    of_key = Window.partitionBy(key).orderBy(order("_stretch")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(key, "_stretch", *(F.coalesce(F.sum(f"_sum_{v}").over(of_key), F.lit(0)).alias(f"_start_{v}") for v in values))
    within = Window.partitionBy(key, "_stretch").orderBy(order(at)).rowsBetween(Window.unboundedPreceding, -1)
    inner = dealt.select("*", *(F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"_in_{v}") for v in values))
    summed = inner.join(starts, [key, "_stretch"])
    return summed.withColumns({f"before_{v}": F.col(f"_in_{v}") + F.col(f"_start_{v}") for v in values}).drop("_stretch", *(f"_in_{v}" for v in values), *(f"_start_{v}" for v in values))


def _keyed(conversations: DataFrame, seed: int) -> DataFrame:
    role, text = text_or_empty("role").alias("role"), text_or_empty("text").alias("text")
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role, text)
    keys = {"k0": F.xxhash64("role", "text", F.lit(seed)), "k1": F.xxhash64("text", "role", F.lit(~seed))}
    return turns.withColumns(keys)


def turn_keys_hold(turns: DataFrame) -> bool:
    """Whether all stored turns of a key have one role and text."""
    content = F.struct("role", "text")
    return not turns.groupBy("k0", "k1").agg(F.min(content).alias("low"), F.max(content).alias("high")).where("low <> high").take(1)


def stored_prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their position and the fingerprints before (e) and after (i) them; conv_id and n, its number of turns."""
    narrow = turns.select("conv_id", "turn", "role", F.substring("text", 1, 64).alias("head"), "k0", "k1", word_count().alias("words"))
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), *(F.col(c).asc() for c in ("role", "head", "k0"))]
    placed = in_order(narrow, order, "at", "trie-turns").select("conv_id", "at", "k0", "k1", "words")
    lengths = cut(placed.groupBy("conv_id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "trie-lengths")
    numbered = placed.join(lengths, "conv_id").select("conv_id", (F.col("at") - F.col("first")).alias("pos"), "k0", "k1", "words")
    terms = numbered.mapInArrow(_terms, "conv_id long, pos long, k0 long, k1 long, words long, " + ", ".join(f"t{j} long" for j in _J))
    summed = running_sums(cut(terms, "trie-terms"), "conv_id", "pos", [f"t{j}" for j in _J])
    prints = {f"e{j}": F.col(f"before_t{j}") % PRIMES[j] for j in _J} | {f"i{j}": (F.col(f"before_t{j}") + F.col(f"t{j}")) % PRIMES[j] for j in _J}
    prefixes = summed.withColumns(prints).select("conv_id", "pos", "k0", "k1", "words", *prints)
    return cut(prefixes, "trie-prefixes"), lengths.select("conv_id", "n")


def rebuilt_prefixes(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row for each prefix of each rebuilt conversation: its node, the parent node, the key and words of its last turn, and whether it is whole."""
    conv = lengths.withColumns({"h": head_length(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % GROUP})
    conv = conv.join(lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
    conv = conv.withColumn("taken", F.least(F.col("h"), F.coalesce("n_base", F.lit(0))).cast("int"))
    heads = cut(prefixes.where(F.col("pos") < HEADS - 1), "trie-heads")
    ends = heads.select(F.col("conv_id").alias("base"), (F.col("pos") + 1).cast("int").alias("taken"), *(F.col(f"i{j}").alias(f"b{j}") for j in _J))
    own = heads.select("conv_id", (F.col("pos") + 1).cast("int").alias("h"), *(F.col(f"i{j}").alias(f"o{j}") for j in _J))
    conv = conv.join(ends, ["base", "taken"], "left").join(own, ["conv_id", "h"], "left").na.fill(0, [f"{x}{j}" for x in "bo" for j in _J])
    conv = cut(conv.withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h"))), "trie-convs")

    whole = (F.col("depth") == F.col("length")).alias("whole")
    root = conv.select("conv_id", F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(c) for c in (*_NODE[1:], *_PARENT, "k0", "k1", "words")), (F.col("length") == 0).alias("whole"))
    from_base = conv.where("taken > 0").select("conv_id", "base", "length", F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken").cast("long"))).alias("depth"))
    stored = heads.select(F.col("conv_id").alias("base"), (F.col("pos") + 1).alias("depth"), "k0", "k1", "words", *(F.col(f"i{j}").alias(f"f{j}") for j in _J), *(F.col(f"e{j}").alias(f"p{j}") for j in _J))
    out = ["conv_id", *_NODE, *_PARENT, "k0", "k1", "words", whole]
    head = from_base.join(stored, ["base", "depth"]).select(*out)

    def product(j: int, mine: str) -> Column:
        """The base's head times the own stretch from h on, moved from h back to the head's length."""
        p, back = PRIMES[j], F.col("h") - F.col("taken")
        shift = F.element_at(F.array(*(F.lit(pow(BASES[j], -k, p)) for k in range(HEADS))), (back + 1).cast("int"))
        return (F.col(f"b{j}") + F.pmod(F.col(f"{mine}{j}") - F.col(f"o{j}"), F.lit(p)) * shift) % p

    after = prefixes.join(conv.drop("n", "base", "n_base"), "conv_id").where("pos >= h").withColumn("depth", F.col("pos") - F.col("h") + F.col("taken") + 1)
    after = after.withColumns({f"f{j}": product(j, "i") for j in _J} | {f"p{j}": product(j, "e") for j in _J}).select(*out)
    return root.unionByName(head).unionByName(after)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ids sorted by node: the node, the first id and the joined decimals of at most ``PIECE`` ids that follow each other."""
    names = [*_NODE, "first", "ids"]
    for batch in slices(batches, PIECE):
        if not batch.num_rows:
            continue
        node = np.stack([batch.column(i).to_numpy() for i in range(len(_NODE))])
        ids = batch.column(len(_NODE)).to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((node[:, 1:] != node[:, :-1]).any(axis=0)) + 1])
        stops = [*starts[1:], len(ids)]
        made = [pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, stops, strict=True)], pa.string())]
        yield pa.RecordBatch.from_arrays([*(pa.array(row[starts]) for row in node), pa.array(ids[starts]), *made], names=names)


def _streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A node's digest from its pieces in order; one piece is held at a time."""
    names, at, digest = [*_NODE, "ends_sha256"], None, None
    done: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in list(zip(*done, strict=True))[:-1]]
        return pa.RecordBatch.from_arrays([*columns, pa.array([d[-1] for d in done], pa.string())], names=names)

    for batch in slices(batches):
        for *node, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node == at:
                digest.update(b",")
            else:
                if at is not None:
                    done.append((*at, digest.hexdigest()))
                at, digest = node, hashlib.sha256()
            digest.update(ids.encode())
        if len(done) >= 1000:
            yield flushed()
            done = []
    if at is not None:
        done.append((*at, digest.hexdigest()))
        yield flushed()


def end_digests(ends: DataFrame) -> DataFrame:
    """Node and SHA-256 of the ascending decimal ids of conversations that end there, joined by commas."""
    longs = ", ".join(f"{c} long" for c in _NODE)
    pieces = ends.select(*_NODE, "conv_id").repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id").mapInArrow(_runs, f"{longs}, first long, ids string")
    return pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(_streamed, f"{longs}, ends_sha256 string")


def prefix_trie(conversations: DataFrame, seeds: tuple[int, ...] = (17, 71, 713)) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    for seed in seeds:
        turns = _keyed(conversations, seed)
        paths = cut(rebuilt_prefixes(*stored_prefixes(turns)), "trie-paths")
        reference = F.struct(*_PARENT, "k0", "k1")
        nodes = paths.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.min(reference).alias("low"), F.max(reference).alias("high"))
        nodes = cut(nodes, "trie-nodes")
        if not nodes.where("low <> high").take(1) and turn_keys_hold(turns):
            return _measured(paths, nodes)
    raise RuntimeError(f"turns or prefixes that differ share a fingerprint under each of the seeds {seeds}")


def _measured(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    nodes = nodes.select(*_NODE, "n_convs", "conv_id", "words", *(F.col(f"low.{c}").alias(c) for c in _PARENT))
    up = [(F.col("depth") - 1).alias("depth"), *(F.col(p).alias(f) for p, f in zip(_PARENT, _NODE[1:], strict=True))]
    children = nodes.where("depth > 0").select(*up).groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(nodes.join(children, _NODE, "left").na.fill(0, ["n_children"]), "trie-children")
    values = nodes.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    along = paths.select("conv_id", *_NODE).join(values, ["conv_id", "depth"], "left").na.fill(0, ["leaf", "saved"])
    summed = running_sums(cut(along, "trie-along"), "conv_id", "depth", ["leaf", "saved"], backwards=True)
    totals = summed.groupBy(*_NODE).agg(F.sum(F.col("leaf") + F.col("before_leaf")).alias("n_leaves"), F.sum(F.col("saved") + F.col("before_saved")).alias("saved_tokens"))
    digests = end_digests(paths.where("whole"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *(F.col(f).alias(p) for p, f in zip(_PARENT, _NODE[1:], strict=True)), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(totals, _NODE).join(digests, _NODE, "left")
    return whole.join(parents, ["depth", *_PARENT], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    )
