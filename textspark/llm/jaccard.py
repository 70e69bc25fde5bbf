"""N-gram Jaccard join by signature trees.

Documents that share their least shingle hash and part of their prefixes, and are close in size, form a node; it holds
the OR of its members' prefix tokens and their size range. Two nodes can only hold a linked pair if
their prefixes share a token and their size ranges are compatible: all node pairs are tested at once, by
sorting the tokens of all nodes. Pairs of nodes that remain are walked in dual traversal over trees
of OR-combined bitmaps down to documents, whose shingle sets then are intersected exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textspark.llm.common import quoted, runs, small_batches
from textspark.operators.lookup import lookup
from textspark.session import materialise

WORDS = 5  # words of a shingle
NUMERATOR, DENOMINATOR = 75, 100  # least similarity
NODE_DOCS, NODE_TOKENS = 256, 1 << 18  # a node closes at either
OPEN_NODES, ALIKE = 8, 4  # nodes of one leaf that take documents at a time; the part of a prefix to share: a fourth
SLICE_TOKENS = 1 << 19  # prefix tokens sorted together
SAMPLE_SHARE, FREQUENT, FREQUENT_MOST = 16, 3, 1 << 20
PROBE, NEAREST = 2, 2  # members that stand for a node in the first walk, and how many of its pairs that takes
SPARSE, LEAST_BITS, MOST_BITS = 4, 8, 20  # a bitmap has at least four bits for each token, within 2^8 and 2^20
FANOUT = 8
GUESTS = 512  # documents held against one node in one task
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLANK = "\x20\t\n\x0b\x0c\r"


def shingles(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of the shingles of each text."""
    low = pc.ascii_lower(pc.fill_null(texts, ""))
    words = pc.ascii_split_whitespace(low)
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(n) for n in names), np.uint64, len(names))
    blank = np.fromiter((not n for n in names), bool, len(names))
    index = coded.indices.to_numpy(zero_copy_only=False)
    size = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    stream, empty = hashes[index], blank[index]
    found = []
    with np.errstate(over="ignore"):
        for lo, hi in zip((ends - size).tolist(), ends.tolist()):
            h = stream[lo:hi]
            if hi > lo and (empty[lo] or empty[hi - 1]):  # blanks at either end of the text
                h = h[~empty[lo:hi]]
            if not len(h):
                found.append(h)
                continue
            n = max(1, len(h) - WORDS + 1)
            mixed = np.zeros(n, np.uint64)
            for k in range(min(WORDS, len(h))):
                mixed = (mixed ^ h[k : k + n]) * _MIX
                mixed ^= mixed >> np.uint64(29)
            found.append(np.unique(mixed))
    return found


def needed(a: int, b: int) -> int:
    """The least intersection of linked sets of ``a`` and ``b`` members."""
    return -(-(a + b) * NUMERATOR // (NUMERATOR + DENOMINATOR))


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Bits set by the top bits of the tokens, packed."""
    row = np.zeros(1 << bits, bool)
    row[tokens >> np.uint64(64 - bits)] = True
    return np.packbits(row)


def map_bits(n: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, int(SPARSE * n).bit_length()))


def folded(packed: np.ndarray, length: int) -> np.ndarray:
    """A bitmap of ``length`` bytes that has a bit where any of those it stands for was set."""
    while len(packed) > length:
        packed = np.packbits(np.unpackbits(packed).reshape(-1, 2).max(1))
    return packed


def prefix(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first tokens of a set in the common order, frequent ones last: linked sets share one of them."""
    if len(frequent):
        at = np.searchsorted(frequent, tokens)
        common = frequent[np.minimum(at, len(frequent) - 1)] == tokens
        tokens = np.concatenate([tokens[~common], tokens[common]])
    n = len(tokens)
    return tokens[: n - -(-n * NUMERATOR // DENOMINATOR) + 1]


def frequent_tokens(docs: DataFrame, share: int = SAMPLE_SHARE) -> np.ndarray:
    """Tokens found often in a hashed share of the texts, sorted; at most ``FREQUENT_MOST``.

    They only move to the end of the order in which prefixes are cut, so neither the share nor the bound
    changes a result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = shingles(batch.column(0).slice(at, 512))
                if sets:
                    token, n = np.unique(np.concatenate(sets), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], names=["token", "n"])

    drawn = docs.select(F.col("text").cast("string").alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    # Equal texts count once: they are one class later.
    counts = drawn.distinct().mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(FREQUENT_MOST)
    with small_batches(docs.sparkSession):
        rows = top.select("token").toArrow().column(0).combine_chunks()
    return np.sort(rows.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def signed(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``_rid, n, leaf, digest, prefix, bits`` and the row itself as ``_row``; written, so the row numbers hold."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    row_type = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
    schema = T.StructType(
        [
            *(T.StructField(n, t()) for n, t in (("_rid", T.LongType), ("n", T.LongType), ("leaf", T.LongType))),
            *(T.StructField(n, T.BinaryType()) for n in ("digest", "prefix", "bits")),
            T.StructField("_row", row_type),
        ]
    )

    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = shingles(part.column(0).field(column).cast(pa.string()))
                heads = [prefix(s, shared.value) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(sets))),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([int(s[0].view(np.int64)) if len(s) else 0 for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([(p * _MIX).tobytes() for p in heads], pa.binary()),
                        pa.array([bitmap(s, map_bits(len(s))).tobytes() for s in sets], pa.binary()),
                        part.column(0),
                    ],
                    names=["_rid", "n", "leaf", "digest", "prefix", "bits", "_row"],
                )
                row += len(sets)

    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("_row"))
    with small_batches(docs.sparkSession):
        return materialise(rows.mapInArrow(run, schema))


def _compatible(a_low, a_high, b_low, b_high):
    """Whether some pair of sizes from two ranges can reach the least similarity."""
    return (DENOMINATOR * a_high >= NUMERATOR * b_low) & (DENOMINATOR * b_high >= NUMERATOR * a_low)


_PART = "kind string, a bigint, b bigint, slice int, low binary, high binary, node binary"


class _Open:
    """A node that still takes documents: close in size to its first one, with a part of its prefix."""

    def __init__(self, rid: int, n: int, tokens: np.ndarray) -> None:
        self.rows, self.prefixes, self.low, self.high, self.tokens = [rid], [tokens], n, n, n
        self.first = np.sort(tokens)

    def takes(self, n: int, tokens: np.ndarray) -> bool:
        if len(self.rows) >= NODE_DOCS or self.tokens + n > NODE_TOKENS or DENOMINATOR * n < NUMERATOR * self.high:
            return False
        at = np.minimum(np.searchsorted(self.first, tokens), len(self.first) - 1)
        return ALIKE * int((self.first[at] == tokens).sum()) >= len(self.first)

    def add(self, rid: int, n: int, tokens: np.ndarray) -> None:
        self.rows.append(rid)
        self.prefixes.append(tokens)
        self.low, self.tokens = n, self.tokens + n  # rows come by falling size


def _nodes(bits: int):
    """Streams sorted signatures into nodes; sends the prefix tokens of each node to slices of the token range.

    Emits ``copy`` rows (a row and the earlier one with an equal set), ``member`` rows (row, node) and one
    ``slice`` row for each slice and few thousand nodes, with tokens, nodes and size ranges as bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple[str, int, int, int]] = []
        nodes: list[tuple[int, int, int, np.ndarray]] = []
        held = 0
        open_: list[_Open] = []
        leaf = last = None

        def close(node: _Open) -> None:
            nonlocal held
            union = np.unique(np.concatenate(node.prefixes))
            name = node.rows[0]
            nodes.append((name, node.low, node.high, union))
            pairs.extend(("member", rid, name, at) for at, rid in enumerate(node.rows))
            held += len(union)

        def flush() -> pa.RecordBatch:
            nonlocal pairs, nodes, held
            kinds, a, b = [p[0] for p in pairs], [p[1] for p in pairs], [p[2] for p in pairs]
            slices, blobs = [], []
            if nodes:
                token = np.concatenate([u for *_, u in nodes])
                count = [len(u) for *_, u in nodes]
                info = np.repeat(np.array([(x, lo, hi) for x, lo, hi, _ in nodes], [("node", "<i8"), ("low", "<u4"), ("high", "<u4")]), count)
                at = (token >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(token), np.int64)
                order = np.argsort(at, kind="stable")
                token, info, at = token[order], info[order], at[order]
                cuts = np.flatnonzero(np.diff(at)) + 1
                for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                    slices.append(int(at[lo]))
                    # 40 bits beside the slice are enough to propose a pair; the walk decides.
                    rest = (token[lo:hi] << np.uint64(bits)) >> np.uint64(24)
                    five = np.ascontiguousarray(rest).view(np.uint8).reshape(-1, 8)[:, :5]
                    name, inverse = np.unique(info[lo:hi], return_inverse=True)
                    blobs.append((np.ascontiguousarray(five).tobytes(), inverse.astype("<u4" if len(name) > 65535 else "<u2").tobytes(), name.tobytes()))
            n, m = len(pairs), len(slices)
            places, none = [p[3] for p in pairs], [None] * n
            pairs, nodes, held = [], [], 0
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(kinds + ["slice"] * m, pa.string()), pa.array(a + [None] * m, pa.int64()), pa.array(b + [None] * m, pa.int64()),
                    pa.array(places + slices, pa.int32()), pa.array(none + [x[0] for x in blobs], pa.binary()),
                    pa.array(none + [x[1] for x in blobs], pa.binary()), pa.array(none + [x[2] for x in blobs], pa.binary()),
                ],
                names=["kind", "a", "b", "slice", "low", "high", "node"],
            )

        for batch in batches:
            for rid, n, at, digest, part in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if leaf == at and last[0] == (n, digest):
                    pairs.append(("copy", rid, last[1], 0))
                    continue
                if leaf != at:
                    while open_:
                        close(open_.pop())
                leaf, last = at, ((n, digest), rid)
                tokens = np.frombuffer(part, np.uint64)
                home = next((x for x in open_ if x.takes(n, tokens)), None)
                if home is None:
                    if len(open_) == OPEN_NODES:
                        close(open_.pop(0))
                    open_.append(_Open(rid, n, tokens))
                else:
                    home.add(rid, n, tokens)
                if held > SLICE_TOKENS:
                    yield flush()
        while open_:
            close(open_.pop())
        yield flush()

    return run


def overlap_of_prefixes(low, high):
    """The least number of prefix tokens that linked sets share, if their sizes lie between two numbers.

    Beyond the shorter reach of both prefixes, at most what follows one of them can be shared. What a larger
    set must share falls with its size but for steps of one up, so the size below the largest counts as well.
    """

    def least(high):
        need = -(-(low + high) * NUMERATOR // (NUMERATOR + DENOMINATOR))
        return need - -(-high * NUMERATOR // DENOMINATOR) + 1

    return np.maximum(np.minimum(least(high), least(np.maximum(high - 1, low))), 1)


def _meet(table: pa.Table) -> pa.RecordBatch:
    """Node pairs of one slice of the token range that share tokens and have compatible sizes.

    ``place`` counts the shared tokens, ``need`` is how many all slices together must find.
    """
    tokens, at, names, known = [], [], [], 0
    for low, high, name in zip(table["low"].to_pylist(), table["high"].to_pylist(), table["node"].to_pylist()):
        five = np.frombuffer(low, np.uint8).reshape(-1, 5)
        wide = np.zeros((len(five), 8), np.uint8)
        wide[:, :5] = five
        tokens.append(wide.view("<u8").ravel())
        names.append(np.frombuffer(name, [("node", "<i8"), ("low", "<u4"), ("high", "<u4")]))
        at.append(np.frombuffer(high, "<u4" if len(names[-1]) > 65535 else "<u2").astype(np.int64) + known)
        known += len(names[-1])
    token, node, names = np.concatenate(tokens), np.concatenate(at), np.concatenate(names)
    low, high = names["low"].astype(np.int64), names["high"].astype(np.int64)
    order = np.argsort(token, kind="stable")
    token, node = token[order], node[order]
    pairs, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    more: list[np.ndarray] = []
    held, step = 0, 1
    alive = np.arange(len(token))

    def merged() -> tuple[np.ndarray, np.ndarray]:
        new, n = np.unique(np.concatenate(more) if more else np.zeros(0, np.uint64), return_counts=True)
        both = np.concatenate([pairs, new])
        key, back = np.unique(both, return_inverse=True)
        return key, np.bincount(back, np.concatenate([counts, n]), len(key)).astype(np.int64)

    while True:  # the partner ``step`` places on, for every token at once
        alive = alive[alive + step < len(token)]
        alive = alive[token[alive] == token[alive + step]]
        if not len(alive):
            break
        for cut in range(0, len(alive), 1 << 20):
            x, y = node[alive[cut : cut + (1 << 20)]], node[alive[cut : cut + (1 << 20)] + step]
            fits = (x != y) & _compatible(low[x], high[x], low[y], high[y])
            x, y = x[fits], y[fits]
            more.append((np.minimum(x, y).astype(np.uint64) << np.uint64(32)) | np.maximum(x, y).astype(np.uint64))
            held += len(x)
            if held > 1 << 21:
                pairs, counts = merged()
                more, held = [], 0
        step += 1
    pairs, counts = merged()
    x, y = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    need = overlap_of_prefixes(np.minimum(low[x], low[y]), np.maximum(high[x], high[y]))
    a, b = names["node"][x], names["node"][y]
    return pa.RecordBatch.from_arrays(
        [pa.array(["pair"] * len(x), pa.string()), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(counts.astype(np.int32)), pa.array(need.astype(np.int32))],
        names=_FOUND,
    )


_FOUND = ["kind", "a", "b", "place", "need"]


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices one after the other, each a run of rows in the sorted partition; other rows pass."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        is_slice = pc.equal(batch.column("kind"), "slice")
        others = batch.filter(pc.invert(is_slice))
        yield pa.RecordBatch.from_arrays([*others.columns[:4], pa.nulls(len(others), pa.int32())], names=_FOUND)
        rows = batch.filter(is_slice)
        at = rows.column("slice").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if held and held[0].column("slice")[0].as_py() != at[lo]:
                yield _meet(pa.Table.from_batches(held))
                held = []
            held.append(rows.slice(lo, hi - lo))
    if held:
        yield _meet(pa.Table.from_batches(held))


class _Tree:
    """Sets under nodes of ``FANOUT`` children, with OR-combined bitmaps and ranges of size."""

    def __init__(self, names: list[int], sets: list[np.ndarray], bits: int) -> None:
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), names[i]))
        self.names, self.sets = [names[i] for i in order], [sets[i] for i in order]
        size = np.array([len(s) for s in self.sets])
        maps = np.stack([bitmap(s, bits) for s in self.sets])
        # Tokens that fall on a bit another token has set: so many more may be shared than bits.
        beyond = size - np.bitwise_count(maps).sum(1)
        self.levels = [(maps, size, size, beyond)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, beyond = self.levels[-1]
            cut = np.arange(0, len(maps), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(beyond, cut)))

    def members(self, level: int, at: int) -> range:
        width = FANOUT**level
        return range(at * width, min((at + 1) * width, len(self.sets)))


def walk(a: _Tree, b: _Tree, root) -> Iterator[tuple[int, int]]:
    """Links between documents of two trees (or within one), as many as join what they join.

    Goes down from the pair of roots. A pair of nodes is left out if no sizes in their ranges fit, if
    the bits they share allow no sufficient overlap, or if all their documents are joined already.
    """
    todo = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while todo:
        i, x, j, y = todo.pop()
        if a is b and (i, x) > (j, y) and i == j:
            continue
        maps, low, high, beyond = a.levels[i]
        maps2, low2, high2, beyond2 = b.levels[j]
        if not _compatible(low[x], high[x], low2[y], high2[y]):
            continue
        most = int(np.bitwise_count(maps[x] & maps2[y]).sum()) + min(int(beyond[x]), int(beyond2[y]))
        if most < needed(int(low[x]), int(low2[y])):
            continue
        if i == 0 and j == 0:
            p, q = a.names[x], b.names[y]
            if p == q or root(p) == root(q):
                continue
            s, t = a.sets[x], b.sets[y]
            if len(s) > len(t):
                s, t = t, s
            at = np.searchsorted(t, s)
            at[at == len(t)] = 0
            both = int((t[at] == s).sum())
            if DENOMINATOR * both >= NUMERATOR * (len(s) + len(t) - both):
                yield p, q
            continue
        tops = {root(a.names[k]) for k in a.members(i, x)}
        if len(tops) == 1 and tops == {root(b.names[k]) for k in b.members(j, y)}:
            continue
        if i >= j and i:
            kids = range(x * FANOUT, min((x + 1) * FANOUT, len(a.levels[i - 1][0])))
            if a is b and i == j:
                pairs = [(k, m) for k in kids for m in range(y * FANOUT, min((y + 1) * FANOUT, len(b.levels[j - 1][0])))]
                todo.extend((i - 1, k, j - 1, m) for k, m in pairs if x != y or k <= m)
            else:
                todo.extend((i - 1, k, j, y) for k in kids)
        else:
            todo.extend((i, x, j - 1, m) for m in range(y * FANOUT, min((y + 1) * FANOUT, len(b.levels[j - 1][0]))))


def _links(rows: pa.Table, inside: bool) -> list[tuple[int, int]]:
    """Links of a unit: between its guests and its hosts and, with ``inside``, among the hosts.

    Documents that share a ``label`` are joined already.
    """
    names, guest, labels = rows["rid"].to_pylist(), rows["guest"].to_pylist(), rows["label"].to_pylist()
    sets = shingles(rows["text"].combine_chunks())
    up = {r: x for r, x in zip(names, labels) if x is not None and x != r}

    def root(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    bits = map_bits(max(len(s) for s in sets))
    hosts, guests = (
        _Tree([r for r, g in zip(names, guest) if g == side], [s for s, g in zip(sets, guest) if g == side], bits) if side in guest else None
        for side in (False, True)
    )
    found = []
    # Inside first: what is joined there, one link from outside joins as a whole.
    for s, t in ([(hosts, hosts)] if inside and hosts else []) + ([(hosts, guests)] if hosts and guests else []):
        for p, q in walk(s, t, root):
            up[root(p)] = root(q)
            found.append((p, q))
    return found


def _walk_units(inside: bool):
    """Units are runs of rows with equal ``unit`` and ``chunk`` in sorted partitions; a run may go on in the next batch."""

    def done(rows: pa.Table) -> pa.RecordBatch:
        ends = _links(rows, inside)
        return pa.RecordBatch.from_arrays([pa.array([e[0] for e in ends], pa.int64()), pa.array([e[1] for e in ends], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if held and keys[lo] != last:
                    yield done(pa.Table.from_batches(held))
                    held = []
                last = keys[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield done(pa.Table.from_batches(held))

    return run


def _sketch(table: pa.Table) -> pa.RecordBatch:
    """OR of the bitmaps of a node's members, their sizes, and the most tokens one has beyond its bits."""
    maps = [np.frombuffer(b, np.uint8) for b in table["bits"].to_pylist()]
    shortest = min(map(len, maps))
    maps = np.stack([folded(m, shortest) for m in maps])
    n = table["n"].to_numpy()
    beyond = n - np.bitwise_count(maps).sum(1)
    return pa.RecordBatch.from_arrays(
        [table["node"].combine_chunks()[:1], pa.array([np.bitwise_or.reduce(maps).tobytes()], pa.binary()), pa.array([int(n.min())]), pa.array([int(beyond.max())])],
        names=["node", "bits", "low", "beyond"],
    )


def _overlapping(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes whose common bits allow the overlap that their smallest members need."""
    for batch in batches:
        fits = []
        columns = (batch.column(c).to_pylist() for c in ("bits_a", "bits_b", "low_a", "low_b", "beyond_a", "beyond_b"))
        for x, y, low, low2, beyond, beyond2 in zip(*columns):
            # A folded bitmap no longer says what its members have beyond it; the other one's bound holds.
            over = min(beyond, beyond2) if len(x) == len(y) else beyond if len(x) < len(y) else beyond2
            short = min(len(x), len(y))
            x, y = folded(np.frombuffer(x, np.uint8), short), folded(np.frombuffer(y, np.uint8), short)
            fits.append(int(np.bitwise_count(x & y).sum()) + over >= needed(low, low2))
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b", "rank")], names=["a", "b", "rank"]).filter(pa.array(fits, pa.bool_()))


def pruned(met: DataFrame, members: DataFrame, facts: DataFrame) -> DataFrame:
    """Node pairs ``a, b, rank`` that their bitmaps don't rule out; ``rank`` is low for the likeliest."""
    inside = materialise(met.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    rows = members.join(inside, "node").join(facts.select("_rid", "n", "bits"), "_rid").select("node", "n", "bits")
    sketches = rows.repartition("node").sortWithinPartitions("node").mapInArrow(runs(_sketch), "node bigint, bits binary, low bigint, beyond bigint")
    sketches = materialise(sketches)
    sides = [sketches.select(*[F.col(c).alias(f"{c}_{x}") for c in sketches.columns]).withColumnRenamed(f"node_{x}", x) for x in "ab"]
    return met.join(sides[0], "a").join(sides[1], "b").mapInArrow(_overlapping, "a bigint, b bigint, rank double")


def _walked(hosts: DataFrame, guests: DataFrame, facts: DataFrame, inside: bool) -> DataFrame:
    """Links ``a, b`` found in units: the members of a node (``hosts``) and documents to be held against them.

    Both are ``unit, _rid, label``. A unit with many guests is cut into chunks, each with all hosts.
    """
    sizes = guests.groupBy("unit").agg(F.ceil(F.count("*") / GUESTS).alias("chunks"))
    came = guests.join(sizes, "unit").select("unit", F.pmod(F.xxhash64("_rid"), "chunks").alias("chunk"), "_rid", "label", F.lit(True).alias("guest"))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("chunks", F.lit(1)) - 1)).alias("chunk")
    home = hosts.join(sizes, "unit", "left").select("unit", chunk, "_rid", "label", F.lit(False).alias("guest"))
    rows = materialise(home.union(came))
    # The texts of documents in some unit, each read once before copies go to its units.
    wanted = materialise(rows.select("_rid").distinct())
    texts = materialise(lookup(facts.select("_rid", F.col("_row.text").cast("string").alias("text")), wanted, "_rid", "inner"))
    laid = rows.join(texts, "_rid").select("unit", "chunk", F.col("_rid").alias("rid"), "label", "guest", "text")
    laid = laid.repartition("unit", "chunk").sortWithinPartitions("unit", "chunk")
    with small_batches(facts.sparkSession):
        return materialise(laid.mapInArrow(_walk_units(inside), "a bigint, b bigint"))


def connected(links: DataFrame) -> DataFrame:
    """``node, label``: the least node reachable over ``links`` (``a, b``), for nodes with links.

    Alternates two star steps, each a pre-aggregated minimum and a join; every step is written, so no
    lineage grows. The number of rounds is logarithmic in the longest path for all practical graphs.
    """
    edges = materialise(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = materialise(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = materialise(small.where("a != b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


def classes(docs: DataFrame) -> DataFrame:
    """``_row, _rid, n, component_id, keeper`` for every row of ``docs``.

    ``n`` counts the distinct shingles of ``WORDS`` lower-cased (A-Z) words; a text with fewer words is
    one shingle, a text without words (or null) has none and is linked with nothing. Two rows are
    linked if their sets reach the least similarity; ``component_id`` is the least ``doc_id``
    reachable, ``keeper`` the row that has it (of repeated ids, the first). Rows with equal sets are one
    class from the start. The result is exact but for collisions of 64-bit shingle hashes.
    """
    frequent = frequent_tokens(docs)
    facts = signed(docs, frequent)
    total = facts.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    bits = max(0, min(24, (total // 8 // SLICE_TOKENS).bit_length()))
    order = ["leaf", F.desc("n"), "digest", "_rid"]
    placed = facts.where("n > 0").select("_rid", "n", "leaf", "digest", "prefix").repartitionByRange(*order).sortWithinPartitions(*order)
    parts = placed.mapInArrow(_nodes(bits), _PART)
    at = F.when(F.col("kind") == "slice", F.col("slice"))
    parts = parts.repartition(F.coalesce(at, F.hash("a"))).sortWithinPartitions(at)
    with small_batches(docs.sparkSession):
        found = materialise(parts.mapInArrow(_meetings, "kind string, a bigint, b bigint, place int, need int"), partition_by="kind")
    members = found.where("kind = 'member'").select(F.col("a").alias("_rid"), F.col("b").alias("node"), "place")
    met = found.where("kind = 'pair'").groupBy("a", "b").agg(F.sum("place").alias("met"), F.max("need").alias("need"))
    met = materialise(met.where("met >= need").select("a", "b", (F.col("need") / F.col("met")).alias("rank")))
    pairs = materialise(pruned(met, members, facts))
    # First every node in itself, with two members of its likeliest partners as guests.
    docs_of = materialise(members.groupBy("node").agg(F.count("*").alias("docs")))
    line = Window.partitionBy("node").orderBy("rank", "a", "b")
    both = pairs.select("a", "b", "rank", F.explode(F.array("a", "b")).alias("node"))
    near = both.withColumn("_at", F.row_number().over(line)).where(F.col("_at") <= NEAREST).select("a", "b").distinct()
    near = near.join(docs_of.select(F.col("node").alias("a"), F.col("docs").alias("docs_a")), "a")
    near = materialise(near.join(docs_of.select(F.col("node").alias("b"), F.col("docs").alias("docs_b")), "b"))
    fewer = F.when(F.col("docs_a") <= F.col("docs_b"), F.col("a")).otherwise(F.col("b"))
    sent = near.select(F.when(fewer == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("unit"), fewer.alias("node"))
    nothing = F.lit(None).cast("bigint").alias("label")
    guests = materialise(sent.join(members.where(F.col("place") < PROBE), "node").select("unit", "_rid", nothing))
    units = docs_of.where("docs > 1").select("node").union(guests.select("unit")).distinct()
    hosts = members.join(units, "node").select(F.col("node").alias("unit"), "_rid", nothing)
    links = _walked(hosts, guests, facts, inside=True)
    joined = materialise(connected(links))
    # Then all other pairs: what of one node isn't joined with most of the other visits that other one.
    label = members.join(joined.withColumnRenamed("node", "_rid"), "_rid", "left")
    label = materialise(label.select("node", "_rid", F.coalesce("label", "_rid").alias("label")))
    state = label.groupBy("node").agg(F.mode("label", deterministic=True).alias("most"), F.min("label").alias("low"), F.max("label").alias("high"))
    state = materialise(state.join(docs_of, "node"))
    sides = [state.select(*[F.col(c).alias(f"{c}_{x}") for c in state.columns]).withColumnRenamed(f"node_{x}", x) for x in "ab"]
    open_ = pairs.join(sides[0], "a").join(sides[1], "b").where(
        ~((F.col("low_a") == F.col("high_b")) & (F.col("high_a") == F.col("low_b")))
    )
    walked = near.where(F.least("docs_a", "docs_b") <= PROBE).select("a", "b")  # walked in full
    open_ = materialise(open_.select("a", "b", "most_a", "most_b", "docs_a", "docs_b").join(walked, ["a", "b"], "left_anti"))
    if not open_.isEmpty():
        alike = F.col("most_a") == F.col("most_b")
        smaller = F.col("docs_a") <= F.col("docs_b")
        none = F.lit(None).cast("bigint")
        moves = F.array(
            F.when(alike | smaller, F.struct(F.col("a").alias("node"), F.col("b").alias("unit"), F.when(alike, F.col("most_b")).otherwise(none).alias("but"))),
            F.when(alike | ~smaller, F.struct(F.col("b").alias("node"), F.col("a").alias("unit"), F.when(alike, F.col("most_a")).otherwise(none).alias("but"))),
        )
        moves = open_.select(F.explode(moves).alias("m")).where("m is not null").select("m.*")
        guests = moves.join(label, "node").where(F.col("but").isNull() | (F.col("label") != F.col("but")))
        guests = materialise(guests.select("unit", "_rid", "label").distinct())
        hosts = label.join(guests.select(F.col("unit").alias("node")).distinct(), "node").select(F.col("node").alias("unit"), "_rid", "label")
        joined = materialise(connected(links.union(_walked(hosts, guests, facts, inside=False))))
    joined = joined.withColumnRenamed("node", "_rid")
    copies = found.where("kind = 'copy'").select(F.col("a").alias("_rid"), F.col("b").alias("rep"))
    heads = materialise(copies.groupBy("rep").agg((F.count("*") + 1).alias("rows")))
    heads = materialise(heads.join(joined, heads["rep"] == joined["_rid"], "left").select("rep", F.coalesce("label", "rep").alias("label"), "rows"))
    tied = joined.union(heads.select(F.col("rep").alias("_rid"), "label")).distinct()
    tied = materialise(tied.union(lookup(copies, heads, "rep", "inner", weight="rows").select("_rid", "label")))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_rid").alias("rid"))
    ids = facts.select("_rid", F.col("_row.doc_id").alias("doc_id"))
    least = tied.join(ids, "_rid").groupBy("label").agg(F.min(first).alias("first"), F.count("*").alias("rows"))
    least = materialise(least.select("label", F.col("first.id").alias("component_id"), F.col("first.rid").alias("_keep"), "rows"))
    named = materialise(lookup(tied, least, "label", "inner", weight="rows").select("_rid", "component_id", "_keep"))
    out = lookup(facts.select("_rid", "n", "_row"), named, "_rid")
    return out.select(
        "_row",
        "_rid",
        "n",
        F.when(F.col("_keep").isNull(), F.col("_row.doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("_keep") == F.col("_rid"), F.lit(True)).alias("keeper"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``: of every class of linked rows the one with the least ``doc_id``."""
    return classes(docs).where("keeper").select("_row.*")
