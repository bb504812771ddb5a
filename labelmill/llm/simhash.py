"""SimHash near-dedup: fingerprints, pigeonhole blocks, verified Hamming distance, groups.

A fingerprint is cut into blocks. Two fingerprints that differ in few bits agree
in whole blocks: with ``blocks`` blocks and at most ``radius`` differing bits, at
least ``blocks - radius`` of them. Equal fingerprints are one to begin with. Each
distinct one is keyed by every choice of ``agree`` blocks, pairs that share a key
are compared, and those within the radius are links.

A key that very many distinct fingerprints share (a large group of near copies)
does not get all its pairs. Where ``agree`` blocks must agree, such a bucket is
linked through centres: two fingerprints differ in at most two bits exactly if
they share a fingerprint that differs from each in at most one, so each member
names the centres around it in the bits outside the key, and the members of a
centre, all within two bits of each other, are linked to its smallest.

A similarity of word shingles far below one needs a radius that no block
arrangement covers for certain. ``SIMILAR`` is the arrangement for a Jaccard
similarity of 0.8: 1,024 bits, of which texts that similar differ in 155 on
average, in 64 blocks; one equal block makes a pair a candidate. The distance only
finds candidates: a link is a pair whose sets of shingles are that similar, counted
in full. Blocks of 16 bits meet many strangers, so a key travels with ``CHECK``
longs of the fingerprint, not with all of it, and a bucket of up to ``WHOLE``
compares all its pairs on those where it lies; what is left is few and is compared
in full. A bucket that is larger, or in which most members are near many others (a
large group of near copies), is crowded: its members first meet
the smallest id and the smallest of those that share one more block; members that
are not connected to the bucket's hub by then meet all others of the bucket, in
parts, so that a pair that shares a block is compared or already connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import LOWER, cut, pieces, row_key, settled, text_of, texts_of
from labelmill.llm.components import components

#: Buckets of more distinct fingerprints are linked without comparing all pairs.
PAIRED = 64
PAIRED_WIDE = 16
#: Buckets of more wide fingerprints are crowded without a look at their pairs.
WHOLE = 1024
#: Longs of a wide fingerprint that travel with each of its keys.
CHECK = 2
#: Blocks that split such a bucket further where its fingerprints are wide.
FURTHER = 1
SEED = 42
_BITS = 64
SIMILAR = {"shingle_words": 5, "bits": 1024, "blocks": 64, "agree": 1, "radius": 190, "similarity": 0.8}
#: Members of a large bucket that meet in one part, on either side.
PART = 128


def _shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words, joined by one blank; of the whole text's words if there are fewer."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())), np.uint64, len(words) - size + 1
    )


def _majority(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each run of hashes the bits that are set in over half of them."""
    out = np.zeros(len(ends), np.uint64)
    starts = np.concatenate([[0], ends[:-1]])
    full = np.flatnonzero(ends > starts)
    if not len(full):
        return out
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.add.reduceat(bits, starts[full], axis=0, dtype=np.int32)
    set_bits = sums * 2 > (ends - starts)[full, None]
    out[full] = np.packbits(set_bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def _mixed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """Independent bits from a hash; the first 64 are the hash itself."""
    if not turn:
        return hashes
    x = hashes + np.uint64((turn * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 3, bits: int = 64) -> DataFrame:
    """(id, h, fingerprint): one row per row of ``docs``, the fingerprint as ``bits / 64`` longs.

    Null, empty and blank texts have no words and fingerprint zero. Wide
    fingerprints count a repeated shingle once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                hashes = [_shingle_hashes(t, shingle_words) for t in texts_of(batch)]
                if bits > _BITS:  # similarity is of sets
                    hashes = [np.unique(h) for h in hashes]
                ends = np.cumsum([len(h) for h in hashes])
                flat = np.concatenate(hashes)
                longs = np.stack([_majority(_mixed(flat, k), ends) for k in range(bits // _BITS)], axis=1).view(np.int64)
                offsets = np.arange(len(hashes) + 1, dtype=np.int32) * (bits // _BITS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("h"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(longs.ravel()))],
                    names=["id", "h", "fingerprint"],
                )

    read = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text_of(text_column)).alias("h"), text_of(text_column).alias("text"))
    return read.mapInArrow(run, "id long, h long, fingerprint array<bigint>")


def _block(start: int, width: int, column: str = "fingerprint") -> Column:
    """Bits start .. start + width - 1 of a fingerprint as a number; a block may cross from one long into the next."""
    first, at = divmod(start, _BITS)
    here = min(width, _BITS - at)
    part = F.shiftrightunsigned(F.col(column)[first], _BITS - at - here).bitwiseAND((1 << here) - 1)
    if here == width:
        return part
    rest = width - here
    return F.shiftleft(part, rest).bitwiseOR(F.shiftrightunsigned(F.col(column)[first + 1], _BITS - rest).bitwiseAND((1 << rest) - 1))


def _distance(a: str, b: str, longs: int) -> Column:
    total = F.lit(0)
    for k in range(longs):
        total = total + F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k]))
    return total


def _shared(distinct: DataFrame, bits: int, blocks: int, agree: int) -> DataFrame:
    """(node, choice, key, n, hub): the keys that several distinct fingerprints have."""
    width = bits // blocks
    keys = []
    for chosen in combinations(range(blocks), agree):
        key = F.lit(0).cast("long")
        for b in chosen:
            key = F.shiftleft(key, width).bitwiseOR(_block(b * width, width))
        keys.append(F.struct(F.lit(len(keys)).alias("choice"), key.alias("key")))
    # the hub of a bucket is the fingerprint of its smallest id: of copies, that is most often what they were copied from
    rank = F.struct(F.col("least").isNull().alias("last"), "least", "node") if "least" in distinct.columns else F.struct("node")
    keyed = distinct.select("node", rank.alias("rank"), F.inline(F.array(*keys)))
    sizes = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("hub")).filter("n > 1")
    return cut(keyed.select("node", "choice", "key").join(sizes.select("choice", "key", "n", F.col("hub.node").alias("hub")), ["choice", "key"]))


def _near(pairs: DataFrame, distinct: DataFrame, longs: int, radius: int) -> DataFrame:
    first = distinct.select(F.col("node").alias("u"), F.col("fingerprint").alias("fu"))
    second = distinct.select(F.col("node").alias("v"), F.col("fingerprint").alias("fv"))
    return pairs.join(first, "u").join(second, "v").filter(_distance("fu", "fv", longs) <= radius).select("u", "v")


def links(distinct: DataFrame, bits: int = 64, blocks: int = 4, agree: int = 2, radius: int = 2) -> DataFrame:
    """Distinct fingerprints (node, fingerprint) of one long -> links (u, v) between nodes.

    With ``agree = blocks - radius`` no pair within the radius is missed.
    """
    width, longs = bits // blocks, bits // _BITS
    shared = _shared(distinct, bits, blocks, agree)
    # only radius two has centres; other arrangements compare all pairs
    centres = radius == 2 and width * agree < bits
    few = shared.filter(F.col("n") <= PAIRED) if centres else shared
    a, b = (few.select("choice", "key", F.col("node").alias(x)) for x in "uv")
    pairs = a.join(b, ["choice", "key"]).filter("u < v").select("u", "v").distinct()
    checked = _near(pairs, distinct, longs, radius)
    if not centres:
        return checked
    many = shared.filter(F.col("n") > PAIRED)
    held = [sum(((1 << width) - 1) << (bits - width * (b + 1)) for b in chosen) for chosen in combinations(range(blocks), agree)]
    flips = F.element_at(
        F.array(*[F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(bits) if not mask >> i & 1]) for mask in held]),
        F.col("choice") + 1,
    )
    around = many.join(distinct, "node").select("choice", "node", F.col("fingerprint")[0].alias("f"), F.explode(flips).alias("flip"))
    centred = around.select("choice", "node", F.col("f").bitwiseXOR(F.col("flip")).alias("centre"))
    met = centred.groupBy("choice", "centre").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("choice", "centre", "v")
    crowded = centred.join(met, ["choice", "centre"]).filter("node <> v").select(F.col("node").alias("u"), "v")
    return checked.unionByName(crowded.distinct())


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by bucket -> tables in which no bucket is cut."""
    held = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        if not held.num_rows:
            continue
        buckets = held["bucket"].to_numpy()
        start = int(np.searchsorted(buckets, buckets[-1]))
        if start:
            yield held.slice(0, start).combine_chunks()
            held = held.slice(start).combine_chunks()
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _flat(table: pa.Table, longs: int) -> np.ndarray:
    column = table["fingerprint"].combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, longs)


def _check_radius(bits: int, longs: int, radius: int) -> int:
    """Bits that may differ in a fingerprint's check: those of a pair at the radius, and five standard deviations."""
    if longs * _BITS >= bits:
        return radius
    share = radius / bits
    return int(longs * _BITS * share + 5 * (longs * _BITS * share * (1 - share)) ** 0.5)


def _parts_of(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Table, bool]]:
    """Rows sorted by bucket -> tables in which no bucket is cut, and of buckets above ``most`` rows, as they come, parts that are marked."""
    held, large = None, None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if large is not None and now.num_rows:
            end = int(np.searchsorted(now["bucket"].to_numpy(), large, side="right"))
            if end:
                yield now.slice(0, end).combine_chunks(), True
            now = now.slice(end)
            large = large if not now.num_rows else None
        held = now if held is None else pa.concat_tables([held, now])
        if not held.num_rows:
            continue
        buckets = held["bucket"].to_numpy()
        start = int(np.searchsorted(buckets, buckets[-1]))
        if start:
            yield held.slice(0, start).combine_chunks(), False
            held = held.slice(start).combine_chunks()
        if held.num_rows > most:
            large = buckets[-1]
            yield held.combine_chunks(), True
            held = None
    if held is not None and held.num_rows:
        yield held.combine_chunks(), False


def _met(nodes: DataFrame, bits: int, blocks: int, agree: int, radius: int) -> DataFrame:
    """(u, v, bucket) of nodes (node, fingerprint): the pairs of a bucket whose checks are near, and with v null the members of crowded buckets.

    Keys are exchanged once; no pair and no fingerprint leaves its bucket before the check has been compared.
    """
    width, longs = bits // blocks, bits // _BITS
    check = min(CHECK, longs)
    limit = _check_radius(bits, check, radius)
    keyed = []
    for choice, chosen in enumerate(combinations(range(blocks), agree)):
        key = F.lit(0).cast("long")
        for b in chosen:
            key = F.shiftleft(key, width).bitwiseOR(_block(b * width, width))
        # the check lies apart from the bits that are equal anyway
        at = chosen[0] * width // _BITS + longs // 2
        own = [F.col("fingerprint")[(at + k) % longs].alias(f"c{k}") for k in range(check)]
        keyed.append(F.struct(_bucket(choice, key, width * agree, blocks).alias("bucket"), *own))

    def crowd(table: pa.Table) -> pa.RecordBatch:
        node = table["node"].combine_chunks()
        return pa.RecordBatch.from_arrays([node, pa.nulls(len(node), pa.int64()), table["bucket"].combine_chunks()], names=["u", "v", "bucket"])

    def pairs(nodes: pa.Array, buckets: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(a)), nodes.take(pa.array(b)), pa.array(buckets[a])], names=["u", "v", "bucket"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, large in _parts_of(batches, WHOLE):
            if large:
                yield crowd(table)
                continue
            buckets, nodes = table["bucket"].to_numpy(), table["node"].combine_chunks()
            checks = [table[f"c{k}"].to_numpy().view(np.uint64) for k in range(check)]
            edges = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1], [True]]))
            sizes = np.diff(edges)
            small = np.repeat(sizes <= PAIRED_WIDE, sizes)
            at = np.flatnonzero(small)
            for shift in range(1, PAIRED_WIDE):
                at = at[at + shift < len(buckets)]
                at = at[buckets[at + shift] == buckets[at]]
                if not len(at):
                    break
                near = at[sum(np.bitwise_count(c[at] ^ c[at + shift]).astype(np.int64) for c in checks) <= limit]
                if len(near):
                    yield pairs(nodes, buckets, near, near + shift)
            for k in np.flatnonzero(sizes > PAIRED_WIDE).tolist():
                first, n = int(edges[k]), int(sizes[k])
                if n > WHOLE:
                    yield crowd(table.slice(first, n))
                    continue
                far = sum(np.bitwise_count(c[first : first + n, None] ^ c[None, first : first + n]).astype(np.int16) for c in checks)
                a, b = np.nonzero(np.triu(far <= limit, 1))
                if 2 * len(a) > PAIRED_WIDE * n:
                    yield crowd(table.slice(first, n))
                elif len(a):
                    yield pairs(nodes, buckets, first + a, first + b)

    rows = nodes.select("node", F.inline(F.array(*keyed))).repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "u long, v long, bucket long")


def _bucket(choice: int, key: Column, width: int, blocks: int) -> Column:
    """One number for a choice of blocks and their key: side by side where they fit, which compresses; else a hash."""
    if width + (2 * blocks).bit_length() <= 62:
        return F.lit(choice << width).cast("long") + key
    return F.xxhash64(F.lit(choice), key)


def _pairs_across(rows: DataFrame, longs: int, radius: int, nearest: bool) -> DataFrame:
    """(bucket, node, fingerprint, root, apart) -> (u, v): pairs of a row that is apart and one that is not, of different roots, within the radius.

    ``nearest`` gives of each row apart and root only the nearest pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_buckets(batches):
            buckets, prints, nodes = table["bucket"].to_numpy(), _flat(table, longs), table["node"].combine_chunks()
            roots = table["root"].combine_chunks().dictionary_encode().indices.to_numpy()
            apart = table["apart"].to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1], [True]]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                side = apart[a:b]
                left, right = a + np.flatnonzero(side), a + np.flatnonzero(~side)
                for i in left.tolist():
                    other = right[roots[right] != roots[i]]
                    far = np.bitwise_count(prints[other] ^ prints[i]).sum(1, dtype=np.int64)
                    met, far = other[far <= radius], far[far <= radius]
                    if nearest and len(met):
                        order = np.lexsort([far, roots[met]])
                        met = met[order]
                        met = met[np.concatenate([[True], roots[met][1:] != roots[met][:-1]])]
                    if len(met):
                        yield pa.RecordBatch.from_arrays([nodes.take(pa.array(np.full(len(met), i))), nodes.take(pa.array(met))], names=["u", "v"])

    found = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "u long, v long")
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _sets(docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str, shingle_words: int) -> DataFrame:
    """(node, shingles) of the texts whose row keys ``wanted`` (row, node) names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                sets = [np.unique(_shingle_hashes(t, shingle_words)) for t in texts_of(batch)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["node", "shingles"])

    texts = docs.select(row_key(id_column, text_column).alias("row"), text_of(text_column).alias("text")).join(wanted, "row").select("node", "text")
    return texts.mapInArrow(run, "node long, shingles array<bigint>").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _similar(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, id_column: str, text_column: str, shingle_words: int, similarity: float) -> DataFrame:
    """The pairs whose sets of shingles have that Jaccard similarity, by exact counts."""
    pairs = settled(pairs)
    ends = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    sets = settled(_sets(docs, nodes.join(ends, "node").select("row", "node"), id_column, text_column, shingle_words))
    met = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
    both = met.select("u", "v", F.size(F.array_intersect("a", "b")).alias("both"), (F.size("a") + F.size("b")).alias("all"))
    return both.filter(F.col("both") >= F.lit(similarity) * (F.col("all") - F.col("both"))).select("u", "v")


def _wide_roots(
    docs: DataFrame, nodes: DataFrame, id_column: str, text_column: str, shingle_words: int, bits: int, blocks: int, agree: int, radius: int, similarity: float
) -> DataFrame:
    """(node, root) over links of similar texts among the pairs that share a key; nodes without a link are left out."""
    longs, width = bits // _BITS, bits // blocks
    prints = nodes.select("node", "fingerprint")
    met = settled(_met(nodes, bits, blocks, agree, radius))

    def apart(found: DataFrame, pairs: DataFrame) -> DataFrame:
        """The pairs that links found so far do not connect."""
        roots = [found.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "uv"]
        met = pairs.join(roots[0], "u", "left").join(roots[1], "v", "left")
        return met.filter(F.coalesce("ru", "u") != F.coalesce("rv", "v")).select("u", "v")

    def grown(found: DataFrame | None, pairs: DataFrame) -> DataFrame:
        """Roots with the similar ones of ``pairs`` linked."""
        added = _similar(pairs, docs, nodes, id_column, text_column, shingle_words, similarity)
        if found is not None:
            added = added.unionByName(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
        return settled(components(added))

    pairs = met.filter("v is not null").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    members = met.filter("v is null").select("bucket", F.col("u").alias("node"))
    # the hub of a bucket is the fingerprint of its smallest id: of copies, that is most often what they were copied from
    rank = F.struct(F.col("least").isNull().alias("last"), "least", "node")
    hubs = members.join(nodes.select("node", rank.alias("rank")), "node").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("hub"))
    many = settled(members.join(hubs.select("bucket", "n", F.col("hub.node").alias("hub")), "bucket"))
    far = many.filter("node <> hub").select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v"))
    if agree == 1:
        # a further block splits the bucket, and its members meet each other's smallest there
        choice = F.shiftright("bucket", width)
        more = many.join(prints, "node").select(
            "node", "bucket", choice.alias("choice"), F.inline(F.array(*[F.struct(F.lit(b).alias("other"), _block(b * width, width).alias("value")) for b in range(blocks)]))
        ).filter(F.pmod(F.col("other") - F.col("choice"), F.lit(blocks)).between(1, FURTHER))
        least = more.groupBy("bucket", "other", "value").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        far = far.unionByName(more.join(least, ["bucket", "other", "value"]).filter("node <> v").select(F.col("v").alias("u"), F.col("node").alias("v")))
    near = settled(_near(pairs.unionByName(far).distinct(), prints, longs, radius))

    def across(found: DataFrame, nearest: bool) -> DataFrame:
        """Pairs within large buckets of one that is not connected to the bucket's hub and any other of another root."""
        placed = many.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
        hubs = placed.filter("node = hub").select("bucket", F.col("root").alias("main"))
        told = placed.join(hubs, "bucket").withColumn("apart", F.col("root") != F.col("main"))
        left = told.groupBy("bucket").agg(F.sum(F.col("apart").cast("long")).alias("left")).filter("left > 0")
        mixed = settled(told.join(left, "bucket").withColumn("across", F.ceil(F.col("n") / PART)).withColumn("down", F.ceil(F.col("left") / PART)))
        own = F.xxhash64("node")
        one = mixed.filter("apart").select("bucket", "node", "root", F.lit(True).alias("apart"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("x"), F.pmod(own, F.col("down")).alias("y"))
        two = mixed.select("bucket", "node", "root", F.lit(False).alias("apart"), F.pmod(own, F.col("across")).alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)).alias("y"))
        rows = one.unionByName(two).select(F.xxhash64("bucket", "x", "y").alias("bucket"), "node", "root", "apart").join(prints, "node").select("bucket", "node", "fingerprint", "root", "apart")
        return settled(_pairs_across(rows, longs, radius, nearest))

    # of each node one pair first; then all that this has not connected, with the nearest of each root in the large buckets; then all that are still of other roots
    found = grown(None, near.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"))
    found = grown(found, apart(found, near).unionByName(across(found, True)).distinct())
    rest = across(found, False)
    return found if rest.isEmpty() else grown(found, rest)


def groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 3,
    bits: int = 64, blocks: int = 4, agree: int = 2, radius: int = 2, similarity: float = 0.8,
) -> DataFrame:
    """(id, h, fingerprint, component_id, root): for each row the smallest id its fingerprint reaches over links.

    ``root`` names the component and is never null.
    Ids are whole numbers. Equal texts, and all texts without words, have equal
    fingerprints and one component. Rows without an id belong to a component but
    do not name it; a component of such rows only has component_id null. Rows
    that repeat an id or a text are one row each. An empty table gives no rows.
    Of fingerprints of more than 64 bits, those within the radius are candidates,
    and links are texts of that ``similarity`` of shingles.
    """
    read = cut(fingerprints(docs, id_column, text_column, shingle_words, bits))
    distinct = read.groupBy("fingerprint").agg(
        F.min("id").alias("least"), F.min(F.struct(F.col("id").isNull().alias("last"), "id", "h")).alias("first")
    ).select("fingerprint", "least", F.struct("first.id", "first.h").alias("row"))
    # a fingerprint is its own node where it is one long, else it gets a number, which the checkpoint fixes: nodes travel
    # with every key, and a number takes a third of a digest's bytes and compresses where a digest does not
    node = F.col("fingerprint")[0] if bits == _BITS else F.monotonically_increasing_id()
    nodes = cut(distinct.withColumn("node", node))
    if bits == _BITS:
        found = components(links(nodes.select("node", "fingerprint", "least"), bits, blocks, agree, radius))
    else:
        found = _wide_roots(docs, nodes, id_column, text_column, shingle_words, bits, blocks, agree, radius, similarity)
    rooted = nodes.join(found, "node", "left").select("fingerprint", "least", F.coalesce("root", "node").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    told = rooted.join(names, "root").select("fingerprint", "component_id", "root")
    return read.join(told, "fingerprint").select("id", "h", "fingerprint", "component_id", "root")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **arrangement: int) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id, rows without an id last.

    ``arrangement`` is as in ``groups``; the default is SIMILAR. All columns stay.
    """
    found = groups(docs, id_column, text_column, **(arrangement or SIMILAR))
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "h")).alias("best"))
    kept = best.select(F.struct("best.id", "best.h").alias("row"))
    rows = docs.select(F.struct("*").alias("doc"), row_key(id_column, text_column).alias("row")).join(kept, "row", "left_semi")
    return rows.groupBy("row").agg(F.first("doc").alias("doc")).select("doc.*")
