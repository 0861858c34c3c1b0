"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within three bits of each other have, after one of three
fixed 21/22-bit blocks is masked, at most two differing bits left whenever
the masked block holds one of the differing bits.  Two such keys meet at a
common variant one flip away from each (half the radius).  Every distinct
fingerprint therefore emits, for each block, its masked value and all
one-flip variants of it (1 + 42 or 43 per block); variants are shuffled and
sorted, colliding fingerprints verified, and a spanning forest of the
verified links goes on to the components.

No bucket is expanded into all pairs: buckets of up to ``SMALL`` members are
checked by one matrix of bit distances and give a spanning forest; in larger
ones members with equal masked bits are always linked, groups whose masked
bits differ in one bit are always linked, and the one case left (three
differing bits inside the block) is looked up by flipping bits, so the work
stays linear in the bucket.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Forest, checkpointed, connected_components, extended, slices, utf8

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCKS = ((0, 21), (21, 42), (42, 64))  # bit ranges that are masked in turn
SMALL = 64  # members of a bucket that are compared by one distance matrix
_LANES = np.uint64(0x0101010101010101)


def _bits_majority(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of groups of hashes: bit set if set in over half of the group.

    Byte lanes of 64-bit words count eight bits at a time; groups are cut in
    chunks of at most 255 hashes so that no lane overflows.
    """
    pieces = -(-counts // 255)
    chunk_starts = np.repeat(starts, pieces) + 255 * (
        np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    ones = np.empty((len(chunk_starts), 8, 8), np.int64)
    for i in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(i)) & _LANES, chunk_starts)
        ones[:, :, i] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.add.reduceat(ones.reshape(-1, 64), np.cumsum(pieces) - pieces, axis=0)
    bits = (2 * ones > counts[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(texts: list[bytes], shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit SimHash of each text (UTF-8 bytes): words between ASCII white
    space, A-Z lower-cased; shingles of ``shingle`` words, repeats included;
    fewer words: the whole sequence; no word: zero."""
    from xxhash import xxh64_intdigest as xxh
    out = np.zeros(len(texts), np.uint64)
    for lo, hi in slices([len(t) for t in texts], 8_000_000):
        hashes, counts, which = [], [], []
        for i in range(lo, hi):
            words = texts[i].lower().split()
            if not words:
                continue
            n, joined = len(words), b" ".join(words)
            if n <= shingle:
                hashes.append(xxh(joined, SEED))
                counts.append(1)
            else:
                ends = list(itertools.accumulate(map(len, words)))
                ends = [e + k for k, e in enumerate(ends)]
                begins = [0] + [e + 1 for e in ends[:n - shingle]]
                hashes += [xxh(joined[s:e], SEED) for s, e in zip(begins, ends[shingle - 1:])]
                counts.append(n - shingle + 1)
            which.append(i)
        if which:
            c = np.array(counts, np.int64)
            out[which] = _bits_majority(np.fromiter(hashes, np.uint64, len(hashes)), np.cumsum(c) - c, c)
    return out


def add_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS,
                    name: str = "fp") -> DataFrame:
    """``docs`` with a signed 64-bit fingerprint column; null text has no word."""
    def run(batches):
        for b in batches:
            fp = fingerprints(utf8(b.column(text)), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], [*b.schema.names, name])

    return docs.mapInArrow(run, extended(docs.schema, f"{name} long"))


def _block_masks() -> np.ndarray:
    return np.array([((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in BLOCKS], np.uint64)


def _emit(batches):
    """(fp) -> (block, key, fp): the masked value and its one-flip variants, for each block."""
    masks = _block_masks()
    flips = [np.array([0] + [1 << b for b in range(64) if not lo <= b < hi], np.uint64)
             for lo, hi in BLOCKS]
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for part in np.array_split(fp, max(1, len(fp) // 20_000)):
            for j in range(len(BLOCKS)):
                keys = ((part & ~masks[j])[:, None] ^ flips[j][None, :]).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), j, np.int8)), pa.array(keys.view(np.int64)),
                     pa.array(np.repeat(part, len(flips[j])).view(np.int64))], ["block", "key", "fp"])


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _bucket_links(fps: np.ndarray, block: int, max_bits: int):
    """Links (pairs of index) that connect whatever the full pair list of the bucket would."""
    n = len(fps)
    if n <= SMALL:
        a, b = np.nonzero(np.triu(_popcount(fps[:, None] ^ fps[None, :]) <= max_bits, 1))
        return zip(a.tolist(), b.tolist())
    mask = _block_masks()[block]
    links: list[tuple[int, int]] = []
    m, first, group = np.unique(fps & mask, return_index=True, return_inverse=True)
    # equal masked bits: the rest differs in two bits at most
    links += [(int(first[g]), i) for i, g in enumerate(group.tolist()) if first[g] != i]
    lo, hi = BLOCKS[block]
    bits = [np.uint64(1 << b) for b in range(lo, hi)]
    for bit in bits:  # masked bits one apart: three bits at most in all
        at = np.minimum(np.searchsorted(m, m ^ bit), len(m) - 1)
        links += [(int(first[x]), int(first[y])) for x, y in zip(np.nonzero(m[at] == (m ^ bit))[0], at[m[at] == (m ^ bit)])]
    # equal unmasked bits, masked bits two or three apart
    order = np.argsort(fps & ~mask, kind="stable")
    rest = (fps & ~mask)[order]
    cuts = np.flatnonzero(np.r_[True, rest[1:] != rest[:-1], True])
    for s, e in zip(cuts[:-1], cuts[1:]):
        if e - s < 2:
            continue
        idx = order[s:e]
        vals = fps[idx]
        by = np.argsort(vals)
        vals, idx = vals[by], idx[by]
        for k in (2, 3):
            for combo in itertools.combinations(bits, k):
                other = vals ^ np.bitwise_or.reduce(np.array(combo, np.uint64))
                at = np.minimum(np.searchsorted(vals, other), len(vals) - 1)
                for x in np.flatnonzero(vals[at] == other):
                    links.append((int(idx[x]), int(idx[at[x]])))
    return links


def _link(max_bits: int):
    def run(batches):
        forest = Forest()
        tail_k = tail_f = tail_j = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                j = batch.column(0).to_numpy(zero_copy_only=False)
                k = batch.column(1).to_numpy(zero_copy_only=False)
                f = batch.column(2).to_numpy(zero_copy_only=False)
                if tail_k is not None:
                    j, k, f = np.r_[tail_j, j], np.r_[tail_k, k], np.r_[tail_f, f]
                if not len(k):
                    continue
                cuts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (j[1:] != j[:-1])])
                last = cuts[-1]  # the last bucket may go on in the next batch
                tail_j, tail_k, tail_f = j[last:].copy(), k[last:].copy(), f[last:].copy()
                j, f, cuts = j[:last], f[:last], cuts[:-1]
                ends = np.r_[cuts[1:], last] if len(cuts) else cuts
            elif tail_k is not None:
                j, f = tail_j, tail_f
                cuts, ends = np.array([0]), np.array([len(f)])
            else:
                break
            found: list[tuple[int, int]] = []
            size = ends - cuts
            two = cuts[size == 2]
            near = two[_popcount(f[two].view(np.uint64) ^ f[two + 1].view(np.uint64)) <= max_bits] if len(two) else two
            found += [(a, b) for a, b in zip(f[near].tolist(), f[near + 1].tolist()) if forest.join(a, b)]
            for s, e in zip(cuts[size > 2].tolist(), ends[size > 2].tolist()):
                members = f[s:e]
                names = members.tolist()
                found += [(names[x], names[y]) for x, y in _bucket_links(members.view(np.uint64), int(j[s]), max_bits)
                          if forest.join(names[x], names[y])]
            if found:
                a, b = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct (fp) -> links (a, b) with the connectivity of all pairs within ``max_bits`` bits."""
    if max_bits != MAX_BITS:
        raise ValueError("the blocks and flips are laid out for three bits")
    variants = fps.select("fp").mapInArrow(_emit, "block byte, key long, fp long")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (variants.repartition(n, "block", "key").sortWithinPartitions("block", "key", "fp")
            .mapInArrow(_link(max_bits), "a long, b long"))


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text",
                           shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(key, fp, component): fp the signed fingerprint, component the smallest
    key reachable over links of at most ``max_bits`` differing bits.

    Texts without a word share fingerprint zero and are linked like any
    other.  Repeated rows stay repeated; rows with a null key take part and
    get the smallest non-null key of their class.  An empty table gives an
    empty table.  Extra columns are ignored.
    """
    marked = checkpointed(add_fingerprint(docs.select(F.col(key).alias("doc"), F.col(text).alias("txt")), "txt", shingle)
                          .select("doc", "fp"))
    fps = checkpointed(marked.groupBy("fp").agg(F.min("doc").alias("low")))
    comp = connected_components(fingerprint_links(fps, max_bits))
    classes = fps.join(comp, fps.fp == comp.node, "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("cls"))
    classes = checkpointed(classes)
    smallest = classes.groupBy("cls").agg(F.min("low").alias("component"))
    named = classes.join(smallest, "cls").select("fp", "component")
    return marked.join(named, "fp").select(F.col("doc").alias(key), "fp", "component")


def keep_one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text",
                       shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the smallest key, and
    of rows that repeat it the first by content.  Columns stay as they are."""
    cols = docs.columns
    row = F.xxhash64(*[F.col(c) for c, kind in docs.dtypes if not kind.startswith("map")])
    light = checkpointed(
        add_fingerprint(docs.select(F.col(key).alias("doc"), row.alias("row"), F.col(text).alias("txt")), "txt", shingle)
        .select("doc", "row", "fp"))
    fps = checkpointed(light.select("fp").distinct())
    comp = connected_components(fingerprint_links(fps, max_bits))
    named = fps.join(comp, fps.fp == comp.node, "left").select("fp", F.coalesce("component", "fp").alias("cls"))
    place = F.struct(F.col("doc").isNull().alias("unknown"), "doc", "row")
    lead = checkpointed(light.groupBy("fp", "doc", "row").agg(F.count(F.lit(1)).alias("n"))
                        .join(named, "fp").groupBy("cls").agg(F.min(F.struct(place.alias("p"), "n")).alias("lead"))
                        .select(F.col("lead.p.doc").alias("__doc"), F.col("lead.p.row").alias("__row"), "lead.n"))
    own = docs.withColumn("__hash", row)
    kept = own.join(lead, own[key].eqNullSafe(lead["__doc"]) & (own["__hash"] == lead["__row"]), "left_semi")
    if not lead.filter("n > 1").isEmpty():  # rows that repeat in every column: one of them
        kept = kept.dropDuplicates([key, "__hash"])
    return kept.select(*cols)
