"""Fuzzy line deduplication, in DataFrame functions only.

Lines are normalised (lower case, anything but letters, digits and non-ASCII
characters one space).  Distinct lines that may be alike meet, and pairs are
verified by edit similarity on the normalised text.  Of each connected group
of lines the first occurrence stays.  Three rules say which lines meet:

``WIDE``, the rule of the queries: a SimHash of 98 bits in seven blocks, over the
different words of a line (counted once each, or the commonest ones make all lines
of a language alike), or over the different runs of three characters if it has at most
64 characters.  Distinct
lines whose fingerprints agree on two blocks of 14 bits meet (pigeonhole: five
differing bits leave two blocks untouched), and are verified if at most
``WIDE_BITS`` bits differ.

``EDIT``: a line's sketch is the ``SKETCH`` smallest
hashes of its grams, runs of 3 or 5 characters of a short line and of three
words of a longer one (near a limit both kinds, so that lines of a similar
length always have one in common).  Lines that share one of the first
``SKETCH_KEYS`` hashes meet, and are verified if they share two of the sketch.

``SIMHASH``: a line's SimHash counts, for each of the 64 bits, the words whose
hash has it set; the counts of two bits share one 64-bit sum.  Lines whose
fingerprints agree on two of five bit blocks meet (pigeonhole: three differing
bits leave two blocks untouched); pairs within three bits are verified.  One
changed word moves more bits than that in most lines of up to 50 words.

No bucket is expanded into all pairs: at first every member is compared with
the bucket's first line; only members that are then still in different groups
are compared with each other.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import lookup_join
from ..session import materialize
from .common import checkpointed, connected_components, release

MAX_BITS = 3
BLOCKS = 5  # bit blocks of a fingerprint
CLEAN = 2  # blocks that must agree (BLOCKS - MAX_BITS)
EDIT, SIMHASH, WIDE = "edit", "simhash", "wide"
WIDE_BLOCKS, WIDE_SIZE = 7, 14  # bit blocks of a wide fingerprint and their bits
WIDE_BITS = 26  # of its 98 bits, those that a pair may differ in to be verified
LONG = 64  # characters: runs of three up to LONG, words beyond
KEYS_A_PASS = 11  # choices of two blocks that are shuffled at once (21 in all)
SKETCH = 10  # smallest gram hashes of a line
SKETCH_KEYS = 6  # of them, those by which lines meet
SHARED = 2  # hashes of the sketch that a pair must share (fewer, if a line has fewer)
SHORT, MIDDLE = 20, 64  # characters: runs of 3 up to SHORT, of 5 up to MIDDLE, then words
SIMILARITY = 0.8  # 1 - edit distance / length of the longer line
BROADCAST_ROWS = 400_000  # up to so many (checked) rows of a few bytes a side is broadcast
BROADCAST_NUMBERS = 4_000_000  # line numbers in such a side, likewise


def normalised(line: Column) -> Column:
    # a lone space between words is no match: it would be replaced by itself
    other = r" *[^0-9a-z \x{80}-\x{10ffff}][^0-9a-z\x{80}-\x{10ffff}]*| {2,}"
    return F.trim(F.regexp_replace(F.lower(line), other, " "))


def _row_hash(text: str) -> Column:
    return F.xxhash64(F.col(text))


def _sketches(norm: str, length: str, words: str) -> Column:
    """One or two sketches of a line, by the grams that its length asks for."""
    def chars(size: int, padded: str) -> Column:
        return F.expr(f"transform(sequence(1, length({padded}) - {size - 1}), i -> hash({size}, substring({padded}, i, {size})))")

    grams = F.expr(f"transform(sequence(0, greatest(size({words}) - 3, 0)), "
                   f"i -> hash(0, get({words}, i), get({words}, i + 1), get({words}, i + 2)))")
    least = lambda g: F.slice(F.sort_array(F.array_distinct(g)), 1, SKETCH)
    n = F.col(length)
    return F.filter(F.array(
        F.when(n <= SHORT, least(chars(3, "pad3"))),
        F.when((n > SHORT * SIMILARITY) & (n <= MIDDLE), least(chars(5, "pad5"))),
        F.when(n > MIDDLE * SIMILARITY, least(grams))), lambda s: s.isNotNull())


def _sketched(lines: DataFrame) -> DataFrame:
    """:func:`occurrences` for the rule ``EDIT``."""
    # each text that a lambda reads is also read outside, or it is made again for every gram
    parts = lines.select(
        "doc", "th", "pos", "norm", F.length("norm").alias("len"), F.split("norm", " ").alias("words"),
        F.concat(F.lit(" " * 2), "norm", F.lit(" " * 2)).alias("pad3"), F.concat(F.lit(" " * 4), "norm", F.lit(" " * 4)).alias("pad5"))
    return parts.filter("len > 0").select(
        "doc", "th", "pos", F.xxhash64("norm").alias("k1"), F.xxhash64(F.lit(1), "norm").alias("k2"), "len",
        _sketches("norm", "len", "words").alias("fp"))


def occurrences(docs: DataFrame, key: str, text: str, rule: str = SIMHASH) -> DataFrame:
    """(doc, th, pos, k1, k2, len, fp) of every line that has a word.  ``th``
    is a hash of the whole text, so rows with the same (or no) key stay apart;
    ``fp`` is the SimHash, or the sketches."""
    lines = (docs.select(F.col(key).alias("doc"), _row_hash(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
             .select("doc", "th", "pos", normalised(F.col("line")).alias("norm")))
    if rule == EDIT:
        return _sketched(lines)
    words = lines.select(
        "doc", "th", "pos", F.xxhash64("norm").alias("k1"), F.xxhash64(F.lit(1), "norm").alias("k2"),
        F.length("norm").alias("len"), F.explode(F.split("norm", " ")).alias("word"),
    ).withColumn("h", F.xxhash64("word"))
    lanes = F.lit(0x0000000100000001)
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(lanes)).alias(f"s{i}") for i in range(32)]
    # what is the same for all words of a line is no key: keys are hashed for each word.
    # Lines without a word are left out here, where the test can't move below the
    # normalisation and have it done twice.
    counted = words.groupBy("doc", "th", "pos").agg(
        F.count(F.lit(1)).alias("n"), F.max("k1").alias("k1"), F.max("k2").alias("k2"), F.max("len").alias("len"),
        *sums).filter("len > 0")
    low = F.lit(0xFFFFFFFF)
    bits = []
    for i in range(32):
        top = 1 << (32 + i)
        bits.append(F.when(F.col(f"s{i}").bitwiseAND(low) * 2 > F.col("n"), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
        bits.append(F.when(F.shiftrightunsigned(f"s{i}", 32) * 2 > F.col("n"),
                           F.lit(top - (1 << 64) if top >> 63 else top).cast("long")).otherwise(F.lit(0).cast("long")))
    fp = reduce(lambda a, b: a.bitwiseOR(b), bits)
    return counted.select("doc", "th", "pos", "k1", "k2", "len", fp.alias("fp"))


def _place() -> Column:
    """Order of occurrences: known keys first, then by key, line and text."""
    return F.struct(F.col("doc").isNull().alias("unknown"), "doc", "pos", "th")


def _block_keys() -> Column:
    """One key for each choice of ``CLEAN`` blocks: the choice and the bits."""
    edges = [round(64 * b / BLOCKS) for b in range(BLOCKS + 1)]
    parts = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges, edges[1:])]
    keys = []
    for number, choice in enumerate(combinations(range(BLOCKS), CLEAN)):
        key = F.lit(number).cast("long")
        for b in choice:
            key = F.shiftleft(key, edges[b + 1] - edges[b]).bitwiseOR(parts[b])
        keys.append(key)
    return F.explode(F.array(*keys))


def _keyed(distinct: DataFrame, rule: str) -> DataFrame:
    """(id, len, fp, key): every line once for each key by which it meets others."""
    if rule == EDIT:
        return distinct.select("id", "len", F.explode("fp").alias("fp")).select(
            "id", "len", "fp", F.explode(F.slice("fp", 1, SKETCH_KEYS)).alias("key"))
    return distinct.select("id", "len", "fp", _block_keys().alias("key"))


def _near(a: str, b: str, rule: str) -> Column:
    if rule == EDIT:
        return F.size(F.array_intersect(a, b)) >= F.least(F.lit(SHARED), F.size(a), F.size(b))
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def _bounded(df: DataFrame) -> DataFrame:
    """Broadcast a checked small side; otherwise leave the join to shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _verified(pairs: DataFrame, distinct: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The (a, b) pairs whose normalised texts have an edit similarity of at least ``SIMILARITY``.
    Texts are fetched for the lines in the pairs only, from their first occurrence."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    where = checkpointed(distinct.join(ids, "id").select("id", "first.doc", "first.th", "first.pos"))
    rows = where.groupBy("doc", "th").agg(F.collect_list(F.struct("pos", "id")).alias("wanted"))
    own = docs.select(F.col(key).alias("d"), F.col(text).alias("t")).withColumn("h", _row_hash("t"))
    side = _bounded(checkpointed(rows))
    found = (own.join(side, own["d"].eqNullSafe(side["doc"]) & (own["h"] == side["th"]))
             .withColumn("lines", F.split("t", "\n"))
             .select(F.explode("wanted").alias("w"), "lines")
             .select("w.id", normalised(F.get("lines", F.col("w.pos"))).alias("norm")).dropDuplicates(["id"]))
    return _edit_near(pairs, checkpointed(found))


def _edit_near(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) pairs whose ``texts`` (id, norm) have an edit similarity of at least ``SIMILARITY``."""
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("norm").alias("x")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("norm").alias("y")), "b"))
    longer = F.greatest(F.length("x"), F.length("y"))
    limit = F.floor(longer * (1 - SIMILARITY) + 1e-9).cast("int")
    # Most pairs are settled without the full distance: words before the first
    # and after the last difference don't count, and neither what is left between
    # them nor the differing words of lines with as many words can need more
    # edits than it has characters.
    # Distances cost far more than their bytes say, so the pairs are dealt to a
    # fixed number of tasks.
    spread = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = both.withColumn("most", limit).repartition(spread, "a", "b").select("a", "b", "most", F.split("x", " ").alias("x"), F.split("y", " ").alias("y"))
    first = "array_position(zip_with({0}, {1}, (p, q) -> p <=> q), false)"
    part = (split.withColumn("head", F.expr(f"coalesce(nullif({first.format('x', 'y')}, 0) - 1, size(x))").cast("int"))
            .withColumn("tail", F.expr(f"coalesce(nullif({first.format('reverse(x)', 'reverse(y)')}, 0) - 1, size(x))").cast("int"))
            .withColumn("tail", F.least("tail", F.least(F.size("x"), F.size("y")) - F.col("head"))))
    middle = part.select(
        "a", "b", "most", *[F.expr(f"array_join(slice({c}, head + 1, size({c}) - head - tail), ' ')").alias(f"m{c}") for c in "xy"],
        F.expr("if(size(x) = size(y), aggregate(zip_with(x, y, (p, q) -> if(p = q, 0, greatest(length(p), length(q)))), 0, "
               "(s, d) -> s + d), null)").alias("changed"))
    near = (F.coalesce(F.col("changed") <= F.col("most"), F.lit(False))
            | (F.greatest(F.length("mx"), F.length("my")) <= F.col("most"))
            | F.expr("levenshtein(mx, my, most) >= 0"))
    return checkpointed(middle.filter(near).select("a", "b"))


def _groups(distinct: DataFrame, docs: DataFrame, key: str, text: str, rule: str) -> DataFrame:
    """(id, grp) of the distinct lines that are linked to another one."""
    keyed = _keyed(distinct, rule)
    bucket = Window.partitionBy("key")
    shared = checkpointed(
        keyed.withColumn("head", F.min(F.struct("id", "len", "fp")).over(bucket))
        .withColumn("n", F.count(F.lit(1)).over(bucket)).filter("n > 1"))
    fits = lambda x, y: F.least(x, y) >= F.greatest(x, y) * SIMILARITY - 1e-9
    star = (shared.filter(F.col("id") != F.col("head.id")).withColumn("fp2", F.col("head.fp"))
            .filter(_near("fp", "fp2", rule) & fits(F.col("len"), F.col("head.len")))
            .select(F.col("id").alias("a"), F.col("head.id").alias("b")).distinct())
    links = _verified(checkpointed(star), distinct, docs, key, text)
    groups = checkpointed(connected_components(links))
    # members of a bucket that are in different groups still: compare them with each other
    named = shared.filter("n > 2").select("key", "id", "len", "fp").join(
        groups.select(F.col("node").alias("id"), "component"), "id", "left").withColumn(
        "grp", F.coalesce("component", "id")).drop("component")
    mixed = named.groupBy("key").agg(F.min("grp").alias("g1"), F.max("grp").alias("g2")).filter("g1 <> g2").select("key")
    left = checkpointed(named.join(mixed, "key"))
    right = left.select("key", *[F.col(c).alias(c + "2") for c in ("id", "len", "fp", "grp")])
    more = (left.join(right, "key").filter((F.col("grp") < F.col("grp2")) & _near("fp", "fp2", rule) & fits(F.col("len"), F.col("len2")))
            .select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct())
    more = checkpointed(more)
    if not more.isEmpty():
        links = links.unionByName(_verified(more, distinct, docs, key, text))
        groups = checkpointed(connected_components(links))
    return groups.select(F.col("node").alias("id"), F.col("component").alias("grp"))


def _hashed_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, th, pos, norm, k1, k2) of every line that has a word."""
    lines = (docs.select(F.col(key).alias("doc"), _row_hash(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
             .select("doc", "th", "pos", normalised(F.col("line")).alias("norm")))
    return lines.withColumn("k1", F.xxhash64("norm")).withColumn("k2", F.xxhash64(F.lit(1), "norm"))


def wide_fingerprints(lines: DataFrame) -> DataFrame:
    """(k1, k2, len, f1, f2) of the distinct lines among (k1, k2, norm).

    ``f1`` holds the first four blocks, ``f2`` the other three.  Copies of a
    line add their words up, which moves no bit: the sums and the count grow
    alike, and a hot line is summed before the shuffle.  A line whose copies
    have 2^32 words or more in all has no fingerprint (its exact copies are
    found all the same)."""
    runs = F.expr("transform(sequence(1, length(pad) - 2), i -> substring(pad, i, 3))")
    own = lines.select("k1", "k2", "norm", F.length("norm").alias("len"), F.concat(F.lit(" "), "norm", F.lit(" ")).alias("pad")).filter("len > 0")
    parts = own.select("k1", "k2", "len", F.explode(F.array_distinct(
        F.when(F.col("len") <= LONG, runs).otherwise(F.split("norm", " ")))).alias("part"))
    h = parts.select("k1", "k2", "len", F.xxhash64("part").alias("h1"), F.xxhash64(F.lit(1), "part").alias("h2"))
    lanes, low = F.lit(0x0000000100000001), F.lit(0xFFFFFFFF)
    widths = {"1": 4 * WIDE_SIZE // 2, "2": (WIDE_BLOCKS - 4) * WIDE_SIZE // 2}  # two bits a sum: i and 32 + i
    sums = [F.sum(F.shiftrightunsigned("h" + w, i).bitwiseAND(lanes)).alias(f"s{w}_{i}") for w, bits in widths.items() for i in range(bits)]
    counted = h.groupBy("k1", "k2", "len").agg(F.count(F.lit(1)).alias("n"), *sums)
    fps = []
    for w, bits in widths.items():
        one = [F.when(part * 2 > F.col("n"), F.lit(1 << at).cast("long")).otherwise(F.lit(0).cast("long"))
               for i in range(bits)
               for part, at in ((F.col(f"s{w}_{i}").bitwiseAND(low), i), (F.shiftrightunsigned(f"s{w}_{i}", 32), bits + i))]
        fps.append(reduce(lambda a, b: a.bitwiseOR(b), one).alias("f" + w))
    return counted.filter(F.col("n") <= F.lit(0xFFFFFFFF)).select("k1", "k2", "len", *fps)


def _wide_keys(choices) -> Column:
    """One key for each of the choices of two blocks: kind of features, choice and the bits."""
    mask = F.lit((1 << WIDE_SIZE) - 1)
    block = [F.shiftrightunsigned("f1" if b < 4 else "f2", WIDE_SIZE * (b % 4)).bitwiseAND(mask) for b in range(WIDE_BLOCKS)]
    first = F.shiftleft((F.col("len") > LONG).cast("long"), 40)
    return F.explode(F.array(*[
        first.bitwiseOR(F.lit(number << 2 * WIDE_SIZE)).bitwiseOR(F.shiftleft(block[a], WIDE_SIZE)).bitwiseOR(block[b])
        for number, (a, b) in choices])).alias("key")


def _wide_near(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """The distinct (a, b) pairs within ``WIDE_BITS`` bits and of a like length."""
    side = lambda c: prints.select(F.col("id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("len", "f1", "f2")])
    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    bits = F.bit_count(F.col("f1_a").bitwiseXOR(F.col("f1_b"))) + F.bit_count(F.col("f2_a").bitwiseXOR(F.col("f2_b")))
    return both.filter((bits <= WIDE_BITS) & (F.least("len_a", "len_b") >= F.greatest("len_a", "len_b") * SIMILARITY - 1e-9)).select("a", "b")


def _wide_groups(prints: DataFrame, lines: DataFrame) -> DataFrame:
    """(node, component) of the numbers of the distinct lines that are linked to another one."""
    spark = lines.sparkSession
    numbered = list(enumerate(combinations(range(WIDE_BLOCKS), 2)))
    passes = [numbered[i:i + KEYS_A_PASS] for i in range(0, len(numbered), KEYS_A_PASS)]
    near, crowds = [], []
    for choices in passes:
        keyed = prints.select("id", _wide_keys(choices))
        # a bucket of two is its pair; only larger ones are read again
        buckets = checkpointed(keyed.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n"))
                               .filter("n > 1"))
        release(spark)
        large = buckets.filter("n > 2").select("key", "lo")
        members = checkpointed(keyed.join(_bounded(large), "key"))
        pairs = buckets.select(F.col("lo").alias("a"), F.col("hi").alias("b")).unionByName(
            members.filter("id <> lo").select(F.col("lo").alias("a"), F.col("id").alias("b")))
        near.append(checkpointed(_wide_near(pairs, prints)))
        crowds.append(members.select("key", "id"))
        release(spark)
    near = checkpointed(reduce(DataFrame.unionByName, near).distinct())
    links = _edit_near(near, _texts(near, prints, lines))
    groups = checkpointed(connected_components(links))
    # members of a bucket that are in different groups still: compare them with each other
    named = (reduce(DataFrame.unionByName, crowds).join(groups.withColumnRenamed("node", "id"), "id", "left")
             .select("key", "id", F.coalesce("component", "id").alias("grp")))
    mixed = named.groupBy("key").agg(F.min("grp").alias("g1"), F.max("grp").alias("g2")).filter("g1 <> g2").select("key")
    left = checkpointed(named.join(mixed, "key").join(prints.select("id", "len", "f1", "f2"), "id"))
    right = left.select("key", *[F.col(c).alias(c + "2") for c in ("id", "len", "f1", "f2", "grp")])
    bits = F.bit_count(F.col("f1").bitwiseXOR(F.col("f12"))) + F.bit_count(F.col("f2").bitwiseXOR(F.col("f22")))
    more = checkpointed(
        left.join(right, (left["key"] == right["key"]) & (F.col("grp") < F.col("grp2")) & (bits <= WIDE_BITS)
                  & (F.least("len", "len2") >= F.greatest("len", "len2") * SIMILARITY - 1e-9))
        .select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct())
    if more.isEmpty():
        return groups
    return checkpointed(connected_components(links.unionByName(_edit_near(more, _texts(more, prints, lines)))))


def _texts(pairs: DataFrame, prints: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, norm) of the lines in the pairs."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = _bounded(checkpointed(prints.join(ids, "id").select("id", "k1", "k2")))
    return checkpointed(lines.select("k1", "k2", "norm").join(wanted, ["k1", "k2"]).select("id", "norm").dropDuplicates(["id"]))


def _removed_wide(docs: DataFrame, key: str, text: str) -> DataFrame:
    """:func:`removed_lines` for the rule ``WIDE``."""
    spark = docs.sparkSession
    lines = materialize(_hashed_lines(docs, key, text).filter("norm <> ''"), "lines", wide=True)
    prints = materialize(wide_fingerprints(lines).withColumn("id", F.monotonically_increasing_id()), "fingerprints", wide=True)
    release(spark)
    groups = _wide_groups(prints, lines)
    release(spark)
    lines = lines.drop("norm")
    grouped = checkpointed(prints.join(groups.withColumnRenamed("node", "id"), "id").select("k1", "k2", F.col("component").alias("grp")))
    copied = lines.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k1", "k2")
    wanted = checkpointed(copied.join(grouped, ["k1", "k2"], "full").select(
        "k1", "k2", F.coalesce("grp", "k1").alias("g1"), F.when(F.col("grp").isNull(), F.col("k2")).otherwise(F.lit(0)).alias("g2"),
        F.col("grp").isNull().alias("g3")))
    met = materialize(lookup_join(lines, wanted, ["k1", "k2"], "inner"), "repeated-lines", wide=True)
    keep = checkpointed(met.groupBy("g1", "g2", "g3").agg(F.min(_place()).alias("keep")))
    gone = lookup_join(met.drop("k1", "k2"), keep, ["g1", "g2", "g3"], "inner").filter(_place() != F.col("keep"))
    return checkpointed(gone.groupBy("doc", "th").agg(F.array_sort(F.collect_set("pos")).alias("removed")))


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: str = SIMHASH) -> DataFrame:
    """(doc, th, removed): sorted numbers (from 0) of the lines to remove from the
    rows with key ``doc`` and text hash ``th``; rows that lose no line are absent."""
    if rule == WIDE:
        return _removed_wide(docs, key, text)
    marked = materialize(occurrences(docs, key, text, rule), "lines", wide=True)
    release(docs.sparkSession)
    distinct = materialize(
        marked.groupBy("k1", "k2").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n"),
                                       F.first("len").alias("len"), F.first("fp").alias("fp"))
        .withColumn("id", F.monotonically_increasing_id()), "distinct-lines", wide=True)
    groups = _groups(distinct, docs, key, text, rule)
    release(docs.sparkSession)
    named = distinct.select("k1", "k2", "id", "n", "first").join(groups, "id", "left")
    keeper = named.filter("grp is not null").groupBy("grp").agg(F.min("first").alias("keep"))
    repeated = (named.join(keeper, "grp", "left").filter("n > 1 or keep is not null")
                .select("k1", "k2", F.coalesce("keep", "first").alias("keep")))
    gone = marked.join(repeated, ["k1", "k2"]).filter(_place() != F.col("keep"))
    return checkpointed(gone.groupBy("doc", "th").agg(F.array_sort(F.collect_set("pos")).alias("removed")))


def with_removed(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: str = SIMHASH) -> DataFrame:
    """``docs`` with __removed, the numbers of the lines to remove (null: none)."""
    gone = removed_lines(docs, key, text, rule).toDF("__doc", "__hash", "__removed")
    size = gone.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("__removed")), F.lit(0)).alias("numbers")).first()
    small = size["rows"] <= BROADCAST_ROWS and size["numbers"] <= BROADCAST_NUMBERS
    own = docs.withColumn("__th", _row_hash(text))
    side = F.broadcast(gone) if small else gone
    return own.join(side, own[key].eqNullSafe(side["__doc"]) & (own["__th"] == side["__hash"]), "left").drop(
        "__doc", "__hash", "__th")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: str = SIMHASH) -> DataFrame:
    """``docs`` with the repeated lines taken out of the texts; documents that
    lose all of their lines with a word go, all others stay.

    The first occurrence of a line (smallest key, then line number) stays;
    lines without a word always stay, as do null and empty texts.  Rows that
    repeat in key and text count as one document and are treated alike; other
    columns pass through; an empty table stays empty.
    """
    cols = docs.columns
    marked = with_removed(docs, key, text, rule)
    kept = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("__removed", i))
    new = F.when(F.col("__removed").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    stays = F.col("__removed").isNull() | F.exists(kept, lambda line: normalised(line) != "")
    return marked.filter(stays).withColumn(text, new).select(*cols)
