"""N-gram Jaccard join: an exact set-similarity join of word shingles by T-occurrence search.

A document's lists are the inverted lists of its shingles. Documents within the threshold share T of them, so one occurs in any T - L short lists of the other when its L longest are left aside. Two steps use that:

* Routing, with L = T - 1: a partner occurs in one of a document's rarest lists. Lists are ranked by counts over all documents: shingles of one document alone come first, then those of up to `hot` documents, then the rest, each by hash, one order for all. Lists of a single member are dropped at once. Near copies are folded first, as each list offers its first member to all others (a star), twice; equal sets are one representative. What then shares a list, lies within the threshold in size and still stands in different components hangs together in a cluster.
* Search, within the blocks of a cluster and then between each two of them (`occurrence`): DivideSkip picks L by the threshold and the longest list, merges a document's short lists, and probes the long ones by binary search for members that occur T - L times. Only links that join components leave a task, so what is sent grows with the documents and not with the pairs.

Components need no more links than that, and none between different texts is lost. No cap is set on partners, candidates or list lengths; blocks are of a bounded number of shingles (or one document). A cluster of many blocks whose members are near each other without linking costs a search between each two blocks.

What is broadcast are bitmaps of a fixed size at most. They tell shared and hot shingles apart. A document without near copies sends nothing while a fifth of its shingles are known as its own, so a bitmap may be half full before that costs anything. Where more are shared than a bitmap holds, those in the most documents are kept in it and lists of single members stay: results are the same, but the prefixes of nearly all documents are then sent and their sets compared.

Defined results: null or empty texts and texts without words have no shingles and link with nothing; fewer words than the width make one shingle. Rows with the same id belong together, so their component is one; repeated rows give repeated results. Rows with a null id come back with a null component and link with nothing. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm import common
from lectern.llm.common import discard, stored
from lectern.llm.components import components
from lectern.llm.occurrence import spanning_links

WIDTH, PERCENT = 5, 80
HOT = 32
KEY_BITS = 22
MOST_BITS = 27  # of a bitmap with bits to spare: 16 MB
LARGEST_BITS = 30  # of a bitmap of many keys: 128 MB
LOAD = 0.7  # keys a bit, at most: half of the other keys seem to be in it
PIECE_BITS = 20  # of a bitmap that a task makes as one
PIECE_KEYS = 500_000  # that a task puts in a bitmap on average, at least
FLUSH_TOKENS = 2_000_000
WIDE = 65535  # the mark of a long gap
BLOCK_SHINGLES = 500_000  # of a block that a task searches
CELL_LOAD = 4_000_000  # shingles that a task of searches is given on average, at most


# ---- bitmaps of a bounded size


def bitmap(keys: DataFrame, column: str, per_key: int = 32) -> np.ndarray:
    """A bitmap of hashed long keys: so many bits a key up to 2**MOST_BITS bits, and beyond that as many as keep it at LOAD keys a bit, up to 2**LARGEST_BITS. Tasks make whole pieces of it."""
    n = keys.count()
    bits = min(MOST_BITS, max(12, int(np.ceil(np.log2(max(1, n) * per_key)))))
    bits = max(bits, min(LARGEST_BITS, int(np.ceil(np.log2(max(1, n) / LOAD)))))
    piece = min(bits, PIECE_BITS)

    def run(batches):
        held = {}
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False)
            for k in np.unique(h >> piece).tolist():
                held.setdefault(k, np.zeros(1 << piece, bool))[h[h >> piece == k] & ((1 << piece) - 1)] = True
        if held:
            packed = [np.packbits(x, bitorder="little").tobytes() for x in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(packed, pa.binary())], names=["piece", "bits"])

    h = F.shiftrightunsigned(F.xxhash64(column), 64 - bits)
    rows = keys.select(h.alias("h")).withColumn("piece", F.shiftright("h", piece))
    out = np.zeros((1 << (bits - piece), 1 << (piece - 6)), np.int64)
    found = rows.repartition(max(1, min(len(out), n // PIECE_KEYS)), "piece").select("h").mapInArrow(run, "piece long, bits binary").toArrow()
    for k, packed in zip(found["piece"].to_pylist(), found["bits"], strict=True):
        out[k] = np.frombuffer(packed.as_buffer(), np.int64)
    return out.reshape(-1)


def may_hold(column: Column, bits: np.ndarray) -> Column:
    """Whether a bitmap may hold a long key."""
    size = int(np.log2(len(bits))) + 6
    shared = _broadcast(bits)

    @F.arrow_udf("boolean")
    def run(hashes: pa.Array) -> pa.Array:
        h = hashes.to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - size)
        return pa.array((shared.value[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63)).astype(np.int64)) & 1 == 1)

    return run(F.xxhash64(column))


def _broadcast(value):
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().sparkContext.broadcast(value)


# ---- long lists


def long_lists(docs: DataFrame, total: int, hot: int, width: int) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """Bitmaps of the shingles in two documents or more and in more than `hot`, the bits of a shingle's hash that make its key, and whether the first bitmap has all.

    Tasks count the shingles they read and send, for each range of keys, the sorted keys' gaps (`packed_gaps`) and the counts above one; a range is summed in one pass over its runs. The number of ranges follows the number of documents.
    """
    range_bits = max(2, int(np.ceil(np.log2(max(1, total) / 500))))
    bits = range_bits + KEY_BITS

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for some in common.slices(batch):
                for s in common.shingle_sets(some.column("text"), width):
                    held.append(s)
                    size += len(s)
                if size > FLUSH_TOKENS:
                    yield from rows(held)
                    held, size = [], 0
        yield from rows(held)

    def rows(held):
        if not held or not (every := np.concatenate(held)).size:
            return
        keys, counts = _counted(every >> np.uint64(64 - bits))
        ends = np.searchsorted(keys, np.arange(1, (1 << range_bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS))
        out, at = [], 0
        for k, end in enumerate(ends.tolist()):
            if end > at:
                own = (keys[at:end] & np.uint64((1 << KEY_BITS) - 1)).astype(np.uint32)
                more = np.flatnonzero(counts[at:end] > 1)
                out.append((k, packed_gaps(own), int(end - at), more.astype(np.uint32).tobytes(), counts[at:end][more].astype(np.uint32).tobytes()))
            at = end
        names = ("part", "gaps", "n", "more", "times")
        types = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    def total_of(batches):
        part, counts = None, None

        def finish():
            if counts is not None and (found := np.flatnonzero(counts > 1)).size:
                yield pa.RecordBatch.from_arrays([pa.array((int(part) << KEY_BITS) + found, pa.int64()), pa.array(counts[found], pa.int64())], names=["key", "df"])

        for batch in batches:
            for k, gaps, n, more, times in zip(*(batch.column(c).to_pylist() for c in ("part", "gaps", "n", "more", "times")), strict=True):
                if k != part:
                    yield from finish()
                    part, counts = k, np.zeros(1 << KEY_BITS, np.int32)
                own = unpacked_gaps(gaps, n)
                counts[own] += 1
                counts[own[np.frombuffer(more, np.uint32)]] += np.frombuffer(times, np.uint32).astype(np.int32) - 1
        yield from finish()

    sent = docs.select("text").mapInArrow(count, "part long, gaps binary, n long, more binary, times binary")
    parts = max(1, min(1 << range_bits, total // 2000))
    found = stored(sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(total_of, "key long, df long"), "shared")
    n, most = found.count(), int(LOAD * (1 << LARGEST_BITS))
    shared = found if n <= most else found.filter(F.col("df") > found.approxQuantile("df", [1 - most / n], 0.001)[0])
    n_hot, most_hot = found.filter(F.col("df") > hot).count(), 1 << (MOST_BITS - 6)
    least = hot if n_hot <= most_hot else max(hot, found.filter(F.col("df") > hot).approxQuantile("df", [1 - most_hot / n_hot], 0.001)[0])
    out = bitmap(shared, "key", 8), bitmap(found.filter(F.col("df") > least), "key"), bits, n <= most
    discard(found)
    return out


def packed_gaps(keys: np.ndarray) -> bytes:
    """Ascending keys of 32 bits as their gaps: two bytes each, after a mark for every WIDE that a gap is long, or four where these are fewer bytes."""
    gaps = np.diff(keys, prepend=np.uint32(0))
    marks = (gaps // WIDE).astype(np.int64)
    if marks.sum() >= len(gaps):
        return gaps.astype(np.uint32).tobytes()
    out = np.full(len(gaps) + int(marks.sum()), WIDE, np.uint16)
    out[np.arange(len(gaps)) + np.cumsum(marks)] = gaps % WIDE
    return out.tobytes()


def unpacked_gaps(packed: bytes, n: int) -> np.ndarray:
    """The n keys."""
    if len(packed) == 4 * n:
        return np.cumsum(np.frombuffer(packed, np.uint32), dtype=np.int64)
    steps = np.frombuffer(packed, np.uint16)
    return np.cumsum(steps, dtype=np.int64)[steps != WIDE]


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[first], np.diff(np.append(first, len(values)))


def spark_hash(values: np.ndarray) -> np.ndarray:
    """xxhash64 of longs with seed 42, as Spark's function gives it."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    rotate = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = h ^ (rotate(values.astype(np.uint64) * p2, 31) * p1)
        h = rotate(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


# ---- documents, lists and pairs


def prepared(docs: DataFrame, lists: tuple[np.ndarray, np.ndarray, int, bool], width: int, percent: int) -> DataFrame:
    """Per row: its number of shingles, the digest of its set, its short lists in the common order, and how many lists of single members were left out before these."""
    key_bits, whole = lists[2:]
    sizes = [int(np.log2(len(b))) + 6 for b in lists[:2]]
    shared = [_broadcast(b) for b in lists[:2]]

    def marked(h: np.ndarray, k: int) -> np.ndarray:
        h = h >> np.uint64(64 - sizes[k])
        return ((shared[k].value[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63)).astype(np.int64)) & 1).astype(np.int8)

    def run(batches):
        from xxhash import xxh3_128_digest

        for batch in batches:
            for some in common.slices(batch):
                counts, digests, heads, skips = [], [], [], []
                sets = common.shingle_sets(some.column("text"), width)
                every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                h = spark_hash(every >> np.uint64(64 - key_bits))
                rank = marked(h, 0)
                rank += rank & marked(h, 1)
                at = 0
                for s in sets:
                    n = len(s)
                    many = n - (percent * n + 99) // 100 + 1 if n else 0
                    own = rank[at : at + n]
                    at += n
                    alone = s[own == 0][:many]
                    rest = np.concatenate([s[own == 1], s[own == 2]])[: many - len(alone)]
                    heads.append(rest if whole else np.concatenate([alone, rest]))
                    skips.append(len(alone) if whole else 0)
                    counts.append(n)
                    digests.append(xxh3_128_digest(s.tobytes()))
                flat = np.concatenate(heads) if heads else np.zeros(0, np.uint64)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in heads])]).astype(np.int32)
                head = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), head, pa.array(skips, pa.int32())], names=["doc_id", "n", "digest", "head", "skip"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, digest binary, head array<long>, skip int")


def shared_lists(postings: DataFrame) -> DataFrame:
    """Of postings sorted by shingle within partitions, those of lists with two members or more; `first` is the list's first member and `n_first` its number of shingles. Neighbours tell, so no list is held."""
    names = ["token", "rid", "n", "pos", "first", "n_first"]

    def run(batches):
        kept = None  # the last row of the batch before
        first = None  # of its list: the shingle, the first member, that one's size, and whether it has two members
        for batch in batches:
            if not batch.num_rows:
                continue
            if kept is not None:
                batch = pa.concat_batches([kept, batch])
            token, rid, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "rid", "n"))
            same = token[1:] == token[:-1]
            new = np.concatenate([[True], ~same])
            at = np.maximum.accumulate(np.where(new, np.arange(len(token)), 0))
            leader, size = rid[at], n[at]
            if first is not None and first[0] == token[0]:  # the list began before
                began = np.cumsum(new) == 1
                leader[began], size[began] = first[1], first[2]
            after = np.concatenate([same, [False]])
            before = np.concatenate([[first is not None and first[0] == token[0] and kept is not None and first[3]], same])
            use = (before | after)[:-1]
            if use.any():
                part = batch.slice(0, len(token) - 1)
                yield pa.RecordBatch.from_arrays([*(pc.filter(part.column(c), pa.array(use)) for c in names[:4]), pa.array(leader[:-1][use]), pa.array(size[:-1][use])], names=names)
            first = (token[-1], leader[-1], size[-1], bool(len(token) > 1 and same[-1]) or bool(len(token) == 1 and before[0]))
            kept = batch.slice(len(token) - 1)
        if kept is not None and first[3]:
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in names[:4]), pa.array([first[1]], pa.int64()), pa.array([first[2]], pa.int64())], names=names)

    return postings.select(*names[:4]).mapInArrow(run, "token long, rid long, n long, pos int, first long, n_first long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: shingles of the smaller set are searched in the other one's sorted array."""
    both = pairs.join(sets.select(F.col("rid").alias("b"), F.col("tokens").alias("y")), "b").join(sets.select(F.col("rid").alias("a"), F.col("tokens").alias("x")), "a")

    def run(batches):
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            xo, yo = (c.offsets.to_numpy() for c in (x, y))
            xv, yv = (c.values.to_numpy(zero_copy_only=False).view(np.uint64) for c in (x, y))
            good = []
            for i in range(batch.num_rows):
                p, q = xv[xo[i] : xo[i + 1]], yv[yo[i] : yo[i + 1]]
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                overlap = int((q[np.minimum(at, len(q) - 1)] == p).sum()) if len(q) else 0
                good.append(overlap > 0 and 100 * overlap >= percent * (len(p) + len(q) - overlap))
            yield pa.RecordBatch.from_arrays([pc.filter(batch.column(c), pa.array(good)) for c in ("a", "b")], names=["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _sized(a: str, b: str, percent: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows with the component that their rid stands in so far."""
    return rows.join(found.withColumnRenamed("id", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))


def clusters(lists: DataFrame, percent: int) -> DataFrame:
    """(cluster, rid, n, component): members of open lists, those that may link in one cluster.

    Partners differ in size by the threshold at most, so sizes are cut in bands of that ratio and a member stands in its own band and the next one: partners meet in one of them. Members of a list within a band are tied to the first of them, and what hangs together is a cluster.
    """
    ratio = float(np.log(100 / percent)) * (1 + 1e-9) if percent < 100 else 1e-6
    band = F.floor(F.log("n") / F.lit(ratio)).cast("long")
    rows = lists.withColumn("band", F.explode(F.array(band, band + 1))).withColumn("node", F.xxhash64("rid", "band"))
    open_ = rows.groupBy("token", "band").agg(F.min("component").alias("c"), F.max("component").alias("z"), F.min("node").alias("least")).filter("c <> z").select("token", "band", "least")
    tied = stored(rows.join(open_, ["token", "band"]).select("rid", "n", "component", "node", "least").distinct(), "tied")
    found = components(tied.select(F.col("least").alias("a"), F.col("node").alias("b"))).select(F.col("id").alias("node"), F.col("component").alias("cluster"))
    members = tied.select("rid", "n", "component", "node").distinct().join(found, "node", "left")
    return members.select(F.coalesce("cluster", "node").alias("cluster"), "rid", "n", "component")


def dealt(members: DataFrame, block_shingles: int) -> DataFrame:
    """The members of clusters with several components, with the number of blocks that their cluster is dealt to, and the block."""
    sizes = members.groupBy("cluster").agg(F.sum("n").alias("all"), F.min("component").alias("c"), F.max("component").alias("z")).filter("c <> z")
    sizes = sizes.select("cluster", F.ceil(F.col("all") / block_shingles).cast("int").alias("blocks"))
    return members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))


def searched(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the components of each cell (cluster, i, j), by T-occurrence search. Of a cell of two blocks only links between these are looked for."""
    spark = cells.sparkSession
    load = cells.agg(F.sum("n")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(load) // CELL_LOAD))
    key = ("cluster", "i", "j")
    rows = cells.select("rid", *key, "side", "component").join(sets, "rid").select(*key, "rid", "side", "component", "tokens")

    def run(batches):
        now, ids, sides, groups, held = None, [], [], [], []

        def finish():
            if len(held) > 1:
                both = np.array(sides) if now[1] != now[2] else None
                if out := spanning_links(ids, both, np.array(groups), held, percent):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

        for batch in batches:
            cell = list(zip(*(batch.column(c).to_pylist() for c in key), strict=True))
            own, side, group = (batch.column(c).to_pylist() for c in ("rid", "side", "component"))
            tokens = batch.column("tokens")
            offsets, values = tokens.offsets.to_numpy(), tokens.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for r, c in enumerate(cell):
                if c != now:
                    yield from finish()
                    now, ids, sides, groups, held = c, [], [], [], []
                ids.append(own[r])
                sides.append(side[r])
                groups.append(group[r])
                held.append(values[offsets[r] : offsets[r + 1]].copy())
        yield from finish()
        common.release()

    return rows.repartition(parts, *key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long").distinct()


def jaccard_classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, hot: int = HOT, rounds: int = 2, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id that links reach) of each row."""
    common.small_batches(docs.sparkSession)
    with common.freed(docs.sparkSession):
        rows, member, found = _linked(docs, width, percent, hot, rounds, block_shingles)
    place = member.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("doc_id", "digest", F.coalesce("component", "rep").alias("component")).groupBy("doc_id", "digest").agg(F.min("component").alias("component"))
    return rows.select("doc_id", "n", "digest").join(place, ["doc_id", "digest"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _linked(docs: DataFrame, width: int, percent: int, hot: int, rounds: int, block_shingles: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their sets' digests, the representative of each id and digest, and the components of representatives."""
    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = source.count()
    rows = stored(prepared(source, long_lists(source, total, hot, width), width, percent), "sets")
    known = rows.filter("n > 0 and doc_id is not null")
    reps = known.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    member = stored(known.select("doc_id", "digest").join(reps, "digest").select("doc_id", "digest", "rep"), "members")
    alone = stored(member.filter("doc_id = rep").select("rep", "digest").distinct(), "reps")
    # rows of one id belong together, whatever their texts
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a <> z")
    links = member.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")).filter("a <> b")
    heads = known.join(alone.withColumnRenamed("rep", "doc_id"), ["doc_id", "digest"], "left_semi")
    postings = heads.select(F.posexplode("head").alias("at", "token"), F.col("doc_id").alias("rid"), "n", "skip").select("token", "rid", "n", (F.col("at") + F.col("skip")).alias("pos"))
    parts = max(rows.rdd.getNumPartitions(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lists = stored(shared_lists(postings.repartition(parts, "token").sortWithinPartitions("token", "rid")), "lists")
    # whole sets, of those in any shared list
    wanted = stored(lists.select("rid").distinct(), "wanted")
    texts = source.filter(F.col("doc_id").isNotNull() & may_hold(F.col("doc_id"), bitmap(wanted, "rid")))  # and a few more
    # several texts of one id have several sets
    sets = stored(_sets(texts, width), "tokens")
    stars = lists.filter((F.col("first") != F.col("rid")) & _sized("n", "n_first", percent)).select(F.col("first").alias("a"), F.col("rid").alias("b")).distinct()
    links = stored(links.union(verified(stars, sets, percent)), "links")
    found = components(links)
    for turn in range(1, rounds + 1):
        # lists that still stand in several components
        placed = _placed(lists.select("token", "rid", "n"), found)
        open_ = placed.groupBy("token").agg(F.min("component").alias("c"), F.max("component").alias("z"), F.min(F.struct(F.xxhash64("rid", F.lit(turn)).alias("h"), "rid", "n", "component")).alias("l")).filter("c <> z")
        left = stored(placed.join(open_.select("token", F.col("l.rid").alias("first"), F.col("l.n").alias("n_first"), F.col("l.component").alias("c_first")), "token"), "lists")
        discard(lists)
        lists = left
        if turn < rounds:
            pairs = lists.filter((F.col("component") != F.col("c_first")) & _sized("n", "n_first", percent)).select(F.col("first").alias("a"), F.col("rid").alias("b")).distinct()
            links = links.union(stored(verified(pairs, sets, percent), "links"))
            found = components(links)
    members = stored(dealt(clusters(lists, percent), block_shingles), "clusters")
    discard(lists)
    inside = members.select("cluster", "rid", "n", "component", F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).alias("side"))
    links = links.union(stored(searched(inside, sets, percent), "links"))
    found = components(links)
    # clusters of several blocks that still stand in several components: each two blocks
    several = dealt(_placed(members.filter("blocks > 1").select("cluster", "rid", "n"), found).select("cluster", "rid", "n", "component"), block_shingles)
    across = several.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("other <> block")
    across = across.select("cluster", "rid", "n", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"))
    links = links.union(stored(searched(across, sets, percent), "links"))
    found = components(links)
    for used in (members, sets, wanted):
        discard(used)
    return rows, member, found


def _sets(texts: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for some in common.slices(batch):
                sets = common.shingle_sets(some.column("text"), width)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))], names=["rid", "tokens"])

    return texts.select("doc_id", "text").mapInArrow(run, "rid long, tokens array<long>")
