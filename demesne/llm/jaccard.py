"""N-gram Jaccard join by grouped prefixes (operator 7).

A document is its set of distinct word shingles; two documents link when their sets have a Jaccard
similarity of at least `least` (in percent), and a component is what links reach.

1. Shingles are ordered by the number of documents that have a shingle of the same slot (2^18 slots,
   counted over all documents, one fixed array a task) and by hash. Any such order is exact, and this
   one puts passages that many documents share last.
2. Equal sets are one class. The prefix of a set of n shingles is its first n - ceil(least n) + 1:
   linked sets share a shingle of their prefixes. Classes with the same prefix and size are one group.
3. Groups meet on the shingles of their prefixes. Where more than `FEW` classes share a shingle, one class leads (the least
   one), and every class of the groups there is compared with the leaders it meets: a number of pairs in
   proportion to the prefixes. Verified pairs give links and, for classes within `LINKS_NEAR` (3) times the distance of a link
   of the leader, the few shingles by which they differ from it. Classes near the same leader are compared by these
   differences alone (|x ^ y| = |Dx ^ Dy|), met on the rarest of them, spreading from linked class to linked class
   over those not reached yet, so that no pair inside a component is asked for again.
4. Two linked sets at most one of which is near a leader are both farther than twice the distance of a link
   from it, by the triangle inequality of the Jaccard distance; copies that each are linked to one text are nearer to each other. Only such
   classes, and those that share a shingle with few others, are paired directly, with filters by size and by position, and verified.
5. Components of classes come from alternating star rounds.

A set is represented by 64-bit hashes of its shingles, a class by 128 bits.

Defined results: documents without words, or with null text, have an empty set and are linked with nothing; documents
with fewer words than n have one shingle, the whole sequence; a null key has a null component of
its own and links nothing; rows with equal keys are documents of their own that share a name; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demesne.llm.common import components, dense_counts, lists, lower, mix, per_piece, raw, shingles, span_hashes, words
from demesne.session import cut

SLOT_BITS = 18
#: Differences from a leader are kept within this many times the distance of a link, so that copies of one text,
#: each linked to it, are told by their differences from any of them: they are at most twice that distance apart.
LINKS_NEAR = 3
#: Classes with a shared shingle that are paired directly.
FEW = 12
#: Pairs that one copy of a class is compared in, and most keys that are sent to every task.
SHARE, BROADCAST_ROWS = 2_000, 200_000


def sets_of(col: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z in lower case, words split at white space of ASCII."""
    data, offsets = raw(col)
    data = lower(data)
    starts, ends, first = words(data, offsets)
    return shingles(span_hashes(data, starts, ends), first, n)


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def slot_counts(docs: DataFrame, n: int) -> np.ndarray:
    """How many document sets have a shingle in each slot (once for each such shingle)."""

    def tally(part, col, totals):
        found = sets_of(col, n)
        if found:
            totals += np.bincount(_slots(np.concatenate(found)), minlength=1 << SLOT_BITS)

    return dense_counts(docs.select("text"), tally, 1 << SLOT_BITS)


def prefix_size(n: int, least: int) -> int:
    return n - -(-n * least // 100) + 1


def _name(s: np.ndarray) -> bytes | None:
    """The 128-bit name of a set: sums of two scramblings, which do not depend on the order."""
    if not len(s):
        return None
    return np.array([mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)]).tobytes()


def _profiles(counts: np.ndarray, n: int, least: int):
    """(doc_id, text, hash) -> doc_id, size of the set, its name, its prefix in order, the group of that prefix and size, and the hash."""

    def run(part, col):
        found = sets_of(col, n)
        prefix = []
        for s in found:
            order = np.lexsort((s, counts[_slots(s)]))[: prefix_size(len(s), least)] if len(s) else []
            prefix.append(s[order].view(np.int64) if len(s) else np.zeros(0, np.int64))
        gid = [int.from_bytes(hashlib.blake2b(p.tobytes() + len(s).to_bytes(8, "little"), digest_size=8).digest(), "little", signed=True) for p, s in zip(prefix, found, strict=True)]
        cols = [part.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(map(_name, found), pa.binary()), lists(prefix, pa.int64()), pa.array(gid, pa.int64()), part.column(2)]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "class", "prefix", "gid", "hash"])

    return per_piece(run)


def _distance_bound(n, m, least: int):
    """Most shingles in which linked sets of n and m may differ: |x ^ y| (100 + least) <= (100 - least) (n + m)."""
    return (100 - least) * (n + m) // (100 + least)


COMPARED = "x binary, y binary, n bigint, m bigint, away array<bigint>"
SIDES = "y binary, copy int, x binary, size bigint, items array<{}>"


def _sides(n: int, brief: bool):
    """(class, lead_copies, partners, text) -> the set of the text, once for each comparison (y, copy, x; x is null for y itself).

    A brief set is what a quarter of all shingles, told by their hash, has of it, each cut to 32 bits.
    """

    def run(part, col):
        y, copy, x, size, items = [], [], [], [], []
        for name, copies, partners, s in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), sets_of(col, n), strict=True):
            if _name(s) != name:
                continue  # another row of the same key
            own = s.view(np.int64)
            # Signed order, so that differences are merges of sorted arrays on both sides.
            size_ = len(own)
            own = np.unique(s[s >> np.uint64(62) == 0] & np.uint64(0xFFFFFFFF)).astype(np.int32) if brief else np.sort(own)
            for k in range(copies or 0):
                y.append(name)
                copy.append(k)
                x.append(None)
                size.append(size_)
                items.append(own)
            pick = int.from_bytes(name[:4], "little")
            for p in partners or []:
                y.append(p["y"])
                copy.append(pick % p["copies"])
                x.append(name)
                size.append(size_)
                items.append(own)
        kind = pa.int32() if brief else pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(y, pa.binary()), pa.array(copy, pa.int32()), pa.array(x, pa.binary()), pa.array(size, pa.int64()), lists(items, kind)], ["y", "copy", "x", "size", "items"])

    return per_piece(run)


def _differences(limit: float, brief: bool):
    """Rows sorted by (y, copy, x), the set of y before those to compare it with -> pairs that differ in at most limit (n + m)."""

    def run(batches):
        lead, own, own_size = None, None, 0
        kind = pa.int32() if brief else pa.int64()
        for batch in batches:
            x, y, n, m, away = [], [], [], [], []
            flat, at = batch.column(4).flatten().to_numpy(), np.concatenate([[0], np.cumsum(batch.column(4).value_lengths().to_numpy(zero_copy_only=False))])
            for i, (to, name, size) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                items = flat[at[i] : at[i + 1]]
                if name is None:
                    lead, own, own_size = to, items.copy(), size
                elif to == lead:
                    apart = np.setxor1d(items, own, assume_unique=True)
                    if len(apart) <= limit * (size + own_size) + 1e-9:
                        x.append(name)
                        y.append(to)
                        n.append(size)
                        m.append(own_size)
                        away.append(apart[:0] if brief else apart)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.binary()), pa.array(n, pa.int64()), pa.array(m, pa.int64()), lists(away, kind).cast(pa.list_(pa.int64()))], ["x", "y", "n", "m", "away"])

    return run


def compare(docs: DataFrame, members: DataFrame, pairs: DataFrame, n: int, limit: float) -> DataFrame:
    """(x, y, sizes n and m, away: the shingles that only one has) of the pairs of classes with |away| <= limit (n + m).

    First on brief sets, an eighth of the bytes: what differs there differs in whole, so pairs that
    differ too much are told without more; then the rest on whole sets.
    """
    near = cut(_compare(docs, members, pairs, n, limit, True).select("x", "y").distinct())
    return _compare(docs, members, near, n, limit, False)


def _compare(docs: DataFrame, members: DataFrame, pairs: DataFrame, n: int, limit: float, brief: bool) -> DataFrame:
    """One comparison of the sets, brief or whole, of pairs of classes, from the text of one document of each.

    The set of x travels to y, once a pair; y is copied for every SHARE pairs it is in, so a class
    that many meet is spread over tasks. The keys of the documents wanted are sent to every task
    only if they are at most BROADCAST_ROWS; beyond that, texts are dealt out by key.
    """
    spark = docs.sparkSession
    leads = pairs.groupBy("y").agg(F.count(F.lit(1)).alias("n")).select(F.col("y").alias("class"), F.ceil(F.col("n") / SHARE).cast("int").alias("lead_copies"))
    known = pairs.join(leads.select(F.col("class").alias("y"), F.col("lead_copies").alias("copies")), "y")
    partners = known.groupBy(F.col("x").alias("class")).agg(F.collect_list(F.struct("y", "copies")).alias("partners"))
    wanted = partners.join(leads, "class", "full_outer").join(members.select("class", "low"), "class")
    wanted = cut(wanted.select(F.col("low").alias("doc_id"), "class", "lead_copies", "partners"))
    small = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    found = docs.join(F.broadcast(wanted) if small else wanted.hint("shuffle_merge"), "doc_id")
    sides = found.select("class", "lead_copies", "partners", "text").mapInArrow(_sides(n, brief), SIDES.format("int" if brief else "bigint"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return sides.repartition(parts, "y", "copy").sortWithinPartitions("y", "copy", F.asc_nulls_first("x")).mapInArrow(_differences(limit, brief), COMPARED)


def _spread(least: int):
    """Links among the classes near one leader, from rows (leader, x, n, away); the leader differs in nothing from itself.

    Classes meet on the rarest of the shingles by which they differ from the leader: linked ones differ from each other in
    at most b of them, so they share one of their first b + 1, or have no more than b each and meet under a mark of their own.
    """

    def run(table: pa.Table) -> pa.Table:
        names = [table["y"][0].as_py(), *table["x"].to_pylist()]
        size = np.concatenate([[table["m"][0].as_py()], table["n"].to_numpy()])
        away = [np.zeros(0, np.int64), *(np.asarray(v.values) for v in table["away"].combine_chunks())]
        length = np.array([len(v) for v in away])
        flat = np.unique(np.concatenate(away), return_inverse=True)[1]
        row = np.repeat(np.arange(len(names)), length)
        often = np.bincount(flat)
        order = np.lexsort((flat, often[flat], row))
        flat = flat[order]  # each class's shingles, rarest first
        begin = np.concatenate([[0], np.cumsum(length)])
        most = _distance_bound(size, -(-100 * size // least), least)
        early = np.arange(len(flat)) - begin[row] <= most[row]
        tokens = len(often)
        few = np.flatnonzero(length <= most)
        token, holder = np.concatenate([flat[early], np.full(len(few), tokens)]), np.concatenate([row[early], few])
        order = np.lexsort((holder, token))
        token, posting = token[order], holder[order]
        start = np.searchsorted(token, np.arange(tokens + 2))
        end, start = start[1:].copy(), start[:-1]
        left = np.ones(len(names), bool)
        mark = np.zeros(tokens + 1, bool)
        links = []
        for seed in range(len(names)):
            if not left[seed]:
                continue
            left[seed] = False
            queue = [seed]
            while queue:
                v = queue.pop()
                own = flat[begin[v] : begin[v + 1]]
                keys = np.append(own[: most[v] + 1], tokens) if len(own) <= most[v] else own[: most[v] + 1]
                met = []
                for t in keys[end[keys] - start[keys] > 1].tolist():
                    there = posting[start[t] : end[t]]
                    there = there[left[there]]
                    posting[start[t] : start[t] + len(there)] = there  # those reached are not asked again
                    end[t] = start[t] + len(there)
                    met.append(there)
                if not met:
                    continue
                u = np.unique(np.concatenate(met))
                mark[own] = True
                each = np.repeat(begin[u], length[u]) + np.arange(length[u].sum()) - np.repeat(np.cumsum(length[u]) - length[u], length[u])
                shared = np.bincount(np.repeat(np.arange(len(u)), length[u]), mark[flat[each]], len(u))
                mark[own] = False
                for w in u[length[u] + len(own) - 2 * shared <= _distance_bound(size[u], size[v], least)].tolist():
                    left[w] = False
                    links.append((names[v], names[w]))
                    queue.append(w)
        return pa.table({"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})

    return run


def class_links(docs: DataFrame, profiles: DataFrame, n: int, least: int) -> DataFrame:
    """Links (a, b) between classes that give the components of all links."""
    near = min(0.9, LINKS_NEAR * (100 - least) / 100)
    sound = profiles.where("n > 0 and doc_id is not null")
    members = cut(sound.groupBy("class").agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("gid").alias("gid")))
    groups = members.groupBy("gid").agg(F.min("class").alias("lead"), F.first("n").alias("m"), F.count(F.lit(1)).alias("size"))
    # Dealt once by shingle, as rows of numbers: which are shared is seen in the same exchange.
    seen = sound.select("gid", F.posexplode("prefix").alias("pos", "token"))
    same = Window.partitionBy("token")
    # Shingles in the prefixes of several groups, led by the least of these; and groups of several classes, as shingles of their own.
    seen = seen.withColumns({"first": F.min("gid").over(same), "last": F.max("gid").over(same), "led": F.count(F.lit(1)).over(same) > FEW}).where("first <> last")
    met = seen.groupBy("token", "gid").agg(F.min("pos").alias("pos"), F.min("first").alias("first"), F.bool_or("led").alias("led"))
    own = groups.where("size > 1").select(F.xxhash64("gid").alias("token"), "gid", F.lit(0).alias("pos"), F.col("gid").alias("first"), F.col("size") > FEW)
    leads = groups.select(F.col("gid").alias("first"), F.col("lead").alias("leader"), "m")
    # Few documents that share a shingle are paired directly; more meet by their leader.
    met = cut(met.union(own).select("token", "gid", "pos", F.when(F.col("led"), F.col("first")).alias("first")))
    led = met.where("first is not null").join(leads, "first").select("token", "gid", "pos", "leader", "m")
    none = met.where("first is null").select("token", "gid", "pos", F.lit(None).cast("binary"), F.lit(None).cast("bigint"))
    met = cut(led.union(none))
    # Every class meets the leaders of its group's shingles, where the sizes allow it to be near.
    classes = members.select("gid", "class", "n")
    at = met.where("leader is not null").select("gid", "leader", "m").distinct().join(classes, "gid").where(F.least("n", "m") >= (1 - near) * F.greatest("n", "m"))
    stars = cut(at.where("class <> leader").select(F.col("class").alias("x"), F.col("leader").alias("y")).distinct())
    away = F.size("away")
    union = (F.col("n") + F.col("m") + away) / 2
    compared = cut(compare(docs, members, stars, n, near / (2 - near)))  # a distance of `near`, as |away| over the sum of sizes
    near_links = compared.groupBy("y").applyInArrow(_spread(least), "a binary, b binary")
    # The rest: classes that share a shingle and are not both near its leader. Both are farther from it than this.
    core = near - (100 - least) / 100
    dist = compared.select(F.col("x").alias("class"), F.col("y").alias("leader"), (away / union).alias("dist"))
    far = met.join(classes, "gid").join(dist, ["class", "leader"], "left")
    far = far.withColumn("dist", F.when(F.col("class") == F.col("leader"), 0.0).otherwise(F.col("dist")))
    far = far.where(F.col("dist").isNull() | (F.col("dist") > core - 1e-9)).select("token", "class", "n", "pos", F.col("dist").isNotNull().alias("near"))
    x, y = far.alias("x"), far.alias("y")
    # With p shingles before the shared one in x, and q in y, at most min(n - p, m - q) are shared if it is the first.
    total = F.col("x.n") + F.col("y.n")
    overlap = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    fits = (
        (F.col("x.class") < F.col("y.class")) & ~(F.col("x.near") & F.col("y.near"))
        & (100 * F.least("x.n", "y.n") >= least * F.greatest("x.n", "y.n")) & (overlap * (100 + least) >= least * total)
    )
    pairs = cut(x.join(y, (F.col("x.token") == F.col("y.token")) & fits).select(F.col("x.class").alias("x"), F.col("y.class").alias("y")).distinct())
    linked = away * (100 + least) <= (100 - least) * (F.col("n") + F.col("m"))
    far_links = compare(docs, members, pairs, n, (100 - least) / (100 + least)).where(linked).select(F.col("x").alias("a"), F.col("y").alias("b"))
    return near_links.union(far_links)


def linked_rows(docs: DataFrame, n: int, least: int) -> DataFrame:
    """(doc_id, hash, n, root) of every document: the hash of its text, the size of its set, the name of its component (null without words)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash"))
    counts = slot_counts(own, n)
    kind = "doc_id bigint, n bigint, class binary, prefix array<bigint>, gid bigint, hash bigint"
    profiles = cut(own.mapInArrow(_profiles(counts, n, least), kind))
    roots = components(class_links(own.select("doc_id", "text"), profiles.drop("hash"), n, least))
    slim = profiles.select("doc_id", "hash", "n", F.when(F.col("doc_id").isNotNull(), F.col("class")).alias("class"))
    return slim.join(roots, slim["class"] == roots["node"], "left").select("doc_id", "hash", "n", F.coalesce("root", "class").alias("root"))


def link_documents(docs: DataFrame, n: int = 3, least: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; component_id is the least doc_id that links reach."""
    named = linked_rows(docs, n, least)
    least_id = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("low"))
    out = named.join(least_id.withColumnRenamed("root", "r"), F.col("root") == F.col("r"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("low", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, least: int = 80) -> DataFrame:
    """One document of each component, all columns kept: the one of least key, then of least hash of its text; rows with a null key, and without words, are kept.

    Rows are told apart by key and text, so texts that share a key go or stay each by itself; one of equal rows stays.
    Texts stay where they are while the keys to leave out are at most BROADCAST_ROWS; beyond that they are dealt by key.
    """
    rows = cut(linked_rows(docs, n, least).where("root is not null").groupBy("doc_id", "hash").agg(F.min("root").alias("root"), F.count(F.lit(1)).alias("rows")))
    first = rows.groupBy("root").agg(F.min(F.struct("doc_id", "hash")).alias("first"))
    judged = cut(rows.join(first, "root").select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), (F.struct("doc_id", "hash") == F.col("first")).alias("_stays"), (F.col("rows") > 1).alias("_twice")))
    small = lambda ids: F.broadcast(ids) if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else ids
    later, twice = small(judged.where("not _stays")), small(judged.where("_stays and _twice"))
    # Each row whole in one column, so that no name can clash.
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    same = lambda ids: (F.col("row.doc_id") == ids["_id"]) & (F.xxhash64("row.text") == ids["_hash"])
    kept = whole.join(later, same(later), "left_anti")
    again = kept.join(twice, same(twice), "left_semi").select("row", F.col("row.doc_id").alias("_id"), F.xxhash64("row.text").alias("_hash"))
    kept = kept.join(twice, same(twice), "left_anti").union(again.dropDuplicates(["_id", "_hash"]).select("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
