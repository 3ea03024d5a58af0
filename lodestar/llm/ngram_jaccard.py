"""N-gram Jaccard join with set-relation skipping.

Equal sets are answered once.  The others meet in an index from shingle to the
sets that hold it among their first shingles in a common order (heavy shingles
last).  Entries of an index list carry their set's size and the shingle's
position; where these rule a link out, the entries are skipped, for a whole
block of sizes at once.

A list's answers start from one pivot, the set in which the shingle stands
earliest: every other entry is compared with it.  A set's home is the least
pivot that it links with, or itself.

All further answers are derived from the home's.  A set x of home h is known by
what it gains and loses against h; for a set y that was compared with h, too,

    |x & y| = |h| - |lost(x)| - |lost(y)| + |lost(x) & lost(y)| + |gained(x) & gained(y)|

so a pair costs what its differences cost, not its sets.  A visitor y whose
answer with h rules out every x of that home is skipped, and where the sizes of
the differences settle a pair, they are not compared.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import HOT_KEYS, HOT_ROWS, drop_written, fresh, hinted, join_counted, materialise, shuffle_partitions, slim, small_batches
from lodestar.llm.components import connected_components
from lodestar.llm.words import WordHashes, chunks

#: Shingles in the order's table of heavy ones, each of HEAVY_SETS sets or more.  Any table gives the same links; its size bounds the broadcast.
HEAVY = 300_000
HEAVY_SETS = 4

#: Members that are compared with one hub in one task.
HUB_MEMBERS = 256

#: Sets of a home that are held in one task; the others of the home and its visitors stream past them.
BLOCK = 512

#: Entries of an index list that meet the list's homes in one task.
LIST_ENTRIES = 1024


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; two sets link at a Jaccard similarity of ``num`` / ``den`` or more."""

    words: int = 4
    num: int = 85
    den: int = 100

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def overlap(self, a: Column, b: Column) -> Column:
        """The least intersection with which sets of these sizes link."""
        return F.floor((F.lit(self.num) * (a + b) + (self.num + self.den - 1)) / (self.num + self.den))

    def links(self, shared, a, b):
        return self.den * shared >= self.num * (a + b - shared)


_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of each text, all bytes of a chunk of texts at once."""

    def __init__(self, words: int):
        self.words = words
        self.hashes = WordHashes(11)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        parts = texts.cast(pa.large_binary()).to_pylist()
        return [s for a, b in chunks(list(map(len, parts))) for s in self._hashed(parts[a:b])]

    def _words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of each word."""
        edges = np.flatnonzero(np.diff(~_WHITE[data], prepend=False, append=False))
        return edges[::2], self.hashes(data, edges[::2], edges[1::2])

    def _hashed(self, texts: list[bytes]) -> list[np.ndarray]:
        starts, h = self._words(np.frombuffer(b" ".join(texts).lower(), np.uint8))  # bytes: A-Z only
        ends = np.cumsum([len(t) + 1 for t in texts])
        bounds = np.searchsorted(starts, ends).tolist()
        k = self.words
        runs = self._mixed(h, k) if len(h) >= k else h
        out, at = [], 0
        for end in bounds:
            n = end - at
            if n >= k:
                s = np.sort(runs[at : end - k + 1])
                out.append(s[np.append(True, s[1:] != s[:-1])])
            elif n:
                out.append(self._mixed(h[at:end], n) + np.uint64(n))
            else:
                out.append(h[:0])
            at = end
        return out

    @staticmethod
    def _mixed(h: np.ndarray, k: int) -> np.ndarray:
        """A hash of each ``k`` neighbours."""
        n = len(h)
        out = h[: n - k + 1].copy()
        for i in range(1, k):
            out ^= out >> np.uint64(29)
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : n - k + 1 + i]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
        return out


def set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


class _Frequent:
    """Counts the shingles of a task's documents and passes on those met three times or more in a window of two million."""

    WINDOW = 2_000_000

    def __init__(self):
        self.parts: list[np.ndarray] = []

    def add(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        self.parts += sets
        return self.flush() if sum(map(len, self.parts)) > self.WINDOW else self.flush([])

    def flush(self, parts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        if parts is None:
            parts, self.parts = self.parts, []
        keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]), return_counts=True)
        return keys[counts >= 3].view(np.int64), counts[counts >= 3]


def _profile(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """Rows (kind 0, doc_id, text_key, n, sid) of each document and (kind 1, null, null, count, shingle) of shingles.

    The latter are each set's first in the order of their hashes, which count over the whole
    corpus, and any that are frequent among a task's documents.
    """
    words = similarity.words

    def profile(batches):
        shingler, frequent = Shingler(words), _Frequent()

        def rows(ids, texts, ns, sids, keys, counts):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([0, 1], np.int32), [len(ids), len(keys)])),
                    pa.concat_arrays([ids, pa.nulls(len(keys), pa.int64())]),
                    pa.concat_arrays([texts, pa.nulls(len(keys), pa.int64())]),
                    pa.concat_arrays([pa.array(ns, pa.int64()), pa.array(counts, pa.int64())]),
                    pa.concat_arrays([pa.array(sids, pa.int64()), pa.array(keys, pa.int64())]),
                ],
                names=["kind", "doc_id", "text_key", "n", "sid"],
            )

        for batch in batches:
            sets = shingler(batch.column(1))
            sids = [set_id(s) if len(s) else None for s in sets]
            once = list({i: s for i, s in zip(sids, sets, strict=True) if i is not None}.values())
            first = np.concatenate([np.zeros(0, np.uint64), *(s[: similarity.prefix(len(s))] for s in once)]).view(np.int64)
            keys, counts = frequent.add(once)
            yield rows(batch.column(0), batch.column(2), [len(s) for s in sets], sids, np.concatenate([first, keys]), np.concatenate([np.ones(len(first), np.int64), counts]))
        yield rows(pa.array([], pa.int64()), pa.array([], pa.int64()), [], [], *frequent.flush())

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return keyed.mapInArrow(slim(profile), "kind int, doc_id long, text_key long, n long, sid long")


def _entries(docs: DataFrame, similarity: Similarity, heavy: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Index entries (token, sid, n, pos): each set's first shingles in the common order."""
    spread = docs.sparkSession.sparkContext.broadcast(heavy)

    def entries(batches):
        shingler = Shingler(similarity.words)
        keys, counts = spread.value
        for batch in batches:
            sets = {set_id(s): s for s in shingler(batch.column(1)) if len(s)}
            if not sets:
                continue
            flat, sizes = np.concatenate(list(sets.values())), np.array([len(s) for s in sets.values()])
            weight = np.zeros(len(flat), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
                weight = np.where(keys[at] == flat, counts[at], 0)
            order = np.lexsort((flat, weight, np.repeat(np.arange(len(sizes)), sizes)))  # set by set
            prefix = np.array([similarity.prefix(n) for n in sizes.tolist()])
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            first = place < np.repeat(prefix, sizes)
            columns = (flat[order[first]].view(np.int64), np.repeat(np.array(list(sets), np.int64), prefix), np.repeat(sizes, prefix).astype(np.int32), place[first].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "sid", "n", "pos"])

    return docs.mapInArrow(slim(entries), "token long, sid long, n int, pos int")


ID_BYTES = 64  # of a row of two to five numbers in a broadcast table


def _overlaps(pairs: DataFrame, docs: DataFrame, owners: DataFrame, similarity: Similarity, differences: bool = False) -> DataFrame:
    """(a, b, shared, n_a, n_b) of each (a, b) pair of set ids, from the texts that own the sets.

    With ``differences`` also what a gains and loses against b, but only of the
    pairs that can tell of a link: pairs have columns most_gained and least_n of
    b's home, by which a set of that home can share that much more with a.
    """
    words, rows = similarity.words, ID_BYTES
    pairs = materialise(pairs, "jaccard-pairs")
    wanted = materialise(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct().join(owners, "sid"), "jaccard-wanted")
    own = F.col("doc_id").eqNullSafe(F.col("owner_id")) & (F.xxhash64("text") == F.col("owner_text"))
    texts = docs.join(hinted(wanted, wanted.count() * rows), own).dropDuplicates(["sid"]).select("sid", "text")
    texts = materialise(texts, "jaccard-texts")
    bounds = ["most_gained", "least_n"] if differences else []
    salts = pairs.groupBy("b", *bounds).agg(F.ceil(F.count("*") / HUB_MEMBERS).cast("int").alias("salts"), F.count("*").alias("n"))
    members = (
        join_counted(pairs.select("a", "b"), salts.select("b", "salts", "n"), "b", "n", pairs.count())
        .select("b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"), F.col("a").alias("sid"), F.lit(1).alias("role"), *(F.lit(0).cast("long").alias(c) for c in bounds))
    )
    hubs = salts.select("b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("b").alias("sid"), F.lit(0).alias("role"), *bounds)
    dealt = (
        members.unionByName(hubs)
        .join(texts, "sid")
        .repartition(shuffle_partitions(docs.sparkSession), "b", "salt")
        .sortWithinPartitions("b", "salt", "role")
        .select("b", "sid", "role", "text", *bounds)
    )
    numbers = ["a", "b", "shared", "n_a", "n_b"]
    sides = ["gained", "lost"] if differences else []

    def compare(batches):
        shingler, hub, hub_id, most, least = Shingler(words), None, None, 0, 0
        for batch in batches:
            out, parts = [], {c: [] for c in sides}
            others = [c.to_pylist() for i, c in enumerate(batch.columns) if i != 3]
            for s, h, sid, role, *bound in zip(shingler(batch.column(3)), *others, strict=True):
                if role == 0:
                    hub, hub_id = s, h
                    most, least = bound or (0, 0)
                elif hub_id == h:
                    common = np.intersect1d(hub, s, assume_unique=True)
                    k = len(common)
                    if sides:
                        if not similarity.links(min(k + most, len(s)), len(s), least):
                            continue
                        for c, whole in (("gained", s), ("lost", hub)):
                            parts[c].append(np.setdiff1d(whole, common, assume_unique=True).view(np.int64))
                    out.append((sid, h, k, len(s), len(hub)))
            columns = [pa.array(c, pa.int64()) for c in (list(zip(*out, strict=True)) or [[]] * 5)]
            for c in sides:
                ends = np.cumsum([0, *map(len, parts[c])])
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *parts[c]]))))
            yield pa.RecordBatch.from_arrays(columns, names=[*numbers, *sides])

    schema = ", ".join([*(f"{c} long" for c in numbers), *(f"{c} array<long>" for c in sides)])
    done = materialise(dealt.mapInArrow(slim(compare), schema), "jaccard-answers")
    for df in (pairs, wanted, texts):
        drop_written(df)
    return done


def _possible(similarity: Similarity) -> Column:
    """Whether entries x and y of one list can link: their sizes fit and enough shingles stand at or after both positions.

    Of y the least and the largest size and the most shingles at or after its position may stand for several entries.
    """
    need = similarity.overlap(F.col("x.n"), F.col("y.least"))
    return (F.least(F.col("x.n") - F.col("x.pos"), "y.rest") >= need) & (F.col("x.n") >= need) & (F.col("y.largest") >= similarity.overlap(F.col("x.n"), F.col("y.largest")))


class _Home:
    """The differences of a home's sets, by which the links of a set that streams past are counted."""

    def __init__(self, similarity: Similarity, rows: list[tuple]):
        self.links = similarity.links
        self.sid, self.n, self.copies = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        self.sizes = [np.array([len(r[i]) for r in rows], np.int64) for i in (3, 4)]
        self.base = int(self.n[0] - self.sizes[0][0] + self.sizes[1][0])  # shingles of the home's own set
        self.keys, self.of = [], []
        for i in (3, 4):
            flat = np.concatenate([np.zeros(0, np.int64), *(r[i] for r in rows)])
            order = np.argsort(flat, kind="stable")
            self.keys.append(flat[order])
            self.of.append(np.repeat(np.arange(len(rows)), self.sizes[i - 3])[order])
        self.found = np.zeros(len(rows), np.int64)

    def _shared(self, i: int, y: np.ndarray) -> np.ndarray:
        low, high = (np.searchsorted(self.keys[i], y, side) for side in ("left", "right"))
        n = high - low
        at = np.repeat(high - np.cumsum(n), n) + np.arange(n.sum())
        return np.bincount(self.of[i][at], minlength=len(self.n))

    def linked(self, n: int, gained: np.ndarray, lost: np.ndarray) -> np.ndarray:
        """Which sets link with one of ``n`` shingles and these differences."""
        surely = self.base - self.sizes[1] - len(lost)
        at_most = surely + np.minimum(self.sizes[0], len(gained)) + np.minimum(self.sizes[1], len(lost))
        yes, maybe = self.links(surely, self.n, n), self.links(at_most, self.n, n)
        if (yes == maybe).all():
            return yes
        return self.links(surely + self._shared(0, gained) + self._shared(1, lost), self.n, n)


def _derived(rows: DataFrame, similarity: Similarity, within: bool) -> DataFrame:
    """(sid, links, other): linked rows of each set, in parts to be summed, and for a visitor a set of the home that it links with.

    ``rows`` are (home, sid, visitor, n, copies, gained, lost); ``within`` also counts the links of a home's own sets with each other.
    """
    parts = shuffle_partitions(rows.sparkSession)
    blocks = rows.groupBy("home").agg(F.ceil(F.count_if(~F.col("visitor")) / BLOCK).cast("int").alias("blocks"), F.count("*").alias("__rows"))
    dealt = join_counted(rows, blocks, "home", "__rows", rows.count()).withColumn("block", F.when(~F.col("visitor"), F.pmod(F.xxhash64("sid"), F.col("blocks"))).cast("int"))
    held = dealt.where(~F.col("visitor")).withColumn("role", F.lit(0))
    last = F.when(F.col("visitor"), F.col("blocks") - 1).otherwise(F.col("block"))
    past = dealt if within else dealt.where("visitor")
    past = past.withColumn("at", F.explode(F.sequence(F.lit(0), last))).withColumn("role", F.when(F.col("at") == F.col("block"), 1).otherwise(2))
    dealt = (
        held.withColumn("at", F.col("block")).unionByName(past)
        .repartition(parts, "home", "at").sortWithinPartitions("home", "at", "role")
        .select("home", "at", "role", "sid", "n", "copies", "gained", "lost", "visitor")
    )

    def count(batches):
        key, held, home = None, [], None

        def batch_of(sids, links, others):
            return pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(links, pa.int64()), pa.array(others, pa.int64())], names=["sid", "links", "other"])

        def settle():
            if home is not None and home.found.any():
                yield batch_of(home.sid, home.found, pa.nulls(len(home.sid), pa.int64()))

        for batch in batches:
            sids, links, others = [], [], []
            plain = [c.to_pylist() for c in batch.columns[:6]]
            lists = [np.split(c.flatten().to_numpy(), np.cumsum(c.value_lengths().to_numpy())[:-1]) for c in batch.columns[6:8]]
            for h, at, role, sid, n, copies, gained, lost, visitor in zip(*plain, *lists, batch.column(8).to_pylist(), strict=True):
                if (h, at) != key:
                    yield from settle()
                    key, held, home = (h, at), [], None
                if role == 0:
                    held.append((sid, n, copies, gained, lost))
                    continue
                home = home or _Home(similarity, held)
                linked = home.linked(n, gained, lost)
                if role == 1:
                    linked &= home.sid != sid
                else:
                    home.found[linked] += copies
                if linked.any():
                    sids.append(sid), links.append(int(home.copies[linked].sum()))
                    others.append(int(home.sid[linked.argmax()]) if visitor else None)
            yield batch_of(sids, links, others)
        yield from settle()

    return dealt.mapInArrow(slim(count), "sid long, links long, other long")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _index(profile: DataFrame, docs: DataFrame, similarity: Similarity) -> DataFrame:
    """Index entries (token, sid, n, pos) of the lists with two entries or more."""
    # Shingles that many sets would index go to the end of the order, the heaviest last.
    top = profile.where("kind = 1").groupBy("sid").agg(F.sum("n").alias("n")).where(F.col("n") >= HEAVY_SETS)
    top = top.orderBy(F.desc("n"), "sid").limit(HEAVY).toPandas()
    keys = top["sid"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    entries = materialise(_entries(docs, similarity, (keys[order], top["n"].to_numpy(np.int64)[order])), "jaccard-entries")
    lists = materialise(entries.groupBy("token").agg(F.count("*").alias("in_list")).where("in_list > 1"), "jaccard-lists")
    index = materialise(join_counted(entries, lists, "token", "in_list", entries.count()).select("token", "sid", "n", "pos"), "jaccard-index")
    drop_written(entries)
    drop_written(lists)
    return index


def _visits(index: DataFrame, homes: DataFrame, linked: DataFrame, similarity: Similarity, within: bool) -> DataFrame:
    """(a, b): sets a that may link with a set of the home b, an earlier one than their own; without ``within`` of other components only."""
    known = (
        index.join(homes.select("sid", "home"), "sid", "left")
        .join(linked.withColumnRenamed("node", "sid"), "sid", "left")
        .select("token", "sid", "n", "pos", F.coalesce("home", "sid").alias("home"), F.coalesce("component", "sid").alias("component"))
    )
    known = materialise(known, "jaccard-known")
    apart = "home" if within else "component"
    salts = F.ceil(F.count("*") / LIST_ENTRIES).cast("int").alias("salts")
    open_ = known.groupBy("token").agg(F.min(apart).alias("low"), F.max(apart).alias("high"), F.count("*").alias("in_list"), salts).where("low < high")
    ratio = float(np.log(similarity.den / similarity.num))

    def block(n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / ratio).cast("int")

    entries = join_counted(known, materialise(open_.drop("low", "high"), "jaccard-open"), "token", "in_list", known.count())
    entries = materialise(entries.withColumn("block", block(F.col("n"))), "jaccard-entries")
    # An entry's position tells the largest set that it can link with: blocks of larger sizes are skipped.
    reach = F.floor((F.lit(similarity.num + similarity.den) * (F.col("n") - F.col("pos"))) / similarity.num) - F.col("n")
    visitors = (
        entries.withColumn("reach", reach).where("reach > 0")
        .withColumn("salt", F.pmod(F.xxhash64("sid"), F.col("salts")).cast("int"))
        .withColumn("last", F.least(F.col("block") + 1, block(F.col("reach"))))
        .where("last >= block - 1")
        .withColumn("block", F.explode(F.sequence(F.col("block") - 1, F.col("last"))))
    )
    visited = entries.groupBy("token", "block", "home", "component", "salts").agg(
        F.min("n").alias("least"), F.max("n").alias("largest"), F.max(F.col("n") - F.col("pos")).alias("rest")
    )
    visited = visited.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    found = (
        visitors.alias("x").join(visited.alias("y"), ["token", "block", "salt"])
        .where((F.col("y.home") < F.col("x.home")) & (F.col(f"x.{apart}") != F.col(f"y.{apart}")) & _possible(similarity))
        .select(F.col("x.sid").alias("a"), F.col("y.home").alias("b"))
        .distinct()
    )
    found = materialise(found, "jaccard-visits")
    drop_written(known)
    drop_written(entries)
    return found


def _answers(docs: DataFrame, similarity: Similarity, count: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_key, n_shingles, sid) of ``docs``, and of each set (sid, root, copies, least_id, first_text, n_links).

    A row's text_key is its text's hash, its sid is null for an empty set.  A
    set's root names its component, least_id and first_text a row that stands
    for it; n_links, with ``count`` only, is the number of other rows that each of its rows links with.
    """
    small_batches(docs.sparkSession)
    profile = materialise(_profile(docs, similarity), "jaccard-profile")
    rows = materialise(profile.where("kind = 0").select("doc_id", "text_key", F.col("n").alias("n_shingles"), "sid"), "jaccard-rows")
    by_id = F.coalesce("doc_id", F.lit((1 << 63) - 1))  # ids before null
    sets = rows.where("sid is not null").groupBy("sid").agg(
        F.first("n_shingles").alias("n"), F.count("*").alias("copies"), F.min("doc_id").alias("least_id"), F.min_by("text_key", by_id).alias("first_text")
    )
    sets = materialise(sets, "jaccard-sets")
    owners = sets.select("sid", F.col("least_id").alias("owner_id"), F.col("first_text").alias("owner_text"))
    index = _index(profile, docs, similarity)
    drop_written(profile)

    # First answers: every entry against its list's pivot.
    pivots = index.groupBy("token").agg(F.min(F.struct("pos", "sid", "n")).alias("p"), F.count("*").alias("in_list"))
    pivots = pivots.select("token", F.struct(F.col("p.sid").alias("sid"), F.col("p.n").alias("least"), F.col("p.n").alias("largest"), (F.col("p.n") - F.col("p.pos")).alias("rest")).alias("y"), "in_list")
    listed = join_counted(index.select("token", F.struct("sid", "n", "pos").alias("x")), pivots, "token", "in_list", index.count())
    first = listed.where((F.col("x.sid") != F.col("y.sid")) & _possible(similarity)).select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b")).distinct()
    answers = _overlaps(first, docs, owners, similarity)
    near = answers.where(similarity.links(F.col("shared"), F.col("n_a"), F.col("n_b")))
    linked = materialise(connected_components(near), "jaccard-linked")
    homes = near.groupBy(F.col("a").alias("sid")).agg(F.min("b").alias("home"), F.min_by(F.col("n_a") - F.col("shared"), "b").alias("gains"), F.first("n_a").alias("n"))
    homes = materialise(homes, "jaccard-homes")

    # Further answers, derived from those of the homes.
    bounds = homes.groupBy(F.col("home").alias("sid")).agg(F.max("gains").alias("most_gained"), F.min("n").alias("least_n"))
    bounds = sets.select("sid", "n").join(bounds, "sid", "left").select(
        F.col("sid").alias("b"), F.coalesce("most_gained", F.lit(0)).alias("most_gained"), F.least("n", "least_n").alias("least_n")
    )
    visits = _visits(index, homes, linked, similarity, count)
    at_most = F.least(F.col("shared") + F.col("most_gained"), F.col("n_a"))
    visits = (
        visits.join(answers.select("a", "b", "shared", "n_a"), ["a", "b"], "left").join(bounds, "b")
        .where(F.col("shared").isNull() | similarity.links(at_most, F.col("n_a"), F.col("least_n")))
        .select("a", "b", "most_gained", "least_n")
    )
    visits = materialise(visits, "jaccard-visits")
    own = homes.select(F.col("sid").alias("a"), F.col("home").alias("b")).join(bounds, "b").select("a", "b", "most_gained", "least_n")
    if not count:
        own = own.join(visits.select("b").distinct(), "b", "left_semi")
    differences = _overlaps(visits.unionByName(own), docs, owners, similarity, differences=True)
    compared = differences.select(F.col("b").alias("home"), F.col("a").alias("sid"), F.col("n_a").alias("n"), "gained", "lost")
    of_sets = sets.select("sid", "copies").join(homes.select("sid", F.col("home").alias("own_home")), "sid", "left")
    compared = compared.join(of_sets, "sid").select("home", "sid", (~F.col("home").eqNullSafe(F.col("own_home"))).alias("visitor"), "n", "copies", "gained", "lost")
    none = F.array().cast("array<long>")
    bases = differences.select(F.col("b").alias("sid")).distinct().join(sets.select("sid", "n", "copies"), "sid").join(homes.select("sid"), "sid", "left_anti")
    bases = bases.select(F.col("sid").alias("home"), "sid", F.lit(False).alias("visitor"), "n", "copies", none.alias("gained"), none.alias("lost"))
    compared = materialise(compared.unionByName(bases), "jaccard-compared")
    derived = materialise(_derived(compared, similarity, count), "jaccard-derived")
    across = derived.where("other is not null").select(F.col("sid").alias("a"), F.col("other").alias("b"))
    if across.limit(1).count():
        linked = connected_components(linked.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(across))
    links = derived.groupBy("sid").agg(F.sum("links").alias("links"))
    out = sets.join(linked.withColumnRenamed("node", "sid"), "sid", "left").join(links, "sid", "left")
    out = materialise(
        out.select("sid", F.coalesce("component", "sid").alias("root"), "copies", "least_id", "first_text", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "jaccard-answered",
    )
    for df in (sets, index, answers, homes, visits, differences, compared, derived):
        drop_written(df)
    return rows, out


def classes(docs: DataFrame, similarity: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, n_shingles, component_id, n_links) for each row of ``docs``.

    A text is lower-cased in A-Z and cut into words at ASCII white space; its
    set holds its distinct shingles, or with fewer words the whole sequence as
    one.  ``component_id`` is the least doc_id reachable by links, itself
    included; ``n_links`` counts the other rows that a row links with, its
    copies included.  Null and empty texts have an empty set and link with
    nothing.  Repeated rows give a row each and link with each other; rows of
    null id take part in links but their id never names a component, and an
    empty-text row of null id has a null one.  Texts of any length are read
    whole.  An empty table gives no rows; other columns are not read.
    """
    rows, sets = _answers(_texts(docs, id_col, text_col), similarity, count=True)
    named = sets.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("in_root"))
    named = materialise(join_counted(sets, named, "root", "in_root", sets.count()).select("sid", "copies", "component_id", "n_links"), "jaccard-classes")
    linked = join_counted(rows.where("sid is not null"), named, "sid", "copies", rows.count())
    empty = rows.where("sid is null").select("*", F.lit(None).cast("long").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(empty).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "n_links")


def keep_one(docs: DataFrame, similarity: Similarity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stand for their class: one row of each.

    It is a row of the class's least id, and one of null id only where no
    member has an id.  Rows are told apart by id and text: texts of one id that
    nothing links stay each.  Empty and null texts link with nothing and stay,
    but rows that repeat an id and an empty text are kept once if the id is not
    null.  Columns of any name may stand beside the two; texts of any length
    are read whole; an empty table stays empty.
    """
    rows, sets = _answers(_texts(docs, id_col, text_col), similarity, count=False)
    by_id = F.coalesce("least_id", F.lit((1 << 63) - 1))
    stands = sets.groupBy("root").agg(F.min_by(F.struct("sid", "least_id", "first_text"), F.struct(by_id, "sid")).alias("of"), F.count("*").alias("in_root"))
    judged = join_counted(sets, stands, "root", "in_root", sets.count()).select("sid", "copies", "of")
    judged = materialise(judged, "jaccard-judged")
    total = rows.count()
    linked = join_counted(rows.where("sid is not null"), judged, "sid", "copies", total)
    first = (F.col("sid") == F.col("of.sid")) & F.col("doc_id").eqNullSafe(F.col("of.least_id")) & (F.col("text_key") == F.col("of.first_text"))
    keys = linked.groupBy("doc_id", "text_key").agg(F.max(first).alias("stands"), F.count("*").alias("n"))
    empty = rows.where("sid is null and doc_id is not null").groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    keys = keys.unionByName(empty.select("doc_id", "text_key", F.lit(True).alias("stands"), "n")).where("not stands or n > 1")
    of_doc, of_text = fresh(docs, "of_doc", "of_text")
    keys = materialise(keys.select(F.col("doc_id").alias(of_doc), F.col("text_key").alias(of_text), "stands", "n"), "jaccard-dropped")

    own = F.col(id_col).cast("long").eqNullSafe(F.col(of_doc)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(of_text))
    hot = F.col("n") > max(HOT_ROWS, total // HOT_KEYS)  # as in join_counted: the rows of such a key are not brought together
    kept, held = docs, keys.where(~hot).select(of_doc, of_text)
    kept = kept.join(F.broadcast(keys.where(hot).select(of_doc, of_text)), own, "left_anti")
    kept = kept.join(hinted(held, held.count() * ID_BYTES), own, "left_anti")
    repeated = keys.where("stands").select(of_doc, of_text)
    n = repeated.count()
    if n:
        kept = kept.unionByName(docs.join(hinted(repeated, n * ID_BYTES), own).dropDuplicates([of_doc, of_text]).select(docs.columns))
    return kept
