"""N-gram Jaccard join: which documents are linked by nearly equal sets of word shingles, by a count-vector R-tree.

A document's set holds its distinct shingles of words, A-Z in lower case; with fewer words than a shingle has, the whole
sequence is the one shingle. Two documents link when 100 * intersection >= percent * union.

1. Equal sets become one, named by the smallest doc_id that has it.
2. Sets are dealt to blocks so that linked sets always share one. All members have a place in one order, rarest first. As
   linked sets share at least percent of each one's members, they share one of the first members of each, so many that
   the rest of it would be too few. Each set emits those members. Among sets with a common one, the bounds of their points in an
   R-tree tell which may be linked, and sets that such possible links connect are one block. Members that many sets have, as
   those of common passages, come last in the order, so that they bring together only sets that have little else. Where more
   than RUN sets have a member, it has to come with a second one: linked sets also share the next of their common members,
   which is among the first of each and one more. Only where more than RUN sets share both are all of them one block.
   How rare a member is, is read off a sketch of fixed size over all documents; any order is right, a good one is fast.
3. In each block, an R-tree over count vectors finds the sets in reach of each set; those are compared in full unless they
   are connected already. Large blocks are dealt to tiles of bounded size, and a few sets of the block go to every tile.
   What isn't connected with the largest group of its block after that is looked up in all tiles of the block.
4. Components of the links found are those of all links.

The shuffle of emitted members holds two numbers a row; points are sent only for sets that share a member, texts only for
sets of a block. A member that a third of all sets has is linked in a stream, without gathering the sets.

Null texts, empty ones and ones without words have an empty set, which is linked with nothing. Very long texts are taken
whole. Rows that repeat a doc_id count as one document where links are concerned. Rows with a null doc_id are returned, and
are linked with rows whose sets are equal to theirs only; their component_id is the smallest doc_id among those and what
those are linked with, or null. Extra columns are carried by representatives(), whatever they are called, and
not read otherwise. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rolemill.llm.common import likely_in, release, stored, text_of
from rolemill.llm.components import components
from rolemill.llm.rtree import fine_groups, point, reachable_links, spanning_links
from rolemill.llm.textarrays import as_bytes, lowered, mixed, windows, word_hashes

#: Members of all sets in a tile, at most, but for a set that is larger by itself.
TILE_MEMBERS = 400_000
#: Sets of a large block that go to each of its tiles.
PIVOTS = 24
#: Buckets in which members are counted, and rows in which the counts meet.
SKETCH, SUMS = 1 << 19, 4
#: Sets with a common member that are held against each other.
RUN = 5000
#: Bytes of the bitmap of members that more sets have, and rows of texts that Python holds at once.
OFTEN, SLICE = 1 << 21, 512


def shingles(data: bytes, width: int) -> np.ndarray:
    """The sorted set of shingle hashes of a whole text."""
    words = word_hashes(lowered(data))
    if not len(words):
        return words
    return np.unique(windows(words, width) if len(words) >= width else windows(words, len(words)))


def digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def needed(members: np.ndarray, percent: int) -> int:
    """Members that a set has in common with any set that is linked with it, at least."""
    return -(-percent * len(members) // 100)


def first_members(members: np.ndarray, percent: int, counts: np.ndarray, more: int = 0) -> np.ndarray:
    """The rarest members of a set, of which any set that is linked with it has one among its own, or with more as many more."""
    order = np.lexsort((members, counts[sketched(members)]))
    return mixed(members[order[: len(members) - needed(members, percent) + 1 + more]])


def paired_members(members: np.ndarray, percent: int, counts: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Keys of pairs: each first member that many sets have with each other one among the first and one more.

    The first two members that linked sets have in common are such a pair in both. Sets that may have but one in common have
    that one as a key by itself.
    """
    first = first_members(members, percent, counts)
    first = first[marked(first, often)]
    if not len(first):
        return first
    second = first_members(members, percent, counts, 1)
    pairs = mixed(first[:, None] * np.uint64(0x9E3779B97F4A7C15) + second[None, :])[first[:, None] != second[None, :]]
    return np.concatenate([pairs, mixed(first + np.uint64(1))]) if needed(members, percent) < 2 else pairs


def marked(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether a bitmap has the bits of keys."""
    at = (keys % np.uint64(8 * len(bits))).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def sketched(members: np.ndarray) -> np.ndarray:
    return (members & np.uint64(SKETCH - 1)).astype(np.int64)


def _sid(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _profile(width: int):
    """A row a document, with its point; and one a task with the number of sets that have members in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "digest", "sid", "point", "sketch"]
        sketch = np.zeros(SKETCH, np.int64)
        for batch in _slices(batches):
            sizes, digests, points = [], [], []
            for t in as_bytes(batch.column("text")):
                s = shingles(t, width)
                points.append(point(s, fine_groups(len(s))).astype(np.uint16).tobytes())
                np.add.at(sketch, sketched(s), 1)
                sizes.append(len(s))
                digests.append(digest(s))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array([_sid(d) for d in digests], pa.int64()), pa.array(points, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(sizes), pa.binary())], names)
        if sketch.any():
            yield _sketch_row(sketch, names)

    return run


def _sketch_row(sketch: np.ndarray, names: list[str]) -> pa.RecordBatch:
    kinds = {"n": pa.int64(), "doc_id": pa.int64(), "sid": pa.int64(), "digest": pa.binary(), "point": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([sketch.tobytes()], pa.binary()) if c == "sketch" else pa.nulls(1, kinds[c]) for c in names], names)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SKETCH, np.int64)
    for batch in batches:
        for x in batch.column("sketch"):
            total += np.frombuffer(x.as_py(), np.int64)
    if total.any():
        yield _sketch_row(total, ["sketch"])


def bucket_counts(profile: DataFrame) -> np.ndarray:
    """How many sets have members in each bucket; sums of fixed size meet in a few rows."""
    sums = profile.where("sketch IS NOT NULL").select("sketch").repartition(SUMS).mapInArrow(_summed, "sketch binary").collect()
    return sum((np.frombuffer(r["sketch"], np.int64) for r in sums), np.zeros(SKETCH, np.int64))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that few texts are Python's at once."""
    for batch in batches:
        for low in range(0, batch.num_rows, SLICE):
            yield batch.slice(low, SLICE)


def _keys(width: int, of):
    """(key, sid) of each set, once for equal sets of a slice; of: the keys of a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            keys, owners, seen = [], [], set()
            for t in as_bytes(batch.column("text")):
                s = shingles(t, width)
                sid = _sid(digest(s))
                if len(s) and sid not in seen:
                    seen.add(sid)
                    keys.append(of(s).view(np.int64))
                    owners.append(np.full(len(keys[-1]), sid, np.int64))
            if sum(map(len, keys)):
                yield _table({"key": np.concatenate(keys), "sid": np.concatenate(owners)})

    return run


def _table(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns.values()], list(columns))


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, bool, np.ndarray]]:
    """Key and sids of each key that several sets have, from rows sorted by key and sid; a long run comes in pieces (key, True, sids)."""
    last, flushed = np.zeros((0, 2), np.int64), False
    for batch in batches:
        rows = np.column_stack([batch.column("key").to_numpy(), batch.column("sid").to_numpy()])
        rows = np.concatenate([last, rows])
        fresh = np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])
        rows = rows[fresh]
        starts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
        ends = np.append(starts[1:], len(rows))
        for a, b in zip(starts[:-1], ends[:-1], strict=True) if len(starts) > 1 else ():
            if b - a > 1:
                yield int(rows[a, 0]), flushed and a == 0, rows[a:b, 1]
        flushed = flushed and len(starts) == 1
        last = rows[starts[-1] :]
        if len(last) > most:
            yield int(last[0, 0]), True, last[:, 1]
            last, flushed = last[[0, -1]], True  # the run goes on from its first sid, however little is left of it
    if len(last) > 1:
        yield int(last[0, 0]), flushed, last[:, 1]


def _shared(most: int, often: bool):
    """(team, sid) of sets that share a member; members that the same sets have make one team.

    Of a run longer than most comes its key as sid, without a team, where often is true; else the links that chain its sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        teams, sids, seen = [], [], set()
        for key, long, found in _runs(batches, most):
            if long or len(found) > most:
                yield _linked(np.array([key]), np.array([key])) if often else _linked(np.full(len(found) - 1, found[0]), found[1:])
                continue
            team = int(mixed(np.array([mixed(found.view(np.uint64)).sum() + np.uint64(len(found))], np.uint64)).view(np.int64)[0])
            if team in seen:
                continue
            if len(seen) > 1_000_000:
                seen.clear()
            seen.add(team)
            teams.append(np.full(len(found), team, np.int64))
            sids.append(found)
            if len(teams) >= 10_000:
                yield _teamed(np.concatenate(teams), np.concatenate(sids))
                teams, sids = [], []
        if teams:
            yield _teamed(np.concatenate(teams), np.concatenate(sids))

    return run


def _teamed(team: np.ndarray, sid: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(team), pa.array(sid), pa.nulls(len(team), pa.int64())], ["team", "sid", "other"])


def _linked(sid: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(len(sid), pa.int64()), pa.array(sid), pa.array(other)], ["team", "sid", "other"])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bitmap of fixed size over the keys of a task."""
    bits = np.zeros(8 * OFTEN, bool)
    for batch in batches:
        bits[(batch.column("sid").to_numpy().view(np.uint64) % np.uint64(8 * OFTEN)).astype(np.int64)] = True
    if bits.any():
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["bits"])


def _within_reach(percent: int):
    """Links between sets of a team that the bounds of their points allow; rows are sorted by team."""

    def links(sids, sizes, points) -> list[tuple[int, int]]:
        grid = [np.frombuffer(x, np.uint16) for x in points]
        return [(sids[i], sids[j]) for i, j in reachable_links(grid, np.array(sizes), percent)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, team, held = [], None, ([], [], [])
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("team", "sid", "n", "point")]
            for now, *row in zip(*columns, strict=True):
                if now != team:
                    if len(held[0]) > 1:
                        found += links(*held)
                    team, held = now, ([], [], [])
                for into, value in zip(held, row, strict=True):
                    into.append(value)
            if found:
                yield _table(dict(zip(("a", "b"), np.unique(np.array(found, np.int64), axis=0).T, strict=True)))
                found = []
        if len(held[0]) > 1:
            found += links(*held)
        if found:
            yield _table(dict(zip(("a", "b"), np.unique(np.array(found, np.int64), axis=0).T, strict=True)))

    return run


def blocks_of(docs: DataFrame, profile: DataFrame, counts: np.ndarray, width: int, percent: int, most: int = RUN) -> DataFrame:
    """node (a sid) and component: sets that may be linked share a component."""
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def met(of, often: bool) -> DataFrame:
        emitted = docs.mapInArrow(_keys(width, of), "key long, sid long").repartition(spread, "key").sortWithinPartitions("key", "sid")
        return stored(emitted.mapInArrow(_shared(most, often), "team long, sid long, other long"), "ngram-shared")

    shared = met(lambda s: first_members(s, percent, counts), True)
    often = shared.where("other IS NOT NULL").select("sid")
    shared = shared.where("team IS NOT NULL")
    if not often.isEmpty():
        maps = often.repartition(SUMS).mapInArrow(_marks, "bits binary").collect()  # of fixed size
        bits = np.bitwise_or.reduce([np.frombuffer(r["bits"], np.uint8) for r in maps])
        release(docs.sparkSession)
        shared = shared.unionByName(met(lambda s: paired_members(s, percent, counts, bits), False))
    points = profile.where("n > 0").groupBy("sid").agg(F.first("n").alias("n"), F.first("point").alias("point"))
    teams = shared.where("team IS NOT NULL").select("team", "sid").distinct().join(points, "sid")
    links = teams.repartition(spread, "team").sortWithinPartitions("team").mapInArrow(_within_reach(percent), "a long, b long")
    return components(links.unionByName(shared.where("other IS NOT NULL").select(F.col("sid").alias("a"), F.col("other").alias("b"))))


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[dict]]:
    """Rows of equal names, which follow one another."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[n] for n in names)
            if key != now and held:
                yield held
                held = []
            now = key
            held.append(row)
    if held:
        yield held


def _links(width: int, percent: int, names: list[str], asked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, names):
            sets, own = [], []
            for row in sorted(rows, key=lambda r: r["rep"]):
                s = shingles((row.pop("text") or "").encode(), width)
                if digest(s) == row["digest"]:  # else another row with this doc_id
                    sets.append(s)
                    own.append(row)
            queries = [i for i, r in enumerate(own) if r["asks"]] if asked else None
            known = np.array([r["component"] for r in own], np.int64) if asked else np.array([r["rep"] for r in own], np.int64)
            found = spanning_links(sets, percent, queries, known)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([own[i]["rep"] for i, _ in found], pa.int64()), pa.array([own[j]["rep"] for _, j in found], pa.int64())], ["a", "b"])

    return run


def _in_groups(rows: DataFrame, names: list[str], run) -> DataFrame:
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(spread, *names).sortWithinPartitions(*names).mapInArrow(run, "a long, b long")


def joined(docs: DataFrame, width: int = 4, percent: int = 85, tile_members: int = TILE_MEMBERS, most: int = RUN) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of docs."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    profile = stored(docs.mapInArrow(_profile(width), "doc_id long, n long, digest binary, sid long, point binary, sketch binary"), "ngram-profile")
    counts = bucket_counts(profile)
    release(spark)
    profile = profile.where("sketch IS NULL").drop("sketch")
    sets = stored(profile.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sid").alias("sid")), "ngram-sets")
    blocks = blocks_of(docs, profile, counts, width, percent, most)
    members = sets.where(F.col("rep").isNotNull()).join(blocks, F.col("sid") == F.col("node")).select("rep", "digest", "n", F.col("component").alias("block"))
    sizes = members.groupBy("block").agg(F.sum("n").alias("total"), F.count("*").alias("sets"))
    sizes = sizes.where("sets > 1").withColumn("tiles", F.ceil(F.col("total") / tile_members).cast("int")).select("block", "tiles")
    members = stored(members.join(sizes, "block"), "ngram-members")
    release(spark)
    tiled = _tiled(members)
    texts = likely_in(docs.select(F.col("doc_id").alias("rep"), "text"), "rep", members.select("rep"))
    links = stored(_in_groups(tiled.join(texts, "rep"), ["block", "tile"], _links(width, percent, ["block", "tile"], False)), "ngram-links")
    release(spark)
    rest = _unsettled(members, links)
    if rest is not None:
        more = _in_groups(rest.join(texts, "rep"), ["block", "tile", "chunk"], _links(width, percent, ["block", "tile", "chunk"], True))
        links = stored(links.unionByName(more), "ngram-links")
    labels = components(links)
    named = sets.join(labels, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    out = profile.where("n > 0").join(named, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(profile.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _tile_of(column: str = "rep"):
    return F.pmod(F.xxhash64(column), F.col("tiles")).cast("int")


def _tiled(members: DataFrame) -> DataFrame:
    """Each member with its tile; the first few members of a block with several tiles go to all of them."""
    own = members.withColumn("tile", _tile_of())
    large = members.where("tiles > 1")
    pivots = _first(large)
    copies = pivots.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")).where(F.col("tile") != _tile_of())
    return own.unionByName(copies.select(*own.columns))


def _first(large: DataFrame) -> DataFrame:
    """The PIVOTS members of each block with the smallest doc_ids: first of each of some slices, then of the block."""
    for part in (["block", F.pmod(F.xxhash64("rep"), F.lit(64))], ["block"]):
        large = large.withColumn("place", F.row_number().over(Window.partitionBy(*part).orderBy("rep", "digest"))).where(F.col("place") <= PIVOTS).drop("place")
    return large


def _unsettled(members: DataFrame, links: DataFrame) -> DataFrame | None:
    """For blocks of several tiles that aren't one component yet: what isn't in the largest one, to be looked up in all tiles."""
    large = members.where("tiles > 1")
    if large.isEmpty():
        return None
    labels = components(links)
    held = stored(large.join(labels, F.col("rep") == F.col("node"), "left").select(*large.columns, F.coalesce("component", "rep").alias("component")), "ngram-held")
    counted = held.groupBy("block", "component").agg(F.count("*").alias("c"))
    largest = counted.groupBy("block").agg(F.max_by("component", F.struct("c", "component")).alias("largest"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    asks = held.join(largest, "block").where(F.col("component") != F.col("largest")).drop("largest")
    weight = asks.groupBy("block").agg(F.sum("n").alias("total"))
    chunks = weight.select("block", F.ceil(F.col("total") / TILE_MEMBERS).cast("int").alias("chunks"))
    asks = asks.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("chunks")).cast("int"))
    everywhere = asks.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.lit(True).alias("asks"))
    there = held.join(chunks, "block").withColumn("tile", _tile_of()).select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(False).alias("asks"))
    both = everywhere.unionByName(there.select(*everywhere.columns))
    return both.groupBy("block", "tile", "chunk", "rep", "digest", "component").agg(F.max("asks").alias("asks"))


def representatives(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all its columns; documents without words stay.

    Of rows that agree in doc_id and text one stays, that whose columns have the smallest digest; rows with one doc_id and
    different texts count as one document, and all stay or go.
    """
    every = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    own = docs.select("doc_id", F.sha2(text_of(), 256).alias("digest"), every.alias("every"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"))
    gone = joined(docs, width, percent).where("doc_id <> component_id").select("doc_id").distinct()
    left = own.join(gone, "doc_id", "left_anti")
    again = stored(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id"), "ngram-again")
    if again.isEmpty():
        return left.select("own.*")
    first = left.join(again, "doc_id", "left_semi").groupBy("doc_id", "digest").agg(F.min_by("own", "every").alias("own"))
    return left.join(again, "doc_id", "left_anti").select("own.*").unionByName(first.select("own.*"))
