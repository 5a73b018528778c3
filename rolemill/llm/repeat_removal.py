"""Removal of long repeats: every byte covered by a string of a given length that starts anywhere else too.

Shorter passages that repeat are counted beside that, not removed: strings of PASSAGE bytes that start elsewhere too cover
them, and those of PASSAGE_WORDS words or more count. Both lengths go through the same steps.

1. A rolling hash marks anchors: of the hashed pieces inside each string of PASSAGE bytes, the least one. Equal strings
   have equal anchors, so that each start has one anchor, and starts of equal strings have anchors with equal keys. The starts
   of an anchor are neighbours; with the bytes that their longer strings cover they make a window.
2. Keys that occur once, which most do, are done with. A window that occurs twice, in any documents, settles all its starts
   without another look at the text. Windows whose key has but that window have no other match.
3. Keys with several different windows are settled by prefix-free parsing: one copy of each window is gathered by key, the
   windows of some keys at a time are put into corpus order, and neighbours there are compared.
   Where a key has more windows than a task should hold, as when a third of all documents quote a passage, its strings are
   counted by digest with partial sums instead. Runs of starts that may have been counted twice then go on as one row a run:
   runs that occur twice are settled, and only what is left of the others is looked up start by start.
4. Starts found are gathered by text, and the bytes they cover are cut out.

Keys and windows compare by digests of 64 bits each, which count only together; texts and single strings by 128 bits.
Equal texts are one text for all of this; if it is long enough, all of it goes. Strings never cross documents, they are
judged on the input, and texts are bytes of UTF-8. Null texts count as empty. Repeated rows are documents of their own, so
their texts are equal texts. Very long texts are taken whole, their anchors some megabytes at a time. Extra columns are not
read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.llm.common import stored, text_of
from rolemill.llm.prefix_free import repeated, rolling, spread
from rolemill.llm.textarrays import as_bytes, word_bounds

LENGTH = 400
#: Bytes of the strings that anchors are chosen for, and words of a passage that counts.
PASSAGE, PASSAGE_WORDS = 300, 50
#: Bytes of the pieces that anchors are chosen by.
PIECE = 48
#: Windows of a key that are put in order together, at most; and bytes of windows of a block of keys.
HOT_WINDOWS = 1000
BLOCK = 1 << 18
#: Starts of a text whose anchors are found at a time; places among them take the lowest bits of a code.
SLICE = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
#: Bits of the bitmap of strings of hot keys that occur twice, whatever their number, and rows in which its parts meet.
MARK_BITS, MARK_ROWS = 1 << 24, 4


def anchors(data: bytes, length: int = PASSAGE, piece: int = PIECE) -> tuple[np.ndarray, ...]:
    """For each anchor of a text: its key, its place, and the first and last start that have it."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4
    starts = len(data) - length + 1
    parts = [_sliced(data, low, min(SLICE, starts - low), length, piece) for low in range(0, starts, SLICE)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _sliced(data: bytes, low: int, starts: int, length: int, piece: int) -> tuple[np.ndarray, ...]:
    """The anchors of some starts from low on; one that goes on beyond them comes in two rows."""
    hashes = spread(rolling(np.frombuffer(data, np.uint8)[low : low + starts + length - 1], piece))
    code = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width, have = length - piece + 1, 1
    while 2 * have <= width:
        code = np.minimum(code[:-have], code[have:])
        have *= 2
    if have < width:
        code = np.minimum(code[: len(code) - (width - have)], code[width - have :])
    at = (code & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return hashes[at[first]].view(np.int64), at[first] + low, first + low, last + low


def _windows(length: int, passage: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dids = batch.column("did").to_pylist()
            for low in range(0, batch.num_rows, 256):
                rows: list[list] = [[], [], [], [], []]
                for did, data in zip(dids[low : low + 256], as_bytes(batch.column("text").slice(low, 256)), strict=True):
                    for key, at, first, last in zip(*(x.tolist() for x in anchors(data, passage, piece)), strict=True):
                        whole = hashlib.blake2b(data[first : last + length], digest_size=8, salt=(at - first).to_bytes(8, "little")).digest()
                        for column, value in zip(rows, (did, key, int.from_bytes(whole, "little", signed=True), first, last), strict=True):
                            column.append(value)
                if rows[0]:
                    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], ["did", "key", "content", "first", "last"])

    return run


def _cut(length: int):
    """The bytes of open windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = (row["text"] or "").encode()
                rows = [(w["hot"], w["key"], row["did"], w["first"], w["last"] - w["first"] + 1, data[w["first"] : w["last"] + length]) for w in row["open"]]
                kinds = [pa.bool_(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
                for low in range(0, len(rows), 4096):
                    columns = zip(*rows[low : low + 4096], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["hot", "key", "did", "first", "live", "bytes"])

    return run


def _digests(row: dict, length: int) -> list[bytes]:
    """Of the string of each live start of a window that is long enough; strings of different lengths have different ones."""
    data, salt = row["bytes"], length.to_bytes(8, "little")
    return [hashlib.blake2b(data[i : i + length], digest_size=16, salt=salt).digest() for i in range(min(row["live"], len(data) - length + 1))]


def _place(did: bytes, first: int) -> int:
    return int.from_bytes(hashlib.blake2b(did + first.to_bytes(8, "little"), digest_size=8).digest(), "little", signed=True)


#: A string in a block: its digest, and the least and greatest code of its places.
_STRING = np.dtype([("a", "<u8"), ("b", "<u8"), ("low", "<i8"), ("high", "<i8")])


def _merged(block: np.ndarray) -> np.ndarray:
    """Each digest of a block once."""
    if not len(block):
        return block
    block = block[np.lexsort((block["b"], block["a"]))]
    at = np.flatnonzero(np.concatenate([[True], (block["a"][1:] != block["a"][:-1]) | (block["b"][1:] != block["b"][:-1])]))
    out = block[at].copy()
    out["low"], out["high"] = np.minimum.reduceat(block["low"], at), np.maximum.reduceat(block["high"], at)
    return out


def _blocked(block: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row for each part of the digests, with the strings that fall there."""
    part = (block["a"] % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    names, at = np.unique(part[order], return_index=True)
    pieces = [x.tobytes() for x in np.split(block[order], at[1:])]
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(pieces, pa.binary())], ["part", "block"])


def _strings(lengths: tuple[int, ...], parts: int):
    """The strings of all live starts of a task's windows, in blocks by digest; equal ones of a task are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                places = np.array([_place(row["did"], row["first"] + k) for k in range(row["live"])], np.int64)
                for n in lengths:
                    digests = _digests(row, n)
                    if digests:
                        block = np.empty(len(digests), _STRING)
                        pair = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
                        block["a"], block["b"], block["low"], block["high"] = pair[:, 0], pair[:, 1], places[: len(digests)], places[: len(digests)]
                        held.append(block)
                        size += len(block)
            if size >= BLOCK:
                held = [_merged(np.concatenate(held))]
                size = len(held[0])
                if size >= BLOCK:
                    yield _blocked(held[0], parts)
                    held, size = [], 0
        if size:
            yield _blocked(_merged(np.concatenate(held)), parts)

    return run


def _twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digests of strings that have several places; rows come sorted by part."""
    held, now = [], None

    def found() -> Iterator[pa.RecordBatch]:
        block = _merged(np.concatenate(held))
        block = block[block["low"] < block["high"]]
        if len(block):
            yield pa.RecordBatch.from_arrays([pa.array([np.stack([block["a"], block["b"]], 1).tobytes()], pa.binary())], ["digests"])

    for batch in batches:
        for row in batch.to_pylist():
            if held and row["part"] != now:
                yield from found()
                held = []
            now = row["part"]
            held.append(np.frombuffer(row["block"], _STRING))
    if held:
        yield from found()


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for digests in batch.column("digests").to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array([digests[k : k + 16] for k in range(0, len(digests), 16)], pa.binary())], ["digest"])


def _bit(digests: bytes) -> np.ndarray:
    """A bit of the bitmap for each digest of 16 bytes."""
    return (np.frombuffer(digests, "<u8").reshape(-1, 2)[:, 1] % np.uint64(MARK_BITS)).astype(np.int64)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bitmap of fixed size over the digests of a task."""
    bits = np.zeros(MARK_BITS, bool)
    for batch in batches:
        for digests in batch.column("digests").to_pylist():
            bits[_bit(digests)] = True
    if bits.any():
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])


def _runs(lengths: tuple[int, ...], bits: bytes):
    """long, did, first, last, run and digests: runs of starts whose strings the bitmap has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(bits, np.uint8)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                for n in lengths:
                    digests = b"".join(_digests(row, n))
                    at = _bit(digests) if digests else np.zeros(0, np.int64)
                    hit = (marked[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                    for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
                        whole = hashlib.blake2b(row["bytes"][a : b - 1 + n], digest_size=16).digest()
                        rows.append((n == lengths[-1], row["did"], row["first"] + a, row["first"] + b - 1, _place(row["did"], row["first"] + a), whole, digests[16 * a : 16 * b]))
            if rows:
                kinds = [pa.bool_(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["long", "did", "first", "last", "code", "run", "digests"])

    return run


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            n = row["last"] - row["first"] + 1
            digests = [row["digests"][16 * k : 16 * k + 16] for k in range(n)]
            columns = [pa.array([row["long"]] * n), pa.array([row["did"]] * n, pa.binary()), pa.array(range(row["first"], row["last"] + 1), pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["long", "did", "first", "digest"])


def _counted(hot: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """did, first, last, long: runs of starts in the windows of hot keys whose strings occur twice."""
    parts = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strings = hot.mapInArrow(_strings(lengths, parts), "part long, block binary").repartition(parts, "part").sortWithinPartitions("part")
    twice = stored(strings.mapInArrow(_twice, "digests binary"), "repeat-strings")
    maps = twice.repartition(MARK_ROWS).mapInArrow(_marks, "bits binary").collect()  # of fixed size
    bits = np.bitwise_or.reduce([np.frombuffer(r["bits"], np.uint8) for r in maps]) if maps else np.zeros(MARK_BITS // 8, np.uint8)
    runs = stored(hot.mapInArrow(_runs(lengths, bits.tobytes()), "long boolean, did binary, first int, last int, code long, run binary, digests binary"), "repeat-runs")
    whole = stored(runs.groupBy("long", "run").agg((F.min("code") < F.max("code")).alias("twice")).where("twice").select("long", "run"), "repeat-whole")
    settled = runs.select("long", "run", "did", "first", "last").join(whole, ["long", "run"], "left_semi").select("did", "first", "last", "long")
    rest = runs.join(whole, ["long", "run"], "left_anti").mapInArrow(_one_by_one, "long boolean, did binary, first int, digest binary")
    single = rest.join(twice.mapInArrow(_listed, "digest binary"), "digest", "left_semi").select("did", "first", F.col("first").alias("last"), "long")
    return settled.unionByName(single)


def _ordered(length: int, passage: int):
    def settle(block: list[tuple[bytes, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        found = repeated([x[3] for x in block], [x[2] for x in block], (passage, length))
        rows = []
        for (did, first, _, _), by_length in zip(block, found, strict=True):
            for long, marks in zip((False, True), by_length, strict=True):
                turns = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
                rows += [(did, first + a, first + b - 1, long) for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)]
        if rows:
            kinds = [pa.binary(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["did", "first", "last", "long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, key = [], 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["key"] != key:
                    key = row["key"]
                    if held > BLOCK:
                        yield from settle(block)
                        block, held = [], 0
                block.append((row["did"], row["first"], row["live"], row["bytes"]))
                held += len(row["bytes"])
        if block:
            yield from settle(block)

    return run


def covered(size: int, ranges: list[tuple[int, int]], length: int) -> np.ndarray:
    """Which of size bytes the strings of this length cover that start in the ranges, as far as they end inside."""
    turns = np.zeros(size + 1, np.int32)
    for first, last in ranges:
        if first + length <= size:
            turns[first] += 1
            turns[min(last, size - length) + length] -= 1
    return np.cumsum(turns[:-1]) > 0


def passage_words(data: bytes, inside: np.ndarray) -> int:
    """Words in stretches of covered bytes that hold PASSAGE_WORDS whole words or more."""
    begin, end = word_bounds(data)
    outside = np.concatenate([[0], np.cumsum(~inside)])
    whole = outside[begin] == outside[end]
    count = np.unique(outside[begin[whole]], return_counts=True)[1]
    return int(count[count >= PASSAGE_WORDS].sum())


def _kept(length: int, passage: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                data = (row["text"] or "").encode()
                ranges = [(0, len(data), True)] if row["copied"] else [(r["first"], r["last"], r["long"]) for r in row["ranges"] or ()]
                gone = covered(len(data), [(first, last) for first, last, long in ranges if long], length)
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
                words = passage_words(data, covered(len(data), [(first, last) for first, last, _ in ranges], passage)) if ranges else 0
                out.append((row["doc_id"], len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), words))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words"])

    return run


def _of_keys(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """rows whose key is among keys, which come out of an aggregation by key.

    The keys are turned over so that both sides are dealt anew for the join: only then can Spark split a key of many rows.
    """
    turned = keys.select(F.bitwise_not("key").alias("__key"), *[c for c in keys.columns if c != "key"])
    return rows.join(turned, F.bitwise_not(rows["key"]) == F.col("__key"), how).drop("__key")


def repeats(texts: DataFrame, length: int = LENGTH, passage: int = PASSAGE, piece: int = PIECE, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """texts: did (a digest of the text) and text. did, first, last, long: runs of starts whose strings start elsewhere too.

    Their strings of passage bytes do; where long is true, those of length bytes as well, as far as the text reaches.
    """
    spark = texts.sparkSession
    windows = stored(texts.mapInArrow(_windows(length, passage, piece), "did binary, key long, content long, first int, last int"), "repeat-windows")
    code = F.xxhash64("content", "did", "first")
    busy = windows.groupBy("key").agg((F.min(code) < F.max(code)).alias("busy")).where("busy")  # the others occur once
    windows = stored(_of_keys(windows, busy.select("key"), "left_semi"), "repeat-busy")
    here = F.struct("did", "first", "last")
    kinds = stored(windows.groupBy("key", "content").agg(F.min(here).alias("here"), (F.min(here) < F.max(here)).alias("twice")), "repeat-kinds")
    twice = kinds.where("twice").select("key", "content")
    settled = windows.join(twice, ["key", "content"], "left_semi").select("did", "first", "last", F.lit(True).alias("long")).distinct()
    several = kinds.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    window = F.struct("key", "here.first", "here.last", (F.col("k") > hot_windows).alias("hot"))
    opened = _of_keys(kinds, several, "inner").groupBy(F.col("here.did").alias("did")).agg(F.collect_list(window).alias("open"))
    once = texts.groupBy("did").agg(F.first("text").alias("text"))
    cut = stored(once.join(opened, "did").mapInArrow(_cut(length), "hot boolean, key long, did binary, first int, live int, bytes binary"), "repeat-open")
    spread_over = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = cut.where("NOT hot").repartition(spread_over, "key").sortWithinPartitions("key")
    ordered = grouped.mapInArrow(_ordered(length, passage), "did binary, first int, last int, long boolean")
    hot = cut.where("hot")
    return settled.unionByName(ordered) if hot.isEmpty() else settled.unionByName(ordered).unionByName(_counted(hot, (passage, length)))


def without_repeats(docs: DataFrame, length: int = LENGTH, passage: int = PASSAGE, piece: int = PIECE, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and n_passage_words of each row of docs; passage is not above length."""
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("did", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))
    found = repeats(rows.select("did", "text"), length, passage, piece, hot_windows)
    ranges = found.groupBy("did").agg(F.collect_list(F.struct("first", "last", "long")).alias("ranges"))
    copied = rows.groupBy("did").agg((F.count("*") > 1).alias("copied"))
    marks = stored(copied.join(ranges, "did", "left"), "repeat-marks")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_words long"
    return rows.join(marks, "did").select("doc_id", "text", "copied", "ranges").mapInArrow(_kept(length, passage), schema)
