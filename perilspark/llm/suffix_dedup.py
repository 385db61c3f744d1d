"""Suffix-array dedup: remove every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere.

Equal strings must meet, so strings are dealt to shards by content. Of the hashed ``GRAM``-byte grams inside a string the least one
is its anchor; equal strings have equal anchors, and neighbouring starts with one anchor form a run (about 90 starts).
Runs are compared by anchor and digest first: an anchor seen once has no repeats (unless its one run holds it twice), equal runs collapse to one with a count. What is left,
anchors with unlike runs, is the text of the shards. Each shard sorts its suffixes by induced sorting (types, leftmost-smaller
positions, the order of leftmost-smaller substrings by an induction, their names' order by doubling ranks to the depth that
counts, one more induction for all suffixes), whole buckets at a time in numpy, and finds common prefixes in text order from
each suffix's neighbour. So that no shard holds an unbounded group, the unlike runs of an anchor that are over ``CROWD_BYTES`` together are
cut into pieces of ``PIECE`` starts at fixed distances from the anchor: the bytes that all strings of such a piece share are its core,
equal strings have equal cores, and pieces go through the same steps by core. Only the pieces of a core that are over
``CROWD_BYTES`` again go to a join of their strings' 128-bit hashes. Marked starts go back to their documents as intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilspark.llm.common import as_bytes, byte_batches, mix, split_mix, starts_of
from perilspark.llm.simhash_dedup import CLEANUP
from perilspark.llm.words import clear_worker
from perilspark.session import materialise

LENGTH, GRAM = 200, 24
#: Starts of a run at most, starts of a piece at most, bytes of a shard, and bytes of one anchor's or core's unlike texts in a shard at most.
RUN_STARTS, PIECE, SHARD_BYTES = 1024, 16, 1 << 20
CROWD_BYTES = SHARD_BYTES // 2
_FACTORS = split_mix(64, 11) | np.uint64(1)


def words_at(buffer: bytes) -> np.ndarray:
    """The 8-byte words that start at each byte of a buffer, but for its last 7."""
    return np.ndarray((max(len(buffer) - 7, 0),), "<u8", buffer, 0, (1,))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours."""
    n = len(x)
    full = -(-n // width) * width
    wide = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    wide[:n] = x
    blocks = wide.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def gram_hashes(body: bytes) -> np.ndarray:
    """Hash of the gram at each byte of a text."""
    word = words_at(body + bytes(GRAM))
    grams = len(body) - GRAM + 1
    return mix(word[:grams] * _FACTORS[0] + word[8 : grams + 8] * _FACTORS[1] + word[16 : grams + 16] * _FACTORS[2])


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first start, number of starts, anchor, whether the anchor is in it more than once) of all runs of the texts."""
    sizes = np.array([len(x) for x in texts], np.int64)
    begin = starts_of(sizes)
    body = b"".join(texts)
    if len(body) < LENGTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, bool))
    gram = gram_hashes(body)
    least = sliding_min(gram, LENGTH - GRAM + 1)
    text = np.repeat(np.arange(len(texts)), np.maximum(sizes - LENGTH + 1, 0))
    starts = np.arange(len(text)) - starts_of(np.maximum(sizes - LENGTH + 1, 0))[text] + begin[text]
    anchor = least[starts]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(text)))
    # Long runs (repeated phrases) are cut at fixed distances from their first start.
    pieces = -(-count // RUN_STARTS)
    at = np.repeat(first, pieces) + (np.arange(pieces.sum()) - np.repeat(starts_of(pieces)[:-1], pieces)) * RUN_STARTS
    count = np.diff(np.append(at, len(text)))
    if not len(at):
        return at, at, count, anchor[at], np.zeros(0, bool)
    # Only a run that holds its anchor twice can hold a string twice.
    width = count + LENGTH - GRAM
    edge = starts_of(width)[:-1]
    held = gram[np.repeat(starts[at] - edge, width) + np.arange(width.sum())] == np.repeat(anchor[at], width)
    return text[at], starts[at] - begin[text[at]], count, anchor[at], np.add.reduceat(held, edge, dtype=np.int64) > 1


def pieces_of(run: bytes, anchor: int) -> list[tuple[int, int, bytes]]:
    """(core's hash, first start, text) of the pieces of a run.

    A string's anchor is the first one at or after its start, so equal strings are equally far from theirs.
    """
    places = np.flatnonzero(gram_hashes(run) == np.uint64(anchor & (1 << 64) - 1))
    starts = np.arange(len(run) - LENGTH + 1)
    place = places[np.searchsorted(places, starts)]
    block = (place - starts) // PIECE
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (block[1:] != block[:-1])]))
    core = place[first] - block[first] * PIECE
    out = []
    for a, b, c, seed in zip(first.tolist(), [*first[1:].tolist(), len(starts)], core.tolist(), block[first].tolist()):
        out.append((xxhash.xxh3_64_intdigest(run[c : c + LENGTH - PIECE + 1], seed), a, run[a : b + LENGTH - 1]))
    return out


def _split(positions: np.ndarray, chars: np.ndarray, lists: list[list[np.ndarray]]) -> None:
    """Append positions to the list of their character, in order."""
    order = np.argsort(chars, kind="stable")
    positions, chars = positions[order], chars[order]
    cut = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    for part, c in zip(np.split(positions, cut), chars[np.concatenate([[0], cut])].tolist()):
        lists[c].append(part)


def induce(text: np.ndarray, larger: np.ndarray, seeds: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix order from the order of the leftmost-smaller ones: larger types forwards, then smaller types backwards.

    A bucket (suffixes of one first character) is taken as a whole: what its members put into itself is the next round.
    """
    none = np.zeros(0, np.int32)
    big: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    small: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    seeded: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    if len(seeds):
        _split(seeds, text[seeds], seeded)

    def pass_on(now: np.ndarray, own: int, wanted: bool, lists: list[list[np.ndarray]]) -> np.ndarray:
        """Predecessors of the wanted type go to their buckets; returns those of the bucket itself."""
        before = now[now > 0] - 1
        before = before[larger[before] == wanted]
        if not len(before):
            return none
        chars = text[before]
        same = chars == own
        if not same.all():
            _split(before[~same], chars[~same], lists)
        return before[same]

    end = np.array([len(text) - 1], np.int32)
    for c in range(sigma):
        if c == text[-1]:
            big[c].insert(0, end)  # the last suffix is smaller than all others of its bucket
        now = np.concatenate(big[c]) if big[c] else none
        whole = [now]
        while len(now):
            now = pass_on(now, c, True, big)
            whole.append(now)
        big[c] = [np.concatenate(whole)]
        if seeded[c]:
            pass_on(np.concatenate(seeded[c]), c, True, big)
    for c in range(sigma - 1, -1, -1):
        now = np.concatenate(small[c]) if small[c] else none
        whole = [now]
        while len(now):
            now = pass_on(now, c, False, small)
            whole.append(now)
        small[c] = [np.concatenate(whole)]
        pass_on(big[c][0][::-1], c, False, small)
    return np.concatenate([part for c in range(sigma) for part in (big[c][0], small[c][0][::-1])])


def suffix_array(text: np.ndarray, sigma: int, depth: int | None = None) -> np.ndarray:
    """Suffixes in order, at least by their first ``depth`` characters (all if None)."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    # Larger type: the suffix is larger than the next one. A run of equal characters has the type of its end.
    differs = np.flatnonzero(text[1:] != text[:-1])
    ends = np.append(differs, n - 1)
    kind = np.append(text[differs] > text[differs + 1], True)
    larger = np.repeat(kind, np.diff(np.concatenate([[-1], ends])))
    leftmost = (np.flatnonzero(~larger[1:] & larger[:-1]) + 1).astype(np.int32)
    if not len(leftmost):
        return induce(text, larger, leftmost, sigma)
    order = induce(text, larger, leftmost, sigma)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    order = order[is_leftmost[order]]
    # Names of leftmost-smaller substrings (to the next such position) by length and hash.
    power = np.cumprod(np.full(n, _FACTORS[5]))
    inverse = np.cumprod(np.full(n, np.uint64(pow(int(_FACTORS[5]), -1, 1 << 64))))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(text.astype(np.uint64) + np.uint64(1)) * power)])
    stop = np.append(leftmost[1:] + 1, n)
    place = np.full(n, -1, np.int64)
    place[leftmost] = np.arange(len(leftmost))
    length, hashed = stop - leftmost, (sums[stop] - sums[leftmost]) * inverse[leftmost]
    ranked = place[order]
    new = np.ones(len(ranked), bool)
    new[1:] = (length[ranked[1:]] != length[ranked[:-1]]) | (hashed[ranked[1:]] != hashed[ranked[:-1]])
    new[ranked == len(leftmost) - 1] = True  # the last one runs to the end of the text
    name = np.empty(len(ranked), np.int64)
    name[ranked] = np.cumsum(new)
    # The names' suffixes: double the ranked length until all differ or the depth is reached (a substring has 2 characters at least).
    span, reach = 1, 2
    while name.max() < len(name) and (depth is None or reach < 2 * depth):
        after = np.zeros(len(name), np.int64)
        after[:-span] = name[span:]
        key = name * (len(name) + 1) + after
        ranked = np.argsort(key, kind="stable")
        new = np.ones(len(ranked), bool)
        new[1:] = key[ranked[1:]] != key[ranked[:-1]]
        name = np.empty(len(ranked), np.int64)
        name[ranked] = np.cumsum(new)
        span, reach = span * 2, reach * 2
        if span >= len(name):
            break
    return induce(text, larger, leftmost[np.argsort(name, kind="stable")], sigma)


def common_prefixes(body: bytes, order: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """In text order, whether each suffix shares ``limit`` bytes (a multiple of 8) with the one before it in suffix order, and which that is."""
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    word = words_at(body + bytes(limit + 8))
    left = np.flatnonzero((before >= 0) & (np.arange(n) + limit <= n) & (before + limit <= n))
    for k in range(0, limit, 8):
        left = left[word[left + k] == word[before[left] + k]]
    out = np.zeros(n, bool)
    out[left] = True
    return out, before


def repeated_starts(runs: list[bytes]) -> list[np.ndarray]:
    """For each run's text, which of its starts begin a string of LENGTH bytes that the shard holds twice."""
    sizes = np.array([len(x) for x in runs], np.int64)
    begin = starts_of(sizes + 1)
    body = b"\0".join(runs) + b"\0"
    text = np.frombuffer(body, np.uint8).astype(np.int16) + 1
    text[begin[1:] - 1] = 0  # separators, smaller than every byte
    shared, before = common_prefixes(body, suffix_array(text, 257, LENGTH), LENGTH)
    # A string that spans a separator is no start's; its neighbour may not be taken for one.
    inside = np.zeros(len(body), bool)
    for b, s in zip(begin.tolist(), sizes.tolist()):
        inside[b : b + s - LENGTH + 1] = True
    hit = np.flatnonzero(shared & inside)
    hit = hit[inside[before[hit]]]
    marked = np.zeros(len(body), bool)
    marked[hit] = True
    marked[before[hit]] = True
    return [marked[b : b + s - LENGTH + 1] for b, s in zip(begin.tolist(), sizes.tolist())]


def string_hashes(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the string at each start of a run's text."""
    word = words_at(run)
    n = len(run) - LENGTH + 1
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for k in range(LENGTH // 8):
        w = mix(word[8 * k : 8 * k + n])
        one += w * _FACTORS[k]
        two += w * _FACTORS[63 - k]
    return mix(one).view(np.int64), mix(two).view(np.int64)


def spans(marked: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    return edge[::2].tolist(), edge[1::2].tolist()


_RUN = "anchor long, d1 long, d2 long"
_MARKS = _RUN + ", low array<int>, high array<int>"
#: A piece takes the names of a run; the run it is of has its own.
_PIECE = _RUN + ", n long, of long, of1 long, of2 long, at int, run binary"


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``row`` and ``spans``, the (low, high) byte intervals to remove, for rows (``row``, ``body``) that have any."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker()
        for batch in batches:
            ids = batch.column("row").to_numpy()
            for first, texts in byte_batches(batch, "body"):
                text, start, count, anchor, multi = runs_of(texts)
                if not len(text):
                    continue
                digest = b"".join([xxhash.xxh3_128_digest(memoryview(texts[t])[s : s + c + LENGTH - 1]) for t, s, c in zip(text.tolist(), start.tolist(), count.tolist())])
                halves = np.frombuffer(digest, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(ids[first + text]), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(multi)],
                    ["anchor", "d1", "d2", "row", "start", "starts", "multi"],
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts of the runs that are wanted of each document."""
        for batch in batches:
            for body, wanted in zip(batch.column("body"), batch.column("wanted")):
                text, out = memoryview(body.as_py()), wanted.as_py()
                if out:
                    columns = [[x[c] for x in out] for c in ("anchor", "d1", "d2", "n", "weight")]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(c, pa.int64()) for c in columns), pa.array([bytes(text[x["start"] : x["start"] + x["starts"] + LENGTH - 1]) for x in out], pa.binary())],
                        ["anchor", "d1", "d2", "n", "weight", "run"],
                    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of runs, with equal pieces of a run or of several as rows of their own."""
        for batch in batches:
            ids = [batch.column(c).to_pylist() for c in ("anchor", "d1", "d2", "n")]
            for first, texts in byte_batches(batch, "run"):
                found = [(i, *x) for i, run in enumerate(texts, first) for x in pieces_of(run, ids[0][i])]
                of = [x[0] for x in found]
                key = np.array([x[1] for x in found], np.uint64).view(np.int64)
                halves = np.frombuffer(b"".join([xxhash.xxh3_128_digest(x[3]) for x in found]), "<i8").reshape(-1, 2)
                own, one, two, times = [pa.array([c[i] for i in of], pa.int64()) for c in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), times, own, one, two, pa.array([x[2] for x in found], pa.int32()), pa.array([x[3] for x in found], pa.binary())],
                    ["anchor", "d1", "d2", "n", "of", "of1", "of2", "at", "run"],
                )

    def shard(key: tuple, table: pa.Table) -> pa.Table:
        clear_worker()
        marked = repeated_starts(table.column("run").to_pylist())
        again = table.column("n").to_numpy() > 1
        found = [spans(m | True) if twice else spans(m) for m, twice in zip(marked, again)]
        out = table.select(["anchor", "d1", "d2"])
        out = out.append_column("low", pa.array([x[0] for x in found], pa.list_(pa.int32()))).append_column("high", pa.array([x[1] for x in found], pa.list_(pa.int32())))
        return out.filter(pa.array([bool(x[0]) for x in found], pa.bool_()))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, two = string_hashes(batch.column("run")[i].as_py())
                same = [pa.array(np.full(len(one), batch.column(c)[i].as_py(), np.int64)) for c in ("anchor", "d1", "d2", "n")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(np.arange(len(one), dtype=np.int32)), pa.array(one), pa.array(two)], ["anchor", "d1", "d2", "n", "at", "s1", "s2"])

    def in_shards(texts: DataFrame) -> DataFrame:
        """Marks of texts whose equal strings have equal anchors."""
        total = texts.agg(F.coalesce(F.sum(F.octet_length("run")), F.lit(0))).first()[0]
        number = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-total // SHARD_BYTES))))
        return texts.withColumn("shard", number).groupBy("shard").applyInArrow(shard, _MARKS)

    def in_pieces(texts: DataFrame) -> DataFrame:
        """Marks of the runs of crowded anchors."""
        cuts = materialise(texts.mapInArrow(pieces, _PIECE), "pieces")
        alike = materialise(cuts.groupBy("anchor", "d1", "d2").agg(F.sum("n").alias("n"), F.min("run").alias("run")), "distinct-pieces")
        cores = alike.groupBy("anchor").agg(F.count("*").alias("crowd"), F.sum("n").alias("all"), F.sum(F.octet_length("run")).alias("weight"))
        met = materialise(alike.join(cores.where("all > 1").drop("all"), "anchor"), "met-pieces")
        whole = met.where("crowd = 1").select("anchor", "d1", "d2", F.array(F.lit(0)).alias("low"), F.array(F.octet_length("run") - (LENGTH - 1)).alias("high"))
        unlike, crowded = met.where("crowd > 1"), F.col("weight") > CROWD_BYTES
        found = whole.unionByName(in_shards(unlike.where(~crowded)))
        if not unlike.where(crowded).isEmpty():
            each = materialise(unlike.where(crowded).mapInArrow(strings, _RUN + ", n long, at int, s1 long, s2 long"), "strings")
            twice = each.groupBy("s1", "s2").agg(F.sum("n").alias("times")).where("times > 1").select("s1", "s2")
            at = each.join(twice, ["s1", "s2"]).groupBy("anchor", "d1", "d2").agg(F.collect_set("at").alias("low"))
            found = found.unionByName(at.select("anchor", "d1", "d2", "low", F.transform("low", lambda x: x + 1).alias("high")))
        back = cuts.join(found, ["anchor", "d1", "d2"]).select(
            F.col("of").alias("anchor"), F.col("of1").alias("d1"), F.col("of2").alias("d2"),
            F.transform("low", lambda x: x + F.col("at")).alias("low"), F.transform("high", lambda x: x + F.col("at")).alias("high"),
        )
        spans_of = back.groupBy("anchor", "d1", "d2").agg(F.collect_list(F.struct("low", "high")).alias("parts"))
        return spans_of.select("anchor", "d1", "d2", F.flatten("parts.low").alias("low"), F.flatten("parts.high").alias("high"))

    spark = rows.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        runs = materialise(rows.mapInArrow(find, _RUN + ", row long, start int, starts int, multi boolean"), "runs")
        distinct = runs.groupBy("anchor", "d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct("row", "start", "starts")).alias("at"), F.max("multi").alias("multi"))
        distinct = materialise(distinct, "distinct-runs")
        anchors = distinct.groupBy("anchor").agg(F.count("*").alias("crowd"), F.sum("n").alias("all"), F.max("multi").alias("any"), F.sum(F.col("at.starts") + (LENGTH - 1)).alias("weight"))
        anchors = anchors.where((F.col("all") > 1) | F.col("any")).select("anchor", "crowd", "weight")
        met = materialise(distinct.join(anchors, "anchor"), "met")
        lone = met.where("crowd = 1 and n > 1").select("anchor", "d1", "d2", F.array(F.lit(0)).alias("low"), F.array("at.starts").alias("high"))
        wanted = met.where("crowd > 1 or n = 1").groupBy(F.col("at.row").alias("row")).agg(
            F.collect_list(F.struct("anchor", "d1", "d2", "n", "weight", "at.start", "at.starts")).alias("wanted")
        )
        texts = materialise(
            rows.join(wanted, "row").mapInArrow(cut, _RUN + ", n long, weight long, run binary").dropDuplicates(["anchor", "d1", "d2"]), "run-texts"
        )
        crowded = F.col("weight") > CROWD_BYTES
        marks = lone.unionByName(in_shards(texts.where(~crowded)))
        if not texts.where(crowded).isEmpty():
            marks = marks.unionByName(in_pieces(texts.where(crowded)))
        marks = materialise(marks, "marks")
        spanned = runs.join(marks, ["anchor", "d1", "d2"]).select(
            "row",
            F.transform(F.arrays_zip("low", "high"), lambda x: F.struct((F.col("start") + x["low"]).alias("low"), (F.col("start") + x["high"] + (LENGTH - 1)).alias("high"))).alias("spans"),
        )
        return materialise(spanned.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def whole_characters(body: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Bytes of the UTF-8 characters that lost none of theirs."""
    first = (body & 0xC0) != 0x80
    broken = np.logical_or.reduceat(gone, np.flatnonzero(first))
    return body[~broken[np.cumsum(first) - 1]]


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", characters: bool = False) -> DataFrame:
    """``key``, ``doc`` (the whole input row), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary) and ``kept_sha256``.

    Texts are UTF-8 bytes, null an empty one, and matches never cross documents; a text of under 200 bytes keeps all. All places of a
    repeated string go, within one document too, judged on the input. Equal rows are documents of their own, so
    each repeats the other. An empty table gives no rows; other columns are only carried in ``doc``. With ``characters``,
    ``kept`` is text: a character that a cut went through goes whole, every other byte stays; the rest is as without.
    """
    row = F.xxhash64(F.lit("row"), F.col(key), F.col(text))
    rows = docs.select(row.alias("row"), as_bytes(text).alias("body"))
    found = repeated_spans(rows)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, number, kept, digest, sizes = [], [], [], [], []
            for value, wanted in zip(batch.column("body"), batch.column("spans")):
                body, pairs = value.as_py(), wanted.as_py()
                edges = np.zeros(len(body) + 1, np.int32)
                if pairs:
                    np.add.at(edges, [x["low"] for x in pairs], 1)
                    np.add.at(edges, [x["high"] for x in pairs], -1)
                gone = np.cumsum(edges)[:-1] > 0
                rest = np.frombuffer(body, np.uint8)[~gone].tobytes()
                sizes.append(len(body))
                removed.append(len(body) - len(rest))
                number.append(len(spans(gone)[0]))
                kept.append(whole_characters(np.frombuffer(body, np.uint8), gone).tobytes() if characters and pairs else rest)
                digest.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(kept, pa.binary()), pa.array(digest, pa.string())],
                schema=pa.schema([("doc", batch.schema.field("doc").type), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())]),
            )

    whole = docs.select(row.alias("row"), as_bytes(text).alias("body"), F.struct(*docs.columns).alias("doc")).join(found, "row", "left").select("doc", "body", "spans")
    kind = docs.schema.simpleString()
    out = whole.mapInArrow(apply, f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return out.select(F.col("doc")[key].alias(key), "doc", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
