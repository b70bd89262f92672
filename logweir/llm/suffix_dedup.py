"""Removal of long repeated byte strings, found by suffix arrays that are built by two-stage sorting.

A corpus-wide suffix array can't be held by one task, so the work is first divided in a way that keeps every pair of
equal strings of ``length`` bytes together. Each such string has an *anchor*: the first smallest hash among its runs
of ``GRAM`` bytes. Equal strings have equal anchors at equal places, so strings with different anchors need never be
compared. Only anchors that occur twice in the corpus matter; around each lies a *piece*, the bytes of all strings
that have it. Pieces with the same bytes are merged and counted, and those of one anchor go to one task.

A task sorts the suffixes of its pieces in two stages. Suffixes that are smaller than their successor are sorted
directly. The others are induced by one scan over the buckets of first bytes: a suffix found there puts its
predecessor, if this is larger, next in the predecessor's bucket. Neighbours in the suffix array are then compared,
and a start whose common prefix with a neighbour has ``length`` bytes is repeated.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import free_name, written
from logweir.llm.textbytes import BASE, BASE_INVERSE, VALUES, blocks, bytes_of, mixed, powers, range_hashes
from logweir.operators.skew import hot_keys, lookup_join, salted_join

LENGTH = 200
GRAM = 64
#: Bits of a place in a block; a text has less than 2 GB.
PLACE_BITS = 31
#: Bytes of text searched for anchors at once; the arrays made of them should stay in a processor's cache.
ANCHOR_BYTES = 250_000
#: Bytes of pieces in one suffix array; a place in it must fit into 21 bits.
ARRAY_BYTES = 500_000
#: An anchor with more different pieces has these cut into blocks of so many starts, and dealt out by what the
#: strings of a block have in common; if a block is still crowded, its strings are dealt out.
CROWDED = 2_000
BLOCK = 12


# --- anchors -------------------------------------------------------------------------------------------------------


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of many texts: each anchor's hash, text, place, and the first and last start of the strings that have it.

    Places count from the beginning of the text. Texts shorter than ``length`` have none.
    """
    width = length - gram + 1
    n = len(data) - gram + 1
    starts = _starts(ends, length)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty, empty
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUES[data] * powers(BASE, len(data)), out=sums[1:])
    hashes = mixed((sums[gram:] - sums[:-gram]) * powers(BASE_INVERSE, n))
    # Minimum of each run of ``width`` hashes: prefix minima from the right and the left of blocks of that width.
    # The place in the low bits makes the first of equal hashes the smallest. The high bits left to the hashes are as
    # many in every block, so that equal strings have equal anchors wherever they stand.
    bits = np.uint64(PLACE_BITS)
    keyed = ((hashes >> bits) << bits) | np.arange(n, dtype=np.uint64)
    fill = -n % width
    grid = np.append(keyed, np.full(fill, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[starts], left[starts + width - 1])
    place = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    new = np.append(True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    text = np.searchsorted(ends, starts[first], side="right") - 1
    base = ends[text]
    return hashes[place[first]], text, place[first] - base, starts[first] - base, starts[last] - base


def _starts(ends: np.ndarray, length: int) -> np.ndarray:
    """Where strings of ``length`` bytes begin that end in the same text."""
    sizes = np.maximum(np.diff(ends) - length + 1, 0)
    skip = np.repeat(ends[:-1] - (np.cumsum(sizes) - sizes), sizes)
    return skip + np.arange(sizes.sum())


def _finder(length: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", ANCHOR_BYTES):
            hashes, text, _, first, last = anchors(*bytes_of(block.column("text")), length, gram)
            yield pa.record_batch(
                {
                    "id": block.column("id").take(pa.array(text)),
                    "anchor": hashes.view(np.int64),
                    "first": first.astype(np.int32),
                    "last": last.astype(np.int32),
                }
            )

    return find


def _cutter(length: int):
    """Rows (id, text, runs of (anchor, first, last)) to pieces: anchor, digest of the bytes, and the bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", ANCHOR_BYTES):
            data, ends = bytes_of(block.column("text"))
            runs = block.column("runs").combine_chunks() if isinstance(block.column("runs"), pa.ChunkedArray) else block.column("runs")
            flat, owner = runs.flatten(), np.repeat(np.arange(len(runs)), np.asarray(runs.value_lengths()))
            first, last = (flat.field(k).to_numpy() for k in ("first", "last"))
            begin, end = ends[owner] + first, ends[owner] + last + length
            digest = range_hashes(data, begin, end)
            check = range_hashes(data[::-1], len(data) - end, len(data) - begin)
            raw = data.tobytes()
            yield pa.record_batch(
                {
                    "id": block.column("id").take(pa.array(owner)),
                    "anchor": flat.field("anchor"),
                    "first": flat.field("first"),
                    "last": flat.field("last"),
                    "d1": digest.view(np.int64),
                    "d2": check.view(np.int64),
                    "bytes": pa.array([raw[i:j] for i, j in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()),
                }
            )

    return cut


# --- suffix arrays -----------------------------------------------------------------------------------------------------


PLACES = 21


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Ranks of up to 2^21 keys of up to 42 bits: equal keys have equal ranks."""
    packed = np.sort((keys.astype(np.uint64) << np.uint64(PLACES)) | np.arange(len(keys), dtype=np.uint64))
    place = (packed & np.uint64((1 << PLACES) - 1)).astype(np.int64)
    key = packed >> np.uint64(PLACES)
    rank = np.empty(len(keys), np.int64)
    rank[place] = np.cumsum(np.append(False, key[1:] != key[:-1]))
    return rank


def _words(text: np.ndarray) -> tuple[np.ndarray, int]:
    """For each place the rank of the ten bytes from there; behind the end stand zeros."""
    wide = np.append(text, np.zeros(10, np.uint8)).astype(np.uint64)
    five = np.zeros(len(text) + 5, np.uint64)
    for k in range(5):
        five = (five << np.uint64(8)) | wide[k : k + len(five)]
    named = _ranks(five[: len(text) + 5])
    return _ranks((named[: len(text)] << PLACES) | named[5 : len(text) + 5]), 10


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; a run of one byte goes by what follows the run."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    # The last run counts as smaller, so that it is sorted directly.
    rises = np.append(text[change] < text[change + 1], True)
    runs = np.diff(np.concatenate(([-1], change, [n - 1])))
    return np.repeat(rises, runs)


def _sorted_directly(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of their suffixes' first ``depth`` bytes or more, ten bytes at a time, ties only."""
    rank, step = _words(text)
    rank = np.append(rank, np.zeros(depth + step, np.int64))
    order = places.copy()
    # Places of ``order`` still in a tie, and the place where each tie begins.
    open_at, group = np.arange(len(places)), np.zeros(len(places), np.int64)
    for at in range(0, depth, step):
        if not len(open_at):
            break
        now = order[open_at]
        packed = np.sort((((group << PLACES) | rank[now + at]) << PLACES) | np.arange(len(now)))
        order[open_at] = now[packed & ((1 << PLACES) - 1)]
        key = packed >> PLACES
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(first, len(now)))
        tied = np.repeat(size > 1, size)
        group = np.repeat(open_at[first], size)[tied]
        open_at = open_at[tied]
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All places of ``text`` in the order of the first ``depth`` bytes of their suffixes, by two-stage sorting."""
    # A zero byte ends the text, so that its last run is not larger than what follows.
    text = np.append(text, np.uint8(0))
    small = _smaller_than_next(text)
    direct = _sorted_directly(text, np.flatnonzero(small), depth)
    symbols = text[direct]
    cuts = np.searchsorted(symbols, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []

    def induce(found: np.ndarray, symbol: int) -> np.ndarray:
        """Put the larger predecessors of ``found`` into their buckets; return those in the bucket being scanned."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        to = text[before]
        by = np.argsort(to, kind="stable")
        before, to = before[by], to[by]
        at = np.searchsorted(to, np.arange(257))
        for s in np.flatnonzero(np.diff(at)):
            if s != symbol:
                waiting[s].append(before[at[s] : at[s + 1]])
        return before[at[symbol] : at[symbol + 1]]

    for symbol in range(256):
        found = np.concatenate(waiting[symbol]) if waiting[symbol] else np.zeros(0, np.int64)
        while len(found):
            out.append(found)
            found = induce(found, symbol)
        part = direct[cuts[symbol] : cuts[symbol + 1]]
        if len(part):
            out.append(part)
            induce(part, symbol)
    order = np.concatenate(out)
    return order[order < len(text) - 1]


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at each a and b, up to ``depth``; zeros stand behind the end."""
    wide = np.append(text, np.zeros(depth + 8, np.uint8))
    # Eight bytes at every place, as one number each.
    eight = np.zeros(len(wide) - 7, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | wide[k : k + len(eight)]
    length = np.zeros(len(a), np.int64)
    on = np.arange(len(a))
    while len(on):
        done = length[on]
        differ = eight[a[on] + done] ^ eight[b[on] + done]
        equal = differ == 0
        for k in range(1, 8):
            length[on[~equal]] += differ[~equal] < np.uint64(1 << (64 - 8 * k))
        on = on[equal]
        length[on] += 8
        on = on[length[on] < depth]
    return np.minimum(length, depth)


def repeated_starts(pieces: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each of some different pieces, the starts whose string of ``length`` bytes is found again among all.

    A piece that was found more than once is repeated as a whole.
    """
    sizes = np.array([len(p) for p in pieces])
    # A zero byte stands between pieces; strings that would cross it are no starts.
    text = np.frombuffer(b"\0".join(pieces), np.uint8)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    starts = np.zeros(len(text), bool)
    whole = np.maximum(sizes - length + 1, 0)
    starts[np.repeat(begins - (np.cumsum(whole) - whole), whole) + np.arange(whole.sum())] = True
    order = suffix_array(text, length)
    # Suffixes that are no starts have less than ``length`` bytes before the end of their piece.
    left, right = order[:-1], order[1:]
    pair = starts[left] & starts[right]
    left, right = left[pair], right[pair]
    shared = common_prefixes(text, left, right, length) >= length
    found = np.zeros(len(text), bool)
    found[left[shared]] = True
    found[right[shared]] = True
    return [
        np.arange(w) if c > 1 else np.flatnonzero(found[b : b + w])
        for b, w, c in zip(begins, whole, counts, strict=True)
    ]


def _runs(places: np.ndarray) -> list[tuple[int, int]]:
    """Ascending numbers as (first, last) of runs without gaps."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.append(0, cut + 1)].tolist(), places[np.append(cut, len(places) - 1)].tolist(), strict=True))


def _arrays(length: int, most: int):
    """Rows (anchor, d1, d2, bytes, n), sorted by anchor, to (anchor, d1, d2, runs of repeated starts)."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("anchor", "d1", "d2", "bytes", "n")), strict=True):
                if size > most and row[0] != held[-1][0]:
                    yield from found(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield from found(held)

    def found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        starts = repeated_starts([r[3] for r in rows], np.array([r[4] for r in rows]), length)
        use = [(r, _runs(s)) for r, s in zip(rows, starts, strict=True) if len(s)]
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        yield pa.record_batch(
            {
                "anchor": pa.array([r[0] for r, _ in use], pa.int64()),
                "d1": pa.array([r[1] for r, _ in use], pa.int64()),
                "d2": pa.array([r[2] for r, _ in use], pa.int64()),
                "starts": pa.array([[{"first": i, "last": j} for i, j in s] for _, s in use], kind),
            }
        )

    return sort


def _blocks(length: int, gram: int, block: int):
    """Pieces of crowded anchors to pieces of ``block`` starts at most, with the hash of their common bytes as anchor.

    Equal strings stand at one distance from their anchor, so blocks are counted from there. All strings of a block,
    of whatever piece, cover the bytes from the block's last start to the end of its first string.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = bytes_of(batch.column("bytes").cast(pa.large_binary()))
            # All strings of a piece have one anchor, so there is one run for each piece.
            _, owner, place, _, last = anchors(data, ends, length, gram)
            lowest, highest = (0 - place) // block, (last - place) // block
            k = np.repeat(lowest, highest - lowest + 1)
            k = k + np.arange(len(k)) - np.repeat(np.cumsum(highest - lowest + 1) - (highest - lowest + 1), highest - lowest + 1)
            who = np.repeat(np.arange(len(owner)), highest - lowest + 1)
            start, zero = place[who] + k * block, ends[owner[who]]
            first, final = np.maximum(start, 0), np.minimum(start + block - 1, last[who])
            core = range_hashes(data, zero + start + block - 1, zero + start + length)
            begin, end = zero + first, zero + final + length
            raw = data.tobytes()
            take = pa.array(owner[who])
            yield pa.record_batch(
                {
                    **{f"p{i}": batch.column(c).take(take) for i, c in enumerate(("anchor", "d1", "d2"))},
                    "n": batch.column("n").take(take),
                    "shift": first.astype(np.int32),
                    "anchor": mixed(core + k.astype(np.uint64)).view(np.int64),
                    "d1": range_hashes(data, begin, end).view(np.int64),
                    "d2": range_hashes(data[::-1], len(data) - end, len(data) - begin).view(np.int64),
                    "bytes": pa.array([raw[i:j] for i, j in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()),
                }
            )

    return split


def _strings(length: int):
    """Pieces of crowded blocks to their strings: the start within the piece and a digest of ``length`` bytes."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = bytes_of(batch.column("bytes").cast(pa.large_binary()))
            first = _starts(ends, length)
            owner = np.searchsorted(ends, first, side="right") - 1
            take = pa.array(owner)
            yield pa.record_batch(
                {
                    **{k: batch.column(k).take(take) for k in ("anchor", "d1", "d2", "n")},
                    "start": (first - ends[owner]).astype(np.int32),
                    "s1": range_hashes(data, first, first + length).view(np.int64),
                    "s2": range_hashes(data[::-1], len(data) - first - length, len(data) - first).view(np.int64),
                }
            )

    return split


# --- the whole operator -------------------------------------------------------------------------------------------------


def _remover(length: int, whole: bool):
    """Rows (id, text, spans of starts) to what is left of the text, and how much was taken away.

    ``whole``: of a character that loses a byte nothing is left.
    """

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            left, removed, runs = [], [], []
            for text, spans in zip(block.column("text").to_pylist(), block.column("spans").to_pylist(), strict=True):
                raw = text.encode()
                edge = np.zeros(len(raw) + 1, np.int32)
                first = np.array([s["first"] for s in spans])
                np.add.at(edge, first, 1)
                np.add.at(edge, np.array([s["last"] for s in spans]) + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                data, lost = np.frombuffer(raw, np.uint8), gone
                if whole:
                    char = np.cumsum((data & 0xC0) != 0x80) - 1
                    lost = (np.bincount(char, weights=gone) > 0)[char]
                left.append(data[~lost].tobytes())
                removed.append(int(gone.sum()))
                runs.append(int((gone & ~np.append(False, gone[:-1])).sum()))
            yield pa.record_batch(
                {
                    "id": block.column("id"),
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array(runs, pa.int64()),
                    "left": pa.array(left, pa.binary()),
                }
            )

    return remove


MARKS = "anchor long, d1 long, d2 long, starts array<struct<first:int,last:int>>"


def _parted(different: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Pieces of anchors that one task can hold, and those of crowded ones, if any."""
    crowd = written(
        different.groupBy("anchor").agg(F.count("*").alias("m")).filter(F.col("m") > CROWDED).select("anchor"), "suffix-crowd"
    )
    if crowd.isEmpty():
        return different, None
    return different.join(crowd, "anchor", "left_anti"), different.join(crowd, "anchor", "left_semi")


def _sorted_marks(sparse: DataFrame, length: int) -> DataFrame:
    ready = sparse.repartition("anchor").sortWithinPartitions("anchor").select("anchor", "d1", "d2", "bytes", "n")
    return ready.mapInArrow(_arrays(length, ARRAY_BYTES), MARKS)


def _marks(different: DataFrame, length: int, gram: int) -> DataFrame:
    """Repeated starts of different pieces (anchor, d1, d2, n, bytes), in one row or more for a piece that has some."""
    sparse, crowded = _parted(different)
    marks = _sorted_marks(sparse, length)
    if crowded is None:
        return marks
    parent = ["p0", "p1", "p2"]
    schema = "p0 long, p1 long, p2 long, n long, shift int, anchor long, d1 long, d2 long, bytes binary"
    columns = ["anchor", "d1", "d2", "n", "bytes"]
    blocks = written(crowded.select(*columns).mapInArrow(_blocks(length, gram, BLOCK), schema), "suffix-blocks")
    merged = blocks.groupBy("anchor", "d1", "d2").agg(F.sum("n").alias("n"), F.any_value("bytes").alias("bytes"))
    sparse, crowded = _parted(written(merged, "suffix-pieces"))
    inner = _sorted_marks(sparse, length)
    if crowded is not None:
        schema = "anchor long, d1 long, d2 long, n long, start int, s1 long, s2 long"
        strings = crowded.select(*columns).mapInArrow(_strings(length), schema)
        common = strings.groupBy("s1", "s2").agg(F.sum("n").alias("times")).filter("times > 1")
        one = F.array(F.struct(F.col("start").alias("first"), F.col("start").alias("last")))
        inner = inner.unionByName(strings.join(common, ["s1", "s2"]).select("anchor", "d1", "d2", one.alias("starts")))
    moved = F.transform(
        "starts", lambda x: F.struct((x["first"] + F.col("shift")).alias("first"), (x["last"] + F.col("shift")).alias("last"))
    )
    outer = blocks.select(*parent, "shift", "anchor", "d1", "d2").join(inner, ["anchor", "d1", "d2"])
    outer = outer.select(*parent, moved.alias("starts")).toDF("anchor", "d1", "d2", "starts")
    return marks.unionByName(outer)


def cut_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    whole: bool = False,
) -> DataFrame:
    """``(id, n_removed, n_spans, left)`` for the ids of ``docs`` whose text loses bytes.

    Every byte goes that is covered by a string of ``length`` bytes which starts at another place of the corpus too,
    in the same text or another; strings are judged on the input. ``left`` has the remaining bytes. They can end
    within a character, as strings are bytes; with ``whole`` such a character goes too. Null texts are empty; texts shorter than ``length`` lose nothing.
    Ids must be unique; ``cut_rows`` takes any. A row with a null id takes part in nothing and is returned by nothing.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.filter("id is not null")
    long_enough = texts.filter(F.octet_length("text") >= length)
    places = long_enough.mapInArrow(_finder(length, gram), "id long, anchor long, first int, last int")
    again = written(places.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "suffix-anchors")
    run = F.struct("anchor", "first", "last")
    # An anchor that many documents quote has its places spread over many tasks.
    hot = hot_keys(again, ["anchor"], "n")
    runs = salted_join(places, again.select("anchor"), ["anchor"], "inner", hot, ["id", "first"]).groupBy("id").agg(F.collect_list(run).alias("runs"))
    candidates = written(long_enough.join(runs, "id"), "suffix-candidates")

    schema = "id long, anchor long, first int, last int, d1 long, d2 long, bytes binary"
    pieces = candidates.mapInArrow(_cutter(length), schema)
    different = pieces.groupBy("anchor", "d1", "d2").agg(F.count("*").alias("n"), F.any_value("bytes").alias("bytes"))
    different = written(different, "suffix-pieces")
    marks = written(_marks(different, length, gram), "suffix-marks")

    keys = ["anchor", "d1", "d2"]
    some = pieces.select("id", "anchor", "first", "d1", "d2")
    where = salted_join(some, marks, keys, "inner", hot_keys(different, keys, "n"), ["id", "first"])
    span = where.select("id", "first", F.explode("starts").alias("s")).select(
        "id", F.struct((F.col("first") + F.col("s.first")).alias("first"), (F.col("first") + F.col("s.last")).alias("last")).alias("span")
    )
    spans = span.groupBy("id").agg(F.collect_list("span").alias("spans"))
    found = candidates.select("id", "text").join(spans, "id")
    return found.mapInArrow(_remover(length, whole), "id long, n_removed long, n_spans long, left binary").withColumnRenamed(
        "id", id_col
    )


class Keyed(NamedTuple):
    """``rows``: the documents with a key; ``texts``: (id, text) of each key; ``twins``: (id, n_bytes) of the keys that
    several rows have."""

    rows: DataFrame
    texts: DataFrame
    twins: DataFrame


def with_keys(docs: DataFrame, id_col: str, text_col: str, own: str) -> Keyed:
    """``docs`` with a key in the new column ``own``, which tells different texts apart that have one id or none.

    A row's key is its id where no other row has that. Rows of repeated ids and of the null id get new keys, rows of
    equal id and text the same one. New keys lie above all ids; where no room is there, all rows get one.
    """
    plain = docs.withColumn(own, F.col(id_col).cast("long"))
    ids = plain.select(own)
    odd = written(ids.groupBy(own).agg(F.count("*").alias("n")).filter(f"n > 1 or `{own}` is null").select(own), "suffix-odd-ids")
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    if odd.isEmpty():
        nothing = plain.limit(0).select(F.col(own).alias("id"), F.lit(0).cast("long").alias("n_bytes"))
        return Keyed(plain, plain.select(F.col(own).alias("id"), text), nothing)
    highest = ids.agg(F.max(own)).first()[0]
    highest = -1 if highest is None else highest
    mark, content = free_name("odd", plain.columns), free_name("content", plain.columns)
    if highest < 1 << 62:
        known = odd.filter(F.col(own).isNotNull()).withColumn(mark, F.lit(True))
        marked = lookup_join(plain, known, [own], "left", [text_col])
        marked = marked.withColumn(mark, F.coalesce(mark, F.col(own).isNull()))
        first = highest + 1
    else:
        marked, first = plain.withColumn(mark, F.lit(True)), 0
    usual = marked.filter(~F.col(mark)).drop(mark)
    strange = marked.filter(mark).withColumn(content, text).drop(mark)
    numbered = strange.groupBy(F.col(own).alias("of"), F.col(content).alias("text")).agg(F.count("*").alias("times"))
    numbered = written(numbered.withColumn("id", F.lit(first) + F.monotonically_increasing_id()), "suffix-odd-rows")
    same = F.col(own).eqNullSafe(F.col("of id")) & (F.col(content) == F.col("of text"))
    found = strange.join(numbered.select(F.col("of").alias("of id"), F.col("text").alias("of text"), F.col("id").alias("new id")), same)
    rows = usual.unionByName(found.withColumn(own, F.col("new id")).select(*plain.columns))
    texts = usual.select(F.col(own).alias("id"), text).unionByName(numbered.select("id", "text"))
    twins = numbered.filter("times > 1").select("id", F.octet_length("text").cast("long").alias("n_bytes"))
    return Keyed(rows, texts, twins)


def cut_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    out: str = "cut",
    keep: list[Column | str] | None = None,
    length: int = LENGTH,
    whole: bool = False,
    **options,
) -> DataFrame:
    """Each row of ``docs``, its columns (or ``keep``) and ``out``: (n_removed, n_spans, left), null if it loses nothing.

    Rows may repeat an id, with the same text or another, or have none; each is a document of its own. A row whose
    text of ``length`` bytes or more stands in another row too loses all of it.
    """
    own = free_name("key", [*docs.columns, out])
    keyed = with_keys(docs, id_col, text_col, own)
    cut = cut_texts(keyed.texts, "id", length=length, whole=whole, **options)
    copies = keyed.twins.filter(F.col("n_bytes") >= length).select(
        "id", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("left")
    )
    cut = cut.join(copies.select("id"), "id", "left_anti").unionByName(copies)
    cut = cut.select(F.col("id").alias(own), F.struct("n_removed", "n_spans", "left").alias(out))
    rows = keyed.rows if keep is None else keyed.rows.select(own, *keep)
    return rows.join(cut, own, "left").drop(own)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated strings taken out of their texts; all rows and columns stay, also unchanged texts.

    A character that a removed string cuts through goes as a whole. Ids may repeat or be null, see ``cut_rows``.
    """
    out = free_name("cut", docs.columns)
    cut = cut_rows(docs, id_col, text_col, out, whole=True, **options)
    left = F.col(f"`{out}`.left").cast("string")
    return cut.withColumn(text_col, F.coalesce(left, text_col)).select(*docs.columns)
