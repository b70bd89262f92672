"""Near-duplicate classes by ProbMinHash over shingles weighted by their counts.

Each shingle is a Poisson process of arrivals whose rate is its weight; every arrival falls on a random register, and
a register keeps the shingle that came first. A shingle whose next arrival is later than all registers is done.
Two texts agree in a register with the probability Jaccard similarity of their weighted shingles

    J_P(a, b) = sum over x of 1 / (sum over y of max(a_y / a_x, b_y / b_x)).

Bands of registers find candidates; the share of equal registers sorts out the most; shingles decide.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.components import components
from logweir.llm.tables import free_name, small_or_shuffled, written
from logweir.llm.textbytes import BASE, blocks, mixed, shingle_hashes, times

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
#: First and last bands of the rounds in which members of a bucket meet the one that leads it.
ROUNDS = ((0, 2), (3, 1 << 20))
#: Candidates must agree in this share of the 128 registers: five standard deviations below a similarity of 0.8.
MARGIN = 5
#: Members of a band bucket that are compared with one another at once, and the bytes of their texts.
CELL = 1024
CELL_BYTES = 16 << 20


# --- signatures ------------------------------------------------------------------------------------------------


def weighted(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) pairs in ascending order, and how often each occurs."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return owner[first], hashes[first], np.diff(np.append(first, len(owner)))


def signatures(n: int, owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, registers: int) -> np.ndarray:
    """For each of n texts the shingle that reached each register first; 0 for texts without shingles."""
    best = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    owner, rate = owner.astype(np.int64), weights.astype(np.float64)
    time, step = np.zeros(len(owner)), 0
    while len(owner):
        step += 1
        draw = mixed(hashes + times(BASE, step))
        # 53 bits make a number in (0, 1]; the register comes from a second scrambling.
        time = time - np.log(((draw >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) / rate
        cell = owner * registers + (mixed(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(best, cell, time)
        came = best[cell] == time
        winner[cell[came]] = hashes[came]
        # Early termination: later arrivals than the latest register can't change anything.
        new = np.append(True, owner[1:] != owner[:-1])
        latest = best.reshape(n, registers)[owner[new]].max(axis=1)
        on = time < latest[np.cumsum(new) - 1]
        owner, hashes, rate, time = owner[on], hashes[on], rate[on], time[on]
    return winner.reshape(n, registers)


def digests(hashes: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
    """Two digests of the weighted shingles of each of n texts."""
    made = [np.zeros(n, np.uint64) for _ in range(2)]
    for k, sums in enumerate(made, 1):
        np.add.at(sums, owner, mixed(hashes ^ times(BASE, k)))
    return made


def _digester(shingle: int):
    """Per text: its id, the first of its digests and itself."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            d1 = digests(*shingle_hashes(block.column("text"), shingle), block.num_rows)[0]
            yield pa.record_batch({"id": block.column("id"), "d1": d1.view(np.int64), "text": block.column("text").cast(pa.string())})

    return digest


def _signer(text: str, shingle: int, bands: int, rows: int):
    """Per text: a digest of its weighted shingles, its bands, and one byte of each register."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            n = block.num_rows
            hashes, owner = shingle_hashes(block.column(text), shingle)
            some = np.bincount(owner, minlength=n) > 0
            digest = digests(hashes, owner, n)
            sig = signatures(n, *weighted(owner, hashes), bands * rows)
            buckets = np.zeros((n, bands), np.uint64)
            for r in range(rows):
                buckets = mixed(buckets * BASE + sig[:, r::rows] + np.arange(bands, dtype=np.uint64))
            keep = np.flatnonzero(some)
            short = np.ascontiguousarray((sig[keep] & np.uint64(0xFF)).astype(np.uint8))
            flat = pa.array(buckets[keep].view(np.int64).ravel())
            starts = pa.array(np.arange(len(keep) + 1, dtype=np.int32) * bands)
            yield pa.record_batch(
                {
                    "id": block.column("id").take(pa.array(keep)),
                    "d1": digest[0][keep].view(np.int64),
                    "d2": digest[1][keep].view(np.int64),
                    "bands": pa.ListArray.from_arrays(starts, flat),
                    "sig": pa.array([x.tobytes() for x in short], pa.binary()),
                }
            )

    return sign


# --- candidates --------------------------------------------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _agreeing(registers: int, least: int):
    """Of (a, b, sig_a, sig_b) rows, the pairs that agree in enough registers."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            equal = _matrix(batch.column("sig_a"), registers) == _matrix(batch.column("sig_b"), registers)
            yield batch.select(["a", "b"]).filter(pa.array(equal.sum(axis=1) >= least))

    return agree


def _crossing(registers: int, least: int, shingle: int, similarity: float):
    """Of rows sorted by cell, the pairs in one cell but two components whose texts are similar enough.

    A pair is looked at in the first of the bands that it shares. The shingles of a text are made once for its cell, and
    only if a pair with it agrees in enough registers. Components that a pair has linked need no further pair.
    """

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            ends = [*(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]
            first = 0
            for last in ends:
                part = batch.slice(first, last - first)
                if held and held[0].column("cell")[0] != part.column("cell")[0]:
                    yield found(held)
                    held = []
                held.append(part)
                first = last
        if held:
            yield found(held)

    def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        members = pa.Table.from_batches(parts).combine_chunks()
        ids, comp = members.column("id").to_numpy(), members.column("component").to_numpy()
        sig = _matrix(members.column("sig"), registers)
        bands = np.array(members.column("bands").to_pylist(), np.int64).reshape(len(ids), -1)
        earlier = np.arange(bands.shape[1]) < members.column("band").to_numpy()[0]
        # Members of one row of the grid meet in the cell of that row alone.
        own = members.column("own").to_numpy()
        alone = (own == own[0]).all()
        texts = members.column("text").combine_chunks()
        vectors: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        head = {c: c for c in comp.tolist()}

        def vector(k: int) -> tuple[np.ndarray, np.ndarray]:
            if k not in vectors:
                owner, hashes, weight = weighted(*_flipped(shingle_hashes(texts.slice(k, 1).cast(pa.large_string()), shingle)))
                vectors[k] = hashes, weight
            return vectors[k]

        def top(c: int) -> int:
            while head[c] != c:
                head[c] = c = head[head[c]]
            return c

        links = []
        for i in range(len(ids) - 1):
            rest = np.arange(i + 1, len(ids))
            rest = rest[(comp[rest] != comp[i]) & (alone | (own[rest] != own[i]))]
            rest = rest[(sig[rest] == sig[i]).sum(axis=1) >= least]
            rest = rest[~((bands[rest] == bands[i]) & earlier).any(axis=1)]
            for j in rest.tolist():
                a, b = top(int(comp[i])), top(int(comp[j]))
                if a != b and probability_jaccard(vector(i), vector(j)) >= similarity:
                    head[a] = b
                    links.append((ids[i], ids[j]))
        return pa.record_batch({k: pa.array([x[n] for x in links], pa.int64()) for n, k in enumerate("ab")})

    return cross


def _flipped(found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return found[1], found[0]


# --- verification ------------------------------------------------------------------------------------------------


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two texts given as ascending shingle hashes with their weights.

    The inner sum takes a_y / a_x for the y whose a_y / b_y is above a_x / b_x and b_y / b_x for the others, so that
    one sort by this ratio gives all of them from running sums.
    """
    (ka, wa), (kb, wb) = a, b
    keys = np.union1d(ka, kb)
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, ka)] = wa
    y[np.searchsorted(keys, kb)] = wb
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.maximum(y, 1e-300), np.inf)
    order = np.argsort(ratio)
    x, y, ratio = x[order], y[order], ratio[order]
    upto = np.cumsum(y)
    above = x.sum() - np.cumsum(x)
    # Equal ratios may count on either side, as both terms are then the same.
    both = (x > 0) & (y > 0)
    return float((1 / (above[both] / x[both] + upto[both] / y[both])).sum())


def _verifier(shingle: int, similarity: float):
    def vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        hashes, owner = shingle_hashes(column, shingle)
        owner, hashes, weight = weighted(owner, hashes)
        cuts = np.searchsorted(owner, np.arange(len(column) + 1))
        return [(hashes[i:j], weight[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for wide in blocks(batches, "text_a"):
            for block in blocks(iter([wide]), "text_b"):
                pairs = zip(vectors(block.column("text_a")), vectors(block.column("text_b")), strict=True)
                near = np.array([probability_jaccard(a, b) >= similarity for a, b in pairs], bool)
                yield block.select(["a", "b"]).filter(pa.array(near))

    return verify


def _links(texts: DataFrame, pairs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose texts are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = written(texts.join(small_or_shuffled(ids), "id", "left_semi"), "near-texts")
    both = pairs.join(needed.toDF("a", "text_a"), "a").join(needed.toDF("b", "text_b"), "b")
    return written(both.mapInArrow(_verifier(shingle, similarity), "a long, b long").distinct(), "near-links")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose texts are not in one component yet."""
    of_a, of_b = found.toDF("a", "in_a"), found.toDF("b", "in_b")
    placed = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return placed.filter(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).select("a", "b")


# --- the whole operator -------------------------------------------------------------------------------------------


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per id of ``docs``: the id, ``class_id`` (the smallest id of its class) and ``kept`` (is it that one).

    Two documents are linked if their weighted shingles have a probability Jaccard similarity of ``similarity`` or
    more; classes are the connected components. Texts with the same shingles and counts are one document from the
    start. In two rounds over the bands, buckets link their members with the one in most company; buckets whose members are still in more than
    one component have all pairs across components compared, in cells of bounded size, so that no link between
    components is missed however large the bucket.

    A text with fewer words than ``shingle`` is one shingle. Null and blank texts are in no class but their own,
    and so is each row with a null id. Rows that repeat an id are one document that has several texts. An empty
    table gives no rows; other columns are ignored.
    """
    registers = bands * rows
    least = max(1, round(registers * similarity - MARGIN * (registers * similarity * (1 - similarity)) ** 0.5))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    named = texts.filter("id is not null")
    schema = "id long, d1 long, d2 long, bands array<long>, sig binary"
    signed = written(named.mapInArrow(_signer("text", shingle, bands, rows), schema), "near-signed")

    copies = signed.groupBy("d1", "d2").agg(F.min("id").alias("rep"))
    members = written(signed.select("id", "d1", "d2").join(copies, ["d1", "d2"]).select("id", "rep"), "near-members")
    alone = signed.join(members.filter("id = rep").select("id").distinct(), "id", "left_semi")
    sigs = written(alone.select("id", "d1", "bands", "sig").dropDuplicates(["id", "d1"]), "near-sigs")
    placed = sigs.select("id", "d1", F.posexplode("bands").alias("band", "bucket"))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    crowd = written(placed.join(sizes, "bucket"), "near-buckets")
    # A text that others are variants of shares more with them than they do with one another, and so has more company
    # over all its buckets. It leads; of equals the smallest id.
    company = crowd.groupBy("id").agg(F.sum("size").alias("company"))
    first = F.max(F.struct("company", (-F.col("id")).alias("minus_id")))
    leaders = crowd.select("bucket", "id").join(company, "id").groupBy("bucket").agg(first.alias("first"))
    leaders = leaders.select("bucket", (-F.col("first.minus_id")).alias("leader"))
    shared = written(crowd.join(leaders, "bucket"), "near-leaders")

    sig = sigs.select("id", "sig")
    links, found = None, None
    # In a large group every band says the same again: a later round asks only for pairs still apart.
    for first, last in ROUNDS:
        pairs = shared.filter(F.col("band").between(first, last) & (F.col("id") != F.col("leader")))
        pairs = pairs.select(F.least("leader", "id").alias("a"), F.greatest("leader", "id").alias("b")).distinct()
        if found is not None:
            pairs = _apart(pairs, found)
        known = pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
        starred = written(known.mapInArrow(_agreeing(registers, least), "a long, b long"), "near-pairs")
        now = _links(named, starred, shingle, similarity)
        links = now if links is None else links.unionByName(now)
        found = components(links)

    of = shared.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", "band", "size", "id", "d1", F.coalesce("component", "id").alias("component")
    )
    mixed_up = of.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    of = written(of.join(mixed_up.filter("lo != hi").select("bucket"), "bucket"), "near-mixed")
    # Texts go to the cells, and each pair is settled there: a pair is never a row.
    needed = named.join(small_or_shuffled(of.select("id").distinct()), "id", "left_semi")
    content = needed.mapInArrow(_digester(shingle), "id long, d1 long, text string").dropDuplicates(["id", "d1"])
    content = written(content.join(sigs, ["id", "d1"]).withColumn("bytes", F.octet_length("text").cast("long")), "near-contents")
    weight = of.join(content.select("id", "d1", "bytes"), ["id", "d1"]).groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    grid = F.ceil(F.greatest(F.col("size") / CELL, F.col("bytes") / CELL_BYTES)).cast("int")
    cells = of.join(weight, "bucket").withColumn("grid", grid).withColumn("own", F.pmod(F.xxhash64("id"), F.col("grid")).cast("int"))
    # Member i of a grid meets member j in cell (min, max): with one cell for all small buckets.
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("grid") - 1)))
    cells = cells.withColumn("cell", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")))
    cells = cells.select("cell", "own", "band", "component", "id", "d1").join(content.drop("bytes"), ["id", "d1"])
    cells = cells.repartition("cell").sortWithinPartitions("cell", "id")
    more = written(cells.mapInArrow(_crossing(registers, least, shingle, similarity), "a long, b long").distinct(), "near-links")

    final = components(links.unionByName(more)).withColumnRenamed("node", "rep")
    classes = members.join(final, "rep", "left").select("id", F.coalesce("component", "rep").alias("class_id"))
    found = named.select("id").join(classes, "id", "left").groupBy("id").agg(F.min("class_id").alias("class_id"))
    found = found.select("id", F.coalesce("class_id", "id").alias("class_id"))
    found = found.unionByName(texts.filter("id is null").select("id", F.col("id").alias("class_id")))
    return found.select(F.col("id").alias(id_col), "class_id", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class, all columns as they were; rows with a null id stay."""
    kept = near_classes(docs, id_col, text_col, **options).filter("kept").select(F.col(id_col).alias("kept id"))
    own = free_name("id", docs.columns)
    marked = docs.withColumn(own, F.col(id_col).cast("long"))
    return marked.join(kept, F.col(own).eqNullSafe(F.col("kept id")), "left_semi").drop(own)
