"""Quality classifier: an interpolated modified Kneser-Ney model over the bytes of trusted text.

Training, in Spark: n-grams of ``order`` bytes are counted in each block of trusted text and summed by n-gram.
Lower orders follow from the next higher one by continuation counts. The model is one table of the probabilities of seen
n-grams and the weights of contexts, sharded by n-gram; only the two lowest orders, 65,536 numbers, are an array.

Scoring, in Spark: all n-grams of the corpus are counted. The most frequent ones, a fixed number, get their
log-probabilities by joins and go to every task, where they score most of the text in place. The rare rest leaves
the tasks as (n-gram, document, count) rows, is joined with the sharded model and summed by document. By the
pigeonhole principle a rare n-gram has at most 1/``head`` of all positions, so that no shard is hot.

A few bad words drown in the mean of a document, so its least likely stretch of ``WINDOW`` bytes is found too. Stretches
without rare n-grams are added up in place; for the others the head's values around rare places travel with a piece
of the document, and the rare ones are put in once they are joined.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import free_name, small_or_shuffled, written
from logweir.llm.textbytes import blocks, bytes_of

#: Up to 5, so that an n-gram and a place in a block fit into 64 bits.
ORDER = 5
HEAD = 1 << 18
#: Bytes that stand before each text so that its first bytes have full contexts; no UTF-8 text holds them.
START = 0xFF
#: Bytes of the stretch that is judged apart from the mean; 3 to 5 told toxic documents best, 8 hardly did.
WINDOW = 4
#: Held-out texts of a language at which its own quantiles and those over all languages weigh the same.
SUPPORT = 100
#: Bytes of a document that one row of rare values is about, so that no row grows with a document.
PIECE = 1 << 14


# --- n-grams of texts ------------------------------------------------------------------------------------------


def codes(column: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of all texts, the n-gram that ends there as a number, and the index of its text."""
    data, ends = bytes_of(column)
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    pad = order - 1
    wide = np.full(len(data) + pad * len(sizes) + pad, START, np.int64)
    place = np.arange(len(data)) + pad * (owner.astype(np.int64) + 1)
    wide[place] = data
    whole = np.zeros(len(wide) - pad, np.int64)
    for back in range(pad, -1, -1):
        whole = (whole << 8) | wide[pad - back : len(wide) - back]
    return whole[place - pad], owner


def _counter(order: int, text: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            code, n = np.unique(codes(block.column(text), order)[0], return_counts=True)
            yield pa.record_batch({"code": code, "n": n.astype(np.int64)})

    return count


def ngram_counts(texts: DataFrame, order: int, text_col: str = "text") -> DataFrame:
    """``(code, n)`` for each n-gram of ``order`` bytes, counted in the map tasks first."""
    found = texts.select(text_col).mapInArrow(_counter(order, text_col), "code long, n long")
    return found.groupBy("code").agg(F.sum("n").alias("n"))


# --- the model ---------------------------------------------------------------------------------------------------


def _context(code: Column) -> Column:
    return F.shiftright(code, 8)


def _last(code: Column, order: int) -> Column:
    """The last ``order`` bytes of an n-gram."""
    return code.bitwiseAND(F.lit((1 << (8 * order)) - 1))


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """Discounts for counts of 1, 2, and 3 or more, from how many n-grams have counts 1 to 4.

    A tiny corpus may leave some of these at zero; a discount that can't be estimated is then 0.5, 1 or 1.5.
    """
    n1, n2, n3, n4 = counts
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    d = [k - (k + 1) * y * b / a if a and b else k / 2 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), d, strict=True))  # type: ignore[return-value]


#: Orders whose probabilities, of all n-grams there can be, go to the tasks as one array: 65,536 numbers.
DENSE = 2


def dense_level(counts: np.ndarray, cuts: tuple[float, float, float], below: np.ndarray) -> np.ndarray:
    """Probabilities of all n-grams of one order from their counts and the probabilities of the order below."""
    n = counts.reshape(-1, 256).astype(np.float64)
    cut = np.where(n == 1, cuts[0], np.where(n == 2, cuts[1], cuts[2])) * (n > 0)
    total = n.sum(axis=1, keepdims=True)
    some = np.maximum(total, 1)
    back = np.where(total > 0, cut.sum(axis=1, keepdims=True) / some, 1.0)
    lower = below[np.arange(counts.size) % below.size].reshape(n.shape)
    return ((n - cut) / some + back * lower).ravel()


def _adder(low: np.ndarray, sought: str, out: str):
    """Add the dense probability of each ``sought`` n-gram's last bytes."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(sought).to_numpy() & (low.size - 1)
            yield batch.append_column(out, pa.array(low[at]))

    return add


class Model:
    """Tables of a trained model.

    ``low`` has the probabilities of all n-grams of the lowest orders. ``table`` (kind, key, value) has those of the
    seen n-grams of each higher order k, with kind 2 k, and with kind 2 k + 1 the weight of the lower order after each
    seen context of k - 1 bytes. Below order 1 all 256 bytes are equally likely.
    """

    def __init__(self, order: int, low: np.ndarray, table: DataFrame | None):
        self.order, self.low, self.table = order, low, table

    def score(self, asked: DataFrame) -> DataFrame:
        """``(code, log_p)`` for the distinct ``code`` values of ``asked``, seen or not.

        From the lowest orders upwards: a seen n-gram has its own probability, an unseen one that of its suffix times
        the weight of its context if this was seen. All that is asked for one n-gram is joined with the model at once.
        """
        rows = asked.select("code").mapInArrow(_adder(self.low, "code", "p"), "code long, p double")
        if self.table is None:
            return rows.select("code", F.log("p").alias("log_p"))
        code, orders = F.col("code"), range(DENSE + 1, self.order + 1)
        sought = [
            F.struct(F.lit(2 * k + back).alias("kind"), key.alias("key"))
            for k in orders
            for back, key in ((0, _last(code, k)), (1, _context(_last(code, k))))
        ]
        found = asked.select("code", F.inline(F.array(*sought))).join(self.table, ["kind", "key"]).select("code", "kind", "value")
        found = found.unionByName(rows.select("code", F.lit(0).alias("kind"), F.col("p").alias("value")))

        def of(kind: int) -> Column:
            return F.max(F.when(F.col("kind") == kind, F.col("value")))

        kinds = [0, *(2 * k + back for k in orders for back in (0, 1))]
        levels = found.groupBy("code").agg(*(of(kind).alias(f"v{kind}") for kind in kinds))
        p = F.col("v0")
        for k in orders:
            p = F.coalesce(f"v{2 * k}", p * F.coalesce(f"v{2 * k + 1}", F.lit(1.0)))
        return levels.select("code", F.log(p).alias("log_p"))


def train(texts: DataFrame, order: int = ORDER, text_col: str = "text") -> Model:
    """Fit the model on all ``texts``; their n-gram tables are written to the shared folder.

    The two lowest orders are worked out on the driver, from one row at most for each pair of bytes. A context has no
    more than 256 n-grams, so these stand in one row with it while it is summed.
    """
    counts = {order: written(ngram_counts(texts, order, text_col), "kn-counts")}
    for k in range(order - 1, 0, -1):
        shorter = counts[k + 1].groupBy(_last(F.col("code"), k).alias("code"))
        counts[k] = written(shorter.agg(F.count("*").alias("n")), "kn-counts")
    low, tables, below = np.full(1, 1 / 256), [], None
    for k in range(1, order + 1):
        levels = counts[k].agg(*(F.count_if(F.col("n") == c).alias(f"n{c}") for c in (1, 2, 3, 4))).first()
        cuts = discounts(list(levels))
        if k <= DENSE:
            seen = counts[k].toArrow()
            dense = np.zeros(256**k, np.int64)
            dense[seen["code"].to_numpy()] = seen["n"].to_numpy()
            low = dense_level(dense, cuts, low)
            continue
        cut = F.when(F.col("n") == 1, cuts[0]).when(F.col("n") == 2, cuts[1]).otherwise(cuts[2])
        by_context = counts[k].groupBy(_context(F.col("code")).alias("context"))
        contexts = by_context.agg(
            F.sum("n").alias("total"), (F.sum(cut) / F.sum("n")).alias("b"), F.collect_list(F.struct("code", "n")).alias("grams")
        )
        contexts = written(contexts, "kn-contexts")
        rows = contexts.select("total", "b", F.inline("grams")).withColumn("suffix", _last(F.col("code"), k - 1))
        if below is None:
            schema = "total long, b double, code long, n long, suffix long, lower double"
            rows = rows.mapInArrow(_adder(low, "suffix", "lower"), schema)
        else:
            # Every suffix was seen, as counts come from the higher order.
            rows = rows.join(below.select(F.col("code").alias("suffix"), F.col("p").alias("lower")), "suffix")
        p = (F.col("n") - cut) / F.col("total") + F.col("b") * F.col("lower")
        below = written(rows.select("code", p.alias("p")), "kn-grams")
        tables.append(below.select(F.lit(2 * k).alias("kind"), F.col("code").alias("key"), F.col("p").alias("value")))
        tables.append(contexts.select(F.lit(2 * k + 1).alias("kind"), F.col("context").alias("key"), F.col("b").alias("value")))
    return Model(order, low, reduce(DataFrame.unionByName, tables) if tables else None)


# --- scoring ---------------------------------------------------------------------------------------------------


PLACE_BITS = 22
#: Text scored at once; a byte takes up some 100 bytes of arrays.
SCORED_BYTES = 1_000_000


def _looked_up(code: np.ndarray, head_codes: np.ndarray, head_log: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For up to 2^22 codes: log-probabilities of those in the head, and which are."""
    packed = np.sort((code << PLACE_BITS) | np.arange(len(code)))
    ordered, place = packed >> PLACE_BITS, packed & ((1 << PLACE_BITS) - 1)
    first = np.searchsorted(ordered, head_codes)
    times = np.searchsorted(ordered, head_codes, side="right") - first
    at = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
    log, known = np.zeros(len(code)), np.zeros(len(code), bool)
    log[place[at]], known[place[at]] = np.repeat(head_log, times), True
    return log, known


def _pieces(sizes: np.ndarray, window: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts of ``sizes`` bytes, one behind the other, into pieces of ``most`` bytes and ``window`` - 1 of the next.

    The text of each piece; its size; and for all bytes of all pieces: where they stand, and whether they are the
    piece's own, not of the overlap. An empty text has one empty piece.
    """
    parts = np.maximum(-(-sizes // most), 1)
    text = np.repeat(np.arange(len(sizes)), parts)
    begin = (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)) * most
    length = np.minimum(sizes[text] - begin, most + window - 1)
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    take = np.repeat((np.cumsum(sizes) - sizes)[text] + begin, length) + within
    return text, length, take, within < most


def _least(values: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """The least sum of ``window`` neighbours in each of the runs that begin at ``first``."""
    wide = np.concatenate((values, np.zeros(window)))
    return np.minimum.reduceat(sum(wide[k : k + len(values)] for k in range(window)), first)


def _scorer(order: int, text: str, head_codes: np.ndarray, head_log: np.ndarray, window: int, most: int):
    """Per piece of a document: what the head gives, its values around rare n-grams, and each of these with its places."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows are written once, so that a number drawn here stays.
        number = TaskContext.get().partitionId() << 40
        for block in blocks(batches, text, SCORED_BYTES):
            code, owner = codes(block.column(text), order)
            log, known = np.zeros(len(code)), np.zeros(len(code), bool)
            for at in range(0, len(code), 1 << PLACE_BITS):
                part = slice(at, at + (1 << PLACE_BITS))
                log[part], known[part] = _looked_up(code[part], head_codes, head_log)
            whose, length, take, own = _pieces(np.bincount(owner, minlength=block.num_rows), window, most)
            n = len(whose)
            piece = np.repeat(np.arange(n), length)
            # Behind each piece stand ``window`` - 1 certain bytes and a mark that no stretch goes over.
            first = np.cumsum(length) - length + window * np.arange(n)
            at = np.arange(len(take)) + window * piece
            wide, rare = np.zeros(len(at) + window * n), np.zeros(len(at) + window * n, bool)
            wide[at], rare[at] = log[take].astype(np.float32), ~known[take]
            wide[first + length + window - 1] = np.inf
            worst = np.where(length > 0, _least(np.where(rare, np.inf, wide), first, window), 0.0)

            near = rare.copy()
            for k in range(1, window):
                near[k:] |= rare[:-k]
                near[:-k] |= rare[k:]
            # Such a mark behind each run of near places, too.
            mark = np.append(False, near[:-1]) & ~near
            wide[mark] = np.inf
            has_rare = np.add.reduceat(rare, first, dtype=np.int64) > 0 if n else np.zeros(0, bool)
            keep = (near | mark) & np.repeat(has_rare, length + window)
            held = np.add.reduceat(keep, first, dtype=np.int64)
            begin = np.cumsum(held) - held
            raw = wide[keep].astype("<f4").tobytes()
            yield pa.record_batch(
                {
                    "id": block.column("id").take(pa.array(whose)),
                    "piece": number + np.arange(n),
                    "code": pa.nulls(n, pa.int64()),
                    "n": np.bincount(piece[own], minlength=n).astype(np.int64),
                    "log_p": np.bincount(piece[own], weights=log[take][own], minlength=n).astype(np.float64),
                    "worst": worst,
                    "logs": pa.array([raw[4 * b : 4 * (b + h)] if h else None for b, h in zip(begin, held)], pa.binary()),
                    "places": pa.nulls(n, pa.list_(pa.int32())),
                }
            )
            where = np.flatnonzero(~known[take])
            if len(where):
                gram, of = code[take[where]], piece[where]
                place = (np.cumsum(keep) - 1)[at[where]] - begin[of]
                pair = np.lexsort((gram, of))
                gram, of, place, mine = gram[pair], of[pair], place[pair], own[where][pair]
                new = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (of[1:] != of[:-1]))))
                ends = pa.array(np.append(new, len(gram)).astype(np.int32))
                yield pa.record_batch(
                    {
                        "id": pa.nulls(len(new), pa.int64()),
                        "piece": number + of[new],
                        "code": gram[new],
                        "n": np.add.reduceat(mine, new, dtype=np.int64),
                        "log_p": pa.nulls(len(new), pa.float64()),
                        "worst": pa.nulls(len(new), pa.float64()),
                        "logs": pa.nulls(len(new), pa.binary()),
                        "places": pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))),
                    }
                )
            number += n

    return score


def _joiner(window: int):
    """Rows of pieces with all values of their rare n-grams: the least stretch, those with rare n-grams included."""

    def put_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop = np.full(window, np.inf, "<f4").tobytes()
        for whole in batches:
            for cut in range(0, whole.num_rows, 500):
                batch = whole.slice(cut, 500)
                logs = batch.column("logs").to_pylist()
                size = np.array([len(x) // 4 + window for x in logs])
                first = np.cumsum(size) - size
                values = np.frombuffer(b"".join([x + stop for x in logs]), "<f4").astype(np.float64)
                found = batch.column("found")
                places, log_p = found.flatten().flatten()
                times = pc.list_value_length(places).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(logs)), pc.list_value_length(found).to_numpy(zero_copy_only=False))
                at = np.repeat(first[row], times) + places.flatten().to_numpy(zero_copy_only=False)
                values[at] = np.repeat(log_p.to_numpy(zero_copy_only=False).astype(np.float32), times)
                worst = np.minimum(_least(values, first, window), batch.column("worst").to_numpy(zero_copy_only=False))
                yield batch.select(["id", "n_bytes", "log_p"]).append_column("worst", pa.array(worst))

    return put_in


def document_scores(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    head: int = HEAD,
    window: int = WINDOW,
) -> DataFrame:
    """``(id, n_bytes, log_p, worst)`` for each id of ``docs``: bytes of its text, their log-probability and the lowest
    one of ``window`` bytes that stand together (all bytes of a shorter text), to the precision of single floats.

    A null text counts as empty and scores 0 over 0 bytes. Rows that repeat an id are added up, so that copies of
    one text have its perplexity. A null id is an id of its own. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = written(ngram_counts(texts, model.order), "kn-corpus")
    # A heap of ``head`` rows in each task; ties by code, so that the choice is the same in a second run.
    frequent = written(asked.orderBy(F.desc("n"), "code").limit(head).select("code"), "kn-head")
    # As Arrow columns: single rows of them would take the driver fifty times the room.
    top = model.score(frequent).toArrow().sort_by("code")
    rare = written(model.score(asked.join(frequent, "code", "left_anti")), "kn-rare")
    scorer = _scorer(model.order, "text", top["code"].to_numpy(), top["log_p"].to_numpy(), window, PIECE)
    schema = "id long, piece long, code long, n long, log_p double, worst double, logs binary, places array<int>"
    found = written(texts.mapInArrow(scorer, schema), "kn-parts")
    heads = found.filter("code is null").select("id", "piece", F.col("n").alias("n_bytes"), "log_p", "worst", "logs")
    tails = found.filter("code is not null").select("piece", "code", "n", "places").join(rare, "code")
    # Pieces bound the lists.
    tails = tails.groupBy("piece").agg(
        F.sum(F.col("n") * F.col("log_p")).alias("rest"), F.collect_list(F.struct("places", "log_p")).alias("found")
    )
    mixed = heads.filter("logs is not null").join(tails, "piece").withColumn("log_p", F.col("log_p") + F.col("rest"))
    scores = "id long, n_bytes long, log_p double, worst double"
    mixed = mixed.select("id", "n_bytes", "log_p", "worst", "logs", "found").mapInArrow(_joiner(window), scores)
    both = heads.filter("logs is null").select("id", "n_bytes", "log_p", "worst").unionByName(mixed).groupBy("id")
    sums = (F.sum("n_bytes").alias("n_bytes"), F.sum("log_p").alias("log_p"), F.min("worst").alias("worst"))
    return both.agg(*sums).withColumnRenamed("id", id_col)


def perplexity() -> Column:
    """Per byte; null for an empty text."""
    return F.when(F.col("n_bytes") > 0, F.exp(-F.col("log_p") / F.col("n_bytes")))


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    low: float = 0.0,
    high: float = 0.99,
    held_out: int = 4,
    support: int = SUPPORT,
) -> DataFrame:
    """One row per id of ``docs``: id, ``lang``, ``n_bytes``, ``perplexity``, ``surprise`` and ``kept``.

    Trusted are documents that ``labels`` gives quality 1 and toxic not 1 (if several labels: by all of them). One
    in ``held_out`` of them, by a hash of the id, is kept out of the training; its perplexities give each language
    its ``low`` and ``high`` quantile (``low`` 0: no lower bound). ``surprise``, what the least likely ``WINDOW`` bytes
    cost in nats a byte, has a ``high`` quantile of its own. A document is kept if its perplexity lies between those of
    its language and its surprise is not above. The quantile of a few texts says little, so a language's bound is
    the mean of its own quantile, weighed by its held-out texts, and the one over all languages, weighed by ``support``;
    a language without any, or a null one, has those over all languages. Empty and null
    texts have no perplexity and are not kept. Without any trusted document nothing can be judged: every text with
    a byte is kept. Where rows repeat an id they are one document, in the first of their languages.
    """
    known = labels.groupBy(F.col(id_col).cast("long").alias("known")).agg(
        F.min((F.col("quality") == 1) & ~F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("good")
    )
    trusted = small_or_shuffled(known.filter("good").select("known"))
    out = F.pmod(F.xxhash64("known"), F.lit(held_out)) == 0
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    model = train(texts.join(trusted.filter(~out), F.col("id") == F.col("known"), "left_semi"), order)

    langs = docs.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(lang_col).alias("lang"))
    scored = document_scores(texts, model, "id").withColumn("perplexity", perplexity())
    same = F.col("id").eqNullSafe(F.col("of"))
    scored = scored.withColumn("surprise", F.when(F.col("n_bytes") > 0, -F.col("worst") / WINDOW))
    scored = written(scored.join(langs.withColumnRenamed("id", "of"), same).drop("of", "log_p", "worst"), "kn-scores")

    held = scored.join(trusted.filter(out), F.col("id") == F.col("known"), "left_semi").filter("perplexity is not null")
    lowest = F.percentile_approx("perplexity", low, 10_000) if low else F.lit(0.0)
    marks = [lowest.alias("lo"), *(F.percentile_approx(c, high, 10_000).alias(m) for c, m in (("perplexity", "hi"), ("surprise", "top")))]
    by_lang = held.groupBy("lang").agg(*marks, F.count("*").alias("texts")).filter("lang is not null")
    overall = held.agg(*marks).first()

    def bound(mark: str, none: float) -> Column:
        every = F.lit(none if overall[mark] is None else overall[mark])
        own = (F.col("texts") * F.col(mark) + F.lit(support) * every) / (F.col("texts") + F.lit(support))
        return F.coalesce(own, every)

    lo, hi, top = bound("lo", 0.0), bound("hi", float("inf")), bound("top", float("inf"))
    within = (F.col("perplexity") >= lo) & (F.col("perplexity") <= hi) & (F.col("surprise") <= top)
    kept = F.coalesce(within, F.lit(False))
    # Spark picks the join: one row for each language with trusted text.
    judged = scored.join(by_lang, "lang", "left")
    return judged.select(F.col("id").alias(id_col), "lang", "n_bytes", "perplexity", "surprise", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is kept by ``judge_quality``, all columns as they were."""
    kept = judge_quality(docs, labels, id_col, **options).filter("kept").select(F.col(id_col).alias("kept id"))
    own = free_name("id", docs.columns)
    marked = docs.withColumn(own, F.col(id_col).cast("long"))
    return marked.join(kept, F.col(own).eqNullSafe(F.col("kept id")), "left_semi").drop(own)
