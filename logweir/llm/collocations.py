"""Phrase collocation mining by direct-address tiling.

Words are numbered by falling frequency, so that the pairs of frequent words lie close together: a square tile of the
table of pairs that is well filled is counted with one ``bincount`` over its cells, and all other pairs are sorted as
coordinates and counted by runs. Pairs that are frequent enough are numbered in their turn, and pairs of such a number
with the next word are counted alike: that makes phrases of three words, then of four.

Texts are cut once into blocks of word numbers. What a block needs to know of the whole corpus are the numbers of its
frequent words and phrases. Their table is sent to the tasks as long as it is within bounds that are checked; a larger one
is joined, and each block gets the rows that it needs, so that no vocabulary has to fit into a task or the driver.
"""

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.tables import BROADCAST_BYTES, written
from logweir.operators.ordered import number_rows
from logweir.operators.skew import fits_broadcast, lookup_join

MIN_COUNT = 30
LONGEST = 4
TOP = 2_000
SCALE = 2_000_000
#: A phrase is covered by a longer one that has at least this percentage of its occurrences.
COVERED = 80
NO_LANG = "und"

#: Bytes of text cut into words at once; words of a block; different words of a block.
SLICE_BYTES = 4 << 20
BLOCK_WORDS = 1_000_000
BLOCK_VOCABULARY = 300_000
#: Side of a tile, the tiles of each side that may be dense, and the least pairs that make one dense.
TILE = 512
DENSE_TILES = 8
DENSE = TILE * TILE // 16
#: Shares of a language's phrases that are ranked apart first.
SALTS = 32
#: Pairs counted at once by a task, and the rows of a batch that it hands on.
AT_ONCE = 2_000_000
BATCH_ROWS = 100_000
#: Rows up to which a table of frequent words or phrases is sent to the tasks; a larger one is joined.
BROADCAST = 1_000_000

_BREAK, _NOTHING = -1, -2
_CUTS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + _CUTS + b"\t", bytes(range(97, 123)) + b"\n" * len(_CUTS) + b" ")


class _Numbers(dict):
    """Numbers words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 2
        return number


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    """``text``, lower-cased and with one kind of cut and blank, in pieces of about ``size`` bytes that end at one."""
    text = text.translate(_TABLE)
    first = 0
    while len(text) - first > size:
        ends = [e for e in (text.find(b" ", first + size), text.find(b"\n", first + size)) if e >= 0]
        if not ends:
            break
        yield text[first : min(ends) + 1]
        first = min(ends) + 1
    yield text[first:]


class _Block:
    """Words of one language as numbers of their own vocabulary; -1 stands between pieces of text."""

    def __init__(self, context: list[bytes]):
        self.numbers = _Numbers({b"": _NOTHING, b"\n": _BREAK})
        self.context = len(context)
        self.found = [np.array([self.numbers[word] for word in context], np.int32)]

    def add(self, text: bytes) -> int:
        tokens = text.replace(b"\n", b" \n ").split(b" ")
        made = np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens))
        made = made[made != _NOTHING]
        self.found.append(made)
        return len(made)

    def end_text(self) -> None:
        self.found.append(np.array([_BREAK], np.int32))

    def last_words(self, n: int) -> list[bytes]:
        """Up to ``n`` words at the end that no cut parts from what may follow."""
        tail = np.zeros(0, np.int32)
        for part in reversed(self.found):
            tail = np.concatenate([part[-n:], tail])[-n:]
            if len(tail) == n:
                break
        tail = tail[np.max(np.flatnonzero(tail == _BREAK), initial=-1) + 1 :]
        words = list(self.numbers)
        return [words[number + 2] for number in tail]

    def row(self, lang: str, block: int) -> dict:
        ids = np.concatenate(self.found)
        new = ids[self.context :]
        counts = np.bincount(new[new >= 0], minlength=len(self.numbers) - 2)
        return {
            "block": block,
            "lang": lang,
            "context": self.context,
            "words": [word.decode() for word in list(self.numbers)[2:]],
            "counts": counts,
            "ids": ids.tobytes(),
        }


_BLOCKS = "block long, lang string, context int, words array<string>, counts array<long>, ids binary"
_ARROW_BLOCKS = pa.schema(
    [
        ("block", pa.int64()),
        ("lang", pa.string()),
        ("context", pa.int32()),
        ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
        ("ids", pa.binary()),
    ]
)


def _cut(batches: Iterator[pa.RecordBatch], longest: int, block_words: int, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a task's texts. A text that spans blocks hands its last words on as context of the next one."""
    open_blocks: dict[str, _Block] = {}
    number, size = TaskContext.get().partitionId() << 32, 0

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal number, size
        for lang, block in open_blocks.items():
            yield pa.RecordBatch.from_pylist([block.row(lang, number)], schema=_ARROW_BLOCKS)
            number += 1
        open_blocks.clear()
        size = 0

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            for piece in _slices(text.as_buffer().to_pybytes() if text.is_valid else b"", slice_bytes):
                if lang not in open_blocks:
                    open_blocks[lang] = _Block([])
                block = open_blocks[lang]
                size += block.add(piece)
                if size >= block_words or len(block.numbers) > BLOCK_VOCABULARY:
                    context = block.last_words(longest - 1)
                    yield from close()
                    open_blocks[lang] = _Block(context)
            open_blocks[lang].end_text()
    yield from close()


def _kind(n: int) -> str:
    """Bytes of numbers below ``n``."""
    return "<i4" if n < 1 << 31 else "<i8"


def _positions(grams: np.ndarray, words: np.ndarray, length: int, context: int) -> np.ndarray:
    """Where a phrase of ``length`` + 1 words begins whose two shorter ones are frequent, and which isn't all context."""
    first = max(context - length, 0)
    last = len(words) - length
    if last <= first:
        return np.zeros(0, np.int64)
    both = (grams[first:last] >= 0) & (grams[first + 1 : last + 1] >= 0)
    return np.flatnonzero(both) + first


def count_pairs(a: np.ndarray, b: np.ndarray, width: int, with_places: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code ``a * width + b`` of each different pair, its count and, if wanted, a place where it stands.

    Pairs of tiles that are filled come first; the others ascend.
    """
    side = TILE * DENSE_TILES
    near = np.flatnonzero((a < side) & (b < side))
    tile = a[near] // TILE * DENSE_TILES + b[near] // TILE
    filled = np.bincount(tile, minlength=DENSE_TILES**2) >= DENSE
    codes, counts, places = [], [], []
    rest = np.ones(len(a), bool)
    for t in np.flatnonzero(filled):
        inside = near[tile == t]
        rest[inside] = False
        cell = a[inside] % TILE * TILE + b[inside] % TILE
        n = np.bincount(cell, minlength=TILE * TILE)
        place = np.zeros(TILE * TILE, np.int64)
        place[cell] = inside
        used = np.flatnonzero(n)
        codes.append((t // DENSE_TILES * TILE + used // TILE) * width + t % DENSE_TILES * TILE + used % TILE)
        counts.append(n[used])
        places.append(place[used])
    del near, tile
    # The arrays of a task's pairs are its memory: one of codes, sorted in place, and one of places if these are wanted.
    left = np.flatnonzero(rest) if with_places else rest
    sparse = a[left].astype(np.int64)
    sparse *= width
    sparse += b[left]
    if with_places:
        order = np.argsort(sparse, kind="stable")
        sparse = sparse[order]
    else:
        sparse.sort()
    new = np.flatnonzero(np.append(True, sparse[1:] != sparse[:-1])) if len(sparse) else np.zeros(0, np.int64)
    if with_places:
        places.append(left[order[new]])
    n = np.diff(np.append(new, len(sparse)))
    return np.concatenate([*codes, sparse[new]]), np.concatenate([*counts, n]), np.concatenate([np.zeros(0, np.int64), *places])


_STREAMS = "block long, context int, grams binary, words binary"


def _stream_rows(table: pa.RecordBatch, kind: str, gram_kind: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for k in range(table.num_rows):
        block, context, grams, words = (table.column(name)[k].as_py() for name in ("block", "context", "grams", "words"))
        found = np.frombuffer(grams, gram_kind)
        # Of single words one column says all.
        yield block, context, found, np.frombuffer(words, kind) if words else found


def _count(batches: Iterator[pa.RecordBatch], length: int, width: int, kind: str, gram_kind: str) -> Iterator[pa.RecordBatch]:
    """Codes of longer phrases and their counts, several blocks at once; beyond pairs with the number of the phrase
    that all but the first word make."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        a, b, *suffix = (np.concatenate(parts) for parts in zip(*held, strict=True))
        held.clear()
        codes, counts, places = count_pairs(a, b, width, bool(suffix))
        del a, b
        for first in range(0, len(codes), BATCH_ROWS):
            part = slice(first, first + BATCH_ROWS)
            columns = {"code": pa.array(codes[part]), "n": pa.array(counts[part])}
            if suffix:
                columns["suffix"] = pa.array(suffix[0][places[part]].astype(np.int64))
            yield pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        for _, context, grams, words in _stream_rows(batch, kind, gram_kind):
            at = _positions(grams, words, length, context)
            rest = (grams[at + 1],) if length > 1 else ()
            held.append((grams[at], words[at + length], *rest))
            size += len(at)
            if size >= AT_ONCE:
                yield from flush()
                size = 0
    if held:
        yield from flush()


def _used(batches: Iterator[pa.RecordBatch], length: int, width: int, kind: str, gram_kind: str) -> Iterator[pa.RecordBatch]:
    """The different codes of each block."""
    for batch in batches:
        for block, _, grams, words in _stream_rows(batch, kind, gram_kind):
            at = _positions(grams, words, length, 0)
            codes, _, _ = count_pairs(grams[at], words[at + length], width, False)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), block)), pa.array(codes)], ["block", "code"])


def _ordered(found: pa.Table, key: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys in ascending order, and their ids."""
    keys, ids = found.column(key).to_numpy(), found.column("id").to_numpy()
    order = np.argsort(keys)
    return keys[order], ids[order]


def _known(sought: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The id of each sought key, or -1."""
    if not len(keys):
        return np.full(len(sought), _BREAK, np.int64)
    place = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
    return np.where(keys[place] == sought, ids[place], _BREAK)


_ARROW_STREAMS = pa.schema([("block", pa.int64()), ("context", pa.int32()), ("grams", pa.binary()), ("words", pa.binary())])


def _stream(block: int, context: int, grams: bytes, words: bytes) -> pa.RecordBatch:
    row = {"block": block, "context": context, "grams": grams, "words": words}
    return pa.RecordBatch.from_pylist([row], schema=_ARROW_STREAMS)


def _closed_up(numbers: np.ndarray, context: int) -> np.ndarray:
    """One mark for each run of words that are not frequent. The context stays as it is."""
    keep = (numbers >= 0) | np.append(True, numbers[:-1] >= 0)
    keep[:context] = True
    return numbers[keep]


def _number_words(batches: Iterator[pa.RecordBatch], known: pa.Table, kind: str) -> Iterator[pa.RecordBatch]:
    """Blocks' own numbers of words turned into those of the corpus; -1 for words that are not frequent."""
    of: dict[str, dict[str, int]] = {}
    for lang, word, number in zip(*(known.column(c).to_pylist() for c in ("lang", "word", "id")), strict=True):
        of.setdefault(lang, {})[word] = number
    for batch in batches:
        for k in range(batch.num_rows):
            block, lang, context, words, ids = (batch.column(c)[k].as_py() for c in ("block", "lang", "context", "words", "ids"))
            ask = of.get(lang, {}).get
            # The mark of a cut, -1, takes the last place.
            numbers = np.array([*(ask(word, _BREAK) for word in words), _BREAK], np.int64)
            made = _closed_up(numbers[np.frombuffer(ids, np.int32)], context).astype(kind).tobytes()
            yield _stream(block, context, made, b"")


def _number_found_words(blocks: pa.Table, found: pa.Table, kind: str) -> pa.RecordBatch:
    """The same for one block and what joins have found for its words."""
    row = {name: blocks.column(name)[0].as_py() for name in ("block", "context", "ids")}
    ids = np.frombuffer(row["ids"], np.int32).astype(np.int64)
    made = _closed_up(_known(ids, *_ordered(found, "local")), row["context"])
    return _stream(row["block"], row["context"], made.astype(kind).tobytes(), b"")


def _number_phrases(
    batches: Iterator[pa.RecordBatch], known: tuple[np.ndarray, np.ndarray], length: int, width: int, kind: str, old: str, new: str
) -> Iterator[pa.RecordBatch]:
    """The numbers of the phrases of ``length`` + 1 words that begin at each place of a block, or -1."""
    for batch in batches:
        for block, context, grams, words in _stream_rows(batch, kind, old):
            at = _positions(grams, words, length, 0)
            out = np.full(len(words), _BREAK, np.int64)
            out[at] = _known(grams[at].astype(np.int64) * width + words[at + length], *known)
            # What no longer phrase can be made of is left out, and takes no room. The last place of each run that stays
            # has no number, so none begins there that goes on in the next run.
            longer = _positions(out, words, length + 1, 0)
            left, after = np.full(len(words), _BREAK, np.int64), np.full(len(words), _BREAK, np.int64)
            for k in (longer, longer + 1):
                left[k] = out[k]
            after[longer + length + 1] = words[longer + length + 1]
            keep = np.zeros(len(words), bool)
            keep[: max(context, 1)] = True
            for k in range(length + 2):
                keep[longer + k] = True
            yield _stream(block, context, left[keep].astype(new).tobytes(), after[keep].astype(kind).tobytes())


def _number_found_phrases(streams: pa.Table, found: pa.Table, **how) -> pa.RecordBatch:
    """The same for one block and what joins have found for its phrases."""
    [made] = _number_phrases(streams.combine_chunks().to_batches(), _ordered(found, "code"), **how)
    return made


def _by_block(blocks: DataFrame, found: DataFrame, make: Callable[[pa.Table, pa.Table], pa.RecordBatch]) -> DataFrame:
    """``make`` of each block and the rows found for it. Both are as large as the block at most."""

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches([make(left, right)])

    # A name of its own keeps the two apart, as both come from the same blocks.
    found = found.withColumn("of", F.col("block") + 0).drop("block")
    return blocks.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(one, _STREAMS)


def _word_streams(blocks: DataFrame, local: DataFrame, vocabulary: DataFrame, kind: str) -> DataFrame:
    """The blocks in numbers of the corpus. A vocabulary within bounds goes to the tasks, another one to the blocks."""
    known = vocabulary.select("lang", "word", "id")
    if fits_broadcast(known, BROADCAST, BROADCAST_BYTES):
        number = partial(_number_words, known=known.toArrow(), kind=kind)
        return blocks.select("block", "lang", "context", "words", "ids").mapInArrow(number, _STREAMS)
    found = local.join(known, ["lang", "word"]).select("block", "local", "id")
    return _by_block(blocks.select("block", "context", "ids"), found, partial(_number_found_words, kind=kind))


def _phrase_streams(streams: DataFrame, grams: DataFrame, how: dict, old: str, new: str) -> DataFrame:
    """The blocks with numbers of longer phrases, got in the same two ways."""
    known = grams.select("code", "id")
    if fits_broadcast(known, BROADCAST, BROADCAST_BYTES):
        number = partial(_number_phrases, known=_ordered(known.toArrow(), "code"), **how, old=old, new=new)
        return streams.mapInArrow(number, _STREAMS)
    used = streams.mapInArrow(partial(_used, **how, gram_kind=old), "block long, code long")
    found = used.join(known, "code").select("block", "code", "id")
    return _by_block(streams, found, partial(_number_found_phrases, **how, old=old, new=new))


def _ranked(counts: DataFrame, order: list[str], label: str) -> tuple[DataFrame, int]:
    """``counts`` with an ``id`` from 0 by falling ``n``, and how many there are."""
    # Ranges are drawn from a first look at the rows, so these are written before they are put in order.
    counts = written(counts, label)
    ranked = number_rows(counts.withColumn("minus", -F.col("n")), ["minus", *order], "id").drop("minus")
    ranked = written(ranked.withColumn("id", F.col("id") - 1), label)
    return ranked, ranked.count()


def cut_score(a: Column, left: Column, right: Column, scale: int = SCALE) -> Column:
    """floor(scale * a / (left + right)) without overflow."""
    wide = "decimal(20,0)"
    return F.call_function("div", a.cast(wide) * F.lit(scale).cast(wide), left.cast(wide) + right.cast(wide))


def _with_parts(grams: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases with their words and the counts of what each cut leaves before it and behind it."""
    parts = ["phrase", "last", "n", "before", "behind"]
    first = shorter.select(F.col("id").alias("prefix"), "lang", *(F.col(c).alias(f"p_{c}") for c in parts))
    rest = shorter.select(F.col("id").alias("suffix"), *(F.col(c).alias(f"s_{c}") for c in parts))
    both = lookup_join(lookup_join(grams, first, ["prefix"], "inner", ["id"]), rest, ["suffix"], "inner", ["id"])
    return both.select(
        "id",
        "prefix",
        "suffix",
        "n",
        "lang",
        F.concat_ws(" ", "p_phrase", "s_last").alias("phrase"),
        F.col("s_last").alias("last"),
        F.concat("p_before", F.array("p_n")).alias("before"),
        F.concat(F.array("s_n"), "s_behind").alias("behind"),
    )


def _scored(grams: DataFrame, longer: DataFrame | None, covered: int, scale: int) -> DataFrame:
    """Candidates that no longer one covers, with their lowest cut.

    A phrase of two words more that covers a candidate has one in it of one word more that does so too, and is
    frequent like it, so only phrases of one word more are looked at.
    """
    if longer is not None:
        sides = longer.select(F.col("prefix").alias("id"), "n").unionByName(longer.select(F.col("suffix").alias("id"), "n"))
        most = sides.groupBy("id").agg(F.max("n").alias("most"))
        wide = "decimal(20,0)"
        hidden = F.col("most").cast(wide) * 100 >= F.col("n").cast(wide) * covered
        grams = grams.join(most, "id", "left").filter(~F.coalesce(hidden, F.lit(False)))
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("before")),
        lambda k: F.struct(
            cut_score(F.col("n"), F.get("before", k - 1), F.get("behind", k - 1), scale).alias("score"),
            k.alias("k"),
            F.get("before", k - 1).alias("l"),
            F.get("behind", k - 1).alias("r"),
        ),
    )
    best = grams.withColumn("best", F.array_min(cuts))
    return best.select("lang", "phrase", F.col("n").alias("a"), "best.l", "best.r", "best.score")


def mine_collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    longest: int = LONGEST,
    covered: int = COVERED,
    scale: int = SCALE,
    block_words: int = BLOCK_WORDS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of each language.

    Texts are lower-cased in A to Z, cut at ``.,;:!?`` and line ends into pieces, and those at spaces and tabs into
    words. A phrase has 2 to ``longest`` words of one piece; ``a`` counts all its occurrences and is at least
    ``min_count``; ``n`` counts all words of the language. A cut into two parts with counts l and r scores floor(``scale``
    * a / (l + r)); the lowest score counts, the earliest cut among equals. A phrase is left out if a longer one around
    it has at least ``covered`` percent of its occurrences. Ranks go by score, then a, falling, then by the bytes of
    the phrase. A null language is ``und``, together with rows that are called so; a null text is empty; repeated rows
    count each time; an empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.coalesce(lang_col, F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text"))
    cut = partial(_cut, longest=longest, block_words=block_words, slice_bytes=slice_bytes)
    blocks = written(texts.mapInArrow(cut, _BLOCKS), "phrase-blocks")
    local = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "entry"))
    local = local.select("block", "lang", F.col("local").cast("long").alias("local"), F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"))
    totals = local.groupBy("lang").agg(F.sum("n").alias("n"))
    vocabulary = local.groupBy("lang", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    vocabulary, width = _ranked(vocabulary, ["lang", "word"], "phrase-words")
    kind = _kind(width)

    streams = written(_word_streams(blocks, local, vocabulary, kind), "phrase-streams")
    shorter = vocabulary.select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "n", F.array().cast("array<long>").alias("before"), F.array().cast("array<long>").alias("behind")
    )
    levels, gram_kind = [], kind
    for length in range(1, longest):
        how = {"length": length, "width": width, "kind": kind}
        # Counts are added up in the tasks already: dealt out as they come, sorted, they take the least room.
        schema = "code long, n long" if length == 1 else "code long, n long, suffix long"
        counted = streams.mapInArrow(partial(_count, **how, gram_kind=gram_kind), schema).repartition("code")
        suffix = F.max("suffix") if length > 1 else F.first(F.col("code") % max(width, 1))
        counted = counted.groupBy("code").agg(suffix.alias("suffix"), F.sum("n").alias("n")).filter(F.col("n") >= min_count)
        grams, n_grams = _ranked(counted, ["code"], "phrase-grams")
        grams = grams.withColumn("prefix", F.expr(f"code div {max(width, 1)}L"))
        if length + 1 < longest:
            new_kind = _kind(n_grams)
            streams = written(_phrase_streams(streams, grams, how, gram_kind, new_kind), "phrase-streams")
            gram_kind = new_kind
        shorter = written(_with_parts(grams.drop("code"), shorter), "phrase-parts")
        levels.append(shorter)
    made = [_scored(grams, longer, covered, scale) for grams, longer in zip(levels, [*levels[1:], None], strict=True)]
    # The first of each salt, then of each language: no task sorts all phrases of one.
    salt, order = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)), [F.desc("score"), F.desc("a"), F.col("phrase")]
    first = reduce(DataFrame.unionByName, made).withColumn("salt", salt)
    for keys in (["lang", "salt"], ["lang"]):
        first = first.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return lookup_join(first, totals, ["lang"], "inner", ["rank"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
