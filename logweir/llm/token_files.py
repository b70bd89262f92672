"""Token ids in binary files, each document compressed alone with a dictionary shared by all.

A file set is a folder with three Parquet tables, so that any store Spark writes to will do:

* ``dictionary``: one row with the zstandard dictionary, its SHA-256 and the width of an id in bytes;
* ``data``: blocks of about a megabyte, in ascending order of document ids. ``payload`` holds one zstandard frame
  for each document, one after the other; beside it stand the dictionary's hash and offset, length and number of
  tokens of each frame;
* ``index``: for each document its block, the offset and length of its frame, and ``start``, the number of ids of
  all documents before it. A document is read by one range of one block and the dictionary.

A frame holds little-endian unsigned ids, two bytes each if the vocabulary has at most 65,536 entries, else four.
"""

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweir.llm.tables import written
from logweir.llm.textbytes import blocks

#: The dictionary is trained on so many documents, those with the smallest hash of their id, and up to so many ids of
#: each, in runs from places all over the document.
SAMPLE_DOCS, SAMPLE_IDS, SAMPLE_RUN = 1_000, 4_000, 250
DICTIONARY_BYTES = 64 * 1024
BLOCK_BYTES = 1_000_000
#: Words whose ids a Python worker remembers, in each of two generations.
MEMORY = 400_000
#: Where the tokenizer splits anyway: before points and commas at the end of a word.
POINTS = re.compile(rb"([.,])(?<=[a-z].)(?=[.,]*(?:\s|$))")
#: Stands between words that are encoded in one call. The tokenizer sets it apart from letters and digits, so that
#: its one id shows where the ids of a word end; words with it in them are encoded alone.
BETWEEN = "|"
#: Fixed value of the tokenizer: what a token that ends a run of characters ends with.
WORD_END = "</w>"
JOINED = 1_000
LEVEL = 3


# --- encoding --------------------------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _memory(path: str, width: int) -> list[dict[bytes, bytes]]:
    """Words met of late, and those met before."""
    return [{}, {}]


def _keys(text: str) -> list[bytes]:
    """Pieces of a text that are encoded apart; equal up to ASCII case means equal ids.

    A text that may hold a special token keeps its case, as such tokens are told by it.
    """
    raw = text.encode()
    return raw.split() if b"<|" in raw else POINTS.sub(rb" \1", raw.lower()).split()


def id_width(path: str) -> int:
    return 2 if _tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def encoded(texts: list[str], path: str, width: int, end: int) -> list[bytes]:
    """The ids of each text, the end id last, as little-endian bytes.

    The tokenizer lower-cases, drops white space and merges within words only, so the ids of a text are those of its
    words one after the other. Each word is encoded by the library once and remembered.
    """
    memory = _memory(path, width)
    split = [_keys(t) for t in texts]
    words = {w for ws in split for w in ws}
    if len(memory[0]) + len(words) > MEMORY:
        memory[:] = [{}, memory[0]]
    known, before = memory
    missing = []
    for w in words:
        if w not in known:
            if w in before:
                known[w] = before[w]
            else:
                missing.append(w)
    known.update(zip(missing, _encode_words(missing, path, width), strict=True))
    last = end.to_bytes(width, "little")
    return [b"".join(map(known.__getitem__, ws)) + last for ws in split]


@lru_cache(maxsize=2)
def _last_tokens(path: str) -> np.ndarray:
    """By id, whether a token is one that ends a run of letters; none where the vocabulary does not tell."""
    vocabulary = _tokenizer(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
    return out


def _one_run(word: str) -> bool:
    """Whether the tokenizer takes a word as one run of letters, as it stands."""
    return word.isalpha() and (word.isascii() or (word.lower() == word and is_normalized("NFC", word)))


def _encode_words(words: list[bytes], path: str, width: int) -> list[bytes]:
    """The ids of each word. Calls cost more than words, so many are encoded as one text.

    Where a word ends is told by tokens that end runs of letters, and for words of other characters by ``BETWEEN``,
    which is put between them. What does not come out word by word is encoded alone.
    """
    tokenizer, kind = _tokenizer(path), f"<u{width}"
    mark, last = tokenizer.encode(BETWEEN, add_special_tokens=False).ids, _last_tokens(path)
    text_of = {w: w.decode() for w in words}
    runs = [w for w in words if _one_run(text_of[w])] if last.any() else []
    apart = set(runs)
    others = [w for w in words if w not in apart and BETWEEN not in text_of[w]] if len(mark) == 1 else []
    out: dict[bytes, bytes] = {}
    for chosen, between in ((runs, " "), (others, f" {BETWEEN} ")):
        parts = [chosen[at : at + JOINED] for at in range(0, len(chosen), JOINED)]
        texts = [between.join([text_of[w] for w in part]) for part in parts]
        for part, e in zip(parts, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, kind)
            # Of a mark's id nothing stays; a last token is the word's own.
            skip = chosen is others
            ends = np.append(np.flatnonzero(ids == mark[0]), len(ids)) if skip else np.flatnonzero(last[ids]) + 1
            if len(ends) != len(part):
                continue
            raw, at = ids.tobytes(), 0
            for word, end in zip(part, ends.tolist(), strict=True):
                out[word] = raw[at * width : end * width]
                at = end + skip
    alone = [w for w in words if w not in out]
    for at in range(0, len(alone), 10_000):
        part = alone[at : at + 10_000]
        found = tokenizer.encode_batch_fast([text_of[w] for w in part], add_special_tokens=False)
        out.update((word, np.array(e.ids, kind).tobytes()) for word, e in zip(part, found, strict=True))
    return [out[w] for w in words]


def words_are_apart(path: str) -> bool:
    """Whether the tokenizer splits at white space and before points, drops the space and lower-cases."""
    t = _tokenizer(path)
    if t.encode("Ab.,", add_special_tokens=False).ids != t.encode("ab .,", add_special_tokens=False).ids:
        return False
    probe = ["a", "the", "don't", "x1", "<|", "Ab", "é", "."]
    joined = t.encode(" ".join(probe), add_special_tokens=False).ids
    alone = [i for w in probe for i in t.encode(w, add_special_tokens=False).ids]
    return joined == alone == t.encode("\n".join(probe) + " ", add_special_tokens=False).ids


def _sampler(path: str, width: int, end: int):
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 1_000_000):
            ids = encoded(block.column("text").to_pylist(), path, width, end)
            yield pa.record_batch({"ids": pa.array([_some_ids(x, width) for x in ids], pa.binary())})

    return sample


def _some_ids(ids: bytes, width: int) -> bytes:
    """All ids of a document, or runs of them from evenly spread places, begun at one that its ids decide."""
    n = len(ids) // width
    if n <= SAMPLE_IDS:
        return ids
    runs = SAMPLE_IDS // SAMPLE_RUN
    step = n / runs
    shift = zlib.crc32(ids) / 2**32 * (step - SAMPLE_RUN)
    starts = [int(k * step + shift) * width for k in range(runs)]
    return b"".join(ids[at : at + SAMPLE_RUN * width] for at in starts)


def train_dictionary(texts: DataFrame, path: str, end: int) -> bytes:
    """A zstandard dictionary from a bounded sample of documents; empty if they are too few or too uniform."""
    width = id_width(path)
    # Only ids take part in the choice; texts are read for the chosen ones.
    chosen = texts.select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
    some = texts.join(F.broadcast(chosen.distinct()), "id", "left_semi").select("text")
    rows = some.mapInArrow(_sampler(path, width, end), "ids binary").limit(2 * SAMPLE_DOCS).collect()
    samples = sorted(bytes(r.ids) for r in rows)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _encoder(path: str, width: int, end: int, dictionary: bytes):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
        for block in blocks(batches, "text", 1_000_000):
            ids = encoded(block.column("text").to_pylist(), path, width, end)
            yield pa.record_batch(
                {
                    "id": block.column("id"),
                    "n_tokens": pa.array([len(x) // width for x in ids], pa.int64()),
                    "frame": pa.array([squeeze.compress(x) for x in ids], pa.binary()),
                }
            )

    return encode


# --- writing -----------------------------------------------------------------------------------------------------


def _packer(most: int):
    """Frames in order to blocks; ``part`` is the task, so that part and block give the order of all blocks."""

    def block(n: int, rows: list[tuple]) -> pa.RecordBatch:
        sizes = [len(r[2]) for r in rows]
        at = np.cumsum([0, *sizes[:-1]])
        kind = pa.list_(pa.struct([("id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("n_tokens", pa.int64())]))
        frames = [
            {"id": i, "offset": int(a), "length": s, "n_tokens": k} for (i, k, _), a, s in zip(rows, at, sizes, strict=True)
        ]
        return pa.record_batch(
            {
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "block": pa.array([n], pa.int32()),
                "payload": pa.array([b"".join(r[2] for r in rows)], pa.binary()),
                "frames": pa.array([frames], kind),
            }
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = n = 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("id", "n_tokens", "frame")), strict=True):
                held.append(row)
                size += len(row[2])
                if size >= most:
                    yield block(n, held)
                    held, size, n = [], 0, n + 1
        if held:
            yield block(n, held)

    return pack


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode all texts of ``docs`` and write a file set below ``folder``, documents in ascending order of their ids.

    ``tokenizer`` is the path of a file of the tokenizers library, on every machine. Null texts are empty and have
    the end id alone. Null ids come first; rows that repeat an id follow one another, in any order if their texts
    differ. An empty table gives a file set without documents; other columns are ignored.
    """
    if not words_are_apart(tokenizer):
        raise ValueError("this tokenizer merges over white space or keeps it")
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    width = id_width(tokenizer)
    dictionary = train_dictionary(texts, tokenizer, end)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(bytearray(dictionary), name, width)], "dictionary binary, sha256 string, width int").coalesce(
        1
    ).write.parquet(f"{folder}/dictionary")
    schema = "id long, n_tokens long, frame binary"
    frames = written(texts.mapInArrow(_encoder(tokenizer, width, end, dictionary), schema), "token-frames")
    ordered = frames.repartitionByRange("id").sortWithinPartitions("id")
    frame = "struct<id:long,offset:long,length:long,n_tokens:long>"
    packed = ordered.mapInArrow(_packer(BLOCK_BYTES), f"part int, block int, payload binary, frames array<{frame}>")
    packed = packed.withColumn("dictionary_sha256", F.lit(name))
    # The frames are compressed already.
    packed.write.option("compression", "none").parquet(f"{folder}/data")

    data = spark.read.parquet(f"{folder}/data")
    rows = data.select("part", "block", F.posexplode("frames").alias("slot", "f")).select("part", "block", "slot", "f.*")
    totals = rows.groupBy("part", "block").agg(F.sum("n_tokens").alias("total"))
    parts = totals.groupBy("part").agg(F.sum("total").alias("total"))
    # One row for each part, then one for each block of a part, then one for each document of a block.
    parts = parts.select("part", _before(F.col("total"), Window.orderBy("part")).alias("part_start"))
    in_part = _before(F.col("total"), Window.partitionBy("part").orderBy("block"))
    starts = totals.select("part", "block", in_part.alias("block_start")).join(parts, "part")
    in_block = _before(F.col("n_tokens"), Window.partitionBy("part", "block").orderBy("slot"))
    index = rows.withColumn("in_block", in_block).join(starts, ["part", "block"])
    start = (F.col("part_start") + F.col("block_start") + F.col("in_block")).alias("start")
    index.select("id", "part", "block", "slot", "offset", "length", "n_tokens", start).write.parquet(f"{folder}/index")


def _before(value: Column, window: Window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


# --- reading ------------------------------------------------------------------------------------------------------


def _dictionary(spark: SparkSession, folder: str) -> tuple[bytes, str, int]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    raw = bytes(row.dictionary)
    if hashlib.sha256(raw).hexdigest() != row.sha256:
        raise ValueError(f"the dictionary of {folder} is not the one it was written with")
    return raw, row.sha256, row.width


def _decoder(dictionary: bytes, name: str, width: int):
    """Rows (id, part, block, slot, frame, n_tokens, sha256 of the dictionary) to ids."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        for batch in batches:
            if any(x != name for x in batch.column("dictionary_sha256").unique().to_pylist()):
                raise ValueError("a block was written with another dictionary")
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                raw = [expand.decompress(x) for x in part.column("frame").to_pylist()]
                ids = [np.frombuffer(x, f"<u{width}").astype("<u4") for x in raw]
                if [len(x) for x in ids] != part.column("n_tokens").to_pylist():
                    raise ValueError("a frame has another number of ids than its index says")
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = pa.array(np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64))
                crc = [zlib.crc32(x.tobytes()) for x in ids]
                yield pa.record_batch(
                    {
                        **{k: part.column(k) for k in ("id", "part", "block", "slot", "n_tokens")},
                        "ids": pa.ListArray.from_arrays(pa.array(ends), flat),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    return decode


def _frames(data: DataFrame, asked: Column) -> DataFrame:
    """``asked``: an array of the frames wanted of a block; each is cut out of the payload."""
    rows = data.select("part", "block", "payload", "dictionary_sha256", F.posexplode(asked).alias("slot", "f"))
    frame = F.expr("substring(payload, cast(f.offset + 1 as int), cast(f.length as int))")
    return rows.select("f.id", "part", "block", "slot", "f.n_tokens", frame.alias("frame"), "dictionary_sha256")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, part, block, slot, n_tokens, ids, ids_crc32)`` for every document of a file set."""
    found = _frames(spark.read.parquet(f"{folder}/data"), F.col("frames"))
    schema = "id long, part int, block int, slot int, n_tokens long, ids array<long>, ids_crc32 long"
    return found.mapInArrow(_decoder(*_dictionary(spark, folder)), schema)


def read_documents(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """The same for the documents named, by the index: only blocks that hold one are read."""
    index = spark.read.parquet(f"{folder}/index").filter(F.col("id").isin(ids))
    where = index.select("part", "block", "slot").distinct()
    wanted = spark.read.parquet(f"{folder}/data").join(F.broadcast(where.select("part", "block").distinct()), ["part", "block"], "left_semi")
    schema = "id long, part int, block int, slot int, n_tokens long, ids array<long>, ids_crc32 long"
    frames = _frames(wanted, F.col("frames")).filter(F.col("id").isin(ids))
    return frames.mapInArrow(_decoder(*_dictionary(spark, folder)), schema)
