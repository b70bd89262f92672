"""SentencePiece encoding and decoding with a max-plus parallel scan for giant documents.

Encoding finds the segmentation into vocabulary pieces with the largest sum of scores. A document longer than a chunk
is cut anywhere; a *state* at a cut is the number of characters that a piece reaches over it. What a chunk does to
states is a max-plus matrix: entry (i, j) is the best score of a way that enters with i characters taken by the piece
before and leaves with j characters taken from the next chunk. Matrices combine associatively, which gives each chunk
its two states; then each is traced back alone. Scores are whole numbers, so sums do not depend on the cuts.

Where no piece of the vocabulary has a space within, no way crosses the beginning of a word. The stretch between the
first and the last such place in a chunk is a sum over words, whose best segmentations are remembered.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import written
from logweir.llm.textbytes import blocks, bytes_of

#: Fixed value of the file format: the sign for a space.
SPACE = "▁"
CHUNK = 32_768
#: Scores are thousandths of natural logarithms.
UNIT = 1000
#: A byte of a character that no piece has costs as much as the rarest piece and so much more.
BYTE_PENALTY = 10 * UNIT
#: Words whose segmentations a Python worker remembers, in each of two generations.
MEMORY = 100_000
#: Words of up to so many characters are segmented together; so many of them at once.
SHORT, AT_ONCE = 64, 8_000
#: How far before its end a chunk looks for a place that no piece crosses.
LOOK_BACK = 4096
#: Chunks of a batch that are Python values at the same time, and ids that are decoded at once.
CHUNKS_AT_ONCE, IDS_AT_ONCE = 8, 200_000


# --- the vocabulary -------------------------------------------------------------------------------------------------


@dataclass(frozen=True, eq=False)
class Vocabulary:
    scores: dict[str, tuple[int, int]]  # piece: (score, id)
    byte_ids: list[int]
    byte_score: int
    longest: int
    text_of: list[bytes]
    apart: bool  # no piece has a space sign after another character
    memory: list[dict[str, bytes]]  # ids of words met of late, and of those met before

    def fallback(self, char: str) -> tuple[int, list[int]]:
        ids = [self.byte_ids[b] for b in char.encode()]
        return self.byte_score * len(ids), ids


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Pieces of a model file. Where its scores are ranks of merges (0, -1, -2, ...), not logarithms, a piece's score
    is that of a frequency inverse to its rank."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    raw = {i: model.get_score(i) for i in plain}
    ranks = all(s <= 0 and s == int(s) for s in raw.values())
    value = {i: round(UNIT * (-log(10 - s) if ranks else s)) for i, s in raw.items()}
    scores = {model.id_to_piece(i): (value[i], i) for i in plain}
    # Without byte pieces a character that no piece has is the unknown piece.
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    text = [b""] * n
    for i in plain:
        text[i] = model.id_to_piece(i).replace(SPACE, " ").encode()
    for b, i in enumerate(byte_ids):
        if model.is_byte(i):
            text[i] = bytes([b])
    apart = all(SPACE not in p.lstrip(SPACE) for p in scores)
    lowest = min(value.values(), default=0)
    return Vocabulary(scores, byte_ids, lowest - BYTE_PENALTY, max(map(len, scores), default=1), text, apart, [{}, {}])


CODE_BITS = 21
_EMPTY = np.int64(-1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Trie:
    """The pieces as a tree of characters, its branches in a table that many places ask at once.

    A branch is told by its node and character together, so that nothing else is taken for it.
    """

    def __init__(self, pieces: dict[str, tuple[int, int]]):
        branches: dict[tuple[int, int], int] = {}
        self.score, self.id = [0], [-1]
        for piece, (score, number) in pieces.items():
            node = 0
            for char in piece:
                key = (node, ord(char))
                if key not in branches:
                    branches[key] = len(self.id)
                    self.score.append(0)
                    self.id.append(-1)
                node = branches[key]
            self.score[node], self.id[node] = score, number
        self.score, self.id = np.array(self.score, np.int64), np.array(self.id, np.int64)
        self.shift = np.uint64(64 - max(4, int(4 * len(branches) + 1).bit_length()))
        size = 1 << (64 - int(self.shift))
        # Room behind the end for branches that find their own place taken.
        self.keys, self.nodes = np.full(size + 4096, _EMPTY), np.zeros(size + 4096, np.int64)
        for (node, char), child in branches.items():
            key = (node << CODE_BITS) | char
            at = int(self._slots(np.array([key]))[0])
            while self.keys[at] != _EMPTY:
                at += 1
            self.keys[at], self.nodes[at] = key, child

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def children(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The node that each character leads to, or -1."""
        keys = (nodes << CODE_BITS) | chars
        slots = self._slots(keys)
        there = self.keys[slots]
        hit = there == keys
        out = np.where(hit, self.nodes[slots], -1)
        # Most are settled by the first look.
        left = np.flatnonzero(~hit & (there != _EMPTY))
        while len(left):
            slots[left] += 1
            there = self.keys[slots[left]]
            hit = there == keys[left]
            out[left[hit]] = self.nodes[slots[left[hit]]]
            left = left[~hit & (there != _EMPTY)]
        return out


@lru_cache(maxsize=4)
def _trie(v: Vocabulary) -> Trie:
    return Trie(v.scores)


@lru_cache(maxsize=4)
def _score_of(v: Vocabulary) -> np.ndarray:
    """The score of each id; one that is no piece's stands for a byte."""
    out = np.full(max([*v.byte_ids, *(i for _, i in v.scores.values())]) + 1, v.byte_score, np.int64)
    for score, i in v.scores.values():
        out[i] = score
    return out


# --- segmentation ---------------------------------------------------------------------------------------------------


def _best(v: Vocabulary, text: str, enter: int, n: int) -> tuple[list[int | None], list[int]]:
    """Best scores from ``enter`` to each place, and where their last piece begins; pieces begin before ``n``.

    A character that is no piece goes on by its bytes.
    """
    best: list[int | None] = [None] * (len(text) + 1)
    came = [0] * (len(text) + 1)
    best[enter] = 0
    piece, size = v.scores.get, len(text)
    for at in range(enter, n):
        here = best[at]
        if here is None:
            continue
        for end in range(at + 1, min(at + v.longest, size) + 1):
            found = piece(text[at:end])
            if found:
                score = here + found[0]
            elif end == at + 1:
                score = here + v.fallback(text[at])[0]
            else:
                continue
            before = best[end]
            if before is None or score > before:
                best[end], came[end] = score, at
    return best, came


def _ids(v: Vocabulary, text: str, came: list[int], enter: int, leave: int) -> list[int]:
    out, at = [], leave
    while at > enter:
        piece = text[came[at] : at]
        out.append([v.scores[piece][1]] if piece in v.scores else v.fallback(piece)[1])
        at = came[at]
    return [i for ids in reversed(out) for i in ids]


WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def segment(v: Vocabulary, text: str) -> tuple[int, bytes]:
    """Score and ids (four bytes each) of a text whose spaces are signs already."""
    return segment_all(v, [text])[0]


def segment_all(v: Vocabulary, texts: list[str]) -> list[tuple[int, bytes]]:
    """``segment`` of each text; words that were not met before are segmented together."""
    if not v.apart:
        return [_segment(v, t) for t in texts]
    split = [WORD.findall(t) for t in texts]
    words = set().union(*split)
    if len(v.memory[0]) + len(words) > MEMORY:
        v.memory[:] = [{}, v.memory[0]]
    known, before = v.memory
    new = words.difference(known)
    met = [w for w in new if w in before]
    known.update(zip(met, map(before.__getitem__, met), strict=True))
    # Long and short ones apart, so that few steps are made for a few words.
    missing = sorted(new.difference(met), key=len)
    while missing and len(missing[-1]) > SHORT:
        word = missing.pop()
        known[word] = _segment(v, word)[1]
    for at in range(0, len(missing), AT_ONCE):
        part = missing[at : at + AT_ONCE]
        known.update(zip(part, _word_ids(v, part), strict=True))
    return _scored(v, [b"".join(map(known.__getitem__, ws)) for ws in split])


def _scored(v: Vocabulary, ids: list[bytes]) -> list[tuple[int, bytes]]:
    """Ids of texts with their scores."""
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
    sums = np.cumsum(np.concatenate(([0], _score_of(v)[np.frombuffer(b"".join(ids), "<u4")])))
    return list(zip((sums[ends[1:]] - sums[ends[:-1]]).tolist(), ids, strict=True))


def _segment_words(v: Vocabulary, words: list[str]) -> list[tuple[int, bytes]]:
    """``_segment`` of many words at once."""
    return _scored(v, _word_ids(v, words))


def _word_ids(v: Vocabulary, words: list[str]) -> list[bytes]:
    """The ids of many words' best segmentations, found together, place by place.

    All places of all words go down the tree of pieces together, until no piece goes on; then the programme takes the
    pieces by where they begin within their word. Of equal scores the earliest beginning stays, as for one word.
    """
    trie = _trie(v)
    size = np.fromiter(map(len, words), np.int64, len(words))
    chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    begin = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    end = (begin + size)[word]
    at, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
    # Small numbers are sorted in less time.
    within = (at - begin[word]).astype(np.min_scalar_type(int(size.max())))
    # Word k has its places, one more than it has characters, from begin[k] + k on.
    places = at + word
    starts, lengths, nodes = [], [], []
    for length in range(1, v.longest + 1):
        node = trie.children(node, chars[at + length - 1])
        if length == 1:
            # A character that is no piece goes on by its bytes.
            other = at[(node < 0) | (trie.id[node] < 0)]
            starts.append(other)
            nodes.append(np.zeros(len(other), np.int64))
            lengths.append(np.ones(len(other), np.int64))
        on = node >= 0
        at, node = at[on], node[on]
        whole = trie.id[node] >= 0
        starts.append(at[whole])
        nodes.append(node[whole])
        lengths.append(np.full(len(starts[-1]), length))
        more = at + length < end[at]
        at, node = at[more], node[more]
        if not len(at):
            break
    start, length, node = (np.concatenate(x) for x in (starts, lengths, nodes))
    order = np.argsort(within[start], kind="stable")
    start, length, node = start[order], length[order], node[order]
    # The root is no piece and stands for bytes.
    number = trie.id[node]
    score = np.where(number < 0, v.byte_score * _n_bytes(chars[start]), trie.score[node])
    here = places[start]
    there = here + length
    best, came = np.full(len(chars) + len(words), np.iinfo(np.int64).min // 2), np.zeros(len(chars) + len(words), np.int64)
    first = begin + np.arange(len(words))
    best[first] = 0
    # Pieces that begin at the same place of a word end at different ones.
    cuts = [0, *np.cumsum(np.bincount(within[start])).tolist()]
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        made = best[here[i:j]] + score[i:j]
        better = np.flatnonzero(made > best[there[i:j]])
        to = there[i:j][better]
        best[to], came[to] = made[better], better + i
    # Back from the ends, all words at once.
    place, on, taken = first + size, np.arange(len(words)), []
    while len(on):
        edge = came[place[on]]
        taken.append((on, edge))
        place[on] = here[edge]
        on = on[place[on] > first[on]]
    owner, edge = (np.concatenate(x) for x in zip(*taken, strict=True))
    # The last pieces were taken first.
    owner, edge = owner[::-1], edge[::-1]
    order = np.argsort(owner.astype(np.min_scalar_type(len(words))), kind="stable")
    owner, edge = owner[order], edge[order]
    # A character that is no piece takes an id for each of its bytes.
    number, char = number[edge], chars[start[edge]]
    other = number < 0
    times = np.where(other, _n_bytes(char), 1)
    owner, number = np.repeat(owner, times), np.repeat(number, times)
    data = char[other].astype("<u4").tobytes().decode("utf-32-le").encode()
    number[np.repeat(other, times)] = np.array(v.byte_ids)[np.frombuffer(data, np.uint8)]
    ends = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
    raw = number.astype("<u4").tobytes()
    return list(map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)))


def _n_bytes(chars: np.ndarray) -> np.ndarray:
    """Bytes of characters in UTF-8."""
    return 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)


def _segment(v: Vocabulary, text: str) -> tuple[int, bytes]:
    best, came = _best(v, text, 0, len(text))
    return best[-1] or 0, np.array(_ids(v, text, came, 0, len(text)), "<u4").tobytes()


def _safe(v: Vocabulary, text: str, n: int) -> tuple[int, int] | None:
    """First and last place below ``n`` that no piece crosses: a space sign after another character."""
    if not v.apart:
        return None
    first = re.search(f"(?<=[^{SPACE}]){SPACE}", text[:n])
    if not first:
        return None
    last = first.start()
    for m in re.finditer(f"(?<=[^{SPACE}]){SPACE}", text[max(first.start() - 1, n - 4096) : n]):
        last = max(last, m.start() + max(first.start() - 1, n - 4096))
    return first.start(), last


def transfer(v: Vocabulary, chunk: str, ahead: str) -> dict[tuple[int, int], int]:
    """The matrix of a chunk, without the entries that no way has. ``ahead``: the characters behind it."""
    text, n = chunk + ahead, len(chunk)
    out = {}
    safe = _safe(v, text, n)
    if safe:
        first, last = safe
        leaves = _best(v, text[last:], 0, n - last)[0]
        middle = segment(v, text[first:last])[0]
    for enter in range(min(v.longest, n)):
        if safe:
            if enter > first:
                break
            head = _best(v, text[:first], enter, first)[0][first]
            ends = {n + j: None if leaves[n - last + j] is None else head + middle + leaves[n - last + j] for j in range(len(text) - n + 1)}
        else:
            best = _best(v, text, enter, n)[0]
            ends = {n + j: best[n + j] for j in range(len(text) - n + 1)}
        out |= {(enter, at - n): s for at, s in ends.items() if s is not None and at - n < v.longest}
    # A chunk shorter than the piece that enters it lies within that piece.
    out |= {(enter, enter - n): 0 for enter in range(n, v.longest) if enter - n <= len(ahead)}
    return out


def combine(a: dict[tuple[int, int], int], b: dict[tuple[int, int], int]) -> dict[tuple[int, int], int]:
    """Max-plus product of two sparse matrices."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for (k, j), s in b.items():
        rows.setdefault(k, []).append((j, s))
    out: dict[tuple[int, int], int] = {}
    for (i, k), s in a.items():
        for j, t in rows.get(k, ()):
            if s + t > out.get((i, j), s + t - 1):
                out[i, j] = s + t
    return out


def states(matrices: list[dict[tuple[int, int], int]]) -> tuple[int, list[tuple[int, int]]]:
    """Score of a document, and the states in which each of its chunks is entered and left."""
    sums = [{(0, 0): 0}]
    for m in matrices:
        sums.append(combine(sums[-1], m))
    j, ways = 0, []
    for m, before in zip(reversed(matrices), reversed(sums[:-1]), strict=True):
        i = max((i for (_, i) in before if (i, j) in m), key=lambda i: (before[0, i] + m[i, j], -i))
        ways.append((i, j))
        j = i
    return sums[-1][0, 0], ways[::-1]


def trace(v: Vocabulary, chunk: str, ahead: str, enter: int, leave: int) -> np.ndarray:
    """Ids of the pieces that begin in a chunk, on the best way between two states."""
    text, n = chunk + ahead, len(chunk)
    if enter >= n:
        return np.zeros(0, "<u4")
    safe = _safe(v, text, n)
    if not safe:
        return np.array(_ids(v, text, _best(v, text, enter, n)[1], enter, n + leave), "<u4")
    first, last = safe
    head = np.array(_ids(v, text[:first], _best(v, text[:first], enter, first)[1], enter, first), "<u4")
    middle = np.frombuffer(segment(v, text[first:last])[1], "<u4")
    rest = text[last:]
    return np.concatenate([head, middle, np.array(_ids(v, rest, _best(v, rest, 0, n - last)[1], 0, n - last + leave), "<u4")])


# --- tasks ----------------------------------------------------------------------------------------------------------------


def signed(text: str) -> str:
    """A text as pieces see it: a space sign first and for each space."""
    return SPACE + text.replace(" ", SPACE)


def _id_lists(raw: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in raw)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), "<i4")))


def _encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for block in blocks(batches, "text", 400_000):
            found = segment_all(v, [signed(t) for t in block.column("text").to_pylist()])
            score = pa.array([f[0] for f in found], pa.int64())
            yield pa.record_batch({"id": block.column("id"), "score": score, "ids": _id_lists([f[1] for f in found])})

    return encode


def _ends(v: Vocabulary, text: str, chunk: int) -> list[int]:
    """Where the chunks of a text end: at the last place near ``chunk`` that no piece crosses, if there is one."""
    ends, at = [], 0
    while len(text) - at > chunk:
        end = at + chunk
        low = max(at + 1, end - LOOK_BACK)
        safe = [m.start() for m in re.finditer(f"(?<=[^{SPACE}]){SPACE}", text[low - 1 : end + 1])] if v.apart else []
        at = low - 1 + safe[-1] if safe else end
        ends.append(at)
    return [*ends, len(text)]


def _chunker(path: str, chunk: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        ahead = v.longest - 1
        for block in blocks(batches, "text", 1_000_000):
            for i, t in zip(block.column("id").to_pylist(), block.column("text").to_pylist(), strict=True):
                text, key = signed(t), uuid4().hex
                ends = _ends(v, text, chunk)
                at = [0, *ends[:-1]]
                yield pa.record_batch(
                    {
                        "id": pa.array([i] * len(at), pa.int64()),
                        "key": pa.array([key] * len(at)),
                        "no": pa.array(range(len(at)), pa.int32()),
                        "part": pa.array([text[k:end] for k, end in zip(at, ends, strict=True)]),
                        "ahead": pa.array([text[end : end + ahead] for end in ends]),
                    }
                )

    return cut


ENTRY = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("s", pa.int64())]))


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds a few chunks, as a batch may be all of a task."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNKS_AT_ONCE):
            yield batch.slice(at, CHUNKS_AT_ONCE)


def _transferrer(path: str):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in _few(batches):
            pairs = zip(batch.column("part").to_pylist(), batch.column("ahead").to_pylist(), strict=True)
            made = [[{"i": i, "j": j, "s": s} for (i, j), s in transfer(v, p, a).items()] for p, a in pairs]
            yield batch.select(["key", "no"]).append_column("entries", pa.array(made, ENTRY))

    return make


def _scanner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            key, chunks = batch.column("key")[row].as_py(), batch.column("chunks")[row].as_py()
            score, ways = states([{(e["i"], e["j"]): e["s"] for e in c["entries"]} for c in chunks])
            yield pa.record_batch(
                {
                    "key": pa.array([key] * len(ways)),
                    "no": pa.array([c["no"] for c in chunks], pa.int32()),
                    "enter": pa.array([i for i, _ in ways], pa.int32()),
                    "leave": pa.array([j for _, j in ways], pa.int32()),
                    "score": pa.array([score] * len(ways), pa.int64()),
                }
            )


def _tracer(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in _few(batches):
            rows = zip(*(batch.column(k).to_pylist() for k in ("part", "ahead", "enter", "leave")), strict=True)
            ids = _id_lists([trace(v, *r).tobytes() for r in rows])
            yield batch.select(["id", "key", "no", "score"]).append_column("ids", ids)

    return run


def _of_ids(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has 200 rows and ``IDS_AT_ONCE`` ids at most, or a single row."""
    ends = np.cumsum([0, *batch.column("ids").value_lengths().to_numpy().tolist()])
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(ends, ends[at] + IDS_AT_ONCE, side="right")) - 1
        end = min(max(end, at + 1), at + 200, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def _decoder(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = pa.array(vocabulary(path).text_of, pa.large_binary())
        for batch in batches:
            for part in _of_ids(batch):
                lists = part.column("ids")
                flat = lists.flatten()
                ends = np.cumsum([0, *lists.value_lengths().to_numpy().tolist()])
                raw_ids = flat.to_numpy().astype("<u4").tobytes()
                # Bytes of all pieces one behind the other, and where each piece ends.
                data, places = bytes_of(text_of.take(flat))
                raw, edge = data.tobytes(), places[ends]
                crc = [zlib.crc32(raw_ids[4 * i : 4 * j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
                text = [raw[i:j][1:].decode("utf-8", "replace") for i, j in zip(edge[:-1], edge[1:], strict=True)]
                yield part.append_column("ids_crc32", pa.array(crc, pa.int64())).append_column("text", pa.array(text, pa.string()))

    return decode


# --- the whole operator ------------------------------------------------------------------------------------------------------


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: id, ``score`` and ``ids`` of the best segmentation of the whole text.

    ``model`` is the path of a SentencePiece model file, on every machine. Spaces become space signs and one stands
    before the text, so a null or empty text is that sign alone. A character without a piece of its own is encoded
    by its bytes. Of equally good segmentations of a word the one with the longest last piece is taken, and so on
    backwards, whatever the chunks; only within a word longer than ``chunk`` the choice depends on where it is cut.
    Repeated rows give equal rows, an empty table gives none; other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    giant = F.char_length("text") >= chunk
    short = texts.filter(~giant).mapInArrow(_encoder(model), "id long, score long, ids array<int>")
    # A key for each row is drawn here and written, as ids need not be unique.
    cut = texts.filter(giant).mapInArrow(_chunker(model, chunk), "id long, key string, no int, part string, ahead string")
    parts = written(cut, "piece-chunks")
    spread = parts.repartition("key", "no")
    made = spread.mapInArrow(_transferrer(model), "key string, no int, entries array<struct<i:int,j:int,s:long>>")
    whole = made.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("no", "entries"))).alias("chunks"))
    found = whole.mapInArrow(_scanner, "key string, no int, enter int, leave int, score long")
    traced = parts.join(found, ["key", "no"]).mapInArrow(_tracer(model), "id long, key string, no int, score long, ids array<int>")
    long = traced.groupBy("key").agg(
        F.first("id").alias("id"), F.first("score").alias("score"), F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("p")
    )
    long = long.select("id", "score", F.flatten(F.col("p.ids")).alias("ids"))
    return short.unionByName(long).withColumnRenamed("id", id_col)


def decode_pieces(encoded: DataFrame, model: str, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``encode_pieces`` with ``text`` and ``ids_crc32``, the checksum of the ids as four bytes each.

    The text is the one encoded, but that space signs in it have become spaces. Bytes that are no text, as ids of
    other origin may give, become replacement characters; control ids give nothing.
    """
    schema = f"`{id_col}` long, score long, ids array<int>, ids_crc32 long, text string"
    return encoded.select(id_col, "score", "ids").mapInArrow(_decoder(model), schema)
