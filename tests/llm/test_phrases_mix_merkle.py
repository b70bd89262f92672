"""Collocations, mixing and the Merkle manifest against plain brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from edge import SCHEMA, documents, odd_rows, prose
from pyspark.sql import functions as F

from logweir.llm import collocations
from logweir.llm.collocations import count_pairs, cut_score, mine_collocations
from logweir.llm.merkle import bundle, build_manifest, leaf_digest, prove
from logweir.llm.mixing import mix, targets


def expected_phrases(rows, min_count, top, longest=4):
    counts, total = defaultdict(Counter), Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        frequent = {w: a for w, a in f.items() if a >= min_count}
        ranked = []
        for words, a in frequent.items():
            if len(words) == 1:
                continue
            longer = [b for w, b in frequent.items() if len(w) > len(words)
                      and any(w[i : i + len(words)] == words for i in range(len(w) - len(words) + 1))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            cuts = [(2_000_000 * a // (f[words[:k]] + f[words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(words).encode(), f[words[:k]], f[words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def chatter(seed, n):
    rng = random.Random(seed)
    words = ["The", "red", "fox", "ran", "far", "ünd", "x"]
    marks = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ! ", "\r\n"]
    return "".join(rng.choice(words) + rng.choice(marks) for _ in range(n)) + "new york city hall\n" * (n // 20)


def phrase_rows():
    rows = [(k, chatter(k, 40 + k), ["en", "de", None, "und", ""][k % 5]) for k in range(40)]
    return odd_rows() + rows + [(99, chatter(7, 4000), "en"), (99, chatter(7, 4000), "en"), (5, "word" * 5000, "en")]


@pytest.mark.parametrize("block_words, slice_bytes", [(1_000_000, 1 << 22), (300, 100), (7, 5)])
def test_phrases_equal_brute_force(spark, block_words, slice_bytes):
    rows = phrase_rows() if block_words > 7 else phrase_rows()[14:40]
    got = mine_collocations(documents(spark, rows), min_count=5, top=40, block_words=block_words, slice_bytes=slice_bytes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == expected_phrases(rows, 5, 40)


def test_phrases_without_broadcasts_or_dense_tiles(spark, monkeypatch):
    rows = phrase_rows()[14:40]
    monkeypatch.setattr(collocations, "BROADCAST", 0)
    got = mine_collocations(documents(spark, rows), min_count=4, top=1000, longest=3)
    assert sorted(tuple(r) for r in got.collect()) == expected_phrases(rows, 4, 1000, 3)


def test_phrases_of_nothing(spark):
    for rows in ([], [(1, None, "en"), (2, "", None), (3, " .,", "en")]):
        assert mine_collocations(documents(spark, rows)).count() == 0


def test_pairs_in_dense_tiles():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5000, 400_000) % 700, rng.integers(0, 9000, 400_000)
    b[:300_000] %= 300
    codes, counts, places = count_pairs(a, b, 9000)
    assert count_pairs(a, b, 9000, False)[0].tolist() == codes.tolist()
    want = Counter((a * 9000 + b).tolist())
    assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == want and len(codes) == len(want)
    assert (a[places] * 9000 + b[places] == codes).all()


def test_streams_hold_no_more_than_phrases_need():
    words = np.array([-1] * 500 + [1, 2, 3, 4] + [-1] * 500, "<i4")
    assert collocations._closed_up(words, 3).tolist() == [-1, -1, -1, 1, 2, 3, 4, -1]
    stream = collocations._stream(7, 0, words.tobytes(), b"")
    how = {"length": 1, "width": 10, "kind": "<i4"}
    known = np.array([12, 23, 34]), np.array([5, 6, 7])
    [made] = collocations._number_phrases(iter([stream]), known, **how, old="<i4", new="<i4")
    grams, after = (np.frombuffer(made.column(c)[0].as_py(), "<i4").tolist() for c in ("grams", "words"))
    assert (grams, after) == ([-1, 5, 6, 7, -1], [-1, -1, -1, 3, 4])
    [counted] = collocations._count(iter([made]), **(how | {"length": 2}), gram_kind="<i4")
    assert counted.to_pydict() == {"code": [53, 64], "n": [1, 1], "suffix": [6, 7]}


def test_scores_beyond_64_bits(spark):
    rows = [(9_000_000_000_000_000_000, 9_000_000_000_000_000_000, 9_000_000_000_000_000_001), (3, 2, 5), (1, 999_999, 1_000_002)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select(cut_score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert [r.s for r in got.collect()] == [2_000_000 * a // (left + right) for a, left, right in rows]


def sourced(spark, rows):
    """Rows (doc_id, text, source)."""
    made = [(i, t, "en", s, 1, 7, "d", "c", None, 1, "w", 2, "l") for i, t, s in rows]
    return spark.createDataFrame(made, SCHEMA)


def sourced_rows():
    rows = [(k, prose(k, 1 + k * 13 % 90), ["b", "a", None, "é", "B", "", "z" * 300][k % 7 if k % 3 else 0]) for k in range(600)]
    return rows + [(i, t, ["a", None][k % 2]) for k, (i, t, _) in enumerate(odd_rows())] + [(3, prose(9, 20), "b")] * 3 + [(1000, None, "empty")]


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, full = Fraction(3, 2) * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        level = left / sum(weights[s] for s in rest) if rest else Fraction(0)
        over = [s for s in rest if weights[s] * level > 2 * sizes[s]]
        if not over:
            return {s: full.get(s, weights[s] * level) for s in names}
        for s in over:
            full[s] = Fraction(2 * sizes[s])
            left -= full[s]


def test_mix(spark):
    rows = sourced_rows()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size_of(t)
    want = expected_targets(sizes)
    docs = sourced(spark, rows)
    got = mix(docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, size_of(t)) for i, t, _ in rows)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(docs.repartition(7)).collect()), key=str)
    taken = Counter()
    for r in got:
        assert r.taken == r.repeats * r.size + r.extra and 0 <= r.taken <= 2 * r.size
    for s in sizes:
        # Rows that stand in two sources are told apart by the target.
        mine = [r for r in got if abs(r.target - float(want[s])) < 1e-6 and r.source_size == sizes[s]]
        assert len(mine) == sum(x[2] == s for x in rows)
        taken[s] = sum(r.taken for r in mine)
        assert taken[s] == int(want[s] + Fraction(1, 2))
        assert sum(0 < r.extra < r.size for r in mine) <= 1


def test_mix_of_one_run_or_many(spark, monkeypatch):
    rows = sourced_rows()
    whole = sorted(map(tuple, mix(sourced(spark, rows)).collect()), key=str)
    monkeypatch.setattr("logweir.llm.mixing.RUN", 3)
    monkeypatch.setattr("logweir.llm.mixing.MOST_RUNS", 16)
    assert sorted(map(tuple, mix(sourced(spark, rows)).collect()), key=str) == whole


def test_mix_of_nothing(spark):
    assert mix(sourced(spark, [])).count() == 0
    rows = [(1, None, "a"), (2, " ", None)]
    assert [(r.target, r.taken) for r in mix(sourced(spark, rows)).collect()] == [(0.0, 0)] * 2


def test_targets_that_need_several_rounds(spark):
    sizes = {f"s{k:02}": 3**k for k in range(12)}
    table = spark.createDataFrame([(k, n, 1) for k, n in sizes.items()], "key string, source_size long, n long")
    want = expected_targets(sizes)
    got = {r.key: r.target for r in targets(table).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - float(want[k])) < 1e-6 for k in want)
    every = targets(table, percent=200).collect()
    assert all(r.target == 2 * r.source_size for r in every)


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def cut_lines(row):
    doc, text = row[0], row[4]
    even = doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0
    return (*row[:4], text.replace("\n", "") if even and text is not None else text)


def expected_proofs(rows):
    """Rows (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(row), leaf_of(cut_lines(row)), row[0]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels_of([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in order}
    above = levels_of([built[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for place, (_, _, leaf, claim, doc) in enumerate(sorted(trees[s], key=lambda x: x[:3])):
            proof, found = [], claim
            for levels, k in ((built[s], place), (above, at)):
                for level in levels[:-1]:
                    run = level[k // 3 * 3 : k // 3 * 3 + 3]
                    found = digest([*run[: k % 3], found, *run[k % 3 + 1 :]])
                    proof += run[: k % 3] + run[k % 3 + 1 :]
                    k //= 3
            out.append((doc, leaf, built[s][-1][0], above[-1][0], digest(proof), found, found == above[-1][0]))
    return Counter(out)


def proofs(spark, rows):
    columns = "doc_id long, source string, lang string, n_chars long, text string, tree string, at int, digest string"
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], columns)
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claimed = leaf_digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])
    return Counter(tuple(r) for r in prove(build_manifest(docs, claimed=claimed)).collect())


@pytest.mark.parametrize("n, sources", [(1, 1), (2, 1), (3, 2), (82, 1), (400, 1), (300, 100)])
def test_proofs_equal_brute_force(spark, n, sources):
    rows = [(k, f"s{k % sources}", "en", k, f"a{k}\nb") for k in range(n)]
    got = proofs(spark, rows)
    assert got == expected_proofs(rows)
    # Only what was tampered with fails.
    assert {r[0] for r in got if not r[6]} == {k for k in range(n) if zlib.crc32(str(k).encode()) % 2 == 0}


def test_proofs_of_odd_rows(spark):
    rows = [(i, s, lang, None, t) for k, (i, t, lang) in enumerate(odd_rows()) for s in ("é", None, "", "B", "a")[: k % 5 + 1]]
    rows += [(7, "a", "en", 3, "same\n")] * 200
    assert proofs(spark, rows) == expected_proofs(rows)
    assert proofs(spark, []) == Counter()


def test_records_lead_from_the_root_to_every_leaf(spark):
    rows = [(k, f"s{k % 4}", "en", k, str(k)) for k in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    made = build_manifest(docs)
    records = {r.digest: r.children for r in made.records().collect()}
    level, leaves = [made.root.first().digest], set()
    while level:
        leaves |= {d for d in level if d not in records}
        assert all(digest(records[d]) == d for d in level if d in records)
        level = [child for d in level for child in records.get(d, [])]
    assert leaves == {leaf_of(r) for r in rows}
    assert prove(made).filter("not verified").isEmpty()


def test_bundles():
    assert bundle(["a"], True) == ("a", 0, [])
    top, levels, records = bundle(["a"], False)
    assert levels == 4 and len(records) == 4 and records[0] == (digest("a"), ["a"]) and records[-1][0] == top
