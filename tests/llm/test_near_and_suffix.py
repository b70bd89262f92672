import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from edge import documents, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweir.llm import probminhash, suffix_dedup
from logweir.llm.components import components
from logweir.llm.probminhash import drop_near_copies, near_classes, probability_jaccard, signatures
from logweir.llm.queries import op2_suffix_dedup
from logweir.llm.suffix_dedup import common_prefixes, cut_rows, cut_texts, remove_repeats, suffix_array


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def jaccard(a, b):
    keys = set(a) | set(b)
    return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in keys) for x in a if x in b)


def classes(texts, similarity=0.8):
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = {i: shingles(t) for i, t in texts.items()}
    for i in texts:
        for j in texts:
            if i < j and bags[i] and bags[j] and root(i) != root(j) and jaccard(bags[i], bags[j]) >= similarity:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in texts}


def varied(seed, text, edits):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near_rows():
    rows = {}
    for g in range(6):
        base = prose(g, 150)
        for k in range(8):
            rows[100 * g + k] = varied(100 * g + k, base, k % 5)
    rows[900] = "few words here"
    rows[901] = "few  words\nhere"
    rows[902] = ("the same line\n" * 40) + prose(77, 30)
    rows[903] = ("the same line\n" * 38) + prose(77, 30)
    return rows


@pytest.mark.parametrize("cell", [probminhash.CELL, 2])
def test_classes_equal_brute_force(spark, near_rows, monkeypatch, cell):
    monkeypatch.setattr(probminhash, "CELL", cell)
    docs = documents(spark, [(i, t, "en") for i, t in near_rows.items()])
    got = {r.doc_id: r.class_id for r in near_classes(docs).collect()}
    assert got == classes(near_rows)


def test_near_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = near_classes(docs).collect()
    found = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert found == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 5, 8: 8, 9: 8, 10: 10, 11: 11}
    assert sum(r.doc_id is None and r.class_id is None and r.kept for r in got) == 2
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 1, 2, 3, 4, 5, 8, 10, 11]
    assert near_classes(documents(spark, [])).count() == 0


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    for k in range(5):
        keys = rng.integers(1, 2**63, 60, dtype=np.uint64)
        a, b = rng.integers(1, 6, 60), rng.integers(1, 6, 60)
        first, second = np.sort(keys[:45]), np.sort(keys[15:])
        x, y = (first, a[:45]), (second, b[15:])
        true = jaccard(Counter(dict(zip(first.tolist(), x[1].tolist()))), Counter(dict(zip(second.tolist(), y[1].tolist()))))
        assert probability_jaccard(x, y) == pytest.approx(true)
        sigs = [signatures(1, np.zeros(45, int), *s, 4096)[0] for s in (x, y)]
        assert (sigs[0] == sigs[1]).mean() == pytest.approx(true, abs=0.04)


def test_components(spark):
    pairs = [(k, k + 1) for k in range(10, 40)] + [(100, k) for k in range(200, 260)] + [(7, 3), (3, 5), (5, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {k: 10 for k in range(10, 41)} | {k: 100 for k in [100, *range(200, 260)]} | {3: 3, 5: 3, 7: 3}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- suffix arrays -----------------------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=120).map(lambda b: bytes(x % 4 for x in b)), st.integers(1, 40))
def test_suffix_array_is_sorted(raw, depth):
    text = np.frombuffer(raw, np.uint8)
    order = suffix_array(text, depth)
    keys = [(raw[i:] + bytes(depth))[:depth] for i in order]
    assert sorted(order.tolist()) == list(range(len(raw))) and keys == sorted(keys)
    want = []
    for x, y in zip(keys[:-1], keys[1:]):
        want.append(next((k for k in range(depth) if x[k] != y[k]), depth))
    assert common_prefixes(text, order[:-1], order[1:], depth).tolist() == want


def cut(texts, length):
    """By counting every string."""
    raw = {i: (t or "").encode() for i, t in texts}
    seen = Counter(r[k : k + length] for r in raw.values() for k in range(len(r) - length + 1))
    out = {}
    for i, r in raw.items():
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if seen[r[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k in range(len(r)) if gone[k] and (k == 0 or not gone[k - 1]))
        if runs:
            out[i] = (sum(gone), runs, bytes(b for b, g in zip(r, gone) if not g))
    return out


@pytest.mark.parametrize("crowded", [suffix_dedup.CROWDED, 5, 1])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    passage = prose(50, 60)
    rows = [(k, f"{prose(k, 20)} {passage} {prose(500 + k, 30)}", "en") for k in range(20)]
    rows += [(30, "ab" * 400, "en"), (31, "z" * 700, "en"), (32, passage, "en"), (33, None, "en"), (34, "short", "en")]
    rows += [(35, prose(9, 90) + passage[:199], "en"), (36, "漢字かな交じり" * 20 + prose(8, 20), "ja"), (37, "漢字かな交じり" * 19, "ja")]
    rows += [(38, prose(60, 30) + "\0" * 300, "en")]
    got = {r.doc_id: (r.n_removed, r.n_spans, bytes(r.left)) for r in cut_texts(documents(spark, rows)).collect()}
    assert got == cut([r[:2] for r in rows], 200)


def test_other_lengths(spark):
    rows = [(k, prose(k % 5, 40), "en") for k in range(12)]
    got = cut_texts(documents(spark, rows), length=50, gram=20).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans, bytes(r.left)) for r in got} == cut([r[:2] for r in rows], 50)


def strange_rows():
    """All odd rows, repeated ids with the same text and others, and null ids with texts that stand elsewhere too."""
    passage = prose(70, 60)
    more = [(6, passage + " one", "en"), (5, passage + " two", "en"), (None, "three " + passage, "en"), (None, prose(2, 40), "en")]
    more += [(-(1 << 40), prose(71, 90), "en")] * 3 + [(20, "short", "en")] * 2 + [(21, None, "en"), (21, "", "en"), (21, prose(72, 80), "de")]
    return odd_rows() + more + [(40, "x" + prose(2, 40), "fr")]


def expected_rows(rows, length=200):
    """One result per row, each row being a document of its own."""
    found = cut(list(enumerate(r[1] for r in rows)), length)
    raw = [(r[1] or "").encode() for r in rows]
    return Counter((r[0], len(x), *found.get(k, (0, 0, x))) for k, (r, x) in enumerate(zip(rows, raw, strict=True)))


@pytest.mark.parametrize("top", [100, (1 << 63) - 1])
def test_any_ids_equal_brute_force(spark, top):
    rows = [*strange_rows(), (top, prose(73, 50), "en")]
    keep = ["doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).alias("n_bytes")]
    got = cut_rows(documents(spark, rows).select("doc_id", "text"), keep=keep).collect()
    made = [(r.doc_id, r.n_bytes, *((r.cut.n_removed, r.cut.n_spans, bytes(r.cut.left)) if r.cut else (0, 0, (r.text or "").encode()))) for r in got]
    assert Counter(made) == expected_rows(rows)


def test_remove_repeats_keeps_rows_and_columns(spark):
    docs = documents(spark, strange_rows())
    out = remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    got, want = Counter((r.doc_id, (r.text or "").encode()) for r in out.collect()), expected_rows(strange_rows())
    # Texts without characters that a span could cut.
    assert {k: n for k, n in got.items() if k[0] != 10} == dict(Counter((i, left) for (i, _, _, _, left), n in want.items() for _ in range(n) if i != 10))
    texts = {r.doc_id: r.text for r in out.collect() if r.doc_id}
    assert texts[1] is None and texts[2] == "" and texts[4] == "one" and texts[11] == ""
    assert texts[8] == "" and texts[9] == " end"
    assert remove_repeats(documents(spark, [])).count() == 0


def test_query_with_any_ids(spark, tmp_path):
    rows = strange_rows()
    documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r) for r in op2_suffix_dedup(spark, str(tmp_path)).collect())
    assert got == Counter((i, n, gone, runs, sha256(left).hexdigest()) for i, n, gone, runs, left in expected_rows(rows).elements())


def test_a_cut_character_goes_as_a_whole(spark):
    same = "x" * 199 + "é"[:1]
    rows = [(1, "a" + same + "b", "en"), (2, "c" + "x" * 199 + "è" + "d", "en")]
    got = {r.doc_id: r.text for r in remove_repeats(documents(spark, rows)).collect()}
    assert got == {1: "ab", 2: "cd"}
    digests = {r.doc_id: sha256(bytes(r.left)).hexdigest() for r in cut_texts(documents(spark, rows)).collect()}
    assert digests == {k: sha256(v[2]).hexdigest() for k, v in cut([r[:2] for r in rows], 200).items()}


def test_replacement_characters_of_the_input_stay(spark):
    """Only characters that a removed string cuts go: é and è share their first byte."""
    same = prose(11, 80)[:250]
    docs = documents(spark, [(1, "one �x" + same + "é end", "en"), (2, "two �y" + same + "è other", "en")])
    got = {r.doc_id: r.text for r in remove_repeats(docs).collect()}
    assert got == {1: "one �x end", 2: "two �y other"}
