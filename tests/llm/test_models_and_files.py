import itertools
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from math import exp, log

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import zstandard
from edge import documents, odd_rows, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logweir.llm import chat, kneser_ney, piece_scan
from logweir.llm.kneser_ney import document_scores, discounts, judge_quality, keep_good, train
from logweir.llm.packing import best_boundaries, pack
from logweir.llm.piece_scan import SPACE, decode_pieces, encode_pieces, vocabulary
from logweir.llm.token_files import read_documents, read_token_files, write_token_files
from logweir.llm.url_filter import RULES, Rule, fit_urls, host_of, judge_urls, path_of
from logweir.workspace import new_folder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# --- packing -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("buckets", [1, 2, 3, 9])
def test_boundaries_are_optimal(buckets):
    rng = np.random.default_rng(buckets)
    lengths = np.unique(rng.integers(1, 60, 8))
    counts = rng.integers(1, 9, len(lengths))

    def padding(bounds):
        return sum(int(n) * (min(b for b in bounds if b >= k) - int(k)) for k, n in zip(lengths, counts, strict=True))

    inner = lengths[:-1].tolist()
    ways = [(*c, int(lengths[-1])) for r in range(buckets) for c in itertools.combinations(inner, r)]
    got = best_boundaries(lengths, counts, buckets)
    assert padding(got) == min(map(padding, ways)) and len(got) <= buckets and got == sorted(got)


def plain_padding(lengths, counts, buckets):
    """Least padding by the plain programme over all pairs of a bucket's first and last length."""
    before = np.concatenate(([0], np.cumsum(counts)))
    best = np.array([0.0] + [np.inf] * len(lengths))
    least = np.inf
    for _ in range(buckets):
        best = np.array([np.inf] + [np.min(best[:j] + lengths[j - 1] * (before[j] - before[:j])) for j in range(1, len(lengths) + 1)])
        least = min(least, best[-1])
    return int(least) - int((lengths * counts).sum())


def padding_of(rows):
    return sum(r.padded_to - r.n_tokens for r in rows)


@pytest.mark.parametrize("buckets", [1, 5, 16])
def test_boundaries_over_many_lengths(buckets):
    rng = np.random.default_rng(buckets)
    lengths = np.unique(np.concatenate((rng.integers(1, 400, 300), rng.integers(1000, 90_000, 200))))
    counts = rng.integers(1, 1000, len(lengths)) ** 2
    bounds = np.array(best_boundaries(lengths, counts, buckets))
    got = int(((bounds[np.searchsorted(bounds, lengths)] - lengths) * counts).sum())
    assert got == plain_padding(lengths, counts, buckets) and len(bounds) == buckets


def test_query_pads_as_little_as_can_be(spark):
    """Texts of up to 7,000 words, by the plain programme over their exact lengths."""
    rng = np.random.default_rng(3)
    sizes = [int(x) for x in rng.integers(1, 300, 150)] + [int(x) for x in rng.integers(900, 7000, 40)] + [0, 0]
    docs = documents(spark, [(k, " ".join(["w"] * n), "en") for k, n in enumerate(sizes)])
    rows = pack(docs, buckets=5).collect()
    lengths, counts = np.unique([n for n in sizes if n], return_counts=True)
    assert padding_of(rows) == plain_padding(lengths, counts, 5)
    assert {r.padded_to for r in rows} <= {*sizes}


def test_batches_fill_up(spark, monkeypatch):
    from logweir.llm import packing

    monkeypatch.setattr(packing, "RUN", 37)
    rows = [(k, " ".join(["w"] * (k % 50)), "en") for k in range(500)] + odd_rows()
    got = pack(documents(spark, rows), buckets=4, token_budget=200).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    assert {r.doc_id: r.n_tokens for r in got if r.doc_id and r.doc_id > 20} == {k: k % 50 for k in range(21, 500)}
    by_batch = defaultdict(list)
    for r in got:
        assert r.n_tokens <= r.padded_to and (r.bucket == 0) == (r.n_tokens == 0)
        by_batch[r.bucket, r.padded_to, r.batch].append(r.slot)
    last = {b: max(k for x, _, k in by_batch if x == b) for b, _, _ in by_batch}
    for (bucket, padded, batch), slots in by_batch.items():
        capacity = max(1, 200 // max(padded, 1))
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= capacity
        assert len(slots) == capacity or batch == last[bucket]
    assert pack(documents(spark, [])).count() == 0


# --- chat ---------------------------------------------------------------------------------------------------------------


def cheapest(roles):
    """By relaxing all (turn, state) costs until nothing changes."""
    cost = {(0, chat.START): 0}
    while True:
        new = dict(cost)
        for (i, s), c in cost.items():
            for t in chat.NEXT[s]:
                new[i, t] = min(new.get((i, t), 99), c + chat.INSERT)
            if i < len(roles):
                for t in (1, 2, 3):
                    k = c + (0 if t == roles[i] else chat.RELABEL)
                    if t == s:
                        new[i + 1, t] = min(new.get((i + 1, t), 99), k + chat.MERGE)
                    if t in chat.NEXT[s]:
                        new[i + 1, t] = min(new.get((i + 1, t), 99), k)
        if new == cost:
            return cost[len(roles), chat.FINAL]
        cost = new


def test_repair_costs_are_least():
    for n in (1, 2, 3, 4):
        for roles in itertools.product(range(4), repeat=n):
            parts = [list(roles[: n // 2]), list(roles[n // 2 :])]
            assert chat.stitch([chat.matrix(p) for p in parts])[0] == cheapest(roles)


@pytest.mark.parametrize("fragment", [chat.FRAGMENT, 2])
def test_repaired_chats_are_legal(spark, monkeypatch, fragment):
    monkeypatch.setattr(chat, "FRAGMENT", fragment)
    rng = np.random.default_rng(3)
    names = ["system", "user", "assistant", "USER ", "tool", None]
    rows = [(c, t, names[rng.integers(0, 6)], f"t{c}.{t}") for c in range(40) for t in range(int(rng.integers(1, 9)))]
    rows += [(99, t, "user", "same") for t in (1, 1, 1)] + [(None, None, None, None), (98, 1, "assistant", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"pos": F.lit("x"), "state": F.lit(1), "conv": F.lit(2)}
    )
    got = chat.format_chats(turns).orderBy("position").collect()
    assert len(got) == len(rows)
    whole, cost, roles = defaultdict(str), {}, defaultdict(list)
    for r in got:
        whole[r.conv_id] += r.rendered
        cost[r.conv_id] = r.cost
        name = (r.role or "").strip().lower()
        roles[r.conv_id].append(chat.ROLES.index(name) + 1 if name in chat.ROLES else 0)
    for conv, text in whole.items():
        marks = re.findall(r"<\|(system|user|assistant|end)\|>", text)
        assert marks[1::2] == ["end"] * (len(marks) // 2)
        assert re.fullmatch("s?(ua)+", "".join(m[0] for m in marks[::2]))
        assert cost[conv] == cheapest(roles[conv])
    for c, t, _, text in rows:
        assert text is None or text in whole[c]
    assert chat.format_chats(turns.limit(0)).count() == 0


# --- Kneser-Ney ---------------------------------------------------------------------------------------------------------


def plain_model(texts, order):
    """Probability of an n-gram by the textbook, from dictionaries."""
    grams = [t[k : k + order] for t in (b"\xff" * (order - 1) + x.encode() for x in texts) for k in range(len(t) - order + 1)]
    counts = {order: Counter(grams)}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut = {k: discounts([sum(n == c for n in counts[k].values()) for c in (1, 2, 3, 4)]) for k in counts}

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / 256
        after = {g: n for g, n in counts[k].items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return p(gram[1:])
        d = cut[k]
        weight = sum(d[min(n, 3) - 1] for n in after.values()) / total
        own = after.get(gram, 0)
        return (own - d[min(own, 3) - 1] if own else 0) / total + weight * p(gram[1:])

    return p


def test_scores_equal_the_textbook(spark):
    train_on = [prose(k, 30, "abcé") for k in range(3)] + ["", "ab", "abab"]
    asked = ["abab abé", "zz漢", "a", "", None, prose(1, 12, "abcé")]
    texts = spark.createDataFrame([(t,) for t in train_on], "text string")
    docs = documents(spark, [(k, t, "en") for k, t in enumerate(asked)])
    for order in (1, 3):
        model, p = train(texts, order), plain_model(train_on, order)
        for head in (4, 1 << 18):
            got = {r.doc_id: r for r in document_scores(docs, model, head=head).collect()}
            for k, t in enumerate(asked):
                raw = (t or "").encode()
                wide = b"\xff" * (order - 1) + raw
                want = sum(log(p(wide[i : i + order])) for i in range(len(raw)))
                assert got[k].n_bytes == len(raw) and got[k].log_p == pytest.approx(want)


def test_probabilities_add_up(spark):
    model = train(spark.createDataFrame([("abracadabra",), ("banana",)], "text string"), 3)
    for context in (b"ab", b"an", b"zz", b"\xff\xff"):
        codes = [(context[0] << 16) | (context[1] << 8) | b for b in range(256)]
        got = model.score(spark.createDataFrame([(c,) for c in codes], "code long")).collect()
        assert sum(exp(r.log_p) for r in got) == pytest.approx(1)


def test_junk_is_found(spark):
    good = [(1000 + k, prose(7, 400)[13 * k % 900 :][:600], "en" if k % 2 else "de") for k in range(120)]
    junk = [(500 + k, "".join(chr(33 + (k * 7 + j * j) % 60) for j in range(300)), "en") for k in range(20)]
    docs = documents(spark, good + junk + odd_rows()[:4])
    labels = spark.createDataFrame(
        [(k, 1, 0) for k, _, _ in good[:100]] + [(k, 0, 0) for k, _, _ in junk[:10]] + [(None, 1, 0), (3, None, None)],
        "doc_id long, quality int, toxic int",
    )
    got = {r.doc_id: r for r in judge_quality(docs, labels, order=3).collect()}
    assert not any(got[k].kept for k, _, _ in junk) and not got[2].kept and got[2].perplexity is None
    assert sum(got[k].kept for k, _, _ in good) >= 100
    left = keep_good(docs, labels, order=3)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {k for k, r in got.items() if r.kept}
    assert judge_quality(docs.limit(0), labels).count() == 0
    nothing_known = judge_quality(docs, labels.limit(0), order=2).collect()
    assert all(r.kept == (r.n_bytes > 0) for r in nothing_known)


def test_worst_stretches(spark, monkeypatch):
    """Against all stretches, with rare and frequent n-grams and across borders of pieces."""
    train_on = [prose(k, 30, "abcé") for k in range(3)]
    asked = ["abab abé", "zz漢", "a", "", None, prose(1, 40, "abcé"), prose(3, 30, "abc") + " zq " + prose(4, 30, "abc"), "xyzxyz" * 20]
    docs = documents(spark, [(k, t, "en") for k, t in enumerate(asked)] + [(None, "ab", "en"), (None, "zzzz", "en")])
    model, p = train(spark.createDataFrame([(t,) for t in train_on], "text string"), 3), plain_model(train_on, 3)
    for head, piece in ((4, 1 << 14), (40, 7), (1 << 18, 16), (1, 16)):
        monkeypatch.setattr(kneser_ney, "PIECE", piece)
        got = {r.doc_id: r for r in document_scores(docs, model, head=head).collect()}
        for k, t in [*enumerate(asked), (None, "zzzz")]:
            raw = (t or "").encode()
            wide = b"\xff\xff" + raw
            logs = [log(p(wide[i : i + 3])) for i in range(len(raw))]
            want = min((sum(logs[i : i + 4]) for i in range(max(1, len(raw) - 3))), default=0)
            assert got[k].worst == pytest.approx(want, rel=1e-5)
            if k is not None:
                assert got[k].n_bytes == len(raw) and got[k].log_p == pytest.approx(sum(logs))


def test_no_rows_on_the_driver(spark, monkeypatch):
    docs = documents(spark, [(i, "some words and more words " * i, "en") for i in range(1, 6)])
    monkeypatch.setattr(type(docs), "toPandas", lambda df: pytest.fail("rows"))
    assert document_scores(docs, train(docs.filter("doc_id < 4"), 5)).count() == 5


def test_few_bad_words_are_found(spark):
    """Recall on toxic and junk documents, whose mean is like that of good ones, and loss of unlabelled good ones."""
    good = [(1000 + k, prose(7, 3000)[31 * k % 9000 :][:1500], "en") for k in range(500)]
    toxic = [(k, t[:700] + " qzxv " + t[700:], "en") for k, (_, t, _) in enumerate(good[:60])]
    junk = [(500 + k, "".join(chr(33 + (k * 7 + j * j) % 60) for j in range(300)), "en") for k in range(20)]
    labels = [(k, 1, 0) for k, _, _ in good[:400]] + [(k, 1, 1) for k, _, _ in toxic] + [(k, 0, 0) for k, _, _ in junk]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in judge_quality(documents(spark, good + toxic + junk), labels).collect()}
    assert sum(got[k] for k, _, _ in toxic) <= 6 and sum(got[k] for k, _, _ in junk) == 0
    assert sum(got[k] for k, _, _ in good[400:]) >= 95


@pytest.mark.parametrize("labelled", [1, 2, 3])
def test_languages_with_few_trusted_texts(spark, labelled):
    """One held-out text or so, and an easy one, is no bound for its language."""
    good = [(1000 + k, prose(7, 2000)[31 * k % 6000 :][:1200], "en") for k in range(300)]
    rare = [(k, prose(7, 2000)[29 * k % 6000 :][:1200], "de") for k in range(40)]
    ids = spark.range(100_000, 100_100).selectExpr("id", "pmod(xxhash64(id), 4) as part").filter("part = 0").limit(labelled)
    easy = [(r.id, prose(7, 2000)[:300] * 4, "de") for r in ids.collect()]
    labels = spark.createDataFrame([(k, 1, 0) for k, _, _ in good + easy], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in judge_quality(documents(spark, good + rare + easy), labels).collect()}
    assert len(easy) == labelled and sum(got[k] for k, _, _ in rare) >= 36


# --- token files --------------------------------------------------------------------------------------------------------


def test_token_files_round_trip(spark):
    rows = odd_rows() + [(k, prose(k, 60) + " <|endoftext|> don't 42é\x1fx\u3000y", "en") for k in range(1000, 1100)]
    folder = new_folder(spark, "files")
    write_token_files(documents(spark, rows), folder, WORD_BPE, 1)
    index = {(r.part, r.block, r.slot): r for r in spark.read.parquet(f"{folder}/index").collect()}
    got = read_token_files(spark, folder).collect()
    assert len(got) == len(rows) == len(index)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for i, t, _ in rows)
    assert Counter((r.id, tuple(r.ids)) for r in got) == want
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    start, last = 0, -1
    for r in sorted(got, key=lambda r: index[r.part, r.block, r.slot].start):
        assert index[r.part, r.block, r.slot].start == start and (r.id or 0) >= last
        start, last = start + r.n_tokens, r.id or 0
    few = read_documents(spark, folder, [5, 1003]).collect()
    assert sorted(r.id for r in few) == [5, 1003]
    write_token_files(documents(spark, []), folder + "-empty", WORD_BPE, 1)
    assert read_token_files(spark, folder + "-empty").count() == 0


def test_another_dictionary_is_refused(spark):
    folder = new_folder(spark, "files")
    write_token_files(documents(spark, odd_rows()), folder, WORD_BPE, 1)
    other = zstandard.ZstdCompressionDict(b"other" * 50).as_bytes()
    spark.createDataFrame([(bytearray(other), "0" * 64, 2)], "dictionary binary, sha256 string, width int").write.mode(
        "overwrite"
    ).parquet(f"{folder}/dictionary")
    with pytest.raises(ValueError, match="dictionary"):
        read_token_files(spark, folder)


# --- URLs ---------------------------------------------------------------------------------------------------------------


def test_hosts_paths_and_rules(spark):
    cases = [
        ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
        ("https://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
        ("https://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
        ("a://b://c/d", "b:", "//c/d", None, None),
        ("http://notnet/en/", "notnet", "/en/", None, None),
        ("http://x.net", "x.net", "", None, None),
        ("http://ÄB.net?x://y", "Äb.net", "", None, None),
        ("no scheme", "", "", None, None),
        ("", "", "", None, None),
        (None, "", "", None, None),
    ]
    pages = spark.createDataFrame([(i, c[0], "h", "r", 1.0) for i, c in enumerate(cases)],
                                  "page_id long, url string, host string, rule string, score double")
    got = judge_urls(pages, trees=2).orderBy("page_id").collect()
    for r, (_, host, path, rule, verdict) in zip(got, cases, strict=True):
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert judge_urls(pages.limit(0)).count() == 0
    assert [r.place for r in RULES] == ["net/", "example.net/en/", "example.com/de/", "org/fr/"]
    allow_only = judge_urls(pages, rules=[Rule.of("allow org/fr/")]).collect()
    assert all(r.verdict == "allow" for r in allow_only)


def test_held_out_accuracy(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(1500):
        bad = int(rng.random() < 0.4)
        digits = "".join(map(str, rng.integers(0, 10, 12 if bad else 2)))
        host = f"{'cheap-pills-' if bad and k % 2 else 'news'}{k % 70}.example.{'biz' if bad else 'org'}"
        rows.append((k, f"http://{host}/{digits}?{'&'.join(f'p{i}={i}' for i in range(6 * bad))}", bad))
    urls = spark.createDataFrame(rows, "page_id long, url string, bad int")
    parts = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    model = fit_urls(parts.filter("page_id % 3 > 0"), trees=5)
    judged = model.judge(parts.filter("page_id % 3 = 0").withColumnRenamed("bad", "truth"))
    assert judged.agg(F.avg((F.col("bad") == (F.col("truth") == 1)).cast("int"))).first()[0] > 0.95


# --- pieces -------------------------------------------------------------------------------------------------------------


def best_score(v, text):
    """Over all segmentations, by the plain programme."""
    best = [0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        ways = [(best[at], text[at:end]) for at in range(max(0, end - v.longest), end) if best[at] is not None]
        scores = [b + v.scores[p][0] for b, p in ways if p in v.scores]
        if text[end - 1] not in v.scores and best[end - 1] is not None:
            scores.append(best[end - 1] + v.byte_score * len(text[end - 1].encode()))
        best[end] = max(scores, default=None)
    return best[-1]


@pytest.mark.parametrize("chunk", [17, 40, piece_scan.CHUNK])
def test_pieces_are_best_and_decode(spark, chunk):
    # The plain programme takes minutes for the two very long texts, which have a test of their own.
    rows = [r for r in odd_rows() if r[0] not in (8, 9)]
    rows += [(100, "the  cat   sat\n" * 6, "en"), (101, "x" * 90 + " " * 40 + "y", "en"), (102, prose(4, 60), "en")]
    made = decode_pieces(encode_pieces(documents(spark, rows), PIECES, chunk=chunk), PIECES).collect()
    v = vocabulary(PIECES)
    assert Counter((r.doc_id, r.text) for r in made) == Counter((i, t or "") for i, t, _ in rows)
    known = {piece: s for piece, s in v.scores.items()}
    by_id = {i: s for s, i in known.values()}
    texts = {i: t for i, t, _ in rows}
    for r in made:
        want = best_score(v, SPACE + (r.text or "").replace(" ", SPACE))
        assert r.score == want
        assert sum(by_id.get(i, v.byte_score) for i in r.ids) == want
        assert r.text == (texts[r.doc_id] or "") or r.doc_id is None
    assert encode_pieces(documents(spark, []), PIECES).count() == 0


def test_words_together_and_alone():
    v = vocabulary(PIECES)
    rng = np.random.default_rng(4)
    letters = list("etaoinshrdlucmfwypvbgkqjxzéèüñ.,!?0123456789ABCDE漢😀")
    words = {SPACE + "".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(3000)} | {SPACE, SPACE * 5, "x", "the", SPACE + "z" * 64}
    words = sorted(words)
    assert piece_scan._segment_words(v, words) == [piece_scan._segment(v, w) for w in words]


def test_words_of_bytes_together(monkeypatch):
    v = vocabulary(PIECES)
    words = [SPACE + "der.\nCha", "\n", "a\n\nb\x7f", SPACE + "\U0001f600\u0600x\n", "x"]
    alone = [piece_scan._segment(v, w) for w in words]
    monkeypatch.setattr(piece_scan, "_segment", lambda v, text: pytest.fail(f"{text!r} alone"))
    assert piece_scan._segment_words(v, words) == alone


def test_choice_does_not_depend_on_chunks(spark):
    """Very long texts give the ids of their words, one after the other."""
    rows = [r for r in odd_rows() if r[0] in (8, 9, 11)] + [(12, "née ".join(["The cat, sat on  the mat."] * 4000), "en")]
    v = vocabulary(PIECES)
    want = {}
    for i, t, _ in rows:
        found = [piece_scan._segment(v, w) for w in piece_scan.WORD.findall(piece_scan.signed(t))]
        want[i] = (sum(s for s, _ in found), b"".join(x for _, x in found))
    for chunk in (5_000, piece_scan.CHUNK):
        made = encode_pieces(documents(spark, rows), PIECES, chunk=chunk)
        assert {r.doc_id: (r.score, np.array(r.ids, "<u4").tobytes()) for r in made.collect()} == want
        assert {r.doc_id: r.text for r in decode_pieces(made, PIECES).collect()} == {i: t for i, t, _ in rows}


def peak_of(task, batch, column, want):
    """The most that Python and numpy hold while a task works on a batch and each row of its ``column`` is ``want``."""
    tracemalloc.start()
    n = 0
    for made in task(iter([batch])):
        assert pc.all(pc.equal(made.column(column), want)).as_py()
        n += made.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == batch.num_rows
    return peak


def test_memory_does_not_grow_with_a_batch():
    """A batch, which may be all of a task, is not held as Python values: neither its chunks nor their ids."""
    chunk = SPACE + SPACE.join(["the", "cat", "sat", "née", "1234"] * 1000)
    score, raw = piece_scan.segment(vocabulary(PIECES), chunk)
    n, ids = 120, np.frombuffer(raw, "<i4")
    zeros = pa.array([0] * n, pa.int32())
    numbers = {"id": pa.array(range(n)), "key": pa.array(map(str, range(n))), "no": zeros, "enter": zeros, "leave": zeros}
    texts = {"part": pa.array([chunk] * n), "ahead": pa.array([""] * n), "score": pa.array([score] * n)}
    batch = pa.record_batch(numbers | texts)
    assert peak_of(piece_scan._transferrer(PIECES), batch, "no", 0) < 3_000_000
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(ids)), pa.array(np.tile(ids, n)))
    batch = pa.record_batch({"id": numbers["id"], "ids": lists})
    for rows in (batch, batch.slice(1)):
        assert peak_of(piece_scan._decoder(PIECES), rows, "text", chunk.replace(SPACE, " ")[1:]) < 9_000_000
    counted = lambda batches: (b.append_column("n", b.column("ids").value_lengths()) for b in piece_scan._tracer(PIECES)(batches))
    assert peak_of(counted, pa.record_batch(numbers | texts), "n", len(ids)) < 6_000_000


def test_matrices_without_word_borders():
    """A vocabulary whose pieces cross words: no place is safe, and chunks still give the best score."""
    pieces = {c: (-10 * k - 50, k) for k, c in enumerate("abc" + SPACE)} | {"a" + SPACE + "b": (-30, 7), "bc" + SPACE: (-41, 8), "ca": (-60, 9)}
    v = piece_scan.Vocabulary(pieces, [9] * 256, -500, 3, [], False, [{}, {}])
    rng = np.random.default_rng(2)
    for _ in range(60):
        text = "".join(rng.choice(list("abc" + SPACE + "?"), 40))
        cuts = [0, *sorted(rng.choice(np.arange(3, 38), 3, replace=False)), 40]
        parts = [(text[a:b], text[b : b + 2]) for a, b in itertools.pairwise(cuts)]
        matrices = [piece_scan.transfer(v, *p) for p in parts]
        score, ways = piece_scan.states(matrices)
        assert score == best_score(v, text)
        left = piece_scan.combine(piece_scan.combine(matrices[0], matrices[1]), piece_scan.combine(matrices[2], matrices[3]))
        assert left[0, 0] == score
        ids = [i for p, w in zip(parts, ways, strict=True) for i in piece_scan.trace(v, *p, *w)]
        assert sum({i: s for s, i in pieces.values()}.get(i, -500) if i != 9 else 0 for i in ids) <= 0
