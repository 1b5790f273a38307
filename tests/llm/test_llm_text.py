"""Operators on texts against the libraries, brute force and their stated cases."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyforge.llm import bpe, licenses, lines, packing, piececoder, pii, quality, tokens
from tallyforge.llm.piececoder import json_coder, rank_coder, safe_stretches

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id bigint, text string, n_tokens string, spans int, ids string, score string, length int"

LONG = "lorem ipsum dolor " * 20_000
TEXTS = [None, "", " ", "\n", "a", "Hello  world \n\n x<|endoftext|>y", "naïve café 中文 😀\x00\x1c\x85 ends ", LONG, LONG, "Hello"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", i, None, "clash", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[-1], (None, "no id", None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def noise(seed: int, n: int, size: int = 60) -> list[str]:
    rng = random.Random(seed)
    bits = [*"aaab  \n\t.'sS1é \x85 \x00\x1c\x1f　 中文😀|#-\r", "<|endoftext|>", "'ll", " the", "ing", "aaaaaaa", "====", "----", " word"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, size))) for _ in range(n)]


# ---- tokenizers ----------------------------------------------------------------------------------


def test_json_ids_are_those_of_the_library():
    stock = Tokenizer.from_file(JSON)
    texts = noise(1, 4000)
    got = json_coder(JSON).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [stock.encode(t, add_special_tokens=False).ids for t in texts]


def test_rank_ids_are_those_of_the_library(ranks):
    texts = noise(2, 4000)
    assert [np.frombuffer(g, "<u4").tolist() for g in rank_coder(RANKS, PATTERN).encode(texts)] == [ranks.encode_ordinary(t) for t in texts]


def test_long_texts_are_cut_at_safe_places(ranks):
    text = "".join(noise(3, 2000))
    parts = list(safe_stretches(text, 500))
    assert "".join(parts) == text and len(parts) > 20
    assert [i for p in parts for i in ranks.encode_ordinary(p)] == ranks.encode_ordinary(text)
    assert list(safe_stretches("x" * 5000, 500)) == ["x" * 5000]


def test_a_full_memory_changes_nothing(monkeypatch):
    from tallyforge.llm import piececoder

    texts = noise(4, 500)
    want = json_coder(JSON).encode(texts)
    monkeypatch.setattr(piececoder, "REMEMBERED", 3)
    assert [g for k in range(0, 500, 10) for g in json_coder(JSON).encode(texts[k : k + 10])] == want


def test_token_counts(docs, nothing):
    stock = Tokenizer.from_file(JSON)
    got = tokens.count_tokens(docs, JSON, keep=("doc_id", "n_tokens", "spans"))
    assert got.columns == ["doc_id", "spans", "n_bytes", "n_tokens", "over_limit"]
    for r in got.collect():
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        n = len(stock.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512)
    assert got.count() == len(TEXTS) + 2 and tokens.count_tokens(nothing, JSON).count() == 0


def test_encode_and_decode(docs, nothing, ranks):
    coded = bpe.encode(docs, RANKS, PATTERN, decoded=True, offsets=True)
    for r in coded.collect():
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert ids == ranks.encode_ordinary(text) and bytes(r.decoded) == text.encode()
        assert len(r.starts) == len(r.ends) == len(ids)
        if ids:
            assert r.starts[0] == 0 and r.ends[-1] == len(text)
            assert all(b <= e and e - b < 3 for b, e in zip(r.starts[1:], r.ends))  # a split character overlaps
    back = {r.doc_id: r.text for r in bpe.decode(coded.select("doc_id", "ids"), RANKS, PATTERN).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(TEXTS))
    assert bpe.encode(nothing, RANKS, PATTERN).count() == 0
    half = np.array(ranks.encode_ordinary("😀")[:1], "<u4").tobytes()
    row = bpe.decode(docs.sparkSession.createDataFrame([(1, half), (2, None)], "doc_id bigint, ids binary"), RANKS, PATTERN).collect()
    assert row[0].text == "�" and bytes(row[0].decoded) == "😀".encode()[: len(row[0].decoded)] and row[1].text == ""


# ---- packing -------------------------------------------------------------------------------------


def test_cuts_cover_a_document():
    for n in [1, 511, 512, 513, 2047, 2048, 2049, 9000]:
        got = packing.cuts(n)
        assert got[0][0] == 0 and sum(k for _, k in got) == n
        assert all(a + k == b for (a, k), (b, _) in zip(got, got[1:])) and all(0 < k <= 2048 for _, k in got)


def test_differencing_balances_and_loses_nothing():
    rng = random.Random(5)
    for n, k in [(1, 1), (1, 4), (10, 3), (200, 31), (64, 64), (3, 8)]:
        sizes = [rng.randint(1, 512) for _ in range(n)]
        parts = packing.differencing(sizes, k)
        assert sorted(i for p in parts for i in p) == list(range(n)) and len(parts) <= k
    sizes = [rng.randint(1, 512) for _ in range(200)]
    sums = [sum(sizes[i] for i in p) for p in packing.differencing(sizes, 31)]
    assert max(sums) - min(sums) < 60
    assert packing.differencing([8, 7, 6, 5, 4], 2) and {sum([8, 7, 6, 5, 4][i] for i in p) for p in packing.differencing([8, 7, 6, 5, 4], 2)} == {14, 16}
    assert packing.windows_of([]) == [] and packing.windows_of([2047] * 3) == [[2], [1], [0]] or len(packing.windows_of([2047] * 3)) == 3


def check_packing(rows, texts):
    stock = Tokenizer.from_file(JSON)
    want = {i: [*stock.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    filled = defaultdict(list)
    seen = defaultdict(list)
    for r in rows:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert len(ids) == r.length > 0 and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        filled[r.sequence_id].append((r.offset, r.length))
        seen[r.doc_id].append((r.start, r.length))
    for pieces in filled.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
    for i, ids in want.items():
        at = 0
        for start, n in sorted(seen[i]):
            assert start == at
            at += n
        assert at == len(ids)
    return filled


def test_packing(docs, nothing):
    whole = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_packing(packing.pack(whole, JSON).collect(), dict(enumerate(TEXTS)))
    assert packing.pack(nothing, JSON).count() == 0
    assert packing.pack(docs, JSON).filter("doc_id = 9 or doc_id is null").count() == 3
    ids = packing.pack(whole, JSON, with_ids=True).filter("doc_id = 5").first()["ids"]
    assert np.frombuffer(bytes(ids), "<u4").tolist() == [*Tokenizer.from_file(JSON).encode(TEXTS[5], add_special_tokens=False).ids, 1]


def test_packing_wastes_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    filled = check_packing(packing.pack(docs, JSON).collect(), {r.doc_id: r.text for r in docs.collect()})
    sums = [sum(n for _, n in p) for p in filled.values()]
    assert sum(sums) / (2048 * len(sums)) > 0.96


# ---- lines ---------------------------------------------------------------------------------------


def brute_lines(rows, min_docs=5, min_length=40):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x))
    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_length:
                held[key(x)].add(i)
    often = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = {}
    for i, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if often.get(key(x), i) == i]
        out[i] = (len(all_), len(all_) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_line_dedup(spark):
    shared = "This Line is Shared by many documents, É and all of them"
    rows = [(i, "\n".join(["own line %d that is long enough to have a key here" % i, f" \t{shared.upper() if i % 2 and False else shared}\r", "", "short"] * (1 + i % 2))) for i in range(30)]
    rows += [(100, None), (101, ""), (102, "\n"), (103, shared + "\n" + shared), (104, "\n".join([shared.replace("L", "l")] * 2000))]
    rows += [(200 + i, "x" * 39) for i in range(6)] + [(300 + i, "y" * 40) for i in range(4)] + [(400 + i, " Z" + "z" * 39 + "\x0b") for i in range(5)]
    df = spark.createDataFrame([(i, t, 1, "en") for i, t in rows], "doc_id bigint, text string, n_lines int, lang string")
    got = lines.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "lang", "n_lines", "n_dropped"]
    have = {r.doc_id: (r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in got.collect()}
    assert have == brute_lines(rows)
    assert lines.dedup_lines(df.limit(0)).count() == 0
    twice = df.filter("doc_id = 400").union(df).union(spark.createDataFrame([(None, " Z" + "z" * 39, 1, "en")], df.schema))
    again = lines.dedup_lines(twice).filter("doc_id between 400 and 404 or doc_id is null").collect()
    assert Counter((r.doc_id, r.n_dropped) for r in again) == Counter([(400, 1), (400, 1), (401, 1), (402, 1), (403, 1), (404, 0), (None, 0)])


# ---- personal data -------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(s))]
        return sum(d - 9 * (d > 9) for d in twice) % 10 == 0

    out = [(0, *m.span()) for m in EMAIL.finditer(t)]
    out += [(1, *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    return out + [(3, *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m.group())) <= 15]


def test_base_spans():
    rng = random.Random(2)
    bits = [*"abA1220000 ..--@@+()%_\n", "555", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "é", "+1 ("]
    for _ in range(20_000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t)[0] == brute_spans(t), t
    for t in ["1" * 100_000, "a" * 100_000 + "@", "1." * 50_000, "a@b." * 20_000, "+1" * 50_000, "1 " * 100_000]:
        pii.base_spans(t)  # in time that grows with the length


PEOPLE = ["write to ann.lee@mail.example.com now", "call +1 (555) 555-0100 today", "host 10.20.30.40 is up", "card 4111 1111 1111 1111 was used",
          "card 4111111111111111 was used", "in 1999 there were 20 of 300", "version 2.0 of item 17", "nothing here", "a 5555555555554444 b", "ring +4930123456 or +4930654321"]


def test_the_model_adds_spans_and_keeps_the_patterns(spark, nothing):
    repeated = "paid by 4111111111111111 4111111111111111 and 4111111111111111 later"
    rows = [(i, t) for i, t in enumerate(PEOPLE * 30)] + [(900, repeated), (901, None), (902, ""), (903, "x" * 50_000 + " 1.2.3.4"), (903, "1.2.3.4")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id bigint, text string, spans int")
    model = pii.train(df)
    got = pii.find_pii(df, model, keep=("doc_id", "spans")).collect()
    assert len(got) == len(rows)
    for r, (i, t) in zip(sorted(got, key=lambda r: (r.doc_id, -len(r.spans))), sorted(rows, key=lambda x: x[0])):
        base = [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.spans if s.base]
        if i != 903:
            assert base == brute_spans(t or "")
    spans = next(r.spans for r in got if r.doc_id == 900)
    assert [(s.start, s.end, s.base) for s in spans] == [(8, 24, False), (25, 41, False), (46, 62, True)]
    clean = [r for r in got if r.doc_id < 900 and r.doc_id % 10 in (5, 6, 7)]
    assert all(not r.spans for r in clean)
    masked = {r.doc_id: r.text for r in pii.redact(df, model).collect()}
    assert masked[0] == "write to [EMAIL] now" and masked[900].count("[CARD]") == 3 and masked[901] is None and masked[7] == "nothing here"
    empty = nothing.select("doc_id", "text")
    assert pii.find_pii(empty, pii.train(empty)).count() == 0


def test_agreement_spreads_along_skip_edges():
    g = pii.graph(["first 7777-1 then words and again 7777-1 end 88888-2"])
    assert len(g.skip) == 1 and len(g.spans) == 3
    model = pii.SkipChain(np.zeros((7, pii.WIDTH)), np.zeros((7, 7)), 3.0)
    plain = model.beliefs(g)
    assert np.allclose(plain, plain[0])
    g.features[0, 1] = 1.0
    model.unary[3, 1] = 4.0
    moved = model.beliefs(g)
    assert moved[1, 3] > 0.6 > plain[1, 3] and np.isclose(moved[2, 3], plain[2, 3])


def test_long_tokens_and_many_spans():
    long = "7" * 300 + "@" + "a" * 10_000
    g = pii.graph([long + " x", long[:-1] + " x"])
    assert (g.features[0] == pii.token_features(long)).all()
    text = " ".join(f"user{k}@mail.example.org" for k in range(20_000))
    begin = time.process_time()
    spans = pii.all_spans([text], pii.SkipChain(np.zeros((7, pii.WIDTH)), np.zeros((7, 7)), 1.0))[0]
    assert len(spans) == 20_000 and time.process_time() - begin < 10  # quadratic: 16 s and more
    taken = pii._Taken([(0, 5, 9), (1, 3, 20), (2, 30, 31)])
    want = lambda s, e: any(a < e and b > s for a, b in [(5, 9), (3, 20), (30, 31)])
    assert all(taken.meets(s, e) == want(s, e) for s in range(35) for e in range(s + 1, 36))


def test_messages_settle_on_long_chains():
    n = 400
    model = pii.SkipChain(np.zeros((7, pii.WIDTH)), 2.0 * np.eye(7), 1.0)
    model.unary[1, 0] = 0.0
    g = pii.Graph([(0, k, k + 1) for k in range(n)], np.zeros((n, pii.WIDTH)), np.array([(k, k + 1) for k in range(n - 1)]), np.zeros((0, 2), np.int64))
    g.features[0, 1] = 1.0
    model.unary[2, 1] = 5.0
    got = model.beliefs(g)
    log = g.features @ model.unary.T
    log[0] += model.trans[0]
    log[-1] += model.trans[:, 0]
    forward, backward = log.copy(), np.zeros_like(log)
    for k in range(1, n):
        forward[k] += np.logaddexp.reduce(forward[k - 1][:, None] + model.trans, axis=0)
        backward[n - 1 - k] = np.logaddexp.reduce(model.trans + (log + backward)[n - k][None, :], axis=1)
    want = np.exp(forward + backward - np.logaddexp.reduce(forward + backward, axis=1)[:, None])
    assert np.allclose(got[:60], want[:60], atol=1e-3)


# ---- licences ------------------------------------------------------------------------------------


def test_license_phrases_and_words():
    rng = random.Random(8)
    bits = ["MIT", "License", "license", "apache", "general", "public", "É", "x1", "<>", " ", " ", ",", "\n", "mit license"]
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for _ in range(3000):
        t = "".join(rng.choice(bits) + rng.choice([" ", "", "-"]) for _ in range(rng.randint(0, 12)))
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        words = word.findall(low)
        assert licenses.words_of(t) == words
        want = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        assert licenses.phrase_places(words, licenses.PHRASES) == want


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def fewest_edits(parts, span):
    """Edits between a notice, cut at its fixed words, and a stretch of text that holds those words as they are."""
    if len(parts) == 1:
        return edit_distance(parts[0], span)
    ends = [m.start() for m in re.finditer(rf"(?<!\S){re.escape(parts[1])}(?!\S)", span)]
    return min((edit_distance(parts[0], span[:at]) + fewest_edits(parts[2:], span[at + len(parts[1]):]) for at in ends), default=999)


def brute_notices(words):
    found = set()
    for notice in licenses.NOTICES:
        plain = licenses.bare(notice)
        most, parts = licenses.edits_for(plain), re.split(r"\{([^}]*)\}", notice)
        if any(w not in words for w in parts[1::2]):
            continue
        for i in range(len(words)):
            for j in range(i, len(words)):
                span = " ".join(words[i : j + 1])
                if abs(len(span) - len(plain)) <= most and fewest_edits(parts, span) <= most:
                    found.add(plain)
    return found


def test_fuzzy_notices_are_found_as_by_a_plain_scan():
    rng = random.Random(9)
    search = licenses.search_for(licenses.NOTICES)
    assert len(search.notices) == len(set(search.notices)) >= 40
    for trial in range(150):
        notice = rng.choice(search.notices)
        chars = list(notice)
        for _ in range(rng.randint(0, licenses.edits_for(notice) + 1)):
            k = rng.randrange(1, len(chars) - 1)
            chars[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "q"])
        words = licenses.words_of("the words before " + "".join(chars) + " and those after it")
        assert {search.notices[m[0]] for m in licenses.verified(words, search)} == brute_notices(words), " ".join(words)


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the MPL license", ["mpl"]),
    ("Released under the MPL license", ["mpl"]),
    ("licensed under CC BY-ND 4.0", ["cc-by-nd"]),
    ("licensed under CC BY-NC-SA 4.0, see below", ["cc-by-nc-sa"]),
    ("licenced under CC BY 4.0", ["cc-by"]),
    ("small rights reserved", []),
    ("Overall rights reserved", []),
    ("All right reserved", ["proprietary"]),
    ("Relaesed under the MIT Licence.", []),
    ("Released undr the MIT Licence.", ["mit"]),
    ("under the terms of the GNU Affero General Public License", ["agpl"]),
    ("under the terms of the GNU General Public Licence", ["gpl"]),
    ("licensed under the unit license", []),
    ("This is free and unencumbered software released in to the public domain", ["unlicense"]),
    ("Licensed under the Apache License, Version 2.0. All rights reserved. Released under the MIT license", ["apache", "proprietary", "mit"]),
])
def test_labels_of_notices(text, labels):
    search = licenses.search_for(licenses.NOTICES)
    assert [search.labels[m[0]] for m in licenses.fuzzy_matches(licenses.words_of(text), search)] == labels


def test_license_operator(spark, nothing):
    texts = [None, "", "Released under the MIT License.", "Released undr the MIT Lisense", "x " * 50_000 + "Licensed under the Apache License, Version 2.0", "clean text"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate([*texts, texts[2]])], "doc_id bigint, text string, n_words string")
    rows = {r.doc_id: r for r in licenses.find_licenses(df, keep=("doc_id", "n_words")).collect()}
    assert len(rows) == 7 and rows[0].n_words == rows[1].n_words == 0 and rows[5].matches == [] and rows[5].places == []
    assert [(m.label, m.edits, m.first_word, m.last_word) for m in rows[2].matches] == [("mit", 0, 0, 4)] and rows[2].places[0].label == "mit"
    assert rows[3].places == [] and [(m.label, m.edits) for m in rows[3].matches] == [("mit", 2)]
    assert rows[4].places[0].first_word == 50_003 and rows[4].matches[0].label == "apache"
    assert licenses.find_licenses(nothing).count() == 0


# ---- tokens of texts that the library has to see ------------------------------------------------


def test_long_texts_of_any_script_are_split():
    coder = piececoder.json_coder(JSON)
    rng = random.Random(12)
    words = ["слово", "и", "ещё", "λόγος", "“quoted”", "x1", "日本語の文章。", "漢字、", "<|endoftext|>", "it's", "\u200b", "\u180e", "\u00a0", "—", "12 345", "e\u0301"]
    stock = Tokenizer.from_file(JSON)
    for _ in range(200):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\n", "\n\n", "\t", "", "\u3000"]) for _ in range(rng.randint(1, 60)))
        for most in (1, 7, 50):
            cut = list(piececoder.safe_stretches(text, most))
            assert "".join(cut) == text
            ids = [i for s in cut for i in stock.encode(s, add_special_tokens=False).ids]
            assert ids == stock.encode(text, add_special_tokens=False).ids, repr(text)
    long = "слово и ещё одно слово. " * 60_000
    assert len(list(piececoder.safe_stretches(long))) > 3
    assert np.frombuffer(coder.encode([long])[0], "<u4").tolist() == stock.encode(long, add_special_tokens=False).ids


# ---- quality -------------------------------------------------------------------------------------


def test_marginals_against_all_labelings():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 4])
    scores, trans = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    z, p, expected = quality.marginals(scores, trans, lengths)
    at, total = 0, np.zeros((2, 2))
    for d, n in enumerate(lengths):
        weights = {}
        for code in range(2**n):
            y = [(code >> k) & 1 for k in range(n)]
            weights[tuple(y)] = np.exp(sum(scores[at + k, y[k]] for k in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
        whole = sum(weights.values())
        assert np.isclose(z[d], np.log(whole))
        for k in range(n):
            assert np.isclose(p[at + k, 1], sum(w for y, w in weights.items() if y[k]) / whole)
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                total[a, b] += w / whole
        at += n
    assert np.allclose(total, expected)


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    field = quality.train(docs, labels, most=800)
    held = docs.join(labels, "doc_id").filter(quality.fold_of() == 2)
    rows = quality.score_docs(held, field, keep=("doc_id", "quality")).collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([[(g > b) + 0.5 * (g == b) for g in good] for b in bad]) > 0.98
    assert np.mean([s >= 0.7 for s in good]) > 0.97 and np.mean([s < 0.7 for s in bad]) > 0.9


def test_a_long_line_is_one_line():
    line = "word " * 5000
    assert quality.split_lines(line + "\nshort") == [line, "short"]
    field = quality.fit_field([["a good line of text here."]] * 5 + [["XX!! YY!! ZZ!!"]] * 5, [1] * 5 + [0] * 5)
    assert len(field.good_lines([quality.split_lines(line)])) == 1


def test_quality_cases(spark, docs, nothing):
    field = quality.fit_field([["a good line of text here."]] * 5 + [["XX!! YY!! ZZ!!"]] * 5, [1] * 5 + [0] * 5)
    rows = quality.score_docs(docs, field, keep=("doc_id", "score")).collect()
    assert len(rows) == len(TEXTS) + 2 and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[0] == by_id[1] and np.isclose(by_id[7], by_id[8])
    assert quality.score_docs(nothing, field).count() == 0
    flat = quality.train(nothing, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert {r.score for r in quality.score_docs(docs, flat).collect()} == {0.5}
    assert quality.keep_good(docs, flat, 0.4).columns == docs.columns and quality.keep_good(docs, flat, 0.6).count() == 0


def test_scores_do_not_depend_on_the_batch(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    field = quality.train(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    one, many = (quality.score_docs(d, field).orderBy("doc_id").collect() for d in (docs.coalesce(1), docs.repartition(7)))
    assert np.allclose([r.score for r in one], [r.score for r in many]) and docs.select(F.count("doc_id")).first()[0] == len(one)


def test_lines_are_described_alike_in_lots(monkeypatch):
    rng = np.random.default_rng(3)
    words = ["aa", "aa", "b!", "C3", "é", "\x1f", " ", "\t", "dd dd"]
    docs = [[" ".join(rng.choice(words, rng.integers(0, 40))) for _ in range(rng.integers(1, 9))] for _ in range(40)] + [[""], ["", ""]]
    whole, weights = quality.line_features(docs), rng.normal(size=quality.WIDTH)
    counts = [quality._word_counts(x) for d in docs for x in d]
    monkeypatch.setattr(quality, "LOT", 17)
    assert len(list(quality.own_features(docs))) > 100
    assert np.array_equal(quality.line_features(docs), whole)
    assert np.allclose(quality.line_values(docs, weights), whole @ weights)
    assert [quality._word_counts(x) for d in docs for x in d] == counts


def test_kept_documents_are_rows_as_they_were(spark):
    rows = [(k, t, 1.5, "x", {"a": [1, None]}) for k, t in enumerate([None, "", "a good line of text here.\n" * 3, "XX!! YY!! ZZ!!", "a good line of text here."])]
    docs = spark.createDataFrame(rows + rows[2:4], "doc_id bigint, text string, score double, `a.b` string, extra map<string,array<int>>")
    field = quality.fit_field([["a good line of text here."]] * 5 + [["XX!! YY!! ZZ!!"]] * 5, [1] * 5 + [0] * 5)
    scores = {r.doc_id: r.score for r in quality.score_docs(docs.drop("score"), field).collect()}
    kept = quality.keep_good(docs, field, 0.6)
    assert kept.dtypes == docs.dtypes
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in rows + rows[2:4] if scores[r[0]] >= 0.6), key=str)
    assert {2, 4} <= {r.doc_id for r in kept.collect()} and 3 not in {r.doc_id for r in kept.collect()}
