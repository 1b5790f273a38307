"""The columns that the registered queries return, against plain code on whole small tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallyforge.llm import licenses, pii
from tallyforge.llm.queries import JSON, QUERIES, RANKS

from test_llm_text import brute_notices, brute_spans, check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows_of(spark, name, texts, per_doc=True):
    rows = QUERIES[name](spark, SF).collect()
    if per_doc:
        assert sorted(r.doc_id for r in rows) == sorted(texts)
    return rows


def hexed(data):
    return hashlib.sha256(data).hexdigest()


def test_personal_data(spark, texts):
    for r in rows_of(spark, "op1_pii_skip_chain", texts):
        want = brute_spans(texts[r.doc_id] or "")
        n = Counter(pii.KINDS[k] for k, _, _ in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in pii.KINDS)
        listed = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in want]
        assert r.base_sha256 == hexed(",".join(listed).encode())
        spans = [x for x in r.spans.split(",") if x]
        assert set(listed) <= set(spans)
        keys = [(pii.KINDS.index(k), int(s)) for k, s, _ in (x.split(":") for x in spans)]
        assert keys == sorted(keys)


def test_token_counts(spark, texts):
    stock = Tokenizer.from_file(JSON)
    for r in rows_of(spark, "op3_token_counts", texts):
        text = texts[r.doc_id] or ""
        n = len(stock.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512)


def test_packing(spark, texts):
    rows = rows_of(spark, "op6_packing", texts, per_doc=False)
    filled = check_packing(rows, texts)
    assert sum(n for p in filled.values() for _, n in p) > 0.9 * 2048 * len(filled)


def test_licenses(spark, texts):
    for r in rows_of(spark, "op7_license_scan", texts):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id] or ""))
        places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        base = sorted({label for _, label in places})
        assert r.base_labels == ",".join(base) and set(base) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        if len(words) < 120:
            found = brute_notices(words)
            assert set(filter(None, r.labels.split(","))) <= {licenses.NOTICES[n] for n in licenses.NOTICES if licenses.bare(n) in found} | set(base)


def test_quality(spark, texts):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = rows_of(spark, "op8_quality", texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert good and bad and np.mean([g > b for g in good for b in bad]) > 0.9


def test_byte_level_bpe(spark, texts):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in rows_of(spark, "op10_byte_bpe", texts):
        text = texts[r.doc_id] or ""
        ids = own.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hexed(np.array(ids, "<u4").tobytes()), hexed(text.encode()))
