"""Personal data: fixed patterns, and a skip-chain conditional random field that adds what they miss."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from itertools import accumulate
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

KINDS = ["email", "ip", "card", "phone"]
#: States of a token: outside, then the kinds; kinds of several tokens have a first and a later state.
STATES = ["O", "email", "ip", "card", "card+", "phone", "phone+"]
FIRST = {"email": 1, "ip": 2, "card": 3, "phone": 5}
#: Documents that a fit takes at most, characters of the longest of them, and tokens in all.
FIT_DOCS = 6000
FIT_CHARS = 32_768
FIT_TOKENS = 60_000
#: Messages are passed until none changes by more than this, in logarithms, or so many times.
SETTLED = 1e-5
ROUNDS = 200
SURE = 0.85

_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_local = re.compile(r"[A-Za-z0-9._%+-]")
# A digit run is taken whole by every pattern below, so a match can only begin where a run begins.
_ip = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_card = re.compile(r"[0-9](?:[ -]?[0-9])++")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_mark = re.compile(r"[0-9@]+")
_edge = re.compile(r"[^\s]*")
_core = re.compile(r"[A-Za-z0-9+(](?:.*[A-Za-z0-9)])?", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str):
    """Leftmost matches of the email pattern: each @ has one run of local characters before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _local.match(text, start - 1):
            start -= 1
        found = _domain.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(kind, start, end) of the fixed patterns in order of kind and start, and the spans that failed their check."""
    good, bad = [], []
    if "@" in text:
        good += [(0, s, e) for s, e in _emails(text)]
    if _mark.search(text):
        for kind, pattern, passes in (
            (1, _ip, _octets),
            (2, _card, lambda s: 16 <= len(d := _digits(s)) <= 19 and luhn(d)),
            (3, _phone, lambda s: 8 <= len(_digits(s)) <= 15),
        ):
            for m in pattern.finditer(text):
                if passes(m.group()):
                    good.append((kind, *m.span()))
                elif kind != 2 or m.end() - m.start() > 12:
                    bad.append(m.span())
    return good, bad


def tokens(text: str) -> list[tuple[int, int]]:
    """Spans of the words that hold a digit or @, without wrapping punctuation. All other words are outside."""
    out, end = [], 0
    for m in _mark.finditer(text):
        if m.start() < end:
            continue
        start = max(end, *(text.rfind(c, end, m.start()) + 1 for c in " \n\t\r"))
        end = _edge.match(text, m.end()).end()
        core = _core.search(text, start, end)
        if core:
            out.append(core.span())
    return out


_BUCKETS = (1, 3, 4, 5, 8, 10, 12, 13, 16, 20)
WIDTH = 18 + len(_BUCKETS)


def token_features(core: str) -> list[float]:
    n = len(d := _digits(core))
    letters = any(c.isalpha() for c in core)
    _, _, host = core.partition("@")
    dots = core.split(".")
    numeric = all(p.isdigit() and p.isascii() for p in dots)
    return [
        1.0, "@" in core, "." in host, letters, core.isdigit(), core.startswith("+"), core.startswith("("), "-" in core and not letters,
        len(dots) == 4 and numeric and _octets(core), len(dots) == 4 and numeric, len(dots) == 2 and numeric,
        12 < n < 20 and luhn(d), 15 < n < 20 and not letters, n == len(core) and 0 < n <= 4, "=" in core or '"' in core, len(core) > 24,
        n == len(core) == 4, n * 2 > len(core), *[1.0 * (n >= b) for b in _BUCKETS],
    ]


@dataclass
class Graph:
    """Tokens of some documents below one another: features, chain edges between neighbours, skip edges between
    successive occurrences of the same or a similar token of a document."""

    spans: list[tuple[int, int, int]]  # document, start, end
    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def graph(texts: Sequence[str]) -> Graph:
    spans, rows, chain, skip = [], [], [], []
    for d, text in enumerate(texts):
        last: dict[str, int] = {}
        for start, end in tokens(text):
            core = text[start:end]
            i = len(spans)
            if spans and spans[-1][0] == d and text[spans[-1][2] : start] in (" ", "-"):
                chain.append((i - 1, i))
            digits = _digits(core)
            key = digits if len(digits) >= 6 and "@" not in core else core.lower()
            if key in last:
                skip.append((last[key], i))
            last[key] = i
            spans.append((d, start, end))
            rows.append(token_features(core))
    as_edges = lambda e: np.array(e, dtype=np.int64).reshape(-1, 2)
    return Graph(spans, np.array(rows, dtype=float).reshape(-1, WIDTH), as_edges(chain), as_edges(skip))


@dataclass
class SkipChain:
    """Weights of features by state, of neighbouring states, and of agreement along skip edges."""

    unary: np.ndarray
    trans: np.ndarray
    agree: float

    def beliefs(self, g: Graph) -> np.ndarray:
        """(tokens, states) by loopy sum-product. Words without a digit or @ are fixed as outside: where a token
        has no neighbour in the chain, they send the transition from or to the outside state."""
        n, k = len(g.spans), len(STATES)
        local = g.features @ self.unary.T
        has_before, has_after = np.zeros(n, bool), np.zeros(n, bool)
        has_before[g.chain[:, 1]] = True
        has_after[g.chain[:, 0]] = True
        local[~has_before] += self.trans[0]
        local[~has_after] += self.trans[:, 0]
        local -= local.max(axis=1, keepdims=True)
        pair = np.concatenate([np.repeat(np.exp(self.trans)[None], len(g.chain), 0), np.repeat(np.exp(self.agree * np.eye(k))[None], len(g.skip), 0)])
        edges = np.concatenate([g.chain, g.skip])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        table = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        sent = np.zeros((len(source), k))
        for _ in range(ROUNDS if len(edges) else 0):
            total = local.copy()
            np.add.at(total, target, sent)
            out = total[source] - sent[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            made = np.log(np.einsum("ej,ejk->ek", out, table) + 1e-300)
            made -= made.max(axis=1, keepdims=True)
            change = np.abs(made - sent).max()
            sent = 0.5 * sent + 0.5 * made
            if change < SETTLED:
                break
        total = local
        np.add.at(total, target, sent)
        total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / total.sum(axis=1, keepdims=True)


def silver(texts: Sequence[str], g: Graph) -> np.ndarray:
    """State of each token by the fixed patterns; -1 in spans that failed their check, which teach nothing."""
    state = np.zeros(len(g.spans), dtype=np.int64)
    by_doc: dict[int, list[int]] = {}
    for i, (d, _, _) in enumerate(g.spans):
        by_doc.setdefault(d, []).append(i)
    for d, members in by_doc.items():
        good, bad = base_spans(texts[d])
        starts, ends = [g.spans[i][1] for i in members], [g.spans[i][2] for i in members]  # both rise
        met = lambda s, e: members[bisect_right(ends, s) : bisect_left(starts, e)]
        for s, e in bad:
            for i in met(s, e):
                state[i] = -1
        for kind, s, e in reversed(good):
            for rank, i in enumerate(met(s, e)):
                state[i] = FIRST[KINDS[kind]] + (rank > 0 and kind >= 2)
    return state


def fit_skip_chain(texts: Sequence[str], rounds: int = 250, rate: float = 0.1, penalty: float = 2e-4) -> SkipChain:
    """Pseudo-likelihood of the tokens' states given their neighbours'; the skip weight stays above 0.5."""
    g = graph(texts)
    k = len(STATES)
    unary, trans, agree = np.zeros((k, WIDTH)), np.zeros((k, k)), 1.0
    if not g.spans:
        unary[0, 0] = 10.0
        return SkipChain(unary, trans, agree)
    y = silver(texts, g)
    before, after = np.zeros(len(y), np.int64), np.zeros(len(y), np.int64)
    before[g.chain[:, 1]] = y[g.chain[:, 0]]
    after[g.chain[:, 0]] = y[g.chain[:, 1]]
    one = np.vstack([np.eye(k), np.zeros(k)])  # -1, an unknown state, weighs nothing
    skips = np.zeros((len(y), k))
    np.add.at(skips, g.skip[:, 1], one[y[g.skip[:, 0]]])
    np.add.at(skips, g.skip[:, 0], one[y[g.skip[:, 1]]])
    use = y >= 0
    f, b, a, skips, want = g.features[use], one[before[use]], one[after[use]], skips[use], one[y[use]]
    counts = want.sum(axis=0)
    weight = 1 / np.sqrt(np.maximum(counts, 1.0))[y[use]]
    weight = (weight / weight.sum())[:, None]
    theta = np.concatenate([unary.ravel(), trans.ravel(), [agree]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for r in range(1, rounds + 1):
        unary, trans, agree = theta[: k * WIDTH].reshape(k, WIDTH), theta[k * WIDTH : -1].reshape(k, k), theta[-1]
        logit = f @ unary.T + b @ trans + a @ trans.T + agree * skips
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        gap = weight * (want - p / p.sum(axis=1, keepdims=True))
        grad = np.concatenate([(gap.T @ f).ravel(), (b.T @ gap + gap.T @ a).ravel(), [(gap * skips).sum()]]) - penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
        theta[-1] = max(theta[-1], 0.5)
    return SkipChain(theta[: k * WIDTH].reshape(k, WIDTH).copy(), theta[k * WIDTH : -1].reshape(k, k).copy(), float(theta[-1]))


def _plausible(kind: int, core: str) -> bool:
    n = len(_digits(core))
    if kind == 0:
        return "@" in core.strip("@") and " " not in core
    if kind == 1:
        return bool(_ip.fullmatch(core)) and _octets(core)
    return 13 <= n <= 19 if kind == 2 else core.startswith("+") and 8 <= n <= 15


class _Taken:
    """Does a stretch meet one of some spans? The spans by their start, and the farthest end up to each."""

    def __init__(self, spans: Sequence[tuple[int, int, int]]):
        ordered = sorted((s, e) for _, s, e in spans)
        self.starts, self.ends = [s for s, _ in ordered], list(accumulate((e for _, e in ordered), max))

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at > 0 and self.ends[at - 1] > start


def all_spans(texts: Sequence[str | None], model: SkipChain) -> list[list[tuple[int, int, int, bool]]]:
    """(kind, start, end, base) of every text, in order of kind and start. Spans of the model that meet a span of
    the patterns are left out: those stay as they are."""
    texts = [t or "" for t in texts]
    found = [base_spans(t)[0] if ("@" in t or _mark.search(t)) else [] for t in texts]
    out = [[(*s, True) for s in spans] for spans in found]
    g = graph(texts)
    if not g.spans:
        return out
    belief = model.beliefs(g)
    state = np.where(belief.max(axis=1) >= SURE, belief.argmax(axis=1), 0)
    linked = {(int(a), int(b)) for a, b in g.chain}
    taken = {d: _Taken(found[d]) for d in {d for d, _, _ in g.spans}}
    i = 0
    while i < len(state):
        d, start, end = g.spans[i]
        s, i = int(state[i]), i + 1
        if s == 0:
            continue
        while s >= 3 and i < len(state) and (i - 1, i) in linked and state[i] == (s if s in (4, 6) else s + 1):
            end, i = g.spans[i][2], i + 1
        kind = {1: 0, 2: 1, 3: 2, 4: 2, 5: 3, 6: 3}[s]
        if _plausible(kind, texts[d][start:end]) and not taken[d].meets(start, end):
            out[d].append((kind, start, end, False))
    return [sorted(s) for s in out]


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", most: int = FIT_DOCS) -> SkipChain:
    """Fits on the patterns' own spans in at most `most` documents, drawn by a hash of their id. Of these, the words
    with a digit or @ and what stands beside them come from documents of up to FIT_CHARS characters. Only this
    bounded sample reaches the driver; every document is searched."""
    drawn = docs.select(F.col(id_col).alias("__id")).filter(F.col("__id").isNotNull()).orderBy(F.xxhash64("__id"), "__id").limit(most)
    marked = docs.filter(F.col(text).rlike("[0-9@]") & (F.length(text) <= FIT_CHARS)).select(id_col, text)
    rows = marked.join(F.broadcast(drawn.distinct()), F.col(id_col) == F.col("__id"), "left_semi")  # at most `most` numbers
    got = [r[text] for r in rows.orderBy(id_col, text).limit(most).collect()]
    kept, n = [], 0
    for t in got:
        n += len(tokens(t))
        if n > FIT_TOKENS:
            break
        kept.append(t)
    return fit_skip_chain(kept)


_SPANS = "spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find_pii(docs: DataFrame, model: SkipChain, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` columns with `spans`: kind, start, end (code points, end exclusive) and whether a pattern found it.

    Every whole text is searched; null and empty texts have no spans. Rows are searched one by one, so repeated rows
    and ids stay; other columns are dropped; a kept column named `spans` gives way; an empty table gives an empty one.
    """

    def work(texts: list) -> list:
        rows = [[{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in spans] for spans in all_spans(texts, model)]
        return [pa.array(rows, _TYPE)]

    return map_texts(docs, work, _SPANS, keep, text)


def masked(text: str, spans: Sequence[tuple[int, int, int, bool]]) -> str:
    """The text with each span replaced by the name of its kind; overlapping spans become one."""
    out, at = [], 0
    for kind, s, e, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{KINDS[kind].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: SkipChain, text: str = "text") -> DataFrame:
    """The rows of `docs` with personal data masked in the text. Null texts stay null; all else is as it was."""

    def work(texts: list) -> list:
        return [pa.array([None if t is None else masked(t, s) if s else t for t, s in zip(texts, all_spans(texts, model))], pa.string())]

    others = [c for c in docs.columns if c != text]
    return map_texts(docs, work, "__masked string", others, text).withColumnRenamed("__masked", text).select(*[F.col(f"`{c}`") for c in docs.columns])
