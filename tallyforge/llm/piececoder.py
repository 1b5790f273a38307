"""Byte-level BPE with the tokenizers library, applied to the distinct pieces of texts.

A text may be cut before a space or line end that follows a character other than white space, and between kana or
ideographs and their punctuation: no match of the splitting pattern spans such a place, so the pieces between are
encoded on their own and joined. Only a text without any such place is encoded in one go. Texts repeat their pieces,
hence each distinct piece is encoded once per worker, in bulk, and looked up afterwards.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .common import worker_cache

SPECIAL = "<|endoftext|>"
#: Longest stretch of an odd text that is cut into pieces at once.
STRETCH = 1 << 18
#: Bytes of text that are encoded at once: more of them share their pieces.
SLICE = 8 << 20
#: Pieces that a worker remembers before it drops those met once.
REMEMBERED = 400_000

# White space and the characters after the other places have the same class in every Unicode version of a library.
_cut = re.compile(r"(?<=[^\s\u180e\u200b])(?= )|(?<=[^\s\u180e\u200b])(?=\n)|(?<=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5])(?=[\u3001\u3002\uff01\uff0c\uff1f])")
#: White space of any of the libraries, for RE2.
_WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Texts in which a space may follow white space, or that end in it, are cut with more care.
_ODD = rf"{_WHITE} |{_WHITE}\z|\x00"
#: Characters beyond those whose classes do not depend on the Unicode version of a library, and special strings.
_UNSETTLED = rf"[^\x00-\x{{24f}}]|{re.escape(SPECIAL)}"


def byte_characters() -> list[str]:
    """Character that stands for each byte: printable ones stand for themselves, the others follow from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in printable else free))
        free += b not in printable
    return out


def safe_stretches(text: str, most: int = STRETCH) -> Iterable[str]:
    """Cuts a long text at safe places about every `most` characters."""
    start = 0
    while len(text) - start > most:
        found = _cut.search(text, start + most)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


class PieceCoder:
    """ids of texts as little-endian unsigned 32-bit bytes. `stock`: the full tokenizer, for texts with special
    strings or characters outside the settled range; without it every text takes the pieces."""

    def __init__(self, model, pattern: str, token_bytes: list[bytes], stock=None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.core, self.stock = Tokenizer(model), stock
        self.pattern = regex.compile(pattern)
        self.token_bytes = token_bytes
        self.lengths = np.array([len(t) for t in token_bytes], dtype=np.int64)
        self.zero = byte_characters()[0]
        self.characters = np.array([0, *map(ord, byte_characters()[1:])], dtype="<u4")  # 0 parts the words
        self.known: dict[str, bytes] = {}
        self.again: set[str] = set()

    def _shown(self, text: str) -> str:
        """The text's bytes as the characters that stand for them."""
        return self.characters[np.frombuffer(text.encode("utf-8"), dtype=np.uint8)].tobytes().decode("utf-32-le")

    def _ids_of(self, words: list[str]) -> np.ndarray:
        """Ids of words, matches of the pattern, one after the other."""
        if not words:
            return np.zeros(0, np.uint32)
        joined = "\0".join(words)
        if joined.count("\0") == len(words) - 1:
            shown = self._shown(joined).split("\0")
        else:
            shown = [self._shown(w).replace("\0", self.zero) for w in words]
        lots = [shown[k : k + 1000] for k in range(0, len(shown), 1000)]
        made = self.core.encode_batch_fast(lots, is_pretokenized=True, add_special_tokens=False)
        return np.concatenate([np.array(e.ids, dtype=np.uint32) for e in made])

    def _encode_pieces(self, new: list[str]) -> list[bytes]:
        """Pieces that have lost the space before them. The byte lengths of the tokens tell whose they are."""
        text = " " + " ".join(new)
        ids = self._ids_of(self.pattern.findall(text))
        sizes = np.array([len(p) for p in new]) if text.isascii() else np.array([len(p.encode("utf-8")) for p in new])
        ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(sizes + 1), side="right")
        data, out, start = ids.astype("<u4").tobytes(), [], 0
        for stop in (4 * ends).tolist():
            out.append(data[start:stop])
            start = stop
        return out

    def _recall(self, uniq: list[str]) -> list[bytes]:
        """Ids of distinct pieces, learned where they are new."""
        got = list(map(self.known.get, uniq))
        new = [p for p, g in zip(uniq, got) if g is None]
        if len(new) < len(uniq):
            self.again.update(self.known.keys() & uniq)
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known = {p: self.known[p] for p in self.again if p in self.known} if 2 * len(self.again) < REMEMBERED else {}
                self.again = set()
            self.known.update(zip(new, self._encode_pieces(new)))
            at = iter(map(self.known.__getitem__, new))
            got = [next(at) if g is None else g for g in got]
        return got

    def _alone(self, text: str) -> np.ndarray:
        """Ids of one odd text, stretch by stretch."""
        return np.concatenate([np.zeros(0, np.uint32), *[self._ids_of(self.pattern.findall(s)) for s in safe_stretches(text)]])

    def _by_library(self, text: str) -> np.ndarray:
        """Ids of a text with unsettled characters, stretch by stretch: the library keeps some 150 bytes a character."""
        made = [self.stock.encode_batch_fast([s], add_special_tokens=False)[0].ids for s in safe_stretches(text)]
        return np.concatenate([np.array(ids, dtype=np.uint32) for ids in made])

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts that are not odd, and the end of each text's ids."""
        split = pc.split_pattern(texts, " ")
        offsets = np.asarray(split.offsets) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        index = np.array(coded.indices)
        recalled = self._recall(coded.dictionary.to_pylist())
        # The first piece of a text has no space before it.
        firsts = offsets[:-1]
        heads = [self.pattern.findall(h) for h in split.flatten().take(pa.array(firsts)).to_pylist()]
        head_ids = self._ids_of([w for h in heads for w in h])
        head_bytes = np.cumsum([sum(len(w.encode("utf-8")) for w in h) for h in heads])
        head_ends = np.searchsorted(np.cumsum(self.lengths[head_ids]), head_bytes, side="right")
        index[firsts] = len(recalled) + np.arange(len(firsts))
        pool = np.concatenate([np.frombuffer(b"".join(recalled), dtype="<u4"), head_ids])
        sizes = np.concatenate([np.array([len(r) >> 2 for r in recalled], np.int64), np.diff(head_ends, prepend=0)])
        starts = np.cumsum(sizes) - sizes
        size = sizes[index]
        ends = np.cumsum(size)
        ids = pool[np.repeat(starts[index] - (ends - size), size) + np.arange(ends[-1])]
        return ids, ends[offsets[1:] - 1]

    def encode(self, texts: pa.Array | list) -> list[bytes]:
        """Ids of each text; null counts as empty."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = pc.fill_null(texts, "")
        out: list = [b""] * len(texts)
        odd = np.asarray(pc.match_substring_regex(texts, _ODD))
        unsettled = np.asarray(pc.match_substring_regex(texts, _UNSETTLED)) if self.stock is not None else np.zeros(len(texts), bool)
        for i in np.nonzero(odd | unsettled)[0].tolist():
            text = texts[i].as_py()
            out[i] = (self._by_library(text) if unsettled[i] else self._alone(text)).astype("<u4").tobytes()
        plain = np.nonzero(~(odd | unsettled))[0]
        if len(plain):
            ids, ends = self._plain(texts.take(pa.array(plain)))
            data, start = ids.astype("<u4").tobytes(), 0
            for i, stop in zip(plain.tolist(), (4 * ends).tolist()):
                out[i] = data[start:stop]
                start = stop
        return out


def json_coder(path: str) -> PieceCoder:
    """Coder of a byte-level tokenizer file, kept by the worker."""
    held = worker_cache()
    if (key := ("json", path)) not in held:
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        stock = Tokenizer.from_file(path)
        table = {c: b for b, c in enumerate(byte_characters())}
        vocab = sorted(stock.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        token_bytes = [bytes(table[c] for c in t) if t != SPECIAL else b"" for t, _ in vocab]
        held[key] = PieceCoder(stock.model, public_tokenizers.PATTERN, token_bytes, stock)
    return held[key]


def rank_coder(path: str, pattern: str) -> PieceCoder:
    """Coder of a rank file, kept by the worker. A pair merges if the ranks hold its bytes, lower ranks first:
    the library gets every such pair, in the order of the ranks of what it makes."""
    held = worker_cache()
    if (key := (path, pattern)) not in held:
        from tokenizers.models import BPE

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        table = byte_characters()
        shown = {t: "".join(table[b] for b in t) for t in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.get):
            pairs = [(token[:k], token[k:]) for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
            merges += [(shown[a], shown[b]) for a, b in sorted(pairs, key=lambda p: (ranks[p[0]], ranks[p[1]]))]
        model = BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
        token_bytes = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            token_bytes[r] = t
        held[key] = PieceCoder(model, pattern, token_bytes)
    return held[key]
