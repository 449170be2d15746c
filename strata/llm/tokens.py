"""Byte-level BPE of whole texts, a batch at a time.

The vocabulary file is a parameter (a public ``tokenizer.json``) and nothing
is trained. Cutting a text into pieces is regular enough for numpy, and equal
pieces are encoded once per worker: a batch's pieces are told apart by their
packed code points, and only new ones reach the encoder. Texts with a special
token's string, or with code points whose class may differ between Unicode
versions, go through the tokenizer itself, so ids always equal
``Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids``.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# classes of code points
_OTHER, _LETTER, _NUMBER, _SPACE, _END, _ODD = 0, 1, 2, 3, 4, 5
# a sentinel between the texts of a batch; no valid text holds it
_SENTINEL = 0x110000
# pieces of at most so many code points (all below 256) are told apart packed
_PACK = 16
# entries a worker keeps of pieces seen; beyond it the cache starts anew
_CACHE_MOST = 400_000

# The contractions that the vocabulary's splitting rule cuts off.
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point (and of the sentinel). Unassigned code points,
    and those newer than Unicode 3.2, are odd: libraries may disagree."""
    table = np.full(_SENTINEL + 1, _ODD, np.uint8)
    old = unicodedata.ucd_3_2_0
    space = {0x85, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x20, 0xA0,
             *range(0x09, 0x0E), *range(0x2000, 0x200B)}
    for c in range(0xD800):
        cat, was = unicodedata.category(chr(c)), old.category(chr(c))
        if c in space:
            table[c] = _SPACE
        elif cat[0] != was[0] or cat == "Cn":
            table[c] = _ODD
        else:
            table[c] = {"L": _LETTER, "N": _NUMBER}.get(cat[0], _OTHER)
    table[0x1C:0x20] = _ODD
    table[0x180E] = _ODD
    table[_SENTINEL] = _END
    return table


def _starts(cp: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Start places of all pieces; sentinels are pieces of their own."""
    n = len(cp)
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(cls[1:], cls[:-1], out=start[1:])
    start[cls == _END] = True
    # the last of a run of white space leaves the run if a non-space follows ...
    last = np.flatnonzero((cls[:-1] == _SPACE) & (cls[1:] != _SPACE) & (cls[1:] != _END))
    start[last] = True
    # ... and a plain blank joins what follows
    start[last[cp[last] == 0x20] + 1] = False
    # contractions: an apostrophe that begins a piece, then one of the endings
    for i in np.flatnonzero((cp[:-1] == 0x27) & start[:-1] & (cls[1:] == _LETTER)):
        for c in _CONTRACTIONS:
            k = len(c)
            if i + k <= n and all(cp[i + j] == ord(c[j]) for j in range(1, k)):
                start[i + 1:i + k] = False
                if i + k < n:
                    start[i + k] = True
                break
    return np.flatnonzero(start)


class BatchEncoder:
    """Ids of texts by the vocabulary file ``path``."""

    def __init__(self, path: str):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = tuple(t["content"] for t in spec.get("added_tokens", []))
        self.bpe = self._encoding(spec)
        self._forget()

    def _encoding(self, spec: dict):
        """The same merges as ranks, or None where they are no byte-level BPE
        whose ids are in merge order (then every text goes the slow way)."""
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel"
                 and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                 and not spec.get("normalizer")
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                    "end_of_word_suffix", "byte_fallback")))
        if not plain:
            return None
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        shown = {b: chr(b) for b in printable}
        for k, b in enumerate(b for b in range(256) if b not in shown):
            shown[b] = chr(256 + k)
        back = {c: b for b, c in shown.items()}
        ranks = {}
        for token, i in model["vocab"].items():
            if token not in self.special:
                ranks[bytes(back[c] for c in token)] = i
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        ids = [model["vocab"][m.replace(" ", "")] for m in merges]
        if ids != sorted(ids) or any(i < 256 for i in ids):
            return None
        self.line = ranks[b"\n"]
        return tiktoken.Encoding("pieces", pat_str=r"[^\n]+|\n+", mergeable_ranks=ranks, special_tokens={})

    def _forget(self) -> None:
        """Start with no pieces known. Piece number k has the ids
        ``pool[begin[k]:begin[k] + many[k]]``; number 0 is the sentinel."""
        self.pool = np.zeros(0, np.uint32)
        self.begin, self.many = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.wide: dict[str, int] = {}
        self.mix = np.zeros(0, np.uint64)  # of the packed pieces, sorted
        self.halves, self.number = np.zeros((0, 2), np.uint64), np.zeros(0, np.int64)

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Numbers of new pieces. Those without a line break are encoded in one
        call, a line each, so that the breaks between come out as ``line``."""
        many = np.zeros(len(pieces), np.int64)
        plain = [i for i, p in enumerate(pieces) if "\n" not in p]
        white = sorted(set(range(len(pieces))) - set(plain))
        flat = np.zeros(0, np.uint32)
        if plain:
            flat = self.bpe.encode_to_numpy("\n".join([pieces[i] for i in plain]), disallowed_special=())
            cut = flat == self.line
            many[plain] = np.diff(np.concatenate(([-1], np.flatnonzero(cut), [len(flat)]))) - 1
            flat = flat[~cut]
        rest = [self.slow.encode(pieces[i], add_special_tokens=False).ids for i in white]
        many[white] = [len(x) for x in rest]
        order = np.array(plain + white, np.int64)
        begin = np.empty(len(pieces), np.int64)
        begin[order] = len(self.pool) + np.cumsum(many[order]) - many[order]
        self.pool = np.concatenate([self.pool, flat, *[np.array(x, np.uint32) for x in rest]])
        numbers = len(self.begin) + np.arange(len(pieces))
        self.begin, self.many = np.append(self.begin, begin), np.append(self.many, many)
        return numbers

    def sentence_ends(self) -> np.ndarray:
        """By id: does its token end a sentence (a full stop, exclamation or
        question mark at its end, or a line break in it)?"""
        out = np.zeros(1 + max(self.slow.get_vocab().values()), bool)
        for token, i in self.slow.get_vocab().items():
            shown = self.slow.decode([i])
            out[i] = shown.endswith((".", "!", "?")) or "\n" in shown
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        flat, ends = self.encode_flat(texts)
        return np.split(flat, ends[:-1]) if len(texts) else []

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each ends."""
        counts, flat, slow = self._run(texts, want_ids=True)
        if not slow:
            return flat, np.cumsum(counts)
        parts = np.split(flat, np.cumsum(counts)[:-1])
        for i, e in zip(slow, self.slow.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)):
            parts[i] = np.array(e.ids, np.uint32)
        return np.concatenate(parts), np.cumsum([len(p) for p in parts])

    def count(self, texts: list[str]) -> np.ndarray:
        """How many ids each text has."""
        counts, _, slow = self._run(texts, want_ids=False)
        for i, e in zip(slow, self.slow.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)):
            counts[i] = len(e.ids)
        return counts

    def _run(self, texts: list[str], want_ids: bool) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Counts and ids of the texts that go the fast way; places of the rest."""
        none = np.zeros(0, np.uint32)
        if self.bpe is None:
            return np.zeros(len(texts), np.int64), none, list(range(len(texts)))
        slow = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        held = set(slow)
        big = "".join([("" if i in held else t) + "\x00" for i, t in enumerate(texts)])
        if not big:
            return np.zeros(0, np.int64), none, slow
        cp = np.frombuffer(big.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        lengths = np.array([0 if i in held else len(t) for i, t in enumerate(texts)], np.int64)
        seps = np.cumsum(lengths + 1) - 1
        cp[seps] = _SENTINEL
        cls = _classes()[cp]
        odd = np.flatnonzero(cls == _ODD)
        if len(odd):
            found = np.unique(np.searchsorted(seps, odd))
            slow = sorted(held | set(found.tolist()))
            rest = set(slow)
            texts = ["" if i in rest else t for i, t in enumerate(texts)]
            counts, ids, _ = self._run(texts, want_ids)
            return counts, ids, slow
        starts = _starts(cp, cls)
        sizes = np.diff(np.append(starts, len(cp)))
        if len(self.begin) > _CACHE_MOST:
            self._forget()
        number = self._numbers(big, cp, starts, sizes)
        each = self.many[number]
        upto = np.cumsum(each)
        counts = np.diff(upto[np.searchsorted(starts, seps)], prepend=0)
        if not want_ids:
            return counts, none, slow
        index = np.repeat(self.begin[number] - (upto - each), each) + np.arange(int(upto[-1]))
        return counts, self.pool[index], slow

    def _numbers(self, big: str, cp: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of every piece; new ones are learnt."""
        number = np.full(len(starts), -1, np.int64)
        number[cp[starts] == _SENTINEL] = 0
        at = np.flatnonzero((sizes <= _PACK) & (np.maximum.reduceat(cp, starts) < 256))
        low = np.concatenate((cp, np.zeros(_PACK, np.uint32))).astype(np.uint8)
        # the 16 bytes from each start as two words, those past the piece cleared;
        # the size goes in too, as code point 0 may end a piece
        both = np.lib.stride_tricks.sliding_window_view(low, _PACK)[starts[at]].view(np.uint64)
        keep_bits = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        size = sizes[at]
        halves = np.empty((len(at), 2), np.uint64)
        halves[:, 0] = both[:, 0] & keep_bits[np.minimum(size, 8)]
        halves[:, 1] = both[:, 1] & keep_bits[np.maximum(size - 8, 0)]
        with np.errstate(over="ignore"):
            mix = (halves[:, 0] ^ (halves[:, 0] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            mix = (mix ^ halves[:, 1]) * np.uint64(0xC2B2AE3D27D4EB4F) + size.astype(np.uint64)
            mix ^= mix >> np.uint64(31)
        values, first, inverse = np.unique(mix, return_index=True, return_inverse=True)
        place = np.searchsorted(self.mix, values)
        known = np.zeros(len(values), bool)
        inside = np.flatnonzero(place < len(self.mix))
        known[inside] = self.mix[place[inside]] == values[inside]
        new = np.flatnonzero(~known)
        if len(new):
            a = starts[at[first[new]]]
            learnt = self._learn([big[x:y] for x, y in zip(a.tolist(), (a + size[first[new]]).tolist())])
            self.halves = np.insert(self.halves, place[new], halves[first[new]], axis=0)
            self.number = np.insert(self.number, place[new], learnt)
            self.mix = np.insert(self.mix, place[new], values[new])
            place = np.searchsorted(self.mix, values)
        mine = place[inverse]
        same = (self.halves[mine] == halves).all(axis=1)  # else two pieces share a hash
        number[at[same]] = self.number[mine[same]]
        left = np.flatnonzero(number < 0)  # long, wide or clashing pieces
        a = starts[left]
        texts = [big[x:y] for x, y in zip(a.tolist(), (a + sizes[left]).tolist())]
        fresh = sorted({t for t in texts if t not in self.wide})
        if fresh:
            self.wide.update(zip(fresh, self._learn(fresh).tolist()))
        number[left] = [self.wide[t] for t in texts]
        return number


@lru_cache(maxsize=2)
def encoder(path: str) -> BatchEncoder:
    """One encoder per worker and vocabulary."""
    return BatchEncoder(path)
