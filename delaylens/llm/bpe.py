"""Byte-pair encoding: a memoised leaf encoder and exact joining of pieces.

A long text is cut into leaves. Cuts before a space that stands between two visible characters
never change the result, as no pre-token crosses them. Where no such place exists, a single
pre-token is halved until its leaves are short; neighbouring encodings are then joined pairwise,
level by level. A join re-encodes a window of tokens around the seam and doubles it until the
window's first and last tokens agree with both sides. As an encoding is right exactly when each
pair of neighbouring tokens encodes to itself, the joined ids equal those of the whole text.
"""

import json
import os
import re

import numpy as np

#: Code points below this bound are classified by a table; other texts take the library's way.
LATIN = 0x250
#: Characters of a pre-token beyond which it is halved.
LEAF = 512
WINDOW = 8
#: Bytes up to which new pre-tokens are merged side by side, and the rank of no merge.
SHORT = 32
NONE = 1 << 40
#: Bounds of the memo of a worker process: hash slots and pooled ids.
SLOTS = 1 << 21
POOL = 8_000_000

#: The pre-tokenizer's pattern (fixed value of the public vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SEAM = "￿"
_LOADED = {}


def load(path):
    """One encoder per vocabulary file and worker process."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def byte_alphabet():
    """The printable stand-in of every byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def _classes():
    import unicodedata
    kinds = np.zeros(LATIN + 1, np.uint8)  # 0 other, 1 letter, 2 number, 3 white space, 4 seam
    for c in range(LATIN):
        kinds[c] = {"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 0)
    kinds[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = 3
    kinds[LATIN] = 4
    return kinds


class Encoder:
    def __init__(self, path):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.alphabet = byte_alphabet()
        self.kinds = _classes()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        back = {c: b for b, c in enumerate(self.alphabet)}
        plain = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            plain[i] = (token.encode() if token in self.specials
                        else bytes(back[c] for c in token))
        self.plain = plain
        self.plain_len = np.array([len(x) for x in plain], np.int64)
        self.plain_at = np.concatenate([[0], np.cumsum(self.plain_len)[:-1]])
        self.plain_data = np.frombuffer(b"".join(plain), np.uint8)
        with open(path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.rank_of = np.argsort(keys, kind="stable")
        self.pair_keys = keys[self.rank_of]
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.byte_id = np.array([vocab[c] for c in self.alphabet], np.int64)
        self.slot_hash = np.zeros(SLOTS, np.uint64)
        self.slot_at = np.zeros(SLOTS, np.uint32)
        self.slot_len = np.zeros(SLOTS, np.uint16)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.pooled = 0

    # -- whole texts -----------------------------------------------------------

    def encode_all(self, texts):
        """(ids of all texts one after another, number of ids of each text)."""
        plain = [i for i, t in enumerate(texts) if self._simple(t)]
        rest = sorted(set(range(len(texts))) - set(plain))
        ids, counts = self._encode_simple([texts[i] for i in plain])
        if not rest:
            return ids, counts
        parts = [None] * len(texts)
        for i, part in zip(plain, np.split(ids, np.cumsum(counts)[:-1])) if plain else ():
            parts[i] = part
        for i in rest:
            parts[i] = self.encode_general(texts[i])
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _simple(self, text):
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                if max(text) >= chr(LATIN):
                    return False
        return not any(s in text for s in self.specials)

    def encode_general(self, text):
        """Any text: special tokens and leaves of the remaining sections, joined."""
        out, at = [], 0
        for m in self.special.finditer(text) if self.special else ():
            out.append(self.encode_section(text[at:m.start()]))
            out.append(np.array([self.tok.token_to_id(m[0])], np.uint32))
            at = m.end()
        out.append(self.encode_section(text[at:]))
        return np.concatenate(out)

    def encode_section(self, text):
        """Text without special tokens; pre-tokens over LEAF characters go through the tree."""
        out = []
        for piece in sections(text, 1 << 14):
            if len(piece) <= 1 << 15:
                out.append(self._library(piece))
                continue
            import regex
            calm = []
            for m in regex.finditer(PATTERN, piece):
                if len(m[0]) <= LEAF:
                    calm.append(m[0])
                    continue
                out += [self._merge_many(calm)[0], self.encode_token(m[0])]
                calm = []
            out.append(self._merge_many(calm)[0])
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def _library(self, text):
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def leaves(self, text):
        """(part, bare, joins) of a long text: bytes that can be encoded apart from one another.

        A bare part is (a stretch of) one pre-token; it joins if its pre-token began in the part
        before. Special tokens stand alone.
        """
        at = 0
        spans = [m.span() for m in self.special.finditer(text)] if self.special else []
        for a, b in [*spans, (len(text), len(text))]:
            for piece in sections(text[at:a], 1 << 14):
                if len(piece) <= 1 << 15:
                    yield piece.encode(), False, False
                    continue
                import regex
                for m in regex.finditer(PATTERN, piece):
                    data = m[0].encode()
                    for i in range(0, len(data), 1 << 14):
                        yield data[i:i + (1 << 14)], True, i > 0
            if b > a:
                yield text[a:b].encode(), False, False
            at = b

    def encode_leaf(self, data, bare):
        if bare:
            return self.encode_data(data)
        return self.encode_all([data.decode()])[0]

    def join_leaves(self, parts, joins):
        """Ids of a whole text from those of its leaves, in order."""
        out, level = [], []
        for ids, onto in zip([*parts, None], [*joins, False]):
            if not onto:
                while len(level) > 1:
                    level = [self.join(*level[i:i + 2]) for i in range(0, len(level), 2)]
                out += level
                level = []
            if ids is not None:
                level.append([int(i) for i in ids])
        return np.concatenate([np.asarray(o, np.uint32) for o in out]) if out else (
            np.zeros(0, np.uint32))

    # -- one pre-token, by tree concatenation -------------------------------------

    def _merge_bytes(self, data):
        """Ids of bytes of one pre-token."""
        mapped = "".join(self.alphabet[b] for b in data)
        return [t.id for t in self.tok.model.tokenize(mapped)]

    def encode_token(self, text, leaf=LEAF):
        return self.encode_data(text.encode(), leaf)

    def encode_data(self, data, leaf=LEAF):
        if len(data) <= leaf:
            return np.array(self._merge_bytes(data), np.uint32)
        level = [self._merge_bytes(data[i:i + leaf]) for i in range(0, len(data), leaf)]
        while len(level) > 1:
            level = [self.join(*level[i:i + 2]) for i in range(0, len(level), 2)]
        return np.array(level[0], np.uint32)

    def join(self, left, right=None):
        """Ids of two neighbouring stretches of one pre-token as if encoded at once."""
        if right is None:
            return left
        size = WINDOW
        while True:
            a, b = min(size, len(left)), min(size, len(right))
            around = left[len(left) - a:] + right[:b]
            ids = self._merge_bytes(b"".join(self.plain[i] for i in around))
            if ((a == len(left) or ids[0] == around[0])
                    and (b == len(right) or ids[-1] == around[-1])):
                return left[:len(left) - a] + ids + right[b:]
            size *= 2

    # -- texts of Latin letters, all at once ---------------------------------------

    def _encode_simple(self, texts):
        from delaylens.llm.kernels import range_hashes, spread
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        whole = _SEAM + _SEAM.join(texts) + _SEAM
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        points = np.minimum(points, LATIN)
        starts, ends = self._pretokens(points)
        real = points[starts] != LATIN
        text_of = (np.cumsum(~real) - 1)[real]
        starts, ends = starts[real], ends[real]
        at, size = self._looked_up(whole, starts, ends, range_hashes(points, starts, ends))
        ids = self.pool[spread(at, size)]
        # the memo goes by hashes: ids that do not spell the texts would be another token's
        spelt = self.plain_data[spread(self.plain_at[ids], self.plain_len[ids])]
        if not np.array_equal(spelt, np.frombuffer("".join(texts).encode(), np.uint8)):
            known = {}
            each = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            for token in each:
                if token not in known:
                    known[token] = np.asarray(self.encode_token(token), np.uint32)
            size = np.array([len(known[token]) for token in each], np.int64)
            ids = np.concatenate([known[token] for token in each])
        return ids, np.bincount(text_of, size, minlength=len(texts)).astype(np.int64)

    def _pretokens(self, points):
        """Bounds of the pre-tokens; each seam character is one of its own."""
        kind = self.kinds[points]
        n = len(points)
        begin = np.ones(n, bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 4)
        runs = np.flatnonzero(begin)
        stop = np.append(runs[1:], n)
        # the last of a white-space run before visible text is its own, or joins if a space
        white = np.flatnonzero((kind[runs] == 3) & (kind[np.minimum(stop, n - 1)] != 4))
        last = stop[white] - 1
        begin[last] = True
        joins = points[last] == 32
        begin[last[joins] + 1] = False
        # contractions take one or two letters of the run after a lone apostrophe
        lone = runs[(points[runs] == 39) & (stop - runs == 1)]
        lone = lone[begin[lone]]
        follow = np.minimum(np.stack([lone + 1, lone + 2]), n - 1)
        one, two = points[follow[0]], points[follow[1]]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | (
            (one == ord("l")) & (two == ord("l")))
        for where, length in ((lone[short], 1), (lone[pair & ~short], 2)):
            begin[where + 1] = False
            rest = where[kind[where + 1 + length] == 1] + 1 + length
            begin[rest] = True
        starts = np.flatnonzero(begin)
        return starts, np.append(starts[1:], n)

    def _looked_up(self, whole, starts, ends, hashes):
        """Place in the pool and number of ids of each pre-token."""
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        at, size = self.slot_at[slot].astype(np.int64), self.slot_len[slot].astype(np.int64)
        missing = np.flatnonzero(self.slot_hash[slot] != hashes)
        if len(missing):
            _, first, inverse = np.unique(hashes[missing], return_index=True, return_inverse=True)
            where = missing[first]
            got, lengths = self._merge_many(
                [whole[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())])
            total = int(lengths.sum())
            while self.pooled + total > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            places = self.pooled + np.cumsum(lengths) - lengths
            if total:
                self.pool[self.pooled:self.pooled + total] = got
            at[missing], size[missing] = places[inverse], lengths[inverse]
            if self.pooled + total <= POOL:  # else the memo stays as it is
                self.pooled += total
                new = (self.slot_hash[slot[where]] == 0) & (lengths < 1 << 16)
                taken = slot[where][new]  # of several for one slot, the last keeps it
                self.slot_hash[taken] = hashes[where][new]
                self.slot_at[taken], self.slot_len[taken] = places[new], lengths[new]
        return at, size

    def _merge_many(self, words):
        """(ids, number of ids of each) of many pre-tokens: all short ones merge in step."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        data = [w.encode() for w in words]
        size = np.array([len(d) for d in data], np.int64)
        counts = np.zeros(len(data), np.int64)
        short = np.flatnonzero(size <= SHORT)
        width = int(size[short].max(initial=1))
        codes = np.frombuffer(b"".join(data[i].ljust(width, b"\0") for i in short), np.uint8)
        symbols = self.byte_id[codes].reshape(-1, width)
        symbols[np.arange(width) >= size[short][:, None]] = -1
        symbols = self._merge_rows(symbols)
        counts[short] = (symbols >= 0).sum(1)
        long = {i: self.encode_token(words[i]) for i in np.flatnonzero(size > SHORT).tolist()}
        for i, ids in long.items():
            counts[i] = len(ids)
        if not long:
            return symbols[symbols >= 0], counts
        out = np.zeros(int(counts.sum()), np.int64)
        at = np.cumsum(counts) - counts
        from delaylens.llm.kernels import spread
        out[spread(at[short], counts[short])] = symbols[symbols >= 0]
        for i, ids in long.items():
            out[at[i]:at[i] + len(ids)] = ids
        return out, counts

    def _ranks(self, left, right):
        keys = np.where((left >= 0) & (right >= 0), left << 32 | right, -1)
        i = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[i] == keys, self.rank_of[i], NONE)

    def _merge_rows(self, symbols):
        """Merge the lowest-ranked, leftmost pair of every row until none is left."""
        n, width = symbols.shape
        if width < 2:
            return symbols
        ranks = np.full((n, width), NONE)
        ranks[:, :-1] = self._ranks(symbols[:, :-1], symbols[:, 1:])
        live = np.arange(n)
        place = np.arange(width)
        while True:
            at = ranks[live].argmin(1)
            best = ranks[live, at]
            live, at, best = live[best < NONE], at[best < NONE], best[best < NONE]
            if not len(live):
                return symbols
            part, rank = symbols[live], ranks[live]
            rows = np.arange(len(live))
            part[rows, at] = self.merged[best]
            shift = np.minimum(place + (place > at[:, None]), width - 1)
            part = np.take_along_axis(part, shift, 1)
            rank = np.take_along_axis(rank, shift, 1)
            part[:, -1], rank[:, -1] = -1, NONE
            nxt = np.minimum(at + 1, width - 1)
            rank[rows, at] = np.where(at + 1 < width, self._ranks(part[rows, at], part[rows, nxt]),
                                      NONE)
            prev = np.maximum(at - 1, 0)
            rank[rows, prev] = np.where(at > 0, self._ranks(part[rows, prev], part[rows, at]),
                                        rank[rows, prev])
            symbols[live], ranks[live] = part, rank

    # -- back to text ---------------------------------------------------------------

    def decode_all(self, ids, counts):
        """UTF-8 bytes of each run of ids, as the library decodes it."""
        from delaylens.llm.kernels import spread
        length = self.plain_len[ids]
        data = self.plain_data[spread(self.plain_at[ids], length)].tobytes()
        bounds = np.concatenate([[0], np.cumsum(counts)])
        at = np.concatenate([[0], np.cumsum(length)])[bounds].tolist()
        return [data[a:b].decode("utf-8", "replace").encode() for a, b in zip(at, at[1:])]


_SAFE = re.compile(r"(?<=\S) (?=\S)")


def sections(text, least):
    """Cut a text before single spaces between visible characters, about every ``least``."""
    at = 0
    while len(text) - at > least:
        m = _SAFE.search(text, at + least)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    if at < len(text):
        yield text[at:]
