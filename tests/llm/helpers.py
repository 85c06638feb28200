"""Small documents with the awkward cases, and brute-force definitions."""

import collections
import hashlib
import random
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, letters="abcdefgh"):
    return [
        "".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n)]


def documents(seed=1, copies=12):
    """Rows with nulls, empty, long and repeated texts, near copies and shared passages."""
    rng = random.Random(seed)
    base = prose(rng, 130)
    passage = prose(rng, 70)
    rows = [(0, " ".join(base)), (1, " ".join(base)), (2, " ".join(base[:40] + ["zz"] + base[40:])),
            (3, None), (4, ""), (5, " \t\n "), (6, "one"), (7, "one two"), (8, "One two"),
            (9, " ".join(prose(rng, 30) + passage + prose(rng, 30))),
            (10, "\n".join(passage[:60]) + "  " + " ".join(prose(rng, 80))),
            (11, "\n".join(["same line here"] * 5 + [" ".join(prose(rng, 60))])),
            (12, "x" * 3000), (13, "Grün ñandú été   中文 😀 don't we'll  go\n\n<|endoftext|> end"),
            (14, " ".join(["tick"] * 200)), (None, " ".join(base)), (15, " ".join(passage)),
            (6, "one"), (6, "other text with the same id")]
    rows += [(100 + k, " ".join(prose(rng, 5) + passage + prose(rng, 60))) for k in range(copies)]
    rows += [(200 + k, " ".join(prose(rng, 90))) for k in range(20)]
    return [(i, t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 2}", len(t or "")) for i, t in rows]


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def rule_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    hit = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
            len(words) < 50 or 100 * len(hit) > 50 * len(words))


def fingerprint(text):
    words = WORD.findall((text or "").encode().lower().decode())
    joined = ([" ".join(w) for w in zip(words, words[1:], words[2:])] if len(words) >= 3
              else [" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in joined]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, bits=2):
    """Root index of each fingerprint."""
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def kept_words(rows, window=50):
    """(words, kept words) of each (id, text); a missing id is larger than all others."""
    key = lambda i: float("inf") if i is None else i
    first, words = {}, []
    for i, text in rows:
        w = WORD.findall(text or "")
        words.append(w)
        for k in range(len(w) - window + 1):
            at = tuple(w[k:k + window])
            first[at] = min(first.get(at, key(i)), key(i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < key(i):
                gone.update(range(k, k + window))
        out.append((w, [x for k, x in enumerate(w) if k not in gone]))
    return out


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text):
    return BENCH_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def bench_hits(text, items, window=10):
    """(words, hit words, listed items) by definition."""
    words = bench_words(text)
    hit, found = set(), set()
    for item, body in items:
        w = bench_words(body)
        size = min(window, len(w))
        for a in range(len(w) - size + 1) if size else ():
            for k in range(len(words) - size + 1):
                if words[k:k + size] == w[a:a + size]:
                    hit.update(range(k, k + size))
                    found.add(item)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)
