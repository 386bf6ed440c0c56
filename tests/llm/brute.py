"""Plain single-machine versions to compare with."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash


def components(ids, linked):
    """Smallest id reachable per position, for a pairwise predicate on positions."""
    n, seen, out = len(ids), set(), [None] * len(ids)
    near = {i: [j for j in range(n) if j != i and linked(i, j)] for i in range(n)}
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        named = [ids[k] for k in group if ids[k] is not None]
        for k in group:
            out[k] = min(named) if named else None
    return out, near


def simhash(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [words[k : k + shingle] for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(" ".join(g).encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def cosine_links(labels, vectors, threshold=0.98):
    def fine(v):
        return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)

    def linked(i, j):
        if labels[i] is None or labels[i] != labels[j] or not fine(vectors[i]) or not fine(vectors[j]):
            return False
        a, b = np.array(vectors[i], float), np.array(vectors[j], float)
        return len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold

    return linked


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# Content-defined chunks, byte by byte.

WORD64 = (1 << 64) - 1


def spread(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> shift)) * factor & WORD64
    return x ^ (x >> 31)


GEAR = [spread(k * 0x9E3779B97F4A7C15 & WORD64) for k in range(1, 257)]


def chunks(data):
    """A chunk ends at 8 bytes or more where six bits are zero, at 24 where three are, and at 96."""
    out, start, h = [], 0, 0
    for k, byte in enumerate(data, 1):
        h = ((h << 2) + (GEAR[byte] >> 48)) & 0xFFFF
        size = k - start
        if (size >= 24 and h < 1 << 13) or (size >= 8 and h < 1 << 10) or size == 96:
            out.append(data[start:k])
            start = k
    return out + [data[start:]] * (start < len(data))


def digest(chunk):
    total = sum(GEAR[b] * pow(0x9FB21C651E98DF25, k, 1 << 64) for k, b in enumerate(chunk)) & WORD64
    return spread(total ^ (len(chunk) * 0x9E3779B97F4A7C15 & WORD64)) >> 32


def fingerprint(text):
    found = {}
    for chunk in chunks(text.encode("utf-8", "surrogatepass")):
        found.setdefault(digest(chunk), len(chunk))
    return found


def fingerprint_text(found):
    return base64.b64encode(b"".join(d.to_bytes(4, "big") + bytes([n]) for d, n in sorted(found.items()))).decode()


def containment(a, b):
    if not a or not b:
        return float(not a and not b)
    return sum(n for d, n in a.items() if d in b) / max(sum(a.values()), sum(b.values()))


# Scores of fitted classifiers, document by document.


def toxic_probabilities(model, text):
    """P(grade > k) for each threshold: logistic of the sum of a document's weights."""
    parts = set()
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        parts |= {"=" + word} | {word[:n] for n in (4, 5, 6) if len(word) >= n}
    hashes = {xxhash.xxh64_intdigest(p.encode()) for p in parts}
    total = sum(model.weights.get(h, 0.0) for h in hashes)
    return [1 / (1 + math.exp(min(30, max(-30, t - total)))) for t in model.thresholds]


def passage_features(text, kind, kinds, size=512):
    data = (text or "").encode("utf-8", "surrogatepass")
    starts = [k for k in range(1, len(data) - 15) if kind[data[k - 1]] == 5 and kind[data[k]] != 5]
    seen = Counter(data[k : k + 16] for k in starts)
    out = []
    for at in range(0, max(1, len(data)), size):
        piece = data[at : at + size]
        n = max(1, len(piece))
        shares, pairs = [0.0] * kinds, [0.0] * kinds**2
        for b in piece:
            shares[kind[b]] += 1 / n
        for k in range(at, min(at + size, len(data) - 1)):
            pairs[kind[data[k]] * kinds + kind[data[k + 1]]] += 1 / n
        here = [k for k in starts if at <= k < at + size]
        again = sum(seen[data[k : k + 16]] > 1 for k in here) / max(1, len(here))
        out.append([*shares, *(p**0.5 for p in pairs), again, len(here) / n * 4, len(piece) / size])
    return np.array(out)


def attention_score(model, x):
    """One bag: encode, gate, softmax over the passages, score of the weighted sum."""
    p = {k: v.astype(float) for k, v in model.weights.items()}
    logits, hidden = [], []
    for row in x:
        h = np.tanh(np.clip((row - model.mean) / model.spread, -6, 6) @ p["E"] + p["e"])
        logits.append(float(np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"]))) @ p["w"]))
        hidden.append(h)
    shares = [math.exp(v - max(logits)) for v in logits]
    z = sum(s / sum(shares) * h for s, h in zip(shares, hidden, strict=True))
    return float(1 / (1 + np.exp(-(z @ p["c"] + p["b"][0]))))
