"""Plain single-process versions of the operators' results."""

from __future__ import annotations

import hashlib
import re
import struct

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 5)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOW))
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def near(texts, bits=2):
    """fingerprint and the members of each text's component, by position."""
    fp = [fingerprint(t) for t in texts]
    par = list(range(len(fp)))

    def root(i):
        while par[i] != i:
            i = par[i]
        return i

    for i in range(len(fp)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                par[max(a, b)] = min(a, b)
    return fp, [[j for j in range(len(fp)) if root(j) == root(i)] for i in range(len(fp))]


def covered(units, length):
    """Per document (in order of precedence) which symbols lie under an earlier window."""
    seen, out = set(), []
    for u in units:
        cov = [False] * len(u)
        for p in range(len(u) - length + 1):
            k = tuple(u[p:p + length])
            if k in seen:
                cov[p:p + length] = [True] * length
            else:
                seen.add(k)
        out.append(cov)
    return out


def suffix_rows(docs, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept bytes); docs: sorted (doc_id, text)."""
    units = [(t or "").encode() for _, t in docs]
    out = {}
    for (i, _), u, c in zip(docs, units, covered(units, length)):
        kept = bytes(b for b, x in zip(u, c) if not x)
        out[i] = (len(u), sum(c), sum(x and not (k and c[k - 1]) for k, x in enumerate(c)), kept)
    return out


def substring_rows(docs, length=20):
    """doc_id -> (n_words, n_removed, kept text)."""
    units = [WORD.findall(t or "") for _, t in docs]
    return {i: (len(u), sum(c), " ".join(w for w, x in zip(u, c) if not x))
            for (i, _), u, c in zip(docs, units, covered(units, length))}


def ids_sha256(ids):
    return hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def sha256(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
