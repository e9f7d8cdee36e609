"""Plain definitions of the operators' results, for small tables."""

import hashlib
import re
from collections import defaultdict


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def near_components(docs, percent, k):
    """{doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t, k) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(i for i in docs if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in docs}


def cut_repeats(docs, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    seen, out = set(), {}
    for i, text in sorted(docs.items()):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s:s + length] in seen:
                gone[s:s + length] = b"\1" * length
            else:
                seen.add(raw[s:s + length])
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def quality_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))
