"""Plain, slow versions of the operators' contracts."""

import collections
import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD, BENCH_WORD = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
STRIP = " \t\n\x0b\x0c\r"


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def quality(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)


def quality_kept(text, stop_words):
    n, chars, symbols, dup, _, failed = quality(text)
    w = WORD.findall(text or "")
    n_lines = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
    stop, loud = sum(x.lower() in stop_words for x in w), sum(x.endswith("!!") for x in w)
    good = 2 * n <= chars <= 14 * n and 100 * symbols <= 6 * chars and 100 * stop >= 4 * n
    return not failed and good and 100 * dup <= 30 * n_lines and 100 * loud <= 30 * n


def substrings(rows):
    """rows (doc_id, text), one a doc_id."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def passages(text, items):
    """items (item_id, text); n_words, n_hit and the sorted ids."""
    split = lambda t: BENCH_WORD.findall((t or "").translate(LOWER))
    w, hit, ids = split(text), set(), set()
    for item, t in items:
        x = split(t)
        n = min(10, len(x))
        if item is None or not n:
            continue
        for a in range(len(x) - n + 1):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == x[a : a + n]:
                    hit |= set(range(i, i + n))
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def shingles(text, k=4):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(rows, k=4, percent=85):
    sets, up = {d: shingles(t, k) for d, t in rows}, {d: d for d, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def lines(rows, min_docs=3):
    """rows are documents, each on its own."""
    keys = lambda t: [x.strip(STRIP).translate(LOWER) for x in (t or "").split("\n")]
    held = collections.defaultdict(list)
    for d, t in rows:
        for k in {k for k in keys(t) if len(k) >= 20}:
            held[k].append(d)
    last = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x, k in zip(all_lines, keys(t), strict=True) if last.get(k, d) == d]
        out.append((d, len(all_lines), len(all_lines) - len(kept), sha("\n".join(kept))))
    return sorted(out)
