"""Plain versions of the operators on lists, for small tables."""

from collections import Counter, defaultdict
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def crc(key):
    return zlib.crc32(("" if key is None else str(key)).encode())


def base_quality(text):
    w = words(text)
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts = Counter(windows)
    covered = {i + j for i, window in enumerate(windows) if counts[window] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(covered), failed


def kept_words(texts, width=35):
    """Per text: words, and which of them go."""
    split = [words(text) for text in texts]
    counts = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    found = []
    for w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if counts[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        found.append((w, gone))
    return found


def repeats(texts, width=35):
    return [(len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()) for w, gone in kept_words(texts, width)]


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def near(texts):
    """Per text: its class (the least place in it) and its links."""
    sets = [shingle_set(text) for text in texts]
    root, links = list(range(len(texts))), [0] * len(texts)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(set)
    for i, shingles in enumerate(sets):
        for shingle in shingles or [("text", texts[i] or "")]:
            holders[shingle].add(i)
    candidates = {(a, b) for group in holders.values() for a in group for b in group if a < b}
    for a, b in candidates:
        common = len(sets[a] & sets[b])
        if (texts[a] or "") == (texts[b] or "") or sets[a] and 5 * common >= 4 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return [top(i) for i in range(len(texts))], links


def unigram_scores(rows):
    """(tokens, known tokens, training tokens, base score) of (key, text) rows."""
    split = [(crc(key) % 7 == 2, [w.encode().lower() for w in words(text)] + [None]) for key, text in rows]
    counts = Counter(w for held, tokens in split if not held for w in tokens)
    n, v = sum(counts.values()), len(counts)
    return [(held, len(tokens), sum(counts[w] > 0 for w in tokens), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)) for held, tokens in split]


def vector_codes(rows, parts=8, entries=16, rounds=6):
    """(key, code, error, label error, digest) of (key, vector, label) rows, looking at all entries each time."""
    kept = [row for row in rows if row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1])]
    kept.sort(key=lambda row: (row[0] is None, row[0] or 0, row[1]))
    width = len(kept[0][1]) // parts
    cut = [[[math.floor(4096 * x) for x in vector[p * width : (p + 1) * width]] for p in range(parts)] for _, vector, _ in kept]
    books = [[cells[p] for cells in cut[:entries]] for p in range(parts)]

    def nearest(cells, book):
        return min((sum((a - b) ** 2 for a, b in zip(cells, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        groups = defaultdict(list)
        for cells in cut:
            for p in range(parts):
                groups[p, nearest(cells[p], books[p])[1]].append(cells[p])
        for (p, e), members in groups.items():
            books[p][e] = [sum(column) // len(members) for column in zip(*members)]
    found = [[nearest(cells[p], books[p]) for p in range(parts)] for cells in cut]
    errors = [sum(d for d, _ in row) for row in found]
    by_label = Counter()
    for (_, _, label), error in zip(kept, errors):
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return [(key, "".join(f"{e:02x}" for _, e in row), error, by_label[label], digest) for (key, _, label), row, error in zip(kept, found, errors)]


def divergence(rows, min_docs=30, top=50):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows, one pair and term after another."""
    rows = [tuple(cell or "" for cell in row) for row in rows]
    counts, holders, found = Counter(), Counter(), []
    for text, lang, source in rows:
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), term) for term in re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text)]
        counts.update((lang, source, term) for term in terms)
        holders.update((lang, term) for term in set(terms))
    sources = defaultdict(set)
    for _, lang, source in rows:
        sources[lang].add(source)
    for lang in sources:
        kept = [term for (of, term), n in holders.items() if of == lang and n >= min_docs]
        n = {s: [counts[lang, s, term] for term in kept] for s in sources[lang]}
        n[None] = [sum(column) for column in zip(*n.values())]
        p = {s: [1 + 10**9 * (c + 5) // (sum(cs) + 5 * len(kept)) for c in cs] for s, cs in n.items()}
        for s in sources[lang]:
            pairs = [(-sum(abs(a - b) for a, b in zip(p[s], p[o])), o.encode()) for o in sources[lang] if o != s]
            terms = [(b - a, t.encode()) for t, c, a, b in zip(kept, n[s], p[s], p[None]) if c and a > b]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                found += [(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(items, 1)]
    return found


def base_secrets(text):
    """(start, kind number, end) of the base patterns, as the contract writes them."""
    text = text or ""
    flags = re.ASCII | re.IGNORECASE
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, flags) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def random_runs(text, base):
    """Spans of key characters outside the base ones, of 20 characters or more."""
    text = text or ""
    taken = {i for start, _, end in base for i in range(start, end)}
    free = "".join("\n" if i in taken else c for i, c in enumerate(text))
    return [m.span() for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", free)]
