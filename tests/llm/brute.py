"""Plain-Python versions of the operators' contracts, for small inputs."""
import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def decontaminated(docs, items, window=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256)}"""
    wins = defaultdict(set)
    for item, text in items:
        w = WORD.findall(ascii_lower(text))
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            wins[tuple(w[k:k + size])].add(item)
    sizes = {len(k) for k in wins}
    out = {}
    for doc, text in docs:
        w, hit, found = WORD.findall(ascii_lower(text)), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if items_here := wins.get(tuple(w[k:k + size])):
                    found |= items_here
                    hit.update(range(k, k + size))
        named = ",".join(sorted(map(str, found)))
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(named.encode()).hexdigest())
    return out


def base_quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = {k + d for k in range(len(w) - 4) if grams[tuple(w[k:k + 5])] > 1 for d in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    return set(zip(w, w[1:])) if len(w) > 1 else set(w)


def near_components(docs):
    """{doc_id: (n_shingles, component_id)} by all pairs."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def base_secrets(text):
    """Sorted (start, kind index, end)."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)
