"""Plain Python forms of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def fingerprint(text, k=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, distance=4):
    """index -> smallest index of its component."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def components(docs):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    prints = [fingerprint(t) for _, t in docs]
    roots, least = linked(prints), {}
    for (i, _), r in zip(docs, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(docs, prints, roots)]


def plain_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def contamination(docs, items, window=13):
    found = defaultdict(set)
    for i, t in items:
        w = plain_words(t)
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if k and i is not None else 0):
            found[tuple(w[a : a + k])].add(str(i))
    out = []
    for i, t in docs:
        w = plain_words(t)
        hit, names = set(), set()
        for k in {len(x) for x in found}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in found:
                    hit |= set(range(a, a + k))
                    names |= found[tuple(w[a : a + k])]
        out.append((i, len(w), len(hit), len(names), sha(",".join(sorted(names))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def without_repeats(docs, window=35):
    words = [(t or "").encode().split() for _, t in docs]
    count = Counter(tuple(w[a : a + window]) for w in words for a in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(docs, words):
        gone = set()
        for a in range(len(w) - window + 1):
            if count[tuple(w[a : a + window])] > 1:
                gone |= set(range(a, a + window))
        out.append((i, len(w), len(gone), sha(b" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal(text):
    """(kind, start, end) of the base kinds, by kind, then start."""
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return out


def pii(docs):
    out = []
    for i, t in docs:
        spans = personal(t)
        n = Counter(k for k, _, _ in spans)
        out.append((i, n["email"], n["ip"], n["card"], n["phone"], sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))))
    return out


def repair_cost(roles):
    """Least cost of a legal sequence, by exhaustive steps over the last role put out."""
    number = {"system": 1, "user": 2, "assistant": 3}
    after = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
    best = {0: 0}
    for role in roles:
        r, new = number.get((role or "").strip().lower(), 0), {}
        for s, cost in best.items():
            ways = [(s, cost + 1 + 2 * (r != s))] if s else []
            for t in (1, 2, 3):
                changed = 2 * (r != t)
                ways += [(t, cost + changed)] * (t in after[s]) + [(t, cost + changed + 3) for b in after[s] if t in after[b]]
            for t, c in ways:
                new[t] = min(new.get(t, c), c)
        best = new
    return min(c + {0: 0, 1: 6, 2: 3, 3: 0}[s] for s, c in best.items())


def shingles(text, k=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard_components(docs):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if x and 100 * common >= 80 * len(x | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i)), d == least.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def audit(docs, least=10, top=10):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows."""
    found, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        terms = re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), (text or "").encode()))
        found[lang or "", source or ""].update(terms)
        seen[lang or ""].update(set(terms))
    out = []
    for lang in seen:
        kept = [t for t, n in seen[lang].items() if n >= least]
        groups = {s: c for (x, s), c in found.items() if x == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def shares(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        q, each = shares(whole), {s: shares(c) for s, c in groups.items()}
        for s, p in each.items():
            pairs = [(-sum(f(p[t], each[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(-f(p[t], q[t]), t.decode()) for t in kept if groups[s][t] and p[t] > q[t]]
            for part, listed, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(listed, key=lambda x: (x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(ranked)]
    return out


def tree(nodes, fanout=2):
    """(root, siblings of each node as lists of (before, after))."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            start = at[i] - at[i] % fanout
            path.append(("".join(nodes[start : at[i]]), "".join(nodes[at[i] + 1 : start + fanout])))
            at[i] //= fanout
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def merkle(docs, fanout=2):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text) rows."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d: sha("".join(map(field, d)))
    by_lang = defaultdict(list)
    for d in docs:
        by_lang[d[2]].append(d)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        rows = sorted(by_lang[lang], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        trees.append((rows, *tree([leaf(d) for d in rows], fanout)))
    root, tops = tree([t[1] for t in trees], fanout) if trees else (None, [])
    out = []
    for (rows, subroot, paths), top in zip(trees, tops):
        for d, path in zip(rows, paths):
            changed = d[0] is not None and d[3] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0
            node = leaf((*d[:3], d[3] + 1, d[4]) if changed else d)
            for before, after in path + top:
                node = sha(before + node + after)
            out.append((d[0], leaf(d), subroot, root, sha("".join(b + a for b, a in path + top)), node, node == root))
    return out


def lexicon_hits(weights, exceptions, words):
    """Sum over the words outside exceptions of the heaviest entry: the word itself, or a proper beginning."""
    inside = {j for i in range(len(words) - 1) if f" {words[i]} {words[i + 1]} " in exceptions for j in (i, i + 1)}
    entries = lambda w: [f" {w} ", *(" " + w[:n] for n in range(1, len(w)))]
    return sum(max((weights[e] for e in entries(w) if e in weights), default=0.0) for i, w in enumerate(words) if i not in inside)
