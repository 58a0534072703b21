"""Plain versions of the operators, for small tables."""

import collections

import regex


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def line_dedup(rows):
    """(doc_id, text) in order of doc_id -> the text without lines that match an earlier one."""
    seen, out, by_word = [], {}, collections.defaultdict(list)
    for i, text in rows:
        kept = []
        for line in text.split("\n"):
            tokens = frozenset(lower(line).split())
            common = collections.Counter(n for w in tokens for n in by_word[w])
            gone = any(5 * c >= 4 * (len(tokens) + len(seen[n]) - c) for n, c in common.items())
            if not gone:
                kept.append(line)
            if tokens:
                for w in tokens:
                    by_word[w].append(len(seen))
                seen.append(tokens)
        out[i] = "\n".join(kept)
    return out


def near_classes(rows):
    """(doc_id, text) -> the least doc_id of each document's class, by weighted Jaccard of five-word shingles."""
    ids, bags = [i for i, _ in rows], []
    for _, text in rows:
        w = lower(text).split()
        bags.append(collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))))
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for n, bag in enumerate(bags):
        near = {m for s in bag for m in where[s]}
        for s in bag:
            where[s].append(n)
        for m in near:
            both = sum((bag & bags[m]).values())
            if both >= 0.8 * (sum(bag.values()) + sum(bags[m].values()) - both):
                a, b = find(n), find(m)
                parent[max(a, b)] = min(a, b)
    least = {}
    for n, i in enumerate(ids):
        least[find(n)] = min(i, least.get(find(n), i))
    return {i: least[find(n)] for n, i in enumerate(ids)}


def contaminations(rows, items, width=20, least=0.8):
    """(doc_id, item_id) where some 20 tokens of the item, or all of a shorter one, are equal in place to four fifths."""
    tokens = lambda s: regex.findall(r"[\p{L}\p{N}]+", s.lower())
    held, grams = {i: tokens(x) for i, x in items}, collections.defaultdict(set)
    for i, x in held.items():
        for k in range(len(x) - 2):
            grams[tuple(x[k : k + 3])].add((i, k))
    out = set()
    for i, text in rows:
        x = tokens(text)
        for item, off in {(j, k - q) for k in range(len(x) - 2) for j, q in grams.get(tuple(x[k : k + 3]), ())}:
            y = held[item]
            w = min(width, len(y))
            same = [0 <= k + off < len(x) and y[k] == x[k + off] for k in range(len(y))]
            if max(sum(same[s : s + w]) for s in range(len(y) - w + 1)) >= least * w:
                out.add((i, item))
    return out


def imatch_prints(texts, least=0.001, most=0.1, subsets=8):
    """The I-Match fingerprint of each text: terms of the band, dealt to subsets by bits of their hashes."""
    import xxhash

    signed = lambda h: h - (1 << 64) if h >> 63 else h
    terms = lambda x: {signed(xxhash.xxh64_intdigest(t.encode(), seed=42)) for t in regex.split(r"[^\p{L}\p{N}]+", x.lower()) if t}
    found = [terms(x) for x in texts]
    df = collections.Counter(h for x in found for h in x)
    band = {h for h, n in df.items() if max(2, least * len(texts)) <= n <= max(2, most * len(texts))}

    def digits(held):
        h = 42
        for t in held:
            h = xxhash.xxh64_intdigest(t.to_bytes(8, "little", signed=True), seed=h)
        return f"{h:X}"[-4:] if held else "...."

    def sign(held):
        if not held:
            return "0"
        level = max(3, len(held).bit_length() - 1)
        out = f"{level:02X}"
        for family in range(3):
            for k in range(subsets):
                for size in range(3):
                    out += digits([t for t in held if ((t % (1 << 64)) >> 21 * family) % (1 << level + size) == k])
        return out

    return [sign(sorted(x & band)) for x in found]


def imatch_likeness(x, y):
    """The share of equal hashes in those subsets of both fingerprints that aren't empty in both."""
    if x == y:
        return 1.0
    if "0" in (x, y):
        return 0.0
    a, b = int(x[:2], 16), int(y[:2], 16)
    cells = lambda z, level: {(k, level + s): z[2 + 12 * k + 4 * s :][:4] for k in range(24) for s in range(3)}
    p, q = cells(x, a), cells(y, b)
    both = [(p[c], q[c]) for c in p.keys() & q.keys() if (p[c], q[c]) != ("....", "....")]
    return sum(i == j for i, j in both) / len(both) if both else 0.0
