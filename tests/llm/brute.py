"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def exact(rows):
    """doc_id -> (keep_id, group_size, kept, sha)."""
    groups = {}
    for d, t in rows:
        groups.setdefault(BLANKS.sub("", t or ""), []).append((-len(t or ""), d))
    return {d: (min(g)[1], len(g), d == min(g)[1], sha(bare.encode())) for bare, g in groups.items() for _, d in g}


def repeats(rows, length=50):
    """doc_id -> (n_bytes, n_removed, n_spans, sha of what stays)."""
    first, out = {}, {}
    for d, t in sorted(rows):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first.setdefault(raw[i : i + length], d) < d:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(raw, gone) if not y)
        out[d] = len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)
    return out


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def near(rows, size=3, percent=85):
    """doc_id -> (n_shingles, component)."""
    sets = {d: shingles(t, size) for d, t in rows}
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {d: (len(s), top(d)) for d, s in sets.items()}


def plain_words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def leaks(docs, items, similarity=0.8, size=5):
    """Pairs (doc, item) with the best similarity over all windows of the item's length."""
    out = {}
    for item, text in items:
        words = plain_words(text)
        if not words:
            continue
        q = min(size, len(words))
        want = Counter(tuple(words[i : i + q]) for i in range(len(words) - q + 1))
        for doc, t in docs:
            have = plain_words(t)
            for s in range(len(have) - len(words) + 1):
                got = Counter(tuple(have[i : i + q]) for i in range(s, s + len(words) - q + 1))
                common = sum((want & got).values())
                value = common / (sum(want.values()) + sum(got.values()) - common)
                if value >= similarity:
                    out[doc, item] = max(value, out.get((doc, item), 0))
    return out


def manifest(rows, changed=lambda d: False):
    """doc_id -> (leaf, subroot, root, proof, folded) of rows (doc_id, source, lang, n_chars, text), by whole trees."""
    def leaf(row):
        return sha(b"".join(b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode()) for v in row))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 8]).encode()) for i in range(0, len(out[-1]), 8)])
        return out

    def lower(text):
        return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, order = {}, {}
    for g in names:
        order[g] = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in order[g]])
    upper = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, row in enumerate(order[g]):
            value, proof = leaf((*row[:4], lower(row[4])) if changed(row[0]) else row), ""
            for tree, at in ((trees[g], i), (upper, k)):
                for level in tree[:-1]:
                    nodes, slot = level[at // 8 * 8 : at // 8 * 8 + 8], at % 8
                    proof += "".join(nodes[:slot] + nodes[slot + 1 :])
                    value = sha("".join([*nodes[:slot], value, *nodes[slot + 1 :]]).encode())
                    at //= 8
            out.append((row[0], leaf(row), trees[g][-1][0], upper[-1][0], sha(proof.encode()), value))
    return out


def term_weights(text):
    return Counter(re.split("[\x20\x09-\x0D]+", (text or "").lower().strip("\x20\x09\x0A\x0B\x0C\x0D")))


def fingerprint(text, samples=64):
    """Consistent weighted samples, one after the other."""
    import math

    import xxhash

    def of_long(x, seed):
        return xxhash.xxh64_intdigest((x % 2**64).to_bytes(8, "little"), seed)

    def of_int(x, seed):
        return xxhash.xxh64_intdigest((x % 2**32).to_bytes(4, "little"), seed)

    def halves(x):
        return ((x & 0xFFFFFFFF) + 0.5) / 2**32, ((x >> 32) + 0.5) / 2**32

    terms = {xxhash.xxh64_intdigest(w.encode(), 42): n for w, n in term_weights(text).items()}
    out = ""
    for i in range(samples):
        least = []
        for term, n in terms.items():
            a = of_int(i, of_long(term, 42))
            b = of_int(1, of_long(a, 42))
            (u, v), (x, y) = halves(a), halves(b)
            r, c, even = -math.log(u * v), math.log(-math.log(x * y)), (of_int(2, of_long(b, 42)) >> 11) / 2**53
            t = math.floor(math.log(n) / r + even)
            least.append((math.floor((c - r * (t - even + 1)) * 2**24), of_long(t, of_long(term, 42)) & 0xFFFFFFFF))
        out += f"{min(least)[1] & 0xFFFF:04x}"
    return out


def collocations(rows, longest=3, least=10, percent=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows (lang, text), by counting every run."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").encode().lower().decode()):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang or "und"] += len(words)
            f.update((lang or "und", tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    covered = {}
    for (lang, words), a in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = lang, words[i : i + k]
                covered[part] = max(a, covered.get(part, 0))
    ranked = {}
    for (lang, words), a in found.items():
        if 100 * covered.get((lang, words), 0) >= percent * a:
            continue
        score, _, l, r = min((1000000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
        ranked.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return [(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, rows in ranked.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
