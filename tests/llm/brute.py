"""Plain Python versions of the contracts, written apart from the operators."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pii(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    n = Counter(k for k, _, _ in found)
    return [n[k] for k in ("email", "ip", "card", "phone")] + [sha(",".join(f"{k}:{a}:{b}" for k, a, b in found))]


def token_rows(docs, encode):
    """docs: (doc_id, text) with distinct ids."""
    start, out = 0, {}
    for doc_id, text in sorted(docs):
        ids = encode(text or "") + [0]
        out[doc_id] = (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)
    return out


def line_dedup(docs):
    strip = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            key = line.strip(strip).translate(UPPER)
            if len(key) >= 20:
                holders[key].add(doc_id)
    out = {}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(strip).translate(UPPER)
            if not (len(key) >= 20 and len(holders[key]) >= 3 and max(holders[key]) != doc_id):
                kept.append(line)
        out[doc_id] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def shingle_set(text):
    words = [w.translate(UPPER) for w in WORD.findall(text or "")]
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def jaccard_components(docs):
    sets = {d: shingle_set(t) for d, t in docs}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    shared = Counter()
    for d, s in sets.items():
        mine = Counter(o for g in s for o in holders[g] if o < d)
        for o, n in mine.items():
            shared[o, d] = n
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[k : k + 8]) for k in range(n - 7))
    hit = set()
    for k in range(n - 7):
        if windows[tuple(words[k : k + 8])] > 1:
            hit.update(range(k, k + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 20 or 100 * len(hit) > 30 * n]


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def url(u):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
    host, path = (m[1].translate(UPPER), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best and best[2]


def substring_dedup(docs):
    first = {}
    split = {d: WORD.findall(t or "") for d, t in docs}
    for d in sorted(split):
        w = split[d]
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), d)
    out = {}
    for d, w in split.items():
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < d:
                gone.update(range(k, k + 50))
        out[d] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def decontaminate(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(UPPER))
        for k in range(max(len(w) - 13, 0) + 1 if w else 0):
            windows[tuple(w[k : k + 13])].add(str(i))
    widths = {len(w) for w in windows}
    out = {}
    for d, t in docs:
        w = word.findall((t or "").translate(UPPER))
        hit, names = set(), set()
        for n in widths:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    names |= windows[g]
        out[d] = (len(w), len(hit), len(names), sha(",".join(sorted(names))), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def mix_targets(sizes):
    """sizes: {source: words}; the contract's loop, as it reads."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in order if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in open_)
        target = {s: 3.0 * sizes[s] if s in full else left * weight[s] / share for s in order}
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def mix_chances(words, want, power=0.5):
    """words: {size class: its words}.  Each class's probability of inclusion: classes become certain one by one."""
    sure = set()
    while True:
        free = [k for k in words if k not in sure]
        level = (want - sum(words[k] for k in sure)) / sum(2 ** (power * k) * words[k] for k in free)
        over = [k for k in free if level * 2 ** (power * k) > 1]
        if not over:
            return {k: 1.0 if k in sure else level * 2 ** (power * k) for k in words}
        sure |= {max(over)}


def mix(docs, seed=7):
    """docs: (doc_id, text, source) with distinct ids.  {doc_id: (size, copies)}"""
    size = {d: len(WORD.findall(t or "")) for d, t, _ in docs}
    sources = defaultdict(list)
    for d, _, s in docs:
        sources[s].append(d)
    totals = {s: sum(size[d] for d in ids) for s, ids in sources.items()}
    target, out = mix_targets(totals), {}
    for s, ids in sources.items():
        whole = min(3, int(target[s] / totals[s])) if totals[s] else 1
        want = max(target[s] - whole * totals[s], 0)
        out |= {d: (size[d], whole) for d in ids}
        if want <= 0:
            continue
        words = Counter()
        for d in ids:
            if size[d]:
                words[size[d].bit_length() - 1] += size[d]
        chance = mix_chances(words, want)
        ranks = []
        for d in ids:
            if size[d]:
                key = f"{'null' if d is None else d}:{seed}"
                u = (int(hashlib.md5(key.encode()).hexdigest()[:12], 16) + 0.5) / 2**48
                p = chance[size[d].bit_length() - 1]
                ranks.append((0.0 if p == 1 else u / (1 - u) / (p / (1 - p)), d is None, d))
        till = 0
        for _, _, d in sorted(ranks, key=lambda x: (x[0], x[1], x[2] or 0)):
            till += size[d]
            if till - size[d] / 2 <= want:
                out[d] = (size[d], whole + 1)
    return out
