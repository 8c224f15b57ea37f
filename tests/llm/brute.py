"""Plain Python answers for small tables."""

import hashlib
import math
import re
import zlib
from array import array
from collections import Counter, defaultdict
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def rule_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, spare = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            spare += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), spare, len(covered), failed


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def components(nodes, links):
    root = {n: n for n in nodes}

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingle_set(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_duplicates(rows, width, per_cent=80):
    sets = {i: shingle_set(t, width) for i, t in rows if i is not None}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = Counter((a, b) for own in holders.values() for a in own for b in own if a < b)
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= per_cent * (len(sets[a]) + len(sets[b]) - n)]
    return sets, components(sets, links)


def repeats(rows, least=50):
    """id -> (bytes, kept, spans); ids are distinct."""
    first = {}
    for i, text in rows:
        b = (text or "").encode()
        for at in range(len(b) - least + 1):
            w = b[at : at + least]
            if first.get(w, i) >= i:
                first[w] = i
    out = {}
    for i, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for at in range(len(b) - least + 1):
            if first[b[at : at + least]] < i:
                gone[at : at + least] = b"\1" * least
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out[i] = (b, bytes(c for c, g in zip(b, gone) if not g), spans)
    return out


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


def rules(rows, least, confidence):
    """(tokens, label, confidence, support) of every combination of tokens, from rows (tokens, label)."""
    held = Counter()
    for tokens, label in rows:
        for n in range(1, len(set(tokens)) + 1):
            for c in combinations(sorted(set(tokens)), n):
                held[c, None] += 1
                held[c, label] += 1
    found = [(c, label, k / held[c, None], k / len(rows)) for (c, label), k in held.items() if label and k >= least * len(rows)]
    return [r for r in found if r[2] >= confidence]


def passages(rows, width=13):
    """(id, words, kept) per row; a null id is larger than any other."""
    key = {None: float("inf")}
    first = {}
    for i, text in rows:
        i = key.get(i, i)
        w = (text or "").encode().split()
        for at in range(len(w) - width + 1):
            s = tuple(w[at : at + width])
            first[s] = min(first.get(s, i), i)
    out = []
    for i, text in rows:
        w = (text or "").encode().split()
        gone = bytearray(len(w))
        for at in range(len(w) - width + 1):
            if first[tuple(w[at : at + width])] < key.get(i, i):
                gone[at : at + width] = b"\1" * width
        out.append((i, len(w), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def hard_negatives(rows, every=100, first=5):
    """Plain loops over (id, vector, label); ids are distinct."""
    own = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        own.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for a, label, v in own:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in own if i != a and len(w) == len(v))
        for ps, p, _ in [s for s in scored if s[2] == label][:first]:
            inside = [s for s in scored if s[2] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps]
            out += [(a, p, k + 1, n, -ps, -ns) for k, (ns, n, _) in enumerate(inside[:first])]
    return out


def spellings(rows, ratio=10):
    """(word, form, root, n, n_near, form_n) by comparing words through deletions."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    times = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            times[run] += len(run) >= 7
    times = {w: n for w, n in times.items() if n >= 2}
    holes = defaultdict(set)
    for w in times:
        for p in range(len(w)):
            holes[w[:p], w[p + 1 :]].add(w)
    near = {w: set() for w in times}
    for w in times:
        for p in range(len(w)):
            near[w] |= holes[w[:p], w[p + 1 :]]
            if (short := w[:p] + w[p + 1 :]) in times:
                near[w].add(short)
                near[short].add(w)
        near[w].discard(w)
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-times[x], x), default=None)
        if best and times[best] >= ratio * times[w]:
            form[w] = best
    out = []
    for w, n in times.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), times[form[w]] if w in form else None))
    return out
