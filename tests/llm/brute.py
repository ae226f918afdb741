"""Plain versions of the operators, for small tables."""

import datetime
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def repeats(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(r[s : s + length] for _, r in raws for s in range(len(r) - length + 1))
    out = []
    for i, r in raws:
        gone = np.zeros(len(r), bool)
        for s in range(len(r) - length + 1):
            if seen[r[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def jaccard(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    parent, degree, postings = {i: i for i in sets}, Counter(), defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in postings[s])
        for s in sets[i]:
            postings[s].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                degree.update((i, j))
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), degree[i]) for i in sets}


def base_scores(rows):
    tokens = [(i, [*WORD.findall((t or "").translate(LOW)), None]) for i, t in rows]
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    train = Counter(w for i, x in tokens if fold(i) != 2 for w in x)
    n, v = sum(train.values()), len(train)
    return [(i, fold(i) == 2, len(x), sum(train[w] > 0 for w in x), n, sum(math.log10((train[w] + 1) / (n + v + 1)) for w in x)) for i, x in tokens]


def ngram_counts(rows, folds):
    """Counts of the tokens, pairs and triples of the rows of some folds; a document begins after an end, and has no two tokens before its first."""
    one, two, three = Counter(), Counter(), Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 in folds:
            words = [*WORD.findall((t or "").translate(LOW)), None]
            padded = [None, *words]
            one.update(words)
            two.update(zip(padded, words))  # noqa: B905
            three.update(zip(padded, words, words[1:]))  # noqa: B905
    return one, two, three


def ngram_places(rows, counts, folds):
    """For each document of the folds and each place: counts of the two tokens before (0 for the first), the triple, the one before, the pair, the token."""
    one, two, three = counts
    out = {}
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 in folds:
            words = [*WORD.findall((t or "").translate(LOW)), None]
            found = []
            for j, w in enumerate(words):
                a, b = words[j - 2] if j > 1 else None, words[j - 1] if j else None
                found.append((two[a, b] if j else 0, three[a, b, w] if j else 0, one[b], two[b, w], one[w]))
            out[i] = np.array(found, float)
    return out


def assemblies(lines, sales):
    """Closings of the sale assembly, row by row."""
    day = lambda t: (t.date() - datetime.date(1970, 1, 1)).days
    cents = lambda a: 0 if a is None or a != a or abs(a) >= 9e16 else math.floor(100 * a + 0.5)
    batch = lambda d: min(max(math.floor((d - 19723) * 10 / 160), 0), 9)
    arrived, per = defaultdict(lambda: defaultdict(list)), defaultdict(list)
    for line in dict.fromkeys(x for x in lines if x[0] is not None):
        h = zlib.crc32(f"{line[0]}:{'' if line[1] is None else line[1]}".encode())
        d = 19723 + h % 152 if line[8] is None else day(line[8]) + h % 15
        arrived[d][line[0]].append((cents(line[5]), None))
        per[line[0]].append((d, cents(line[5])))
    for sale in dict.fromkeys(x for x in sales if x[0] is not None):
        kind, own = zlib.crc32(str(sale[0]).encode()) % 5, per.get(sale[0], [])
        last = max((d for d, _ in own), default=0)
        due = cents(sale[3]) if kind == 0 else sum(c for d, c in own if kind > 1 or d < last)
        arrived[day(sale[5]) if sale[5] else 19723][sale[0]].append((None, due))
    opened, last_of, out, prior = {}, {}, [], -math.inf
    for b in range(10):
        days = sorted(d for d in arrived if batch(d) == b)
        for d in days:
            for i, rows in arrived[d].items():
                first, n, c, due = opened.get(i, (d, 0, 0, None))
                got = [x for x, _ in rows if x is not None]
                n, c = n + len(got), c + sum(got)
                due = min((x for _, x in rows if x is not None), default=None) if due is None else due
                opened[i] = first, n, c, due
                last_of[i] = d
                if due is not None and n and c == due:
                    out.append((i, first, d, n, c, due, "complete", b))
                    del opened[i]
        for i, (first, n, c, due) in list(opened.items()):
            if b == 9 or first + 10 <= prior:
                status = "headless" if due is None else "orphan" if not n else "short" if c < due else "over"
                out.append((i, first, last_of[i], n, c, due, status, b))
                del opened[i]
        prior = max([prior, *days[-1:]])
    return out
