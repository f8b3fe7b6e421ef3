"""Plain Python versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def facts(text):
    found, text = words(text), text or ""
    windows = [tuple(found[i:i + 8]) for i in range(len(found) - 7)]
    counts = Counter(windows)
    covered = set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(found)
    return (n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def near_duplicates(rows, size, percent=80):
    """rows: (doc_id, text). doc_id -> (n_shingles, component_id)."""
    sets = {}
    for doc_id, text in rows:
        found = words((text or "").translate(LOWER))
        width = min(size, len(found))
        sets[doc_id] = {tuple(found[i:i + width]) for i in range(len(found) - width + 1)} if found else set()
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and 100 * small >= percent * large:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (small + large - shared):
                    one, other = sorted((root(a), root(b)))
                    parent[other] = one
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id in ids}


def contamination(text, items, window=13):
    """items: (item_id, text). n_words, n_hit, n_items, items_sha256, contaminated."""
    found = ITEM_WORD.findall((text or "").translate(LOWER))
    hit, names = set(), set()
    for name, item in items:
        known = ITEM_WORD.findall((item or "").translate(LOWER))
        size = min(window, len(known))
        if not size:
            continue
        grams = {tuple(known[i:i + size]) for i in range(len(known) - size + 1)}
        for i in range(len(found) - size + 1):
            if tuple(found[i:i + size]) in grams:
                hit.update(range(i, i + size))
                names.add(str(name))
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(found), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(found)


ASSIGN = re.compile("(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def secrets(text):
    """The base spans: (kind, start, stop), in order."""
    text = text or ""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def targets(sizes, share=1.5, weights=(3, 1, 2), most=2):
    """sizes: source -> words. Rounds of sharing what is above the limits."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, left = {}, share * sum(sizes.values())
    open_ = set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not above:
            return {**fixed, **{s: level * weight[s] for s in open_}}
        for s in above:
            fixed[s] = float(most * sizes[s])
            left -= fixed[s]
        open_ -= above
    return fixed


def line_runs(lines, most=50):
    """Every run of whole lines that has more words than ``most`` and none to spare at one end, blank lines left aside."""
    counts = [len(words(line)) for line in lines]
    full = [i for i, n in enumerate(counts) if n]
    runs = set()
    for places, step in ((full, 1), (full[::-1], -1)):
        for k, i in enumerate(places):
            total = 0
            for j in places[k:]:
                total += counts[j]
                if total > most:
                    runs.add((i, j)[::step])
                    break
    return runs


def without_repeats(rows, rolling):
    """rows: (doc_id, text), ids distinct. ``rolling(line before or None, line)``: the rolling hash at a line."""
    pieces, seen = {}, {}
    for doc_id, text in sorted(rows):
        lines, start, found = (text or "").split("\n"), 0, []
        rolled = [rolling(before, line) for before, line in zip([None, *lines], lines)]
        for i in range(len(lines)):
            if i == len(lines) - 1 or (i > 0 and rolled[i - 1] > rolled[i] <= rolled[i + 1]):
                if i > start and WORD.search("\n".join(lines[start:i + 1])):
                    found.append((start, i, "\n".join(lines[start:i + 1])))
                start = i + 1
        pieces[doc_id] = (lines, found)
        for _, _, content in found:
            seen[content] = seen.get(content, doc_id)
    out, first = {}, {}
    runs = {doc_id: line_runs(lines) for doc_id, (lines, _) in pieces.items()}
    for doc_id, (lines, _) in pieces.items():
        for start, stop in sorted(runs[doc_id]):
            first.setdefault("\n".join(lines[start:stop + 1]), (doc_id, stop))
    for doc_id, (lines, found) in pieces.items():
        gone, own = set(), set()
        for start, stop in runs[doc_id]:
            owner, end = first["\n".join(lines[start:stop + 1])]
            if owner != doc_id or start > end:
                gone.update(range(start, stop + 1))
        for start, stop, content in found:
            if seen[content] != doc_id or content in own:
                gone.update(range(start, stop + 1))
            own.add(content)
        out[doc_id] = ("\n".join(line for i, line in enumerate(lines) if i not in gone), len(gone))
    return out


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle(rows):
    """rows: (doc_id, source, lang, n_chars, text). Rows of (doc_id, leaf, subroot, root, proof, folded root, verified)."""

    def leaf(row):
        return sha(*("-" if value is None else f"{len(str(value).encode())}:{value}" for value in row))

    def climb(digests):
        """The root, and for every digest the (left, right) siblings on its way up."""
        ways, places, level = [[] for _ in digests], list(range(len(digests))), list(digests)
        while len(level) > 1:
            for way, place in zip(ways, places):
                begin = place // 3 * 3
                way.append(("".join(level[begin:place]), "".join(level[place + 1:begin + 3])))
            level = [sha(*level[i:i + 3]) for i in range(0, len(level), 3)]
            places = [place // 3 for place in places]
        return level[0], ways

    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        members = sorted(sources[source], key=lambda row: (row[0] is not None, row[0] or 0, leaf(row)))
        trees[source] = members, *climb([leaf(row) for row in members])
    root, above = climb([trees[source][1] for source in order]) if order else (None, [])
    out = []
    for source, last in zip(order, above):
        members, subroot, ways = trees[source]
        for row, way in zip(members, ways):
            current = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                current = leaf((*row[:4], row[4].replace("\n", "")))
            for left, right in way + last:
                current = sha(left, current, right)
            proof = sha(*(left + right for left, right in way + last))
            out.append((row[0], leaf(row), subroot, root, proof, current, current == root))
    return out


UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def middle(doc_id, text, seed=42):
    """n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    units = UNIT.findall(text)
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    draw = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or draw[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted(h % (len(units) + 1) for h in draw[:2])
    prefix, inner, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if draw[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(inner), f"<S>{suffix}<P>{prefix}<M>{inner}"
    return len(units), "psm", len(prefix), len(inner), f"<P>{prefix}<S>{suffix}<M>{inner}"


def personal(text):
    """The base spans: (kind, start, stop), in order."""
    text = text or ""
    digits = lambda s: [int(c) for c in s if c in "0123456789"]

    def luhn(ds):
        return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(ds))) % 10 == 0

    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(part) <= 255 for part in m[0].split("."))]
    spans += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[1], ["email", "ip", "card", "phone"].index(s[0])))
