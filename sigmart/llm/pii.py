"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field that adds what they miss.

Every text is cut into islands: stretches around digits, at signs and written-out ones in which an entity can lie. An
island is a row of tokens, and a segment of it is a single token outside of entities or a candidate: a row of at most
``LONGEST`` tokens with a type. Features describe whole candidates (digits, groups, separators, check sums, octets,
domains, what stands beside them); their weights and those of neighbouring types make the score of a segmentation. All
other text is outside of any entity in every segmentation, so the islands' best segmentations are the text's.

The field is trained on a bounded sample of texts, with the matches of the fixed patterns as entities, and rewritten
copies of them: written-out at signs, defanged addresses, numbers without country code, other separators, and as many
spoilt ones that are no entities. Sums over all segmentations come from forward and backward passes; shards of
the sample improve the weights by themselves and are averaged, round by round. In a scan the patterns' matches are
held fixed, dynamic programming chooses boundaries and types of the rest, and what it adds needs a probability of
``LEAST_CHANCE`` over all segmentations.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigmart.llm.common import materialize

KINDS = ["email", "ip", "card", "phone"]
FINDINGS = "array<struct<kind: string, start: int, stop: int, base: boolean, chance: double>>"
SAMPLE = 1_000  # distinct texts with digits or at signs that are learned from, those with the smallest hashes
ISLANDS, ISLAND = 3, 1_000  # of a text of the sample: how many islands, and the longest one
WINDOW, OVERLAP = 8_192, 1_024  # code points of an island that are looked at together; no candidate has half the overlap
LONGEST, GROUPS = 24, 6  # tokens of an entity, and groups of digits in a number that no fixed pattern matches
LEAST_CHANCE = 0.9
SHARDS, ROUNDS, STEPS = 8, 3, 15
RATE, PENALTY = 0.4, 0.02
FIXED = 60.0  # added to the score of what the fixed patterns found

# The base patterns and their limits. Possessive repeats and look-behinds only save time.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

EVIDENCE = re.compile("[0-9@]")
NUMERIC = re.compile(r"[+(]{0,2}[0-9](?:[0-9 ().\[\]{}+-]*[0-9])?")
AT = re.compile(r"@| ?[\[({] ?at ?[\])}] ?")
WRITTEN = ("at]", "at)", "at}", "at ]", "at )", "at }")
BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]{1,96}\Z")
AFTER_AT = re.compile(r"(?:[A-Za-z0-9-]|\.| ?[\[({] ?(?:dot|\.) ?[\])}] ?){1,160}")
TOKEN = re.compile(r" ?[\[({] ?(?:at|dot|\.) ?[\])}] ?|[A-Za-z0-9]+|.", re.S)
SIGNS = {"@": "a", ".": "d", " ": "s", "-": "h", "+": "p", "(": "(", ")": ")", "_": "l", "%": "l"}


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else (2 * digit - 9 if digit > 4 else 2 * digit)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(filter("0123456789".__contains__, text))


def _emails(text: str) -> list[tuple[str, int, int]]:
    """The matches around each at sign, from the left: what stands before it is looked at once."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        last = domain.end() if domain else last
        if domain:
            found.append(("email", start, last))
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The matches of the fixed patterns, leftmost and without overlaps within a kind, failing ones dropped after matching."""
    found = _emails(text)
    if not EVIDENCE.search(text):
        return found
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches in which an entity can lie, in order and apart."""
    found = []
    if "@" in text or any(ending in text for ending in WRITTEN):
        for at in AT.finditer(text):
            before, after = BEFORE_AT.search(text, max(0, at.start() - 96), at.start()), AFTER_AT.match(text, at.end())
            if before and after:
                found.append((before.start(), after.end()))
    if EVIDENCE.search(text):
        for m in NUMERIC.finditer(text):
            # No number of less than 7 digits is looked for, save dotted ones.
            if m.end() - m.start() >= 7 and (m[0].count(".") >= 3 or len(_digits(m[0])) >= 7):
                found.append(m.span())
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return merged


def windows(start: int, stop: int) -> list[tuple[int, int, int, int]]:
    """Stretches of an island, overlapping if it is a long one, and where the entities taken from each begin."""
    out = []
    for first in range(start, max(stop - OVERLAP, start + 1), WINDOW - OVERLAP):
        last = min(first + WINDOW, stop)
        out.append((first, last, first if first == start else first + OVERLAP // 2, stop if last == stop else last - OVERLAP // 2))
    return out


# Names of the features: a candidate has a few of each group.
NAMES = ([f"digits {n}" for n in ("few", "7", "9", "10", "11", "12", "13", "16", "17", "many")]
         + [f"groups {n}" for n in range(1, 7)] + [f"longest {n}" for n in ("1", "3", "4", "5", "7", "10", "12")]
         + ["plus", "parentheses", "area", "even", "ends in four", "begins with three", "octets", "no octets", "check sum", "no check sum"]
         + [f"by {n}" for n in ("nothing", "space", "hyphen", "dot", "mark", "several")]
         + [f"{side} {what}" for side in ("before", "after") for what in ("letter", "joint", "number", "space", "other")]
         + ["mail", "mail marked", "mail dotted", "domain 2", "domain 3", "domain 4", "top letters", "top other", "local 1", "local 2", "local 3"])
FEATURE = {name: place for place, name in enumerate(NAMES)}
_DIGITS = [(7, "few"), (9, "7"), (10, "9"), (11, "10"), (12, "11"), (13, "12"), (16, "13"), (17, "16"), (20, "17")]
_LENGTHS = [(3, "1"), (4, "3"), (5, "4"), (7, "5"), (10, "7"), (12, "10")]


def _bucket(value: int, table: list[tuple[int, str]], rest: str) -> str:
    return next((name for limit, name in table if value < limit), rest)


def _beside(text: str, place: int, step: int, side: str) -> str:
    if not 0 <= place < len(text) or text[place] in "\n\r\t":
        return f"{side} space"
    char = text[place]
    if char.isalnum():
        return f"{side} letter"
    if char in "._%+@/:-":
        return f"{side} joint"
    if char == " ":
        beyond = place + step
        return f"{side} number" if 0 <= beyond < len(text) and text[beyond] in "0123456789+(" else f"{side} space"
    return f"{side} other"


class Lattice:
    """The candidates of an island: token places, types allowed and features."""

    def __init__(self, text: str, start: int, stop: int, fixed: list[tuple[str, int, int]]) -> None:
        self.text = text
        walls = sorted({place for _, *span in fixed for place in span if start < place < stop})
        self.places, kinds = [start], []
        for first, last in zip([start, *walls], [*walls, stop], strict=True):
            for m in TOKEN.finditer(text, first, last):
                token = m[0]
                self.places.append(m.end())
                if token.isascii() and token.isalnum():
                    kinds.append("n" if token.isdigit() else "w")
                elif len(token) > 1:
                    kinds.append("a" if "at" in token else "d")
                else:
                    kinds.append(SIGNS.get(token, "o"))
        self.kinds, self.size = kinds, len(kinds)
        spans: dict[tuple[int, int, bool], None] = {}
        for i in range(self.size):
            self._numbers(i, spans)
            self._mails(i, spans)
        at = {place: number for number, place in enumerate(self.places)}
        self.fixed = set()
        for kind, first, last in fixed:
            if first in at and last in at:
                spans.setdefault((at[first], at[last], kind == "email"))
                self.fixed.add((at[first], at[last], KINDS.index(kind)))
        self.spans = sorted(spans, key=lambda span: (span[1], span[0], span[2]))
        self.allowed = np.zeros((len(self.spans), len(KINDS)), dtype=bool)
        self.x = np.zeros((len(self.spans), len(NAMES)))
        for row, (first, last, mail) in enumerate(self.spans):
            self.allowed[row] = [mail, not mail, not mail, not mail]
            for name in self._mail_features(first, last) if mail else self._number_features(first, last):
                self.x[row, FEATURE[name]] = 1.0
        self.stops = [stop for _, stop, _ in self.spans]

    def _numbers(self, i: int, spans: dict) -> None:
        if self.kinds[i] not in "np(":
            return
        digits = groups = dots = apart = 0
        for j in range(i, min(i + LONGEST, self.size)):
            kind = self.kinds[j]
            if kind == "n":
                digits, groups, apart = digits + self.places[j + 1] - self.places[j], groups + 1, 0
                if digits > 19 or groups > GROUPS:
                    return
                if digits >= 7 or dots == 3:
                    spans[i, j + 1, False] = None
            elif kind in "shd()" or kind == "p" and j == i:
                apart, dots = apart + 1, dots + (kind == "d")
                if apart > 2:
                    return
            else:
                return

    def _mails(self, i: int, spans: dict) -> None:
        if self.kinds[i] not in "nw" or "a" not in self.kinds[i:i + LONGEST]:
            return
        at = dots = 0
        for j in range(i, min(i + LONGEST, self.size)):
            kind = self.kinds[j]
            if kind == "a":
                if at or j == i:
                    return
                at = j
            elif kind in "nw":
                if at and dots and self.kinds[j - 1] == "d":
                    spans[i, j + 1, True] = None
            elif kind not in "dhpl":
                return
            dots += bool(at) and kind == "d"

    def _number_features(self, first: int, last: int) -> list[str]:
        text, a, b = self.text, self.places[first], self.places[last]
        kinds = self.kinds[first:last]
        groups = [text[self.places[first + k]:self.places[first + k + 1]] for k, kind in enumerate(kinds) if kind == "n"]
        digits = "".join(groups)
        apart = {kind for kind in kinds if kind in "shd"}
        marked = any(kind == "d" and self.places[first + k + 1] - self.places[first + k] > 1 for k, kind in enumerate(kinds))
        out = [f"digits {_bucket(len(digits), _DIGITS, 'many')}", f"groups {min(len(groups), 6)}",
               f"longest {_bucket(max(map(len, groups), default=0), _LENGTHS, '12')}", _beside(text, a - 1, -1, "before"), _beside(text, b, 1, "after")]
        out.append("by mark" if marked else "by nothing" if not apart else "by several" if len(apart) > 1 else
                   {"s": "by space", "h": "by hyphen", "d": "by dot"}[apart.pop()])
        out += ["plus"] * (kinds[0] == "p")
        if "(" in kinds or ")" in kinds:
            out.append("parentheses")
            out += ["area"] * bool(re.match(r"\+?[0-9]{0,3} ?\([0-9]{2,4}\) ?[0-9]", text[a:b]))
        out += ["even"] * (len(groups) > 1 and len(set(map(len, groups))) == 1)
        out += ["ends in four"] * (len(groups) > 1 and len(groups[-1]) == 4) + ["begins with three"] * (len(groups) > 1 and len(groups[0]) == 3)
        if "".join(kinds) == "ndndndn":
            out.append("octets" if all(map(_octet, groups)) else "no octets")
        if 12 <= len(digits) <= 19:
            out.append("check sum" if _luhn(digits) else "no check sum")
        return out

    def _mail_features(self, first: int, last: int) -> list[str]:
        kinds, text = self.kinds[first:last], self.text
        at = kinds.index("a") if "a" in kinds else 0
        wide = lambda k: self.places[first + k + 1] - self.places[first + k] > 1
        top = text[self.places[last - 1]:self.places[last]]
        local, dots = sum(kind in "nw" for kind in kinds[:at]), kinds[at:].count("d")
        return ["mail", f"domain {min(dots + 1, 4)}" if dots else "domain 2", "top letters" if top.isalpha() and len(top) > 1 else "top other",
                f"local {min(max(local, 1), 3)}", _beside(text, self.places[first] - 1, -1, "before"), _beside(text, self.places[last], 1, "after"),
                *(["mail marked"] if wide(at) else []), *(["mail dotted"] if any(kind == "d" and wide(k) for k, kind in enumerate(kinds)) else [])]


class Field:
    """Weights of features by type, and of neighbouring types; type 0 is outside, type k + 1 is ``KINDS[k]``."""

    def __init__(self, weights: np.ndarray | None = None) -> None:
        size = len(NAMES) * len(KINDS)
        flat = np.zeros(size + (len(KINDS) + 1) ** 2) if weights is None else weights
        self.flat = flat
        self.features = flat[:size].reshape(len(NAMES), len(KINDS))
        self.moves = flat[size:].reshape(len(KINDS) + 1, len(KINDS) + 1)

    def scores(self, lattice: Lattice, fixed: bool) -> np.ndarray:
        scores = np.where(lattice.allowed, lattice.x @ self.features, -np.inf)
        if fixed and lattice.fixed:
            for row, (first, last, _) in enumerate(lattice.spans):
                for kind in range(len(KINDS)):
                    if (first, last, kind) in lattice.fixed:
                        scores[row, kind] += FIXED
        return scores

    def forward(self, lattice: Lattice, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log sums over the segmentations of the tokens before each place, by last type, and by the type that follows."""
        ends = np.full((lattice.size + 1, len(KINDS) + 1), -np.inf)
        follows = np.full_like(ends, -np.inf)
        ends[0, 0] = 0.0
        follows[0] = self.moves[0]
        for place in range(1, lattice.size + 1):
            ends[place, 0] = follows[place - 1, 0]
            low, high = bisect_left(lattice.stops, place), bisect_left(lattice.stops, place + 1)
            if low < high:
                begins = [first for first, _, _ in lattice.spans[low:high]]
                ends[place, 1:] = np.logaddexp.reduce(follows[begins, 1:] + scores[low:high], axis=0)
            follows[place] = np.logaddexp.reduce(ends[place][:, None] + self.moves, axis=0)
        return ends, follows

    def backward(self, lattice: Lattice, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log sums over the segmentations of the tokens from each place on, by the type before, and by the type that begins."""
        after = np.full((lattice.size + 1, len(KINDS) + 1), -np.inf)
        begin = np.full_like(after, -np.inf)
        after[-1] = 0.0
        starting: dict[int, list[int]] = {}
        for row, (first, _, _) in enumerate(lattice.spans):
            starting.setdefault(first, []).append(row)
        for place in range(lattice.size - 1, -1, -1):
            begin[place, 0] = after[place + 1, 0]
            rows = starting.get(place)
            if rows:
                stops = [lattice.stops[row] for row in rows]
                begin[place, 1:] = np.logaddexp.reduce(scores[rows] + after[stops, 1:], axis=0)
            after[place] = np.logaddexp.reduce(self.moves + begin[place][None, :], axis=1)
        return after, begin

    def chances(self, lattice: Lattice, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """The probability of each candidate by type, the expected numbers of moves, and the log of the sum of all segmentations."""
        ends, follows = self.forward(lattice, scores)
        after, begin = self.backward(lattice, scores)
        total = float(np.logaddexp.reduce(ends[-1]))
        begins = [first for first, _, _ in lattice.spans]
        spans = np.exp(follows[begins, 1:] + scores + after[lattice.stops, 1:] - total) if lattice.spans else np.zeros((0, len(KINDS)))
        moves = np.exp(ends[:-1, :, None] + self.moves + begin[:-1, None, :] - total).sum(axis=0)
        return spans, moves, total

    def gradient(self, lattice: Lattice, gold: list[tuple[int, int, int]]) -> tuple[np.ndarray, float]:
        """Of the log probability of the entities (first, last, type), and its value."""
        scores = self.scores(lattice, False)
        spans, moves, total = self.chances(lattice, scores)
        wanted, kinds, at, value = np.zeros_like(spans), [0], 0, -total
        rows = {(first, last): row for row, (first, last, _) in enumerate(lattice.spans)}
        for first, last, kind in sorted(gold):
            kinds += [0] * (first - at) + [kind + 1]
            wanted[rows[first, last], kind] = 1.0
            value += scores[rows[first, last], kind]
            at = last
        kinds += [0] * (lattice.size - at)
        steps = np.zeros_like(moves)
        np.add.at(steps, (kinds[:-1], kinds[1:]), 1.0)
        value += float((steps * self.moves).sum())
        return np.concatenate([(lattice.x.T @ (wanted - spans)).ravel(), (steps - moves).ravel()]), value

    def best(self, lattice: Lattice, scores: np.ndarray) -> list[tuple[int, int]]:
        """The best segmentation's entities: (candidate, type)."""
        ends = np.full((lattice.size + 1, len(KINDS) + 1), -np.inf)
        ends[0, 0] = 0.0
        follows, origin = np.full_like(ends, -np.inf), np.zeros(ends.shape, dtype=int)
        follows[0] = self.moves[0]
        chosen = np.full(ends.shape, -1)
        for place in range(1, lattice.size + 1):
            ends[place, 0] = follows[place - 1, 0]
            for row in range(bisect_left(lattice.stops, place), bisect_left(lattice.stops, place + 1)):
                value = follows[lattice.spans[row][0], 1:] + scores[row]
                better = value > ends[place, 1:]
                ends[place, 1:][better] = value[better]
                chosen[place, 1:][better] = row
            reached = ends[place][:, None] + self.moves
            origin[place] = reached.argmax(axis=0)
            follows[place] = reached.max(axis=0)
        place, kind, out = lattice.size, int(ends[-1].argmax()), []
        while place > 0:
            row = chosen[place, kind]
            if kind:
                out.append((int(row), kind - 1))
            place = lattice.spans[row][0] if kind else place - 1
            kind = int(origin[place, kind]) if place else 0
        return out[::-1]


def entities(text: str, field: Field | None, least: float = LEAST_CHANCE) -> list[tuple[str, int, int, bool, float]]:
    """(kind, start, stop, by a fixed pattern, probability) of everything found in a text, in order."""
    base = base_spans(text)
    out = [(*span, True, 1.0) for span in base]
    if field is not None:
        taken = sorted((start, stop) for _, start, stop in base)
        begins = [start for start, _ in taken]
        reach = np.maximum.accumulate([stop for _, stop in taken]).tolist() if taken else []
        for first, last, low, high in (window for island in islands(text) for window in windows(*island)):
            inside = [span for span in base if first < span[2] and span[1] < last]
            if len(inside) == 1 and inside[0][1:] == (first, last):
                continue  # one match fills the island
            lattice = Lattice(text, first, last, inside)
            if not lattice.spans:
                continue
            scores, chances = field.scores(lattice, True), None
            for row, kind in field.best(lattice, scores):
                start, stop = (lattice.places[place] for place in lattice.spans[row][:2])
                before = bisect_left(begins, stop) - 1
                if not low <= start < high or before >= 0 and reach[before] > start:
                    continue  # another window's, a base match, or across one
                chances = field.chances(lattice, scores)[0] if chances is None else chances
                if chances[row, kind] >= least:
                    out.append((KINDS[kind], start, stop, False, round(float(chances[row, kind]), 6)))
    return sorted(out, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def rewritten(kind: str, span: str, turn: int) -> tuple[str, bool]:
    """Another form of a match, and whether it is still one of its kind."""
    digits = _digits(span)
    if kind == "email":
        local, domain = span.split("@")
        return [(f"{local} [at] {domain}", True), (f"{local}(at){domain}", True), (f"{local} (at) {domain.replace('.', ' (dot) ')}", True),
                (f"{local}[at]{domain.replace('.', '[.]')}", True), (f"{local}.{domain}", False), (f"{local}@{domain.split('.')[0]}", False)][turn % 6]
    if kind == "ip":
        parts = span.split(".")
        return [("[.]".join(parts), True), ("(.)".join(parts), True), (".".join([*parts[:3], str(300 + turn)]), False),
                (".".join(parts[:3]), False)][turn % 4]
    if kind == "card":
        fours = [digits[place:place + 4] for place in range(0, len(digits), 4)]
        spoilt = digits[:-1] + str((int(digits[-1]) + 1 + turn % 9) % 10)
        return [(".".join(fours), True), (spoilt, False), (" ".join(spoilt[place:place + 4] for place in range(0, len(spoilt), 4)), False),
                (digits[:10], False)][turn % 4]
    ten = digits[-10:]
    return [(f"({ten[:3]}) {ten[3:6]}-{ten[6:]}", True), (f"{ten[:3]}-{ten[3:6]}-{ten[6:]}", True), (f"({ten[:3]}) {ten[3:6]} {ten[6:]}", True),
            (digits, False), (f"{ten[3:6]}-{ten[6:]}", False), (f"{ten[:4]}-{ten[4:6]}-{ten[6:8]}", False), (f"{ten[:4]}-{ten[4:6]}-{ten[6:8]} {ten[8:]}:00", False)][turn % 7]


def training_windows(text: str) -> list[str]:
    """The islands of a text that are learned from, with what stands beside them."""
    found = [(start, stop) for start, stop in islands(text) if stop - start <= ISLAND]
    return [text[max(0, start - 2):stop + 2] for start, stop in found[:ISLANDS]]


def examples(window: str, turn: int) -> list[tuple[Lattice, list[tuple[int, int, int]]]]:
    """Lattices with their entities: a window as it stands, and with one match rewritten."""
    out = [_example(window, None)]
    for kind, start, stop in base_spans(window)[:2]:
        for form in range(2):
            other, stays = rewritten(kind, window[start:stop], turn + 3 * form)
            also = (kind, start, start + len(other)) if stays else None
            out.append(_example(window[:start] + other + window[stop:], also))
    return [example for example in out if example is not None]


def _example(window: str, also: tuple[str, int, int] | None):
    spans = [] if also is None else [also]
    for span in sorted(base_spans(window), key=lambda span: (span[1], KINDS.index(span[0]))):
        if all(span[2] <= start or stop <= span[1] for _, start, stop in spans):
            spans.append(span)
    around = [(start, stop) for start, stop in islands(window)]
    if not around:
        return None
    lattice = Lattice(window, around[0][0], max(stop for _, stop in around), spans)
    known = {(first, last) for first, last, _ in lattice.spans}
    gold = sorted(span for span in lattice.fixed if span[:2] in known and span[1] - span[0] <= LONGEST)
    return (lattice, gold) if lattice.spans else None


def improved(field: Field, rows: list[tuple[Lattice, list[tuple[int, int, int]]]], steps: int) -> np.ndarray:
    """The weights after some steps up the mean log probability, each weight at its own pace (Adam)."""
    flat, first, second = field.flat.copy(), 0.0, 0.0
    for step in range(1, steps + 1):
        current = Field(flat)
        slope = sum(current.gradient(*row)[0] for row in rows) / len(rows) - PENALTY * flat / len(rows) ** 0.5
        first, second = 0.8 * first + 0.2 * slope, 0.95 * second + 0.05 * slope ** 2
        flat = flat + RATE * (first / (1 - 0.8 ** step)) / (np.sqrt(second / (1 - 0.95 ** step)) + 1e-4)
    return flat


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """A field learned from at most ``sample`` distinct texts; None where there is none with an island."""
    hashed = docs.where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("hash"), "text")
    chosen = hashed.select("hash").distinct().orderBy("hash").limit(sample)

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([training_windows(text) for text in texts.to_pylist()], type=pa.list_(pa.string()))

    # At most ``sample`` numbers: a proven bound for the broadcast. Equal texts meet in partial aggregates.
    cut_rows = hashed.join(F.broadcast(chosen), "hash").select("hash", F.arrow_udf(cut, "array<string>")("text").alias("windows"))
    rows = materialize(cut_rows.groupBy("hash").agg(F.first("windows").alias("windows")).where("size(windows) > 0").withColumn(
        "shard", F.expr(f"pmod(hash, {SHARDS})")), "sample").repartition(SHARDS, "shard")  # small rows, much work: a task for each
    flat = None
    for _ in range(ROUNDS):

        def learn(key, table):
            texts = sorted(zip(table.column("hash").to_pylist(), table.column("windows").to_pylist(), strict=True))
            known = [example for place, (_, found) in enumerate(texts) for number, window in enumerate(found)
                     for example in examples(window, place + number)]
            better = improved(Field(flat), known, STEPS) if known else None
            return pa.table({"shard": pa.array([key[0].as_py()], type=pa.int64()), "n": pa.array([len(known)], type=pa.int64()),
                             "weights": pa.array([better], type=pa.list_(pa.float64()))})

        parts = rows.groupBy("shard").applyInArrow(learn, "shard long, n long, weights array<double>")
        parts = sorted((row for row in parts.collect() if row.n), key=lambda row: row.shard)  # one row for each shard
        if not parts:
            return None
        flat = np.average([row.weights for row in parts], axis=0, weights=[row.n for row in parts])
    return Field(flat)


def findings(docs: DataFrame, sample: int = SAMPLE, least: float = LEAST_CHANCE) -> DataFrame:
    """``docs`` with column findings: (kind, start, stop, base, chance) in code points, by start, then in the order of ``KINDS``.

    Null and empty texts have no findings, repeated rows the same ones; all columns of ``docs`` but one called
    findings are kept. Without any island to learn from, findings are those of the fixed patterns.
    """
    field = fit(docs.select("text"), sample)
    names = ["kind", "start", "stop", "base", "chance"]

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = pa.list_(pa.struct(list(zip(names, [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.float64()], strict=True))))
        for texts in batches:
            yield pa.array([[dict(zip(names, span, strict=True)) for span in entities(text, field, least)] if text else []
                            for text in texts.to_pylist()], type=kinds)

    kept = [F.col(f"`{name}`") for name in docs.columns if name.lower() != "findings"]
    return docs.select(*kept, F.arrow_udf(scan, FINDINGS)("text").alias("findings"))


def spans(found, base: bool | None = None):
    """kind:start:stop of the findings (of those by fixed patterns, or of the others), joined by commas."""
    chosen = found if base is None else F.filter(found, lambda part: part["base"] == base)
    return F.array_join(F.transform(chosen, lambda part: F.concat_ws(":", part["kind"], part["start"], part["stop"])), ",")


def count_of(found, kind: str):
    """The number of matches of a fixed pattern."""
    return F.size(F.filter(found, lambda part: (part["kind"] == kind) & part["base"])).cast("long")
