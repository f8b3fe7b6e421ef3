"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts and items are lower-cased (A to Z) and cut into words of digits, letters and all characters beyond ASCII. The
automaton holds every substring of every item; a text's words are streamed through it, and the longest match that
ends at each word is tracked. A match of ``window`` words, or of a whole item that has fewer, makes its words hit.

Only stretches whose adjacent word pairs all occur in some item can hold a match, and a hashed table of those pairs
finds the stretches in whole batches; the automaton walks over them alone.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigmart.llm.common import materialize

WINDOW = 13
BLOCK_WORDS = 200_000  # words of items in one automaton; more items are taken in blocks, one after the other
PAIR_BITS = 22
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
FOUND = "array<struct<start: int, stop: int>>"


def normal_words(text: bytes | None) -> list[bytes]:
    return WORD.findall((text or b"").lower())


class ItemAutomaton:
    """Generalised suffix automaton over word numbers; states are places in parallel lists."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.names = sorted({name for name, _ in items})
        self.vocabulary: dict[bytes, int] = {}
        self.next: dict[int, int] = {}
        self.length, self.link = [0], [-1]
        self._out: list[list[int]] = [[]]
        number = {name: place for place, name in enumerate(self.names)}
        holders: dict[int, set[int]] = {}
        short: dict[int, dict[int, set[int]]] = {}
        pairs, self.shortest = set(), window
        for name, found in items:
            if not found:
                continue
            self.shortest = min(self.shortest, len(found))
            ids = [self.vocabulary.setdefault(word, len(self.vocabulary)) for word in found]
            pairs.update(zip(ids, ids[1:]))
            state = 0
            for word in ids:
                state = self._extend(state, word)
        for name, found in items:
            state = 0
            for word in found:
                state = self.next[state << 32 | self.vocabulary[word]]
                holders.setdefault(state, set()).add(number[name])
            if 0 < len(found) < window:
                short.setdefault(state, {}).setdefault(len(found), set()).add(number[name])
        del self._out
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)
        for state in order:
            parent = self.link[state]
            if self.length[parent] >= window and state in holders:
                holders.setdefault(parent, set()).update(holders[state])
        # Of a match that ends in a state: the items that hold its last `window` words, and whole shorter items.
        self.items: list[frozenset[int]] = [frozenset()] * len(self.length)
        self.short: list[tuple[tuple[int, frozenset[int]], ...]] = [()] * len(self.length)
        for state in reversed(order):
            parent = self.link[state]
            if self.length[state] >= window:
                self.items[state] = self.items[parent] if self.length[parent] >= window else frozenset(holders.get(state, ()))
            own = tuple((size, frozenset(who)) for size, who in short.get(state, {}).items())
            self.short[state] = self.short[parent] + own
        self.pairs = np.zeros(1 << PAIR_BITS, dtype=bool)
        if pairs:
            left, right = np.array(sorted(pairs), dtype=np.int64).T
            self.pairs[self._slot(left, right)] = True

    @staticmethod
    def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return ((left * 0x9E3779B1 + right * 0x85EBCA77) >> 7) & ((1 << PAIR_BITS) - 1)

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append([])
        return len(self.length) - 1

    def _put(self, state: int, word: int, target: int) -> None:
        key = state << 32 | word
        if key not in self.next:
            self._out[state].append(word)
        self.next[key] = target

    def _split(self, state: int, word: int, target: int) -> int:
        """The state of the strings that end in ``word`` after ``state``; splits ``target`` if it holds longer ones."""
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1, self.link[target])
        for other in self._out[target]:
            self._put(clone, other, self.next[target << 32 | other])
        self.link[target] = clone
        while state >= 0 and self.next.get(state << 32 | word) == target:
            self.next[state << 32 | word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        known = self.next.get(last << 32 | word)
        if known is not None:
            return self._split(last, word, known)
        fresh = self._state(self.length[last] + 1, 0)
        state = last
        while state >= 0 and state << 32 | word not in self.next:
            self._put(state, word, fresh)
            state = self.link[state]
        if state >= 0:
            self.link[fresh] = self._split(state, word, self.next[state << 32 | word])
        return fresh

    def stretches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and stops of the stretches of word numbers (-1: unknown or end of text) that can hold a match."""
        known = ids >= 0
        if self.shortest > 1:
            known = known[:-1] & known[1:] & self.pairs[self._slot(ids[:-1], ids[1:])]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
        starts, stops = edges[::2], edges[1::2] + (self.shortest > 1)
        long = stops - starts >= self.shortest
        return starts[long], stops[long]

    def walk(self, ids: list[int], found: list[tuple[int, int]], names: set[int], base: int) -> None:
        """Add the hit intervals of one stretch, ``base`` words into its text, and the items concerned."""
        state = length = 0
        step, link, window = self.next, self.link, self.window
        for place, word in enumerate(ids, base + 1):
            target = step.get(state << 32 | word)
            while target is None and state:
                state = link[state]
                length = self.length[state]
                target = step.get(state << 32 | word)
            state, length = (0, 0) if target is None else (target, length + 1)
            reach = window if length >= window else 0
            if reach:
                names |= self.items[state]
            for size, who in self.short[state]:
                if size <= length:
                    names |= who
                    reach = max(reach, size)
            if reach:
                if found and found[-1][1] >= place - reach:
                    start = found.pop()[0]
                    while found and found[-1][1] >= min(start, place - reach):
                        start = min(start, found.pop()[0])
                    found.append((min(start, place - reach), place))
                else:
                    found.append((place - reach, place))


def _merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _scan(docs: DataFrame, automaton: ItemAutomaton) -> DataFrame:
    """Adds what one block of items hits to the columns n_words, spans and items of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(automaton))
    schema = docs.schema

    def scan(batches):
        import pyarrow as pa

        one = pickle.loads(shared.value)
        number, names = one.vocabulary.get, one.names
        for batch in batches:
            texts = [normal_words(text) for text in batch.column("scanned").to_pylist()]
            counts = np.array([len(found) for found in texts], dtype=np.int64)
            spans = [[(x["start"], x["stop"]) for x in row] for row in batch.column("spans").to_pylist()]
            items = [set(row) for row in batch.column("items").to_pylist()]
            ids = np.full(int(counts.sum()) + len(texts) + 1, -1, dtype=np.int64)
            begins, at = [], 0
            for found in texts:
                ids[at:at + len(found)] = np.fromiter((number(word, -1) for word in found), dtype=np.int64, count=len(found))
                begins.append(at)
                at += len(found) + 1
            starts, stops = one.stretches(ids)
            owners = np.searchsorted(np.array(begins), starts, side="right") - 1 if len(starts) else starts
            for owner, start, stop in zip(owners.tolist(), starts.tolist(), stops.tolist(), strict=True):
                hit: set[int] = set()
                fresh: list[tuple[int, int]] = []
                one.walk(ids[start:stop].tolist(), fresh, hit, start - begins[owner])
                if fresh:
                    spans[owner] = _merged(spans[owner] + fresh)
                    items[owner] |= {names[place] for place in hit}
            replaced = {
                "n_words": pa.array(counts, type=pa.int64()),
                "spans": pa.array([[{"start": a, "stop": b} for a, b in row] for row in spans],
                                  type=pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                "items": pa.array([sorted(row) for row in items], type=pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays(
                [replaced.get(name, batch.column(name)) for name in batch.schema.names], batch.schema.names)

    return docs.mapInArrow(scan, schema)


def item_blocks(benchmark: DataFrame, window: int, block_words: int = BLOCK_WORDS):
    """Automata over blocks of at most ``block_words`` words (one item at least), items streamed to the driver.

    Items with a null text or no words have no windows; a null item_id is read as an empty name.
    """
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                            F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")
    for row in rows.toLocalIterator():
        found = normal_words(bytes(row.text))
        if block and size + len(found) > block_words:
            yield ItemAutomaton(block, window)
            block, size = [], 0
        block.append((row.item_id, found))
        size += len(found)
    yield ItemAutomaton(block, window)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
            text: str = "text") -> DataFrame:
    """``docs`` with n_words, spans (hit word intervals, merged, stop exclusive) and items (item ids, sorted).

    Every column of ``docs`` is kept unless it has one of those names or is called scanned. Null and empty texts have no words and no
    hits; repeated documents and items are judged alike, and an item id counts once. An empty benchmark hits nothing.
    """
    kept = [F.col(f"`{name}`") for name in docs.columns if name.lower() not in ("n_words", "spans", "items", "scanned")]
    current = docs.select(*kept, F.col(text).cast("binary").alias("scanned"), F.lit(0).cast("long").alias("n_words"),
                          F.array().cast(FOUND).alias("spans"), F.array().cast("array<string>").alias("items"))
    current = current.sparkSession.createDataFrame([], current.schema).unionAll(current)  # all columns nullable
    first = True
    for automaton in item_blocks(benchmark, window, block_words):
        current = _scan(current if first else materialize(current, "matches"), automaton)
        first = False
    return current.drop("scanned")


def judged(found: DataFrame) -> DataFrame:
    """``found`` of :func:`matches` with n_hit, n_items and contaminated (a twentieth of the words or more is hit)."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["stop"] - span["start"])
    return found.withColumn("n_hit", hit).withColumn("n_items", F.size("items").cast("long")).withColumn(
        "contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def cut_spans(found: DataFrame, longest: int, text: str = "text") -> DataFrame:
    """``found`` with column ``text`` free of the hit intervals of more than ``longest`` words, whatever their share."""
    name_of_text = text

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(name_of_text).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                far = [span for span in spans if span["stop"] - span["start"] > longest]
                if far:
                    raw = text.encode()
                    places = [word.span() for word in WORD.finditer(raw.lower())]
                    for span in reversed(far):
                        raw = raw[:places[span["start"]][0]] + raw[places[span["stop"] - 1][1]:]
                    text = raw.decode()
                texts.append(text)
            columns = [pa.array(texts, type=pa.string()) if name == name_of_text else batch.column(name)
                       for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return found.mapInArrow(cut, found.schema)


def items_digest(items):
    return F.sha2(F.array_join(items, ","), 256)


__all__ = ["ItemAutomaton", "cut_spans", "items_digest", "judged", "matches"]
